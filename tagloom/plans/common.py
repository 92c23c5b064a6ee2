"""What the query plans share: synthetic sequences that any SQL engine can make, too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = "0123456789abcdef"


def dna(key: Column, n: int = 20, letters: str = "ACGTACGTACGTACGT") -> Column:
    """A pseudo-random sequence of up to 32 letters made from a key."""
    return F.translate(F.substring(F.md5(key.cast("string")), 1, n), DIGITS, letters)


def dna_sql(key: str, n: int = 20, letters: str = "ACGTACGTACGTACGT") -> str:
    """The same as SQL text."""
    return f"translate(substr(md5(CAST({key} AS VARCHAR)),1,{n}),'{DIGITS}','{letters}')"
