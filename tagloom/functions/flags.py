"""Bit flags of reads: tests, masks and the priority score of duplicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The bits of the flag field.
FLAGS = {
    "polya_detected": 1,
    "delimiter_mismatch": 2,
    "has_modification": 4,
    "by_fluorescence": 8,
    "barcode_mismatch": 16,
    "delimiter_shifted": 32,
    "dark_cycle": 64,
    "no_delimiter": 128,
    "bad_quality": 256,
    "biased": 512,
    "bad_signal": 1024,
    "dark_over_threshold": 2048,
    "chimeric": 4096,
    "intact_end": 8192,
}
#: Reads with any of these bits aren't counted.
BAD_FLAGS = 8064

#: Weight, flag and whether it counts when set or when clear.
PRIORITY = (
    (1024, "barcode_mismatch", False),
    (512, "no_delimiter", False),
    (256, "delimiter_mismatch", False),
    (128, "by_fluorescence", True),
    (64, "dark_over_threshold", False),
    (32, "biased", False),
    (16, "bad_signal", False),
    (8, "dark_cycle", False),
    (4, "delimiter_shifted", False),
    (2, "polya_detected", True),
)


def has_any(flags: Column, mask: int) -> Column:
    """Whether any bit of the mask is set; null for null flags."""
    return flags.bitwiseAND(F.lit(mask)) != 0


def passes(flags: Column, mask: int = BAD_FLAGS) -> Column:
    """Whether no bit of the mask is set."""
    return flags.bitwiseAND(F.lit(mask)) == 0


def with_flag(flags: Column, name: str) -> Column:
    """The flags with one more bit set; setting it again changes nothing."""
    return flags.bitwiseOR(F.lit(FLAGS[name]))


def priority_score(flags: Column) -> Column:
    """How good a read is among its duplicates: a weighted sum of ten flag tests."""
    parts = [F.when(has_any(flags, FLAGS[name]) == F.lit(when_set), weight).otherwise(0) for weight, name, when_set in PRIORITY]
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return F.when(flags.isNotNull(), out)


def intact_end(length: Column, flags: Column, least: int = 5) -> Column:
    """A 3' end is intact if its tail is long enough or it was found at a known site."""
    return (length >= least) | has_any(flags, FLAGS["intact_end"])
