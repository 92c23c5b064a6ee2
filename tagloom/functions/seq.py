"""Sequence functions as column expressions: they stay in generated code and push down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters and their complements (RNA's U pairs with A).
COMPLEMENT = ("ATUGCatugc", "TAACGtaacg")
#: Bases that each ambiguity letter stands for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


def reverse_complement(seq: Column) -> Column:
    """Reverse complement, case kept; letters that aren't bases stay as they are."""
    return F.translate(F.reverse(seq), *COMPLEMENT)


def only_bases(seq: Column) -> Column:
    """Letters other than A, C, G, T become N."""
    return F.regexp_replace(seq, "[^ACGT]", "N")


def hamming(a: Column, b: Column) -> Column:
    """Positions at which two texts differ, over the shorter one's length."""
    n = F.least(F.length(a), F.length(b))
    differing = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    return F.when(n == 0, 0).otherwise(F.size(differing))


def hamming_to(seq: Column, word: str) -> Column:
    """Differences to a constant word, position by position; missing letters differ."""
    parts = [F.when(F.substring(seq, i + 1, 1) != c, 1).otherwise(0) for i, c in enumerate(word)]
    out = F.lit(0)
    for part in parts:
        out = out + part
    return out


def iupac_mismatches(seq: Column, at: Column, pattern: str) -> Column:
    """Mismatches of a pattern with ambiguity letters at a 0-based position; letters beyond the end mismatch."""
    out = F.lit(0)
    for i, c in enumerate(pattern):
        base = F.substring(seq, at + F.lit(i + 1), F.lit(1))
        out = out + F.when(base.isin(*IUPAC.get(c, c)), 0).otherwise(1)
    return out


def edit_within(a: Column, b: Column, k: int) -> Column:
    """Edit distance if it is at most ``k``, else -1."""
    return F.levenshtein(a, b, k)


def trimers(seq: Column) -> Column:
    """All overlapping words of three letters."""
    n = F.length(seq) - 2
    return F.when(n < 1, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(seq, i, F.lit(3))))


def trimer_distance(a: Column, b: Column) -> Column:
    """L1 distance of the trimer counts of two sequences."""
    ta, tb = trimers(a), trimers(b)
    count = lambda words, w: F.size(F.filter(words, lambda x: x == w))
    return F.aggregate(F.array_distinct(F.concat(ta, tb)), F.lit(0), lambda acc, w: acc + F.abs(count(ta, w) - count(tb, w)))


def cigar_length(cigar: Column, operations: str) -> Column:
    """Total length of the given operations of an alignment string (0 if there is none)."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{operations}]"), F.lit(1)), F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint"))


def reference_span(cigar: Column) -> Column:
    return cigar_length(cigar, "MDN=X")


def read_span(cigar: Column) -> Column:
    return cigar_length(cigar, "MIS=X")


def match_span(cigar: Column) -> Column:
    return cigar_length(cigar, "M")


def trailing_run(seq: Column, letter: str, most: int = 20) -> Column:
    """Length of the run of a letter at the end, at most ``most``."""
    return F.least(F.length(F.regexp_extract(seq, f"{letter}*$", 0)), F.lit(most))


def strip_trailing_homopolymer(seq: Column, letters: str = "TGC") -> Column:
    """A sequence without the run of one of ``letters`` that it ends with."""
    return F.regexp_replace(seq, "(" + "|".join(f"{c}+" for c in letters) + ")$", "")


def count_letter(seq: Column, letter: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))


def count_phred(qual: Column, least: int, start: Column, length: int) -> Column:
    """Positions in [start, start + length) whose quality (Phred+33) is at least ``least``."""
    return F.length(F.regexp_replace(F.substring(qual, start + 1, F.lit(length)), f"[^\\x{33 + least:02x}-\\x7e]", ""))


def ranges_of(seq: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """Concatenation of (1-based first, last) ranges."""
    return F.concat(*[F.substring(seq, a, b - a + 1) for a, b in ranges])


def rolling_hash(seq: Column, letters: int = 30) -> Column:
    """A 63-bit hash of a text's first letters: three bits of each letter's code are shifted
    in, crossed with the three that leave at the top. Null for null."""
    code = lambda i: F.ascii(F.substring(seq, i, F.lit(1))).cast("bigint").bitwiseAND(F.lit(7))
    fold = lambda v, i: F.shiftleft(v, 3).bitwiseOR(code(i).bitwiseXOR(F.shiftright(v, 60))).bitwiseAND(F.lit((1 << 63) - 1))
    n = F.least(F.length(seq), F.lit(letters))
    return F.when(n == 0, F.lit(0).cast("bigint")).when(n > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0).cast("bigint"), fold))


def read_name(tile: Column, cluster: Column) -> Column:
    return F.format_string("%s:%08d", tile, cluster.cast("bigint"))


def verbose_name(tile: Column, cluster: Column, flags: Column, clones: Column, length: Column, mods: Column) -> Column:
    """tile:cluster:flags:clones:length:modifications, the flags as four hex digits."""
    return F.format_string("%s:%08d:%04x:%d:%d:%s", tile, cluster.cast("bigint"), flags.cast("int"), clones.cast("int"), length.cast("int"), mods)


def without_version(name: Column) -> Column:
    """What stands before the first dot."""
    return F.split_part(name, F.lit("."), F.lit(1))


def quoted_attribute(text: Column, name: str) -> Column:
    """Value of name "value" in an attribute field; '' if it isn't there."""
    return F.regexp_extract(text, f'{name} "([^"]+)"', 1)
