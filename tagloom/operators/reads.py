"""Per-read operators: sample assignment, filters, delimiter search, best segment.

All but the best segment are column expressions over one row, so they run inside the
scan's generated code; the best segment is a vectorised Arrow function that scores a
whole batch of reads at once from prefix sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.functions.flags import FLAGS


@dataclass(frozen=True)
class Sample:
    """One row of the sample dimension."""

    name: str
    index: str
    max_index_mm: int = 1
    fingerprint: str = ""
    fingerprint_pos: int = 0
    max_fp_mm: int = 1
    delimiter: str = ""
    delimiter_pos: int = 0
    max_delim_mm: int = 1


def assign_sample(index: Column, samples: Sequence[Sample]) -> Column:
    """struct(sample, mismatches) of the sample whose index is nearest by Hamming distance.

    Two samples equally near, or the nearest beyond its own limit, leave the read
    unassigned (null sample, mismatches -1). The samples are literals of the plan, so no
    join takes place; there are as many terms as samples. A null index is unassigned.
    """
    found = [F.struct(S.hamming_to(index, s.index).alias("mm"), F.lit(s.name).alias("sample"), F.lit(s.max_index_mm).alias("most")) for s in samples]
    near = F.array_sort(F.array(*found))
    best = F.get(near, F.lit(0))
    tie = F.coalesce(F.get(near, F.lit(1))["mm"] == best["mm"], F.lit(False))
    ok = index.isNotNull() & ~tie & (best["mm"] <= best["most"])
    return F.struct(F.when(ok, best["sample"]).alias("sample"), F.when(ok, best["mm"]).otherwise(-1).alias("mismatches"))


def demultiplex(df: DataFrame, index: str, samples: Sequence[Sample], control: Column | None = None, flags: str | None = None) -> DataFrame:
    """Adds sample and mismatches; unassigned reads become 'PhiX' where ``control`` holds, else 'Unknown'.

    With ``flags`` the barcode-mismatch bit is set on reads with mismatches.
    """
    a = assign_sample(F.col(f"`{index}`"), samples)
    out = df.withColumn("__a", a)
    other = F.when(F.coalesce(control, F.lit(False)), "PhiX").otherwise("Unknown") if control is not None else F.lit("Unknown")
    out = out.withColumn("sample", F.coalesce("__a.sample", other)).withColumn("mismatches", F.col("__a.mismatches")).drop("__a")
    if flags:
        out = out.withColumn(flags, F.when(F.col("mismatches") > 0, F.col(f"`{flags}`").bitwiseOR(F.lit(FLAGS["barcode_mismatch"]))).otherwise(F.col(f"`{flags}`")))
    return out


def demux_counters(df: DataFrame, by: Sequence[str], fingerprint_ok: Column, quality_ok: Column, delimiter_ok: Column) -> DataFrame:
    """Reads per group: without, with one and with more index mismatches, and what each filter drops.

    Unassigned reads have mismatches -1 and count among those without.
    """
    passed = fingerprint_ok & quality_ok & delimiter_ok
    n = lambda c: F.count_if(c)
    return df.groupBy(*by).agg(
        n(F.col("mismatches") <= 0).alias("cln_no_index_mm"),
        n(F.col("mismatches") == 1).alias("cln_1_index_mm"),
        n(F.col("mismatches") > 1).alias("cln_2_index_mm"),
        n(~fingerprint_ok).alias("cln_fp_mm"),
        n(fingerprint_ok & ~quality_ok).alias("cln_qc_fail"),
        n(fingerprint_ok & quality_ok & ~delimiter_ok).alias("cln_no_delim"),
        n(passed).alias("cln_passed"),
    )


def with_totals(counts: DataFrame, key: str, detail: str, sums: Sequence[str], label: str = "(total)") -> DataFrame:
    """Per-key totals over all values of ``detail`` beside the detail rows."""
    sets = counts.groupingSets([[F.col(key)], [F.col(key), F.col(detail)]], F.col(key), F.col(detail))
    out = sets.agg(F.grouping(detail).alias("__g"), *[F.sum(c).alias(c) for c in sums])
    return out.withColumn(detail, F.when(F.col("__g") == 1, F.lit(label)).otherwise(F.col(detail))).drop("__g")


def fixed_sequence_ok(seq: Column, word: str, start: int, most: int) -> Column:
    """Whether a fixed sequence (0-based start) is there with at most ``most`` mismatches."""
    return S.hamming_to(F.substring(seq, start + 1, len(word)), word) <= most


def quality_ok(qual: Column, start: int, length: int, least: int = 25, fraction: float = 0.7) -> Column:
    """Whether enough positions of [start, start + length) have the least quality."""
    return S.count_phred(qual, least, F.lit(start), length) >= int(length * fraction)


def find_delimiter(seq: Column, delimiter: str, at: Column, most: int) -> Column:
    """struct(end, flags) of a delimiter expected at a 0-based position.

    The position itself is tried first, then one before, then one after; the first
    with at most ``most`` mismatches (ambiguity letters match what they stand for)
    wins. end is -1 if none does, and the flags tell mismatches, shift or absence.
    """
    n = len(delimiter)
    out = F.struct(F.lit(-1).alias("end"), F.lit(FLAGS["no_delimiter"]).alias("flags"))
    for offset in (1, -1, 0):
        mm = S.iupac_mismatches(seq, at + offset, delimiter)
        fits = (mm <= most) & (at + offset >= 0)
        bits = F.when(mm > 0, FLAGS["delimiter_mismatch"]).otherwise(0) + F.lit(FLAGS["delimiter_shifted"] if offset else 0)
        out = F.when(fits, F.struct((at + offset + n).cast("int").alias("end"), bits.cast("int").alias("flags"))).otherwise(out)
    return out


def composition_ok(seq: Column, least: int = 2) -> Column:
    """Whether each base occurs at least ``least`` times."""
    out = S.count_letter(seq, "A") >= least
    for base in "CGT":
        out = out & (S.count_letter(seq, base) >= least)
    return out


def dark_flags(flags: Column, dark: Column, most: int = 5) -> Column:
    """Flags with the bits for any dark cycle and for too many of them."""
    some = F.when(dark >= 1, F.lit(FLAGS["dark_cycle"])).otherwise(0)
    many = F.when(dark >= most, F.lit(FLAGS["dark_over_threshold"])).otherwise(0)
    return flags.bitwiseOR(some).bitwiseOR(many)


#: Scores of the letters in the segment and before it (reads are antisense: T is tail).
TAIL_SCORES = {"T": 2, "A": -9, "C": -9, "G": -9, "N": -1}
HEAD_SCORES = {"T": -1, "A": 0, "C": -4, "G": -4, "N": 0}


def best_segments(texts: list[str | None], tail: dict[str, int], head: dict[str, int], least: int, most_before: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the best segment of each text, (-1, -1) where there is none.

    The score of [i, j] is the head score of what precedes i plus the tail score of the
    segment; of equal scores the first by i, then j, counts; a score below 1 is none.
    """
    n = len(texts)
    lengths = np.array([len(t) if t else 0 for t in texts], dtype=np.int64)
    starts, ends = np.full(n, -1), np.full(n, -1)
    table_t, table_h = np.full(256, tail.get("N", -1)), np.full(256, head.get("N", 0))
    for c, w in tail.items():
        table_t[ord(c)] = w
    for c, w in head.items():
        table_h[ord(c)] = w
    for size in np.unique(lengths):
        if size < least:
            continue
        at = np.flatnonzero(lengths == size)
        for part in np.array_split(at, max(1, len(at) * size // 8_000_000)):
            codes = np.frombuffer("".join([texts[i] for i in part]).encode("latin-1", "replace"), dtype=np.uint8).reshape(len(part), size)
            p = np.zeros((len(part), size + 1), dtype=np.int64)
            np.cumsum(table_t[codes], axis=1, out=p[:, 1:])
            h = np.zeros((len(part), size + 1), dtype=np.int64)
            np.cumsum(table_h[codes], axis=1, out=h[:, 1:])
            # suffix maximum of p and the first place where it is reached
            rev = np.maximum.accumulate(p[:, ::-1], axis=1)[:, ::-1]
            best = np.zeros(len(part), dtype=np.int64)
            s, e = np.full(len(part), -1), np.full(len(part), -1)
            for i in range(min(most_before, size)):
                if i + least > size:
                    break
                top = rev[:, i + least]
                score = h[:, i] - p[:, i] + top
                better = score > best
                if better.any():
                    rows = np.flatnonzero(better)
                    best[rows], s[rows] = score[rows], i
                    e[rows] = i + least + np.argmax(p[rows, i + least :] == top[rows, None], axis=1)
            starts[part], ends[part] = s, e
    return starts, ends


def best_segment(seq: Column, tail: dict[str, int] | None = None, head: dict[str, int] | None = None, least: int = 5, most_before: int = 20) -> Column:
    """struct(start, end) of the best tail segment, null where there is none or the sequence is null."""
    tail, head = dict(tail or TAIL_SCORES), dict(head or HEAD_SCORES)

    @F.pandas_udf("start int, end int")
    def run(column: pd.Series) -> pd.DataFrame:
        starts, ends = best_segments(column.where(column.notna(), None).tolist(), tail, head, least, most_before)
        return pd.DataFrame({"start": starts.astype("int32"), "end": ends.astype("int32")})

    out = run(seq)
    return F.when(out["start"] >= 0, out)


def modification(seq: Column, delimiter_end: Column, start: Column) -> Column:
    """Reverse complement of the bases between delimiter and tail; what isn't a base is N."""
    return S.reverse_complement(S.only_bases(F.substring(seq, delimiter_end + F.lit(1), start)))


def segment_flags(flags: Column, start: Column, length: Column) -> Column:
    """Flags with the bits for a found tail and for bases before it."""
    return flags.bitwiseOR(F.when(length > 0, F.lit(FLAGS["polya_detected"])).otherwise(0)).bitwiseOR(F.when(start > 0, F.lit(FLAGS["has_modification"])).otherwise(0))


def tail_bases(cigar: Column, reverse: Column, seq: Column, ref: Column, width: int = 2) -> Column:
    """Bases that the template doesn't explain, at the 3' end of the RNA.

    For a reverse-mapped read the RNA is on the + strand: its soft-clipped end, longer if
    one of the last ``width`` matched bases differs from the reference window ``ref``
    that ends there. For a forward-mapped read it is the mirror image: the clipped start,
    the window that begins at the alignment, and the reverse complement of the result.
    """
    clip_end = F.coalesce(F.regexp_extract(cigar, r"(\d+)S$", 1).try_cast("int"), F.lit(0))
    clip_start = F.coalesce(F.regexp_extract(cigar, r"^(\d+)S", 1).try_cast("int"), F.lit(0))
    # both cases looked at in the RNA's direction
    sense = F.when(reverse, seq).otherwise(S.reverse_complement(seq))
    window = F.when(reverse, ref).otherwise(S.reverse_complement(ref))
    clip = F.when(reverse, clip_end).otherwise(clip_start)
    n = F.length(sense)
    again = F.lit(0)
    for i in reversed(range(width)):
        mine = F.substring(sense, n - clip - (width - i) + 1, F.lit(1))
        again = F.when(mine != F.substring(window, i + 1, 1), width - i).otherwise(again)
    return F.substring(sense, n - clip - again + 1, clip + again)


def reevaluated_tail(length: Column, bases: Column, required: Sequence[int], keep_over: int = 7, rescue: int = 3) -> Column:
    """Tail length from the non-templated bases, for tails of at most ``keep_over``.

    The run of T, G or C at the end is left out; the As of the rest count if they are as
    many as ``required`` for its length, else only a run of As at the end of at least
    ``rescue``, else nothing.
    """
    body = S.strip_trailing_homopolymer(bases)
    n, a = F.length(body), S.count_letter(body, "A")
    need = F.get(F.array(*[F.lit(x) for x in required]), n)
    run = F.length(F.regexp_extract(body, "A*$", 0))
    new = F.when(n == 0, 0).when(a >= F.coalesce(need, F.lit(len(required))), a).when(run >= rescue, run).otherwise(0)
    return F.when(length > keep_over, length).otherwise(new)


def has_chimera(left: DataFrame, right: DataFrame, key: str, place: str, pos: str, within: int) -> DataFrame:
    """Rows of ``left`` none of whose key's rows is near one of ``right`` at the same place.

    An equi-join on key and place; only rows of one read meet.
    """
    l, r = left.alias("l"), right.alias("r")
    near = l.join(r, (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col(f"l.{place}") == F.col(f"r.{place}")) & (F.abs(F.col(f"l.{pos}") - F.col(f"r.{pos}")) < within), "left_semi").select(key)
    both = left.join(right.select(key), key, "left_semi")
    return both.join(near.distinct(), key, "left_anti")
