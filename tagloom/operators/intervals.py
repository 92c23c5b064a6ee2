"""Intervals: arithmetic, merging, overlap joins.

Intervals are 0-based and half-open. Joins by overlap are equi-joins on bins: each
interval is listed under the bins it touches, a pair is only kept in the first bin that
both share. An interval's number of bins is bounded by choosing the bin width from
its length class, so that a few very long intervals don't multiply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bin widths are powers of BASE: an interval lies in the widest class whose bins it spans at most two of.
SMALLEST, BASE, CLASSES = 1024, 8, 9


def flipped(strand: Column) -> Column:
    return F.when(strand == "+", "-").when(strand == "-", "+").otherwise(strand)


def flank_after(start: Column, end: Column, strand: Column, size: int = 1) -> tuple[Column, Column]:
    """The ``size`` bases downstream of an interval, by its strand."""
    plus = strand != "-"
    return F.when(plus, end).otherwise(start - size), F.when(plus, end + size).otherwise(start)


def slop(start: Column, end: Column, strand: Column, upstream: int, downstream: int, size: Column | None = None) -> tuple[Column, Column]:
    """An interval widened up- and downstream by its strand, clamped to [0, size)."""
    plus = strand != "-"
    lo = start - F.when(plus, upstream).otherwise(downstream)
    hi = end + F.when(plus, downstream).otherwise(upstream)
    lo = F.greatest(lo, F.lit(0))
    return (lo, hi) if size is None else (lo, F.least(hi, size))


def terminal_base(start: Column, end: Column, strand: Column) -> tuple[Column, Column]:
    """The last base of an RNA's interval: the base before its 1-base downstream flank."""
    a, b = flank_after(start, end, strand, 1)
    plus = strand != "-"
    return F.when(plus, a - 1).otherwise(a + 1), F.when(plus, b - 1).otherwise(b + 1)


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: int = 0, stretch: int = 1 << 22) -> DataFrame:
    """Overlapping or book-ended (or at most ``gap`` apart) intervals of a key merged to one.

    Intervals are merged within stretches of places. What reaches over a stretch's end is
    carried as one number per stretch, the farthest end so far, so that no window spans
    the intervals of a whole key. n counts the merged ones. Empty or reversed intervals
    are left out.
    """
    # one struct as key: null parts are equal in it, and the join below keeps the partitioning
    rows = df.select(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).alias("__k"), F.col(f"`{start}`").cast("bigint").alias("start"), F.col(f"`{end}`").cast("bigint").alias("end")).filter("start < end")
    rows = rows.withColumn("__s", F.floor(F.col("start") / stretch)).groupBy("__k", "__s", "start", "end").agg(F.count("*").alias("n"))  # equal intervals would have no order
    w = W.partitionBy("__k", "__s").orderBy("start", "end")
    far = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    marked = rows.withColumn("__new", F.when(far.isNull() | (F.col("start") > far + gap), 1).otherwise(0)).withColumn("__i", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    near = marked.groupBy("__k", "__s", "__i").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
    # per stretch, a row each: the farthest end before it, and where the last interval that was begun before it starts
    before = W.partitionBy("__k").orderBy("__s").rowsBetween(W.unboundedPreceding, -1)
    ends = near.groupBy("__k", "__s").agg(F.max("end").alias("__far"), F.max("start").alias("__last")).withColumn("__carry", F.max("__far").over(before))
    begun = F.when(F.col("__carry").isNull() | (F.col("__last") > F.col("__carry") + gap), F.col("__last"))
    ends = ends.withColumn("__open", F.last(begun, True).over(before)).filter("__carry IS NOT NULL").select("__k", "__s", "__carry", "__open")
    # what starts within reach of the end carried in goes on with the interval that was open there
    goes_on = F.coalesce(F.col("start") <= F.col("__carry") + gap, F.lit(False))
    met = near.join(ends, ["__k", "__s"], "left").withColumn("__g", F.when(goes_on, F.col("__open")).otherwise(F.col("start")))
    out = met.groupBy("__k", "__g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
    return out.select(*[F.col(f"__k.k{i}").alias(k) for i, k in enumerate(keys)], "start", "end", "n")


def group_consecutive(df: DataFrame, keys: Sequence[str], value: str, width: int = 1, stretch: int = 1 << 16) -> DataFrame:
    """Runs of whole values that follow each other at steps of at most ``width``: first, last, n distinct values.

    As intervals [v, v + 1) at most ``width - 1`` apart, merged by stretches.
    """
    rows = df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{value}`").alias("__v")).filter("__v IS NOT NULL").distinct()
    kind = df.schema[value].dataType
    out = merge_intervals(rows.withColumn("__w", F.col("__v") + 1), keys, "__v", "__w", width - 1, stretch)
    return out.select(*[F.col(f"`{k}`") for k in keys], F.col("start").cast(kind).alias("first"), (F.col("end") - 1).cast(kind).alias("last"), "n")


def aligned_blocks(start: Column, cigar: Column) -> Column:
    """array<struct<start, end>> of the parts of an alignment between its N gaps, 0-based.

    M, D, = and X reach over the reference, I, S, H and P don't. A part without reference
    is left out; null or empty alignments have none.
    """
    steps = F.regexp_extract_all(cigar, F.lit("[0-9]+[MDNX=]"), F.lit(0))

    def walk(acc: Column, step: Column) -> Column:
        n = F.substring(step, F.lit(1), F.length(step) - 1).cast("bigint")
        skips = F.endswith(step, F.lit("N"))
        # the open part is [s, at): a gap closes it
        closed = F.when(skips & (acc["at"] > acc["s"]), F.concat(acc["done"], F.array(F.struct(acc["s"].alias("start"), acc["at"].alias("end"))))).otherwise(acc["done"])
        return F.struct(closed.alias("done"), F.when(skips, acc["at"] + n).otherwise(acc["s"]).alias("s"), (acc["at"] + n).alias("at"))

    def finish(acc: Column) -> Column:
        return F.when(acc["at"] > acc["s"], F.concat(acc["done"], F.array(F.struct(acc["s"].alias("start"), acc["at"].alias("end"))))).otherwise(acc["done"])

    first = start.cast("bigint")
    begin = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done"), first.alias("s"), first.alias("at"))
    return F.aggregate(steps, begin, walk, finish)


def block_overlap_join(reads: DataFrame, features: DataFrame, keys: Sequence[str], read: Sequence[str], start: str, cigar: str, columns: Sequence[str]) -> DataFrame:
    """Distinct (``read`` columns, ``columns`` of the features) of spliced reads and the features that one of their
    parts overlaps: a feature inside a read's gap isn't met. Features have start and end."""
    parts = reads.select(*keys, *read, F.explode(aligned_blocks(F.col(f"`{start}`"), F.col(f"`{cigar}`"))).alias("__b")).select(*keys, *read, "__b.start", "__b.end")
    out = overlap_join(parts, features.select(*keys, *columns, "start", "end"), keys)
    return out.select(*read, *[F.col(f"`{c}_r`").alias(c) for c in columns]).distinct()


def _level(start: Column, end: Column) -> Column:
    """An interval's length class."""
    length = F.greatest(end - start, F.lit(1))
    level = F.lit(CLASSES - 1)
    for k in reversed(range(CLASSES - 1)):
        level = F.when(length <= SMALLEST * BASE**k, k).otherwise(level)
    return level


def _listed(start: Column, end: Column, levels: Sequence[int]) -> Column:
    """(level, bin) of the bins that an interval touches in its own and all wider classes."""
    own, last = _level(start, end), F.greatest(end - 1, start)

    def at(k: int) -> Column:
        size = SMALLEST * BASE**k
        bins = F.transform(F.sequence(F.floor(start / size), F.floor(last / size)), lambda b: F.struct(F.lit(k).alias("l"), b.alias("b")))
        return F.when(own <= k, bins).otherwise(F.array().cast("array<struct<l:int,b:bigint>>"))

    return F.concat(*[at(k) for k in levels])


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], span: Sequence[str] = ("start", "end"), how: str = "inner") -> DataFrame:
    """Pairs of overlapping intervals with equal keys; right columns get the suffix _r.

    Every interval is listed in the bins of its own length class and of the wider ones
    that occur, in each at most two (the widest class excepted); a pair meets in the
    class of the longer of both, in the first bin that they share. ``how`` is inner,
    left_semi or left_anti (rows of ``left``, each once). Null keys or bounds match
    nothing.
    """
    s, e = span
    lo, hi = F.col(f"`{s}`"), F.col(f"`{e}`")
    bounded = lambda df: df.filter(lo.isNotNull() & hi.isNotNull())
    # the classes that occur: at most CLASSES numbers
    levels = sorted(row[0] for row in bounded(left).select(_level(lo, hi)).union(bounded(right).select(_level(lo, hi))).distinct().collect()) or [0]
    names = {c: f"{c}_r" for c in right.columns}
    r = bounded(right).withColumn("__k", _level(lo, hi)).withColumn("__p", F.explode(_listed(lo, hi, levels)))
    r = r.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col("__k").alias("__k_r"), F.col("__p").alias("__p_r"))
    l = bounded(left).withColumn("__k", _level(lo, hi)).withColumn("__p", F.explode(_listed(lo, hi, levels)))
    same = F.col("__p") == F.col("__p_r")
    for k in keys:
        same = same & (F.col(f"`{k}`") == F.col(names[k]))
    meet = F.col("__p.l") == F.greatest("__k", "__k_r")
    overlap = (lo < F.col(names[e])) & (F.col(names[s]) < hi)
    if how == "inner":
        width = F.element_at(F.array(*[F.lit(SMALLEST * BASE**k).cast("bigint") for k in range(CLASSES)]), F.col("__p.l") + 1)
        first = F.col("__p.b") == F.floor(F.greatest(lo, F.col(names[s])) / width)
        return l.join(r, same & meet & overlap & first).drop("__p", "__k", "__k_r", "__p_r")
    hit = l.select(*[F.col(f"`{k}`") for k in keys], lo, hi, "__k", "__p").join(r, same & meet & overlap, "left_semi").select(*keys, s, e).distinct()
    # rows with the same key and bounds are alike to the join
    return left.join(hit, [*keys, s, e], how)
