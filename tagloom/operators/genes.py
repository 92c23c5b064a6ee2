"""Gene-level analytics: ambiguity, count cubes, window counts, wide statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import flags as FL
from tagloom.functions import seq as S
from tagloom.operators.wstats import interval_of_sums, weighted_quantiles

#: The length windows (from, up to but not including).
LENGTH_WINDOWS = ((0, 1), (1, 4), (1, 6), (1, 16), (5, 11), (5, 16), (5, 26), (8, 16), (8, 26), (16, 26), (26, 41), (41, 100))


def ambiguity(pairs: DataFrame, read: Sequence[str], gene: str) -> DataFrame:
    """Distinct (read, gene) pairs with the number of genes that the read has.

    The count is a partial aggregate joined back, not a window, so that reads spread
    freely over tasks. Null genes aren't pairs.
    """
    p = pairs.select(*[F.col(f"`{r}`") for r in read], F.col(f"`{gene}`")).filter(F.col(f"`{gene}`").isNotNull()).distinct()
    n = p.groupBy(*read).agg(F.count("*").cast("int").alias("ambig"))
    return p.join(n, list(read))


def refined(length: str, mods: str, other_length: str, other_mods: str) -> tuple[Column, Column]:
    """Length and modifications, replaced by the unaligned ones where these have
    modifications and no length was found."""
    use = (F.col(other_mods) != "") & (F.col(length) <= 0)
    return F.when(use, F.col(other_length)).otherwise(F.col(length)), F.when(use, F.col(other_mods)).otherwise(F.col(mods))


def count_cube(tags: DataFrame, gene: str, length: str, mods: str, flags: str, letters: str = "TGC", most: int = 232, most_mods: int = 20, intact: int = 5, short: int = 4) -> DataFrame:
    """(gene, modtype, tailtype, length, modcount, n): a sparse count cube in one pass.

    Each passing read counts once per modification type, in the cube of intact
    (canonical) or of other ends; lengths outside 0..most (0..short) are dropped.
    """
    c = lambda x: F.col(f"`{x}`")
    rows = tags.filter(FL.passes(c(flags)))
    end = FL.intact_end(c(length), c(flags), intact)
    # reads are antisense: the modification letters of the RNA's U is T
    runs = F.array(*[F.struct(F.lit("U" if x == "T" else x).alias("modtype"), S.trailing_run(c(mods), x, most_mods).alias("modcount")) for x in letters])
    each = rows.select(c(gene).alias("gene"), F.when(end, "canonical").otherwise("noncanonical").alias("tailtype"), c(length).alias("length"), F.explode(runs).alias("r"))
    ok = F.col("length").between(0, F.when(F.col("tailtype") == "canonical", most).otherwise(short))
    return each.filter(ok).groupBy("gene", F.col("r.modtype").alias("modtype"), "tailtype", "length", F.col("r.modcount").alias("modcount")).agg(F.count("*").alias("n"))


def window_names() -> list[str]:
    return [f"{a}-{b - 1}" for a, b in LENGTH_WINDOWS]


def gene_statistics(cube: DataFrame, short: int = 5, confidence: float = 0.95) -> DataFrame:
    """One wide row per gene: lengths, tag counts, counts per window, mean modifications.

    Counts come from the U cube; average_<letter>_<window> is the mean number of
    modifications of the window's tags, null where it has none.
    """
    # one pass over the cube: what is left has a row per gene, letter, kind of tail and length
    by = cube.groupBy("gene", "modtype", "tailtype", "length").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("modcount")).alias("mods"))
    u, canonical, n, length = F.col("modtype") == "U", F.col("tailtype") == "canonical", F.col("n"), F.col("length")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    mean = lambda cond: F.try_divide(F.sum(F.when(cond, F.col("mods"))), F.sum(F.when(cond, n)))
    aggs = [
        total(u & canonical & (length >= short)).alias("polyA_tag_count"),
        total(u & canonical & (length < short)).alias("nonpolyA_tag_count"),
        total(u & ~canonical).alias("noncanonical_tag_count"),
        total(u).alias("total_tag_count"),
    ]
    for (a, b), name in zip(LENGTH_WINDOWS, window_names()):
        inside = canonical & (length >= a) & (length < b)
        aggs.append(total(u & inside).alias(f"polyA_tag_count_{name}"))
        aggs += [mean((F.col("modtype") == letter) & inside).alias(f"average_{letter}_{name}") for letter in "UGC"]
    aggs += [mean((F.col("modtype") == letter) & ~canonical).alias(f"average_{letter}_noncanonical") for letter in "UGC"]
    own = u & canonical
    long = own & (length >= short)
    k, lx = F.when(long, n.cast("double")).otherwise(0.0), F.when(long, F.log(F.greatest(length, F.lit(1)).cast("double"))).otherwise(0.0)
    aggs += [F.sum(k).alias("__k"), F.sum(k * lx).alias("__s"), F.sum(k * lx * lx).alias("__ss")]
    wide = by.groupBy("gene").agg(*aggs)
    mean_, lo, hi = interval_of_sums(F.col("__k"), F.col("__s"), F.col("__ss"), confidence)
    # taken from the same rows and columns as above, unfiltered, so that their exchange is used again instead of a second scan
    lengths = by.groupBy("gene", "length").agg(F.sum(F.when(own, n)).alias("n"), F.sum("mods").alias("__m")).filter("n > 0 AND __m >= 0")
    medians = weighted_quantiles(lengths, ["gene"], "length", "n", (0.5,)).select("gene", F.col("q50").alias("polyA_median"))
    out = wide.join(medians, "gene", "left")
    return out.select("*", *[F.when(F.col("polyA_median").isNotNull(), c).alias(name) for c, name in ((mean_, "polyA_mean"), (lo, "polyA_mean_ci_lo"), (hi, "polyA_mean_ci_hi"))]).drop("__k", "__s", "__ss")


def merge_samples(long: DataFrame, row: str, sample: str, samples: Sequence[str], stats: Sequence[str], total: str, names: DataFrame | None = None, name_key: str | None = None) -> DataFrame:
    """Statistics of several samples side by side, columns sample:stat, greatest total first.

    The samples are given, so the pivot needs no pass to find them. ``names`` (one row
    per ``name_key``) is joined from the statistics' side: genes without statistics don't
    appear.
    """
    aggs = [F.first(F.col(s), ignorenulls=True).alias(s) for s in stats]
    wide = long.groupBy(row).pivot(sample, list(samples)).agg(*aggs)
    cols = {f"{p}_{s}" if len(stats) > 1 else p: f"{p}:{s}" for s in stats for p in samples}
    out = wide.select(row, *[F.col(f"`{a}`").alias(b) for a, b in cols.items()])
    every = sum((F.coalesce(F.col(f"`{p}:{total}`"), F.lit(0)) for p in samples[1:]), F.coalesce(F.col(f"`{samples[0]}:{total}`"), F.lit(0)))
    out = out.withColumn("total_tags", every)
    if names is not None:
        out = out.join(names, out[row] == names[name_key or row], "left")
    return out.orderBy(F.col("total_tags").desc(), row)
