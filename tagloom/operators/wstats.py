"""Weighted statistics, histograms, density estimates.

Inputs are (group, value, weight) frames, usually histograms made by a first partial
aggregation, so that the heavy data is only read once and what windows sort is the
distinct values of a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.special import t_quantile


def histogram(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, value, n); null values don't count."""
    return df.filter(F.col(f"`{value}`").isNotNull()).groupBy(*[F.col(f"`{g}`") for g in groups], F.col(f"`{value}`")).agg(F.count("*").alias("n"))


def dense_histogram(hist: DataFrame, group: str, value: str, most: int) -> DataFrame:
    """Counts for every whole value 0..most of every group, zeros filled in.

    Negative values and those over ``most`` are dropped, and so are the values at the
    end that no group has.
    """
    h = hist.filter(F.col(f"`{value}`").between(0, most))
    top = h.filter("n > 0").agg(F.max(f"`{value}`")).first()[0]  # one number
    axis = F.sequence(F.lit(0), F.lit(-1 if top is None else int(top))) if top is not None else F.array().cast("array<int>")
    full = h.select(F.col(f"`{group}`").alias("__g")).distinct().select("__g", F.explode(axis).alias("__v"))
    met = full.join(h, F.col("__g").eqNullSafe(F.col(f"`{group}`")) & (F.col("__v") == F.col(f"`{value}`")), "left")
    return met.select(F.col("__g").alias(group), F.col("__v").alias(value), F.coalesce("n", F.lit(0)).alias("n"))


def weighted_moments(df: DataFrame, groups: Sequence[str], value: str, weight: str, center: float | None = None) -> DataFrame:
    """Weighted mean, geometric mean (positive values, zeros count as 1), mode, RMSE and MAE.

    The mode is the mean of the values with the greatest weight. RMSE and MAE are about
    ``center`` (by default the mean). Groups of no weight give nulls.
    """
    x, w = F.col(f"`{value}`").cast("double"), F.col(f"`{weight}`").cast("double")
    gs = [F.col(f"`{g}`") for g in groups]
    rows = df.filter(x.isNotNull() & w.isNotNull()).select(*gs, x.alias("x"), w.alias("w"))
    per = rows.groupBy(*gs, "x").agg(F.sum("w").alias("w"))
    positive = F.greatest(F.col("x"), F.lit(1.0))
    total = F.sum("w")
    base = per.groupBy(*gs).agg(
        total.alias("weight"),
        F.try_divide(F.sum(F.col("x") * F.col("w")), total).alias("mean"),
        F.exp(F.try_divide(F.sum(F.log(positive) * F.col("w")), total)).alias("geomean"),
        F.try_divide(F.sum(F.col("x") * F.col("x") * F.col("w")), total).alias("__sq"),
        F.max("w").alias("__top"),
    )
    named = base.select(*[F.col(f"`{g}`").alias(f"__k{i}") for i, g in enumerate(groups)], "weight", "mean", "geomean", "__sq", "__top")
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(f"__k{i}"))
    about = F.lit(center) if center is not None else F.col("mean")
    met = per.join(named, same)
    return met.groupBy(*gs, "weight", "mean", "geomean").agg(
        F.avg(F.when(F.col("w") == F.col("__top"), F.col("x"))).alias("mode"),
        F.sqrt(F.try_divide(F.sum((F.col("x") - about) * (F.col("x") - about) * F.col("w")), F.sum("w"))).alias("rmse"),
        F.try_divide(F.sum(F.abs(F.col("x") - about) * F.col("w")), F.sum("w")).alias("mae"),
    )


def weighted_quantiles(df: DataFrame, groups: Sequence[str], value: str, weight: str, qs: Sequence[float]) -> DataFrame:
    """q<NN>: the least value at which the cumulative weight share is greater than q.

    Strictly greater, so neither interpolating nor discrete percentiles agree with it.
    A group without weight gives no row.
    """
    gs = [F.col(f"`{g}`") for g in groups]
    per = df.filter(F.col(f"`{value}`").isNotNull()).groupBy(*gs, F.col(f"`{value}`").alias("x")).agg(F.sum(f"`{weight}`").alias("w")).filter("w > 0")
    up_to = F.sum("w").over(W.partitionBy(*gs).orderBy("x"))
    total = F.sum("w").over(W.partitionBy(*gs))
    shares = per.withColumn("r", up_to / total)
    return shares.groupBy(*gs).agg(*[F.min(F.when(F.col("r") > q, F.col("x"))).alias(f"q{round(q * 100):02d}") for q in qs])


def cumulative_shares(hist: DataFrame, groups: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """The cumulative distribution of each group."""
    gs = [F.col(f"`{g}`") for g in groups]
    w = W.partitionBy(*gs)
    return hist.select(*gs, F.col(f"`{value}`"), (F.sum(n).over(w.orderBy(f"`{value}`")) / F.sum(n).over(w)).alias("share"))


def bandwidth(rule: str | float, total: float, squares: float) -> float:
    """Factor of Scott's or Silverman's rule (one dimension) for Kish's effective size, or a constant."""
    if not isinstance(rule, str):
        return float(rule)
    n = total * total / squares
    return n ** (-0.2) if rule == "scott" else (n * 3 / 4) ** (-0.2)


def weighted_kde(hist: DataFrame, groups: Sequence[str], value: str, weight: str, grid: Sequence[float], rule: str | float = "scott") -> DataFrame:
    """Gaussian density estimate of each group at the grid's points: (groups, x, density).

    The spread is the weighted standard deviation, corrected for bias by the effective
    size, times the rule's factor; a number as ``rule`` is that factor. The grid is a
    constant array that is exploded beside each distinct value, then summed: values x
    points terms on the map side. Groups without spread give no row.
    """
    gs = [F.col(f"`{g}`") for g in groups]
    x, w = F.col("x"), F.col("w")
    per = hist.filter(F.col(f"`{value}`").isNotNull() & (F.col(f"`{weight}`") > 0)).groupBy(*gs, F.col(f"`{value}`").cast("double").alias("x")).agg(F.sum(f"`{weight}`").cast("double").alias("w"))
    win = W.partitionBy(*gs)
    total, square = F.sum("w").over(win), F.sum(w * w).over(win)
    mean = F.sum(x * w).over(win) / total
    spread = per.withColumn("t", total).withColumn("s2", square).withColumn("m", mean)
    spread = spread.withColumn("var", F.sum(w * (x - F.col("m")) * (x - F.col("m"))).over(win) / F.nullif(F.col("t") - F.col("s2") / F.col("t"), F.lit(0.0)))
    n_eff = F.col("t") * F.col("t") / F.col("s2")
    factor = F.lit(float(rule)) if not isinstance(rule, str) else (F.pow(n_eff, F.lit(-0.2)) if rule == "scott" else F.pow(n_eff * 0.75, F.lit(-0.2)))
    h = F.sqrt(F.col("var")) * factor
    points = F.array(*[F.lit(float(g)) for g in grid])
    each = spread.withColumn("h", h).filter("h > 0").select(*gs, "x", "w", "t", "h", F.explode(points).alias("at"))
    z = (F.col("at") - x) / F.col("h")
    return each.groupBy(*gs, "at").agg(F.sum(w / F.col("t") * F.exp(-0.5 * z * z) / (F.col("h") * math.sqrt(2 * math.pi))).alias("density")).select(*gs, F.col("at").alias("x"), "density")


def geometric_mean_ci(hist: DataFrame, groups: Sequence[str], value: str, n: str, least: float = 5, confidence: float = 0.95) -> DataFrame:
    """Geometric mean of values of at least ``least`` and its confidence interval.

    The half-width is the one-sided t quantile times the standard error of the logs
    (population variance over n). A single value is its own interval; none gives NaN.
    """
    gs = [F.col(f"`{g}`") for g in groups]
    ok = F.col(f"`{value}`") >= least
    k, lx = F.when(ok, F.col(f"`{n}`").cast("double")).otherwise(0.0), F.when(ok, F.log(F.col(f"`{value}`"))).otherwise(0.0)
    sums = hist.groupBy(*gs).agg(F.sum(k).alias("count"), F.sum(k * lx).alias("s"), F.sum(k * lx * lx).alias("ss"))

    mean, lo, hi = interval_of_sums(F.col("count"), F.col("s"), F.col("ss"), confidence)
    return sums.select(*gs, F.col("count").cast("bigint").alias("count"), mean.alias("mean"), lo.alias("ci_lo"), hi.alias("ci_hi"))


def interval_of_sums(count: Column, s: Column, ss: Column, confidence: float = 0.95) -> tuple[Column, Column, Column]:
    """Geometric mean and its confidence limits from the number of values and the sums of their logs and of these' squares."""

    @F.pandas_udf("double")
    def quantile(counts: pd.Series) -> pd.Series:
        known = {c: (t_quantile(confidence, c - 1) if c > 1 else 0.0) for c in counts.unique()}
        return counts.map(known).astype(float)

    mean = F.when(count > 0, F.try_divide(s, count)).otherwise(F.lit(float("nan")))
    var = F.greatest(F.try_divide(ss, count) - mean * mean, F.lit(0.0))
    half = F.when(count > 1, quantile(count) * F.sqrt(F.try_divide(var, count))).otherwise(0.0)
    return F.exp(mean), F.exp(mean - half), F.exp(mean + half)


def accuracy_table(df: DataFrame, group: str, value: str, weight: str, qs: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Percentiles, means, mode and errors of measured lengths, rounded to two decimals."""
    a, b = weighted_moments(df, [group], value, weight), weighted_quantiles(df, [group], value, weight, qs)
    met = a.join(b, group)
    return met.select(group, *[F.round(F.col(c).cast("double"), 2).alias(c) for c in (*[f"q{round(q * 100):02d}" for q in qs], "mean", "geomean", "mode", "rmse", "mae")])


def gel_lanes(hist: DataFrame, lane: str, value: str, n: str, grid: Sequence[float], control: str | None = None, factor: float = 0.05) -> DataFrame:
    """Lane densities on a square-root scale of length, scaled to the lanes' totals.

    intensity is relative to the control lane's maximum, or to the greatest of all lanes.
    """
    root = hist.filter(F.col(f"`{value}`") >= 1).withColumn("__r", F.sqrt(F.col(f"`{value}`").cast("double")))
    lanes = weighted_kde(root, [lane], "__r", n, [math.sqrt(g) for g in grid], factor)
    tops = lanes.groupBy(lane).agg(F.max("density").alias("top"))
    best = tops.filter(F.col(lane) == control) if control else tops
    top = best.agg(F.max("top")).first()[0] or 1.0  # one number
    return lanes.select(lane, F.round(F.col("x") * F.col("x"), 6).alias("length"), "density", (F.col("density") / F.lit(top)).alias("intensity"))


def log2_clipped(x: Column) -> Column:
    return F.log2(F.greatest(x.cast("double"), F.lit(1.0)))


def migration(length: Column, least: float, most: float) -> Column:
    """Position on a gel: square-root scale between two lengths, 0 to 1."""
    return (F.sqrt(length.cast("double")) - math.sqrt(least)) / (math.sqrt(most) - math.sqrt(least))
