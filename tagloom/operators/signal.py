"""Signals of sequencing cycles: correction, scores, change points, tail ruler, cut-offs.

Signals are arrays, one element per cycle. Everything that a higher-order function
expresses stays a column expression; the cut-off fit works per (tile, cycle) on a
histogram of at most some thousand bins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.seq import rolling_hash
from tagloom.session import durable, keyed

#: Channel of the letter T.
T = 3


def inverse_of(matrix: Sequence[float]) -> list[float]:
    """Inverse of a 4 x 4 colour matrix, row by row."""
    return np.linalg.inv(np.array(matrix, dtype=float).reshape(4, 4)).ravel().tolist()


def read_color_matrix(text: str) -> list[float]:
    """Sixteen numbers of a colour matrix file; lines that begin with # are comments."""
    numbers = [float(x) for line in text.splitlines() if not line.lstrip().startswith("#") for x in line.split()]
    if len(numbers) != 16:
        raise ValueError("a colour matrix has sixteen numbers")
    return numbers


def corrected(raw: Column, inverse: Sequence[float]) -> Column:
    """Channels freed of cross-talk: inverse matrix times the raw channels."""
    return F.array(*[sum((F.get(raw, F.lit(k)).cast("double") * float(inverse[4 * r + k]) for k in range(1, 4)), F.get(raw, F.lit(0)).cast("double") * float(inverse[4 * r])) for r in range(4)])


def normalized(signal: Column, low: Sequence[float], band: Sequence[float]) -> Column:
    """Channels scaled to their range, negative ones 0, then to a sum of 1; null where all are 0 (dark)."""
    scaled = F.array(*[F.greatest(F.lit(0.0), (F.get(signal, F.lit(k)) - float(low[k])) / float(band[k])) for k in range(4)])
    # values are bound through one-element arrays, so that each is computed once
    both = F.transform(F.array(scaled), lambda v: F.struct(v.alias("v"), F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("t")))
    return F.get(F.transform(both, lambda b: F.when(b["t"] > 0, F.transform(b["v"], lambda x: x / b["t"]))), F.lit(0))


def positive_sum(signal: Column) -> Column:
    return F.aggregate(signal, F.lit(0.0), lambda a, x: a + F.greatest(x, F.lit(0.0)))


def entropy_score(shares: Column, kinds: int = 4) -> Column:
    """1 - H / H_max of an array of shares: 1 is a pure signal."""
    return 1 + F.aggregate(shares, F.lit(0.0), lambda a, p: a + F.when(p > 0, p * F.log(F.greatest(p, F.lit(1e-300)))).otherwise(0.0)) / math.log(kinds)


def logistic_score(share: Column, k: float = 17.0, center: float = 0.6, bins: int = 200) -> Column:
    """Logistic score of a share's bin midpoint; a share of exactly 1 scores 1."""
    at = F.floor(share * bins)
    return F.when(at >= bins, 1.0).otherwise(1 / (1 + F.exp(-k * ((at + 0.5) / bins - center))))


def tail_scores(signals: Column, low: Sequence[float], band: Sequence[float], inverse: Sequence[float] | None = None, dark: float = 10.0) -> Column:
    """Array of struct(score, downhill) of an array of four-channel cycles.

    The score is entropy times logistic T share; null for dark cycles (channel sum under
    ``dark``, or nothing above the low ends). downhill: the entropy score is less than
    the previous cycle's.
    """

    def one(cycle: Column) -> Column:
        s = corrected(cycle, inverse) if inverse is not None else F.transform(cycle, lambda x: x.cast("double"))
        shares = F.transform(F.array(s), lambda v: F.when(positive_sum(v) >= dark, normalized(v, low, band)))
        return F.get(F.transform(shares, lambda n: F.struct(entropy_score(n).alias("e"), logistic_score(F.get(n, F.lit(T))).alias("t"))), F.lit(0))

    each = F.transform(signals, one)
    bound = F.transform(F.array(each), lambda xs: F.transform(xs, lambda x, i: F.struct((x["e"] * x["t"]).alias("score"), F.coalesce(x["e"] < F.get(xs, i - 1)["e"], F.lit(False)).alias("downhill"))))
    return F.get(bound, F.lit(0))


def quantised(score: Column, top: int = (1 << 24) - 1) -> Column:
    """24-bit form of a score in [0, 1]; 0 stands for a dark cycle."""
    return F.when(score.isNull() | F.isnan(score), 0).otherwise(F.lit(1) + F.floor(score * (top - 1))).cast("int")


def ranked_mean(values: Column, count: int, largest: bool) -> Column:
    """Mean of the ``count`` least or largest values of an array."""
    part = F.slice(F.sort_array(values, asc=not largest), 1, count)
    return F.aggregate(part, F.lit(0.0), lambda a, x: a + x, lambda a: F.try_divide(a, F.size(part).cast("double")))


def contrast(values: Column, left: int, right: int) -> Column:
    """struct(contrast, pos): where the mean so far exceeds the mean of the rest most.

    Positions within the guards at either end don't count; ties go to the first. The
    sum of the first i + 1 values is divided by i, as the threshold was tuned on that.
    """

    def run(b: Column) -> Column:
        # sums[i] is the sum of the first i values
        sums, n = b["sums"], F.size(b["sums"]) - 1
        places = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i >= left) & (i < n - right) & (i > 0))
        total = F.get(sums, n)
        found = F.transform(places, lambda i: F.struct((F.get(sums, i + 1) / i - (total - F.get(sums, i + 1)) / F.nullif(n - i, F.lit(0))).alias("contrast"), (-i).alias("back")))
        return F.array_max(found)

    sums = F.aggregate(values, F.array(F.lit(0.0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    best = F.get(F.transform(F.array(F.struct(sums.alias("sums"))), run), F.lit(0))
    return F.when(best.isNotNull(), F.struct(best["contrast"].alias("contrast"), (-best["back"]).alias("pos")))


def tail_length(scores: Column, downhill: Column, cutoffs: Column, weight: float = 0.49) -> Column:
    """Length of a tail by the ruler.

    Each cycle counts +1 if its score reaches the cut-off, else -1; those without a
    cut-off (null or NaN) count nothing, dark ones -1. The tail reaches to the first maximum of
    the running sum; downhill cycles right after it (dark ones are passed over) add
    about half their number. 0 if the sum never rises above 0.
    """

    def measure(b: Column) -> Column:
        scores, downhill, cutoffs = b["s"], b["d"], b["c"]
        n = F.size(scores)
        places = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))

        def step(i: Column) -> Column:
            cut = F.get(cutoffs, i)
            return F.when(cut.isNull() | F.isnan(cut), 0).when(F.coalesce(F.get(scores, i) >= cut, F.lit(False)), 1).otherwise(-1)

        def forward(a: Column, i: Column) -> Column:
            s = a["s"] + step(i)
            return F.struct(s.alias("s"), F.greatest(a["top"], s).alias("top"), F.when(s > a["top"], i).otherwise(a["at"]).alias("at"))

        def extend(a: Column, i: Column) -> Column:
            stop = F.struct(a["m"].alias("m"), a["e"].alias("e"), F.lit(False).alias("on"))
            on = F.struct(a["m"].alias("m"), i.alias("e"), F.lit(True).alias("on"))
            return F.when((i <= a["m"]) | ~a["on"] | F.get(scores, i).isNull(), a).when(F.get(downhill, i), on).otherwise(stop)

        walk = F.aggregate(places, F.struct(F.lit(0).alias("s"), F.lit(0).alias("top"), F.lit(-1).alias("at")), forward)
        ends = F.transform(F.array(walk), lambda w: F.aggregate(places, F.struct(w["at"].alias("m"), w["at"].alias("e"), F.lit(True).alias("on")), extend))
        return F.transform(ends, lambda r: F.when((n == 0) | (r["m"] < 0), 0).otherwise(r["m"] + 1 + F.round((r["e"] - r["m"]) * weight).cast("int")))

    # the arrays are bound once through a one-element array, not evaluated at every step
    bound = F.transform(F.array(F.struct(scores.alias("s"), downhill.alias("d"), cutoffs.alias("c"))), measure)
    return F.get(F.get(bound, F.lit(0)), F.lit(0))


def score_bins(df: DataFrame, keys: Sequence[str], scores: str, bins: int = 1000, first: Column | None = None) -> DataFrame:
    """(keys, cycle, bin, n): how often each score occurs per cycle; null and NaN scores don't count.

    A partial aggregate per task: this is how the distributions of tiles and of the run
    come about, too.
    """
    ks = [F.col(f"`{k}`") for k in keys]
    each = df.select(*ks, (first if first is not None else F.lit(0)).alias("__f"), F.posexplode(F.col(f"`{scores}`")).alias("__c", "__s")).filter("__s IS NOT NULL AND NOT isnan(__s)")
    return each.groupBy(*ks, (F.col("__f") + F.col("__c")).alias("cycle"), F.least(F.floor(F.col("__s") * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def _density(bins: np.ndarray, n: np.ndarray, grid: np.ndarray, factor: float) -> np.ndarray:
    total = n.sum()
    mean = (bins * n).sum() / total
    var = (n * (bins - mean) ** 2).sum() / total / max(1e-12, 1 - (n**2).sum() / total**2)
    h = max(math.sqrt(var) * factor, 1e-6)
    return (n[None, :] / total * np.exp(-0.5 * ((grid[:, None] - bins[None, :]) / h) ** 2)).sum(1) / (h * math.sqrt(2 * math.pi))


def equal_odds(pos: np.ndarray, n_pos: np.ndarray, neg: np.ndarray, n_neg: np.ndarray, bins: int = 1000, factor: float = 0.1, floor: float = 0.001, ends: Sequence[float] = (0.4, 0.6)) -> float | None:
    """Score at which both classes are equally likely: root of the log ratio of two density
    estimates (floored), by bisection on (0, end) for each end in turn; None if there is
    none. The densities are evaluated at every step, from all bins."""

    def at(t: float) -> float:
        a, b = (float(_density(x / bins, n, np.array([t]), factor)[0]) for x, n in ((pos, n_pos), (neg, n_neg)))
        return math.log(max(floor, a) / max(floor, b))

    for end in ends:
        lo, hi = 0.0, end
        low = at(lo)
        if low * at(hi) >= 0:
            continue
        while hi - lo > 1e-12:
            mid = (lo + hi) / 2
            if low * at(mid) > 0:
                lo = mid
            else:
                hi = mid
        if 0 < lo < end:
            return lo
    return None


def fit_cutoffs(hist: DataFrame, tile: str = "tile", bins: int = 1000, least: int = 300) -> DataFrame:
    """(tile, cycle, cutoff, basis) from (tile, cycle, positive, bin, n).

    A cycle needs ``least`` counts of both classes and takes its tile's own cut-off
    (basis d), else the run's (i), which is interpolated where the run has none, else
    none (x). Each (tile, cycle) is a group of at most 2 x bins rows.
    """
    run = hist.groupBy("cycle", "positive", "bin").agg(F.sum("n").alias("n")).withColumn(tile, F.lit(None).cast("string"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = pdf[pdf["positive"]], pdf[~pdf["positive"]]
        cut = None
        if p["n"].sum() >= least and q["n"].sum() >= least:
            cut = equal_odds(p["bin"].to_numpy(float), p["n"].to_numpy(float), q["bin"].to_numpy(float), q["n"].to_numpy(float), bins)
        return pd.DataFrame({tile: [pdf[tile].iloc[0]], "cycle": [int(pdf["cycle"].iloc[0])], "own": [cut]}, dtype=object)

    both = hist.select(tile, "cycle", "positive", "bin", "n").unionByName(run.select(tile, "cycle", "positive", "bin", "n"))
    own = keyed(both, tile, "cycle").groupBy(tile, "cycle").applyInPandas(fit, f"{tile} string, cycle int, own double")
    own = durable(own)  # a row per tile and cycle, read twice
    whole = infer_missing(own.filter(F.col(tile).isNull()).select(F.lit("run").alias("g"), "cycle", F.col("own").alias("cutoff")), ["g"], "cycle", "cutoff").select(F.col("cycle").alias("c"), F.col("cutoff").alias("whole"))
    met = own.filter(F.col(tile).isNotNull()).join(whole, F.col("cycle") == F.col("c"), "left")
    return met.select(tile, "cycle", F.coalesce("own", "whole").alias("cutoff"), F.when(F.col("own").isNotNull(), "d").when(F.col("whole").isNotNull(), "i").otherwise("x").alias("basis"))


def infer_missing(df: DataFrame, keys: Sequence[str], at: str, value: str, nearest: int = 5) -> DataFrame:
    """Fills null values: on the line between the nearest known ones of both sides, or,
    beyond the ends, with the median of the ``nearest`` known values next to the end."""
    ks = [F.col(f"`{k}`") for k in keys]
    x, v = F.col(f"`{at}`"), F.col(f"`{value}`")
    w = W.partitionBy(*ks).orderBy(x)
    known = F.when(v.isNotNull(), F.struct(x.cast("double").alias("x"), v.alias("v")))
    rows = df.withColumn("__p", F.last(known, True).over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("__n", F.first(known, True).over(w.rowsBetween(0, W.unboundedFollowing)))
    have = df.filter(v.isNotNull()).withColumn("__a", F.row_number().over(W.partitionBy(*ks).orderBy(x))).withColumn("__z", F.row_number().over(W.partitionBy(*ks).orderBy(x.desc())))
    ends = have.groupBy(*[k.alias(f"__k{i}") for i, k in enumerate(ks)]).agg(F.median(F.when(F.col("__a") <= nearest, v)).alias("__head"), F.median(F.when(F.col("__z") <= nearest, v)).alias("__tail"))
    same = F.lit(True)
    for i, k in enumerate(ks):
        same = same & k.eqNullSafe(F.col(f"__k{i}"))
    rows = rows.join(ends, same, "left")
    line = F.col("__p.v") + (F.col("__n.v") - F.col("__p.v")) * F.try_divide(x - F.col("__p.x"), F.col("__n.x") - F.col("__p.x"))
    out = F.when(v.isNotNull(), v).when(F.col("__p").isNotNull() & F.col("__n").isNotNull(), line).when(F.col("__p").isNull(), F.col("__head")).otherwise(F.col("__tail"))
    return rows.withColumn(value, out).drop("__p", "__n", "__head", "__tail", *[f"__k{i}" for i in range(len(ks))])


def refine_rounds(signals: DataFrame, hist: DataFrame, key: str, rounds: int = 1, least: int = 8) -> DataFrame:
    """Iterated measurement: round N measures with the cut-offs fitted on round N - 1's counts.

    ``signals`` has tile, ``key``, scores, downhill (arrays); ``hist`` the first counts
    (tile, cycle, positive, bin, n). Measured tails of at least ``least`` replace the
    positive counts with nine tenths of their scores for the next round.
    """
    counts, out = hist, None
    for turn in range(rounds + 1):
        # one row per tile: cycles are few
        cut = durable(fit_cutoffs(counts).groupBy("tile").agg(F.map_from_entries(F.collect_list(F.struct("cycle", "cutoff"))).alias("__c")))
        met = signals.join(cut, "tile", "left")
        cutoffs = F.transform("scores", lambda s, i: F.col("__c")[i])
        out = met.withColumn("length", tail_length(F.col("scores"), F.col("downhill"), cutoffs)).drop("__c")
        if turn < rounds:
            part = F.slice("scores", 1, F.col("length") - F.floor(F.col("length") * 0.1).cast("int"))
            again = score_bins(out.filter(F.col("length") >= least).withColumn("__part", part), ["tile"], "__part").withColumn("positive", F.lit(True))
            counts = hist.filter("NOT positive").unionByName(again.select(*hist.columns))
    return out


def control_score(read: str, control: str, match: int = 1, mismatch: int = 2, open_: int = 4, extend: int = 1) -> int:
    """Best local alignment score (affine gaps), a row of the matrix at a time."""
    if control.find(read) >= 0:
        return match * len(read)
    ref = np.frombuffer(control.encode(), dtype=np.uint8)
    h, f = np.zeros(len(ref) + 1, dtype=np.int64), np.full(len(ref) + 1, -(1 << 30), dtype=np.int64)
    best = 0
    slope = np.arange(len(ref) + 1) * extend
    for c in read.encode():
        diagonal = h[:-1] + np.where(ref == c, match, -mismatch)
        f = np.maximum(f - extend, h - open_)
        new = np.zeros_like(h)
        new[1:] = np.maximum(0, np.maximum(diagonal, f[1:]))
        # gaps along the row: running maximum of (score + slope)
        run = np.maximum.accumulate(new + slope)
        gap = np.concatenate(([0], run[:-1] - slope[1:] - open_ + extend))
        h = np.maximum(new, gap)
        best = max(best, int(h.max()))
    return best


def matches_control(read: Column, control: str, share: float = 0.65) -> Column:
    """Whether a read aligns to the control with at least ``share`` of its length as score.

    Exact substrings are found by the engine; only the other reads reach Python.
    """

    @F.pandas_udf("boolean")
    def aligned(column: pd.Series) -> pd.Series:
        known = {s: s is not None and control_score(s, control) >= share * len(s) for s in column.unique()}
        return column.map(known)

    exact = F.coalesce(F.lit(control).contains(read), F.lit(False))
    return F.when(exact, True).otherwise(F.coalesce(aligned(F.when(~exact, read)), F.lit(False)))


def fair_sample(df: DataFrame, text: str, order: Sequence[str], most: int = 5, buckets: int = 1 << 20, letters: int = 30, rolling: bool = False) -> DataFrame:
    """At most ``most`` rows per bucket of a hash of the text's first letters, first by ``order``.

    The engine keeps only the first rows of each bucket before it shuffles. ``rolling``
    takes the rolling sequence hash instead of the engine's own, which is faster.
    """
    t = F.col(f"`{text}`")
    h = rolling_hash(t, letters) if rolling else F.xxhash64(F.substring(t, 1, letters))
    return bucket_sample(df, F.pmod(h, F.lit(buckets)), order, most)


def bucket_sample(df: DataFrame, bucket: Column, order: Sequence[str], most: int) -> DataFrame:
    """As fair_sample, by any bucket."""
    w = W.partitionBy("__b").orderBy(*[F.col(f"`{o}`") for o in order])
    return df.withColumn("__b", bucket).withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= most).drop("__b", "__k")


def reservoir(df: DataFrame, key: Sequence[str], k: int, seed: int = 1) -> DataFrame:
    """A uniform sample of ``k`` rows that is the same in every run: the least hashes of the key."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in key], F.lit(seed))
    return df.withColumn("__h", h).orderBy("__h", *key).limit(k).drop("__h")


def seed_counts(df: DataFrame, tile: str, scores: str, length: str, start: str, fingerprint: str, order: Sequence[str], trigger: int = 10, boundary: int = 120, gap: int = 3, least_contrast: float = 0.35, guards: tuple[int, int] = (20, 20), shortest: int = 30, bins: int = 1000, most: int = 5) -> DataFrame:
    """First score counts (tile, cycle, positive, bin, n) to fit cut-offs on.

    Positive: reads with a tail of at least ``trigger`` whose contrast is great and lies
    beyond ``boundary``; their scores up to ``gap`` before it count. Negative: reads
    without a tail and at least ``shortest`` cycles, at most ``most`` per fingerprint
    bucket; all scores count. Scores are taken from the tail's start; null scores don't
    count.
    """
    s, n = F.col(f"`{scores}`"), F.size(F.col(f"`{scores}`"))
    c = contrast(F.transform(s, lambda x: F.coalesce(x, F.lit(0.0))), *guards)
    marked = df.withColumn("__c", c)
    begin = F.greatest(F.col(f"`{start}`"), F.lit(0))
    positive = marked.filter((F.col(f"`{length}`") >= trigger) & (F.col("__c.pos") >= boundary) & (F.col("__c.contrast") >= least_contrast))
    positive = positive.withColumn("__s", F.slice(s, begin + 1, F.greatest(F.least(n, F.lit(boundary - gap)) - begin, F.lit(0))))
    negative = fair_sample(df.filter((F.col(f"`{length}`") <= 0) & (n >= shortest)), fingerprint, order, most).withColumn("__s", F.slice(s, begin + 1, n))
    parts = [score_bins(x.withColumn("__at", begin), [tile], "__s", bins, F.col("__at")).withColumn("positive", F.lit(p)) for x, p in ((positive, True), (negative, False))]
    return parts[0].unionByName(parts[1]).select(tile, "cycle", "positive", "bin", "n")


def smoothed(values: Column, weights: Sequence[float]) -> Column:
    """Convolution with an odd number of weights; the ends are mirrored."""
    half = len(weights) // 2

    def run(values: Column) -> Column:
        n = F.size(values)

        def at(i: Column) -> Column:
            j = F.when(i < 0, -i).when(i >= n, 2 * (n - 1) - i).otherwise(i)
            return F.get(values, F.least(F.greatest(j, F.lit(0)), n - 1)) / float(sum(weights))

        return F.transform(values, lambda x, i: sum((at(i + (k - half)) * float(w) for k, w in enumerate(weights) if k), at(i - half) * float(weights[0])))

    return F.get(F.transform(F.array(values), run), F.lit(0))


def savitzky_golay(window: int, degree: int) -> list[float]:
    """Smoothing weights: the value at the centre of a least-squares polynomial."""
    half = window // 2
    powers = np.vander(np.arange(-half, half + 1), degree + 1, increasing=True)
    return np.linalg.pinv(powers)[0].tolist()
