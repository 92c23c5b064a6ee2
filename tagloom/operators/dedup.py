"""Duplicate elimination: exact by key, approximate by leader clustering, first of many.

Exact deduplication is expressed with aggregates that combine on the map side, not with
a window over each group: a hot group costs one buffer per task. Leader clustering
works on islands of places that no cluster can span; islands go to tasks whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.flags import priority_score
from tagloom.session import keyed

MERGED, LOWER = -2, -3


def half_away(x: Column) -> Column:
    """Rounded to a whole number, halves away from zero."""
    return F.round(x, 0).cast("int")


def exact_dedup(df: DataFrame, key: Sequence[str], flags: str, length: str, tie: Sequence[str]) -> DataFrame:
    """One row per key: the representative's ``tie`` columns, flags, length and clones.

    Only rows of the greatest priority count. A single one keeps its length; of several
    the one nearest to their mean length represents them (ties: first by ``tie``), with
    the mean, rounded half away from zero, as its length, or -1 if its own is negative.
    clones counts all rows of the key. Null flags count as 0, null lengths as -1; keys
    may be null and are then a key like any other.
    """
    keys = [F.col(f"`{k}`") for k in key]
    prio, value = priority_score(F.coalesce(F.col(f"`{flags}`"), F.lit(0))), F.coalesce(F.col(f"`{length}`"), F.lit(-1))
    rows = df.select(*keys, *[F.col(f"`{t}`") for t in tie], F.coalesce(F.col(f"`{flags}`"), F.lit(0)).alias("__f"), value.alias("__v"), prio.alias("__p"))
    # one pass: a row per key, priority and length, of which there are few however many tags a key has
    order = F.struct(*[F.col(f"`{t}`").alias(f"t{i}") for i, t in enumerate(tie)])
    small = rows.groupBy(*keys, "__p", "__v").agg(F.count("*").alias("__n"), F.min(F.struct(order.alias("t"), F.col("__f").alias("f"))).alias("__r"))
    per = small.groupBy(*keys, "__p").agg(F.sum("__n").alias("__n"), F.sum(F.col("__n") * F.col("__v")).alias("__s"), F.collect_list(F.struct(F.col("__v").alias("v"), F.col("__r").alias("r"))).alias("__l"))
    top = per.groupBy(*keys).agg(F.sum("__n").alias("clones"), F.max_by(F.struct("__n", "__s", "__l"), "__p").alias("__t"))
    best = top.select(*keys, "clones", F.col("__t.__n").alias("__n1"), (F.col("__t.__s") / F.col("__t.__n")).alias("__mean"), F.col("__t.__l").alias("__l"))
    near = F.array_min(F.transform("__l", lambda x: F.struct(F.abs(x["v"] - F.col("__mean")).alias("d"), x["r"]["t"].alias("t"), x["v"].alias("v"), x["r"]["f"].alias("f"))))
    rep = best.withColumn("__x", near)
    out = F.when(F.col("__n1") == 1, F.col("__x.v")).when(F.col("__x.v") < 0, -1).otherwise(half_away(F.col("__mean")))
    return rep.select(*keys, *[F.col(f"__x.t.t{i}").alias(t) for i, t in enumerate(tie)], F.col("__x.f").alias(flags), out.cast("int").alias(length), "clones")


def _same(key: Sequence[str]) -> Column:
    out = F.lit(True)
    for i, k in enumerate(key):
        out = out & F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}"))
    return out


def dedup_trace(df: DataFrame, deduped: DataFrame, key: Sequence[str], flags: str, length: str, row: Sequence[str]) -> DataFrame:
    """What became of every row: the final length, -2 for merged, -3 for lower priority."""
    keys = [F.col(f"`{k}`") for k in key]
    prio = priority_score(F.coalesce(F.col(f"`{flags}`"), F.lit(0)))
    best = deduped.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(key)], *[F.col(f"`{r}`").alias(f"__r{i}") for i, r in enumerate(row)], F.col(f"`{length}`").alias("__final"), priority_score(F.col(f"`{flags}`")).alias("__top"))
    met = df.withColumn("__p", prio).join(best, _same(key))
    own = F.lit(True)
    for i, r in enumerate(row):
        own = own & F.col(f"`{r}`").eqNullSafe(F.col(f"__r{i}"))
    return met.select(*keys, *[F.col(f"`{r}`") for r in row], F.when(own, F.col("__final")).when(F.col("__p") < F.col("__top"), LOWER).otherwise(MERGED).cast("int").alias("trace"))


def dedup_with_bypass(df: DataFrame, bypass: Column, key: Sequence[str], flags: str, length: str, tie: Sequence[str]) -> DataFrame:
    """Exact deduplication of all rows but those of ``bypass``, which pass as they are with one clone."""
    keep = [*key, *tie, flags, length]
    alone = df.filter(bypass).select(*keep).withColumn("clones", F.lit(1).cast("bigint"))
    return exact_dedup(df.filter(~F.coalesce(bypass, F.lit(False))), key, flags, length, tie).unionByName(alone)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order`` (nulls first): a partial minimum, no sort."""
    rank = F.struct(*[F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order)])
    rows = df.groupBy(*[F.col(f"`{k}`") for k in key]).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in columns]), rank).alias("__r"))
    return rows.select(*[F.col(f"`{k}`") for k in key], *[F.col(f"__r.{c}").alias(c) for c in columns])


def islands(df: DataFrame, place: Sequence[str], pos: str, gap: int, order: Sequence[str], name: str = "island", stretch: int = 4096) -> DataFrame:
    """Numbers the maximal runs of rows whose positions are at most ``gap`` apart.

    Places are cut into stretches first, so that no window spans a whole chromosome: a
    stretch is sorted in one task, the borders of stretches (two numbers each) are
    compared in a second, small window and islands that cross a border joined there.
    """
    cut = df.withColumn("__s", F.floor(F.col(f"`{pos}`") / F.lit(stretch)))
    keys = [F.col(f"`{p}`") for p in place]
    w = W.partitionBy(*keys, "__s").orderBy(F.col(f"`{pos}`"), *[F.col(f"`{o}`") for o in order])
    new = F.coalesce((F.col(f"`{pos}`") - F.lag(f"`{pos}`").over(w) > gap).cast("int"), F.lit(0))
    local = cut.withColumn("__n", new).withColumn("__i", F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, 0)))
    ends = local.groupBy(*keys, "__s").agg(F.min(f"`{pos}`").alias("__lo"), F.max(f"`{pos}`").alias("__hi"), F.max("__i").alias("__m"))
    w2 = W.partitionBy(*keys).orderBy("__s")
    # how many islands begin before this stretch; the first one may go on from the stretch before
    joins = F.coalesce((F.col("__lo") - F.lag("__hi").over(w2) <= gap).cast("int"), F.lit(0))
    starts = ends.withColumn("__j", joins).withColumn("__base", F.sum(F.col("__m") + 1 - F.col("__j")).over(w2.rowsBetween(W.unboundedPreceding, 0)) - F.col("__m") - 1)
    named = starts.select(*[F.col(f"`{p}`").alias(f"__k{i}") for i, p in enumerate(place)], F.col("__s").alias("__t"), "__base")
    met = local.join(named, _same(place) & (F.col("__s") == F.col("__t")))
    return met.withColumn(name, (F.col("__base") + F.col("__i")).cast("bigint")).drop(*[f"__k{i}" for i in range(len(place))], "__s", "__t", "__n", "__i", "__base")


def _distance_within(a: str, b: str, k: int) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > k:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > k:
            return False
    return row[-1] <= k


def leaders(tags: list[tuple[int, str]], reach: int, edits: int) -> list[int]:
    """Index of the head that each of the sorted (position, text) tags follows.

    A tag follows the first live head that is at most ``reach`` behind and at most
    ``edits`` away; else it becomes a head itself.
    """
    heads: list[int] = []
    out: list[int] = []
    first = 0
    for i, (pos, text) in enumerate(tags):
        while first < len(heads) and tags[heads[first]][0] < pos - reach:
            first += 1
        follow = next((h for h in heads[first:] if _distance_within(tags[h][1], text, edits)), None)
        if follow is None:
            heads.append(i)
        out.append(i if follow is None else follow)
    return out


class _Heads:
    """Live heads of one island in order, with their trimer profiles in one array.

    An edit changes at most three trimers on either side, so texts within k edits have
    profiles at most 6 k apart: one array operation leaves few heads to compare. Letters
    beyond A, C, G, T share profile cells, which only lets more heads pass.
    """

    def __init__(self, reach: int, edits: int) -> None:
        self.reach, self.edits = reach, edits
        self.heads: list[tuple[int, object, str]] = []
        self.first = 0
        self.profiles = np.zeros((64, 64), dtype=np.int16)

    def follow(self, pos: int, row: object, text: str) -> object:
        """The row of the head that the next tag follows; its own if it becomes a head."""
        while self.first < len(self.heads) and self.heads[self.first][0] < pos - self.reach:
            self.first += 1
        n = len(self.heads)
        if self.first > 4096 and self.first * 2 > n:
            self.heads, self.profiles = self.heads[self.first :], self.profiles[self.first :].copy()
            n, self.first = n - self.first, 0
        mine = np.zeros(64, dtype=np.int16)
        codes = [_CODE.get(c, 0) for c in text]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            mine[a * 16 + b * 4 + c] += 1
        near = np.flatnonzero(np.abs(self.profiles[self.first : n] - mine).sum(1) <= 6 * self.edits)
        for i in near:
            head = self.heads[self.first + i]
            if _distance_within(head[2], text, self.edits):
                return head[1]
        if n == len(self.profiles):
            self.profiles = np.concatenate([self.profiles, np.zeros_like(self.profiles)])
        self.profiles[n] = mine
        self.heads.append((pos, row, text))
        return row


_CODE = {c: i for i, c in enumerate("ACGT")}


def leader_clusters(df: DataFrame, place: str, pos: str, text: str, row: str, reach: int = 4, edits: int = 2) -> DataFrame:
    """(row, head): greedy clusters of tags by position and text, in order of (pos, row).

    Sequential by nature, so an island of positions (no gap over ``reach``) is the unit
    of work: the rows are sorted within a place's stretch and handed over in order,
    and the state is only the live heads, however long the island. Rows with a null
    place, position or text are left out; ties of position go by row.
    """
    rows = df.select(F.col(f"`{place}`").cast("string").alias("place"), F.col(f"`{pos}`").cast("bigint").alias("pos"), F.col(f"`{text}`").alias("text"), F.col(f"`{row}`").alias("row")).filter("place IS NOT NULL AND pos IS NOT NULL AND text IS NOT NULL")
    kind = rows.schema["row"].dataType.simpleString()
    marked = islands(rows, ["place"], "pos", reach, ["row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, _Heads(reach, edits)
        for batch in batches:
            ids, out = batch.column(3).to_pylist(), []
            for place_, island, pos_, id_, text_ in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4))):
                if (place_, island) != at:
                    at, heads = (place_, island), _Heads(reach, edits)
                out.append(heads.follow(pos_, id_, text_))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(3).type), pa.array(out, batch.column(3).type)], names=["row", "head"])

    sorted_ = keyed(marked.select("place", "island", "pos", "row", "text"), "place", "island").sortWithinPartitions("place", "island", "pos", "row")
    return sorted_.mapInArrow(run, f"row {kind}, head {kind}")


def merge_clusters(members: DataFrame, head: str, flags: str, clones: str, length: str, tail: str, tie: str) -> DataFrame:
    """One row per cluster of approximate duplicates.

    clones is the sum over all members. Among those of the greatest priority: with one
    member, or no positive ``tail`` length, the first by ``tie`` keeps its own lengths;
    else both lengths are clone-weighted means over the members with a positive tail,
    rounded half away from zero, and the one nearest to the mean tail represents.
    """
    prio = priority_score(F.col(f"`{flags}`"))
    m = members.select(F.col(f"`{head}`").alias("head"), F.col(f"`{tie}`").alias("id"), F.col(f"`{flags}`").alias("f"), F.col(f"`{clones}`").cast("bigint").alias("c"), F.col(f"`{length}`").alias("l"), F.col(f"`{tail}`").alias("u"), prio.alias("p"))
    top = m.groupBy("head", "p").agg(F.sum("c").alias("all_c"), F.count("*").alias("n"), F.sum(F.when(F.col("u") > 0, F.col("c"))).alias("w"), F.sum(F.when(F.col("u") > 0, F.col("c") * F.col("l"))).alias("wl"), F.sum(F.when(F.col("u") > 0, F.col("c") * F.col("u"))).alias("wu"), F.min_by(F.struct("id", "f", "l", "u"), "id").alias("first"))
    best = top.groupBy("head").agg(F.sum("all_c").alias("clones"), F.max_by(F.struct("n", "w", "wl", "wu", "first", "p"), "p").alias("t"))
    means = best.select(F.col("head").alias("h"), "clones", "t", (F.col("t.wu") / F.col("t.w")).alias("mu"), (F.col("t.wl") / F.col("t.w")).alias("ml"))
    near = m.join(means, (F.col("head") == F.col("h")) & (F.col("p") == F.col("t.p")) & (F.col("u") > 0)).groupBy("head").agg(F.min_by(F.struct("id", "f"), F.struct(F.abs(F.col("u") - F.col("mu")), F.col("id"))).alias("r"))
    out = means.join(near, F.col("h") == F.col("head"), "left")
    own = (F.col("t.n") <= 1) | F.coalesce(F.col("t.w"), F.lit(0)).isin(0)
    pick = lambda mean, mine: F.when(own, mine).otherwise(mean)
    return out.select(
        F.col("h").alias("head"),
        pick(F.col("r.id"), F.col("t.first.id")).alias("id"),
        pick(F.col("r.f"), F.col("t.first.f")).alias("flags"),
        "clones",
        pick(half_away(F.col("ml")), F.col("t.first.l")).alias("length"),
        pick(half_away(F.col("mu")), F.col("t.first.u")).alias("tail"),
    )


def leader_frame(pdf: pd.DataFrame, reach: int = 4, edits: int = 2) -> pd.DataFrame:
    """Leader clustering of one small frame (columns pos, row, text): the operator's plain form."""
    s = pdf.sort_values(["pos", "row"])
    at = leaders(list(zip(s["pos"], s["text"])), reach, edits)
    return pd.DataFrame({"row": s["row"].to_numpy(), "head": s["row"].to_numpy()[at]})
