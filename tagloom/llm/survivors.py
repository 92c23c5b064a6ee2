"""The best representative of each duplicate group, built from whole bundles.

Fields that depend on each other form a bundle and are always taken together, from one
row. Per group, one candidate of each bundle is chosen so that the trust of the rows
they come from is greatest, under two kinds of constraints between bundles:

* ``depends``: two bundles must have occurred together in some row of the group;
* ``functional``: a functional dependency left -> right over the bundles' columns (the
  row id counts as a column of every bundle): chosen bundles that agree on the left
  column must agree on the right one.

The choice is made by branch and bound, for every group. The root node is the
relaxation without constraints: the best candidate of each bundle, one aggregation with
map-side partial results whatever the size of the group. Its trust is the upper bound.
Where its choice keeps all constraints the bound is met, which proves it best, and the
group is closed at the root. The other groups branch, bundle by bundle, over their
candidates in falling order; a branch is cut where even the best of the remaining
bundles can't beat what was found. The best single row keeps every constraint and is
the first lower bound. Candidates are handed to the search in blocks that grow only
while a group's bounds are open, so a crowded group isn't gathered as a whole: a
group is closed as soon as what was left out can't beat what was found.

Solutions are ordered by trust, then by the rank of the first bundle's row, the second
one's and so on; the root's choice and the search's are the same by that order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.session import durable, keyed

#: Candidates of a bundle that the search is given at first, and how much more each time its bounds stay open.
BLOCK, GROWTH = 32, 16


@dataclass(frozen=True)
class Bundle:
    """Columns that are taken together, and whether a row has them all (``valid``)."""

    name: str
    columns: tuple[str, ...]
    valid: Column


def _order(order: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])


def _value(bundle: Bundle) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in bundle.columns])


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _has(bundle: Bundle, column: str, row_id: str) -> bool:
    return column == row_id or column in bundle.columns


def _agreeing(bundles: Sequence[Bundle], functional: Sequence[tuple[str, str]], row_id: str) -> Column:
    """Whether the root's choice keeps the functional dependencies."""
    out = F.lit(True)
    at = lambda b, c: F.col(f"{b.name}.id") if c == row_id else F.col(f"{b.name}.value.{c}")
    for left, right in functional:
        held = [b for b in bundles if _has(b, left, row_id) and _has(b, right, row_id)]
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                same = F.col(a.name).isNotNull() & F.col(b.name).isNotNull() & (at(a, left) == at(b, left))
                out = out & ~(F.coalesce(same, F.lit(False)) & ~at(a, right).eqNullSafe(at(b, right)))
    return out


def survivors(
    df: DataFrame,
    key: str,
    row_id: str,
    bundles: Sequence[Bundle],
    order: Sequence[Column],
    depends: Sequence[tuple[str, str]] = (),
    functional: Sequence[tuple[str, str]] = (),
    trust: Column | None = None,
    least_rows: int = 1,
    block: int = BLOCK,
) -> DataFrame:
    """One row per group: the key, n_rows, per bundle struct(id, <columns>) or null, and the
    proof: ``trust`` of the choice, the root's ``bound`` and the ``nodes`` that were visited.

    ``order`` ranks rows, greatest first, nulls least; its last column should tell all
    rows apart. ``trust`` (by default the first column of ``order``; null counts 0) must
    not be negative and must not decrease along ``order``. A bundle no row has is null,
    and so is one that the constraints leave nothing for. Rows with a null key belong to
    no group. Groups under ``least_rows`` rows give no row. An empty input gives no rows.
    """
    rank = _order(order)
    rows = df.filter(F.col(f"`{key}`").isNotNull())
    weight = F.coalesce((trust if trust is not None else order[0]).cast("double"), F.lit(0.0))
    best = [F.max_by(F.struct(F.col(f"`{row_id}`").alias("id"), _value(b).alias("value"), weight.alias("w")), F.when(b.valid, rank)).alias(b.name) for b in bundles]
    single = F.max(weight * _sum([F.when(b.valid, 1.0).otherwise(0.0) for b in bundles]))
    root = rows.groupBy(F.col(f"`{key}`").alias("key")).agg(F.count("*").alias("n_rows"), *best, single.alias("__least")).filter(F.col("n_rows") >= least_rows)
    root = root.withColumn("__bound", _sum([F.coalesce(F.col(f"{b.name}.w"), F.lit(0.0)) for b in bundles])).withColumn("__kept", _agreeing(bundles, functional, row_id))
    shown = [F.when(F.col(b.name).isNotNull(), F.struct(F.col(f"{b.name}.id").alias("id"), *[F.col(f"{b.name}.value.{c}").alias(c) for c in b.columns])).alias(b.name) for b in bundles]
    proof = [F.col("__bound").alias("trust"), F.col("__bound").alias("bound"), F.lit(len(bundles)).cast("bigint").alias("nodes")]
    closed = lambda x: x.select(F.col("key").alias(key), "n_rows", *shown, *proof)
    if not depends and not functional:
        return closed(root)
    root = durable(root)  # a row per group, read several times from here on
    if depends:
        root = durable(_joint(rows, key, bundles, depends, root))
    if root.filter("NOT __kept").isEmpty():
        return closed(root)
    done = closed(root.filter("__kept"))
    open_ = root.filter("NOT __kept").select("key", "n_rows", "__least", "__bound")
    near = rows.withColumn("__key", F.col(f"`{key}`")).join(open_.select(F.col("key").alias("__open")), F.col("__key") == F.col("__open"), "left_semi")
    facts = _Facts(near, row_id, bundles, rank, weight, depends, functional, open_)
    while True:
        found = durable(facts.searched(open_, block))
        picked = found.filter("proven").select(F.col("key").alias(key), "n_rows", *[b.name for b in bundles], "trust", F.col("__bound").alias("bound"), "nodes")
        done = done.unionByName(picked)
        rest = found.filter("NOT proven").select("key", "n_rows", "__least", "__bound")
        if rest.isEmpty():
            return done
        open_, block = rest, block * GROWTH


def _joint(rows: DataFrame, key: str, bundles: Sequence[Bundle], depends: Sequence[tuple[str, str]], root: DataFrame) -> DataFrame:
    """``root`` with __kept false where two dependent bundles of its choice never occurred together."""
    by = {b.name: b for b in bundles}
    chosen = root.select(F.col("key").alias("__chosen"), *[F.col(f"{b.name}.value").alias(f"__{b.name}") for b in bundles])
    met = rows.withColumn("__key", F.col(f"`{key}`")).join(chosen, F.col("__key") == F.col("__chosen"))
    both = lambda a, b: F.coalesce(by[a].valid & by[b].valid & (_value(by[a]) == F.col(f"__{a}")) & (_value(by[b]) == F.col(f"__{b}")), F.lit(False))
    free = lambda a, b: F.col(f"__{a}").isNull() | F.col(f"__{b}").isNull()
    seen = met.groupBy("__key").agg(*[F.max(free(a, b) | both(a, b)).alias(f"__s{i}") for i, (a, b) in enumerate(depends)])
    every = reduce(lambda a, b: a & b, [F.col(f"__s{i}") for i in range(len(depends))])
    return root.join(seen.select("__key", every.alias("__seen")), F.col("key") == F.col("__key")).withColumn("__kept", F.col("__kept") & F.col("__seen")).drop("__key", "__seen")


class _Facts:
    """Candidates and joint occurrences of the groups that branch."""

    def __init__(self, near: DataFrame, row_id: str, bundles: Sequence[Bundle], rank: Column, weight: Column, depends: Sequence[tuple[str, str]], functional: Sequence[tuple[str, str]], open_: DataFrame) -> None:
        self.bundles, self.row_id, self.functional = bundles, row_id, functional
        self.place = {b.name: i for i, b in enumerate(bundles)}
        self.wanted = [(self.place[a], self.place[b]) for a, b in depends]
        self.shape = [f"struct<id:{near.schema[row_id].dataType.simpleString()},{','.join(f'`{c}`:{near.schema[c].dataType.simpleString()}' for c in b.columns)}>" for b in bundles]
        self.key_kind = open_.schema["key"].dataType.simpleString()
        # candidates are alike if they have the same value; where a dependency tells rows apart, the row is part of it
        apart = any(row_id in pair for pair in functional)
        text = [F.when(b.valid, F.to_json(F.struct(_value(b).alias("v"), *([F.col(f"`{row_id}`").cast("string").alias("i")] if apart else [])), {"ignoreNullFields": "false"})) for b in bundles]
        whole = [F.to_json(F.struct(F.col(f"`{row_id}`").alias("id"), *[F.col(f"`{c}`") for c in b.columns]), {"ignoreNullFields": "false"}) for b in bundles]
        one = F.array(*[F.struct(F.lit(i).alias("b"), t.alias("t"), v.alias("v")) for i, (t, v) in enumerate(zip(text, whole))])
        each = near.select("__key", weight.alias("w"), rank.alias("rank"), F.explode(one).alias("x")).filter("x.t IS NOT NULL")
        values = each.groupBy("__key", F.col("x.b").alias("b"), F.col("x.t").alias("t")).agg(F.max(F.struct("rank", "w", F.col("x.v").alias("v"))).alias("m"))
        tops = F.map_from_entries(F.collect_list(F.struct("b", "w")))  # one entry per bundle
        top = values.groupBy("__key", "b").agg(F.max("m.w").alias("w")).groupBy("__key").agg(tops.alias("__tops")).withColumnRenamed("__key", "__g")
        held = values.join(top, F.col("__key") == F.col("__g")).join(open_.select(F.col("key").alias("__h"), "__least", "__bound"), F.col("__key") == F.col("__h"))
        # even with the best of all other bundles, what can't reach the best single row isn't wanted
        self.held = durable(held.filter(F.col("m.w") + F.col("__bound") - F.col("__tops")[F.col("b")] >= F.col("__least")).select("__key", "b", "t", "m"))
        self.pairs = None
        if depends:
            pair = F.array(*[F.struct(F.lit(self.place[a]).alias("b"), text[self.place[a]].alias("t"), F.lit(self.place[b]).alias("b2"), text[self.place[b]].alias("t2")) for a, b in depends])
            self.pairs = durable(near.select("__key", F.explode(pair).alias("p")).filter("p.t IS NOT NULL AND p.t2 IS NOT NULL").select("__key", "p.*").distinct())

    def searched(self, open_: DataFrame, block: int) -> DataFrame:
        """One search of each open group over the best ``block`` candidates of each bundle."""
        groups = open_.select(F.col("key").alias("__o"), "n_rows", "__bound")
        own = self.held.join(groups, F.col("__key") == F.col("__o"), "left_semi")
        at = F.row_number().over(W.partitionBy("__key", "b").orderBy(F.col("m.rank").desc(), "t"))
        # one more than the block: it bounds what is left out
        part = own.withColumn("at", at).filter(F.col("at") <= block + 1)
        cands = part.select("__key", "b", "at", F.when(F.col("at") <= block, F.col("t")).alias("t"), F.col("m.w").alias("w"), F.col("m.v").alias("v"), F.lit(None).cast("int").alias("b2"), F.lit(None).cast("string").alias("t2"))
        facts = cands
        if self.pairs is not None:
            one = cands.filter("t IS NOT NULL").select(F.col("__key").alias("k1"), F.col("b").alias("x"), F.col("t").alias("y"))
            two = one.select(F.col("k1").alias("k2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
            seen = self.pairs.join(one, (F.col("__key") == F.col("k1")) & (F.col("b") == F.col("x")) & (F.col("t") == F.col("y")), "left_semi")
            seen = seen.join(two, (F.col("__key") == F.col("k2")) & (F.col("b2") == F.col("x2")) & (F.col("t2") == F.col("y2")), "left_semi")
            facts = cands.unionByName(seen.select("__key", "b", F.lit(0).alias("at"), "t", F.lit(None).cast("double").alias("w"), F.lit(None).cast("string").alias("v"), "b2", "t2"))
        rules = [(left, right, [i for i, b in enumerate(self.bundles) if _has(b, left, self.row_id) and _has(b, right, self.row_id)]) for left, right in self.functional]
        run = _searcher(len(self.bundles), self.wanted, [("id" if x == self.row_id else x, "id" if y == self.row_id else y, on) for x, y, on in rules])
        picks = ", ".join(f"v{i} string" for i in range(len(self.bundles)))
        sorted_ = keyed(facts, "__key").sortWithinPartitions("__key", "b", "at")
        out = sorted_.mapInArrow(run, f"key {self.key_kind}, trust double, nodes bigint, proven boolean, {picks}")
        out = out.join(groups, F.col("key") == F.col("__o"))
        return out.select("key", "n_rows", *[F.from_json(f"v{i}", shape).alias(b.name) for i, (b, shape) in enumerate(zip(self.bundles, self.shape))], "trust", "nodes", "proven", "__bound", F.lit(0.0).alias("__least"))


def _searcher(total: int, wanted: Sequence[tuple[int, int]], rules: Sequence[tuple[str, str, list[int]]]):
    """The search as a function over batches (key, b, at, t, w, v, b2, t2), sorted by key, b, at."""
    import json

    def solve(options: list[list[tuple]], more: list[float | None], seen: set) -> tuple:
        tops = [o[0][0] if o else 0.0 for o in options]
        rest = [sum(tops[b:]) for b in range(total + 1)]
        best: list = [-1.0, [None] * total]
        nodes = 0

        def fits(b: int, x: tuple, chosen: list) -> bool:
            for i, j in wanted:
                if j == b and i < b and chosen[i] is not None and (i, chosen[i][1], j, x[1]) not in seen:
                    return False
                if i == b and j < b and chosen[j] is not None and (i, x[1], j, chosen[j][1]) not in seen:
                    return False
            for left, right, on in rules:
                if b in on:
                    for k in on:
                        other = chosen[k] if k < b else None
                        if other is not None and x[3][left] is not None and x[3][left] == other[3][left] and x[3][right] != other[3][right]:
                            return False
            return True

        def branch(b: int, got: float, chosen: list) -> None:
            nonlocal nodes
            if got + rest[b] <= best[0]:
                return
            if b == total:
                best[0], best[1] = got, list(chosen)
                return
            for x in options[b]:
                if got + x[0] + rest[b + 1] <= best[0]:
                    break  # they come in falling trust: none of the others can be better
                nodes += 1
                if fits(b, x, chosen):
                    branch(b + 1, got + x[0], [*chosen, x])
            branch(b + 1, got, [*chosen, None])

        branch(0, 0.0, [])
        got, chosen = best
        # what was left out of bundle b reaches `could` at most; on a tie it comes later by rank if all before b are first choices
        proven = True
        for b, w in enumerate(more):
            if w is None:
                continue
            could = sum(tops) - tops[b] + w
            first = chosen[b] is not None and all(chosen[k] is not None and chosen[k] is options[k][0] for k in range(b) if options[k])
            proven = proven and (could < got or (could == got and first))
        return got, nodes, proven, [None if c is None else c[2] for c in chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.float64(), pa.int64(), pa.bool_(), *[pa.string()] * total]
        names = ["key", "trust", "nodes", "proven", *[f"v{i}" for i in range(total)]]
        at, kind = None, pa.int64()
        options: list[list[tuple]] = [[] for _ in range(total)]
        more: list[float | None] = [None] * total
        seen: set = set()
        began = False

        def closed() -> tuple:
            got, nodes, proven, picks = solve(options, more, seen)
            return (at, got, nodes, proven, *picks)

        for batch in batches:
            out: list[tuple] = []
            kind = batch.column(0).type
            for key, b, _, t, w, v, b2, t2 in zip(*(c.to_pylist() for c in batch.columns)):
                if began and key != at:
                    out.append(closed())
                    options, more, seen = [[] for _ in range(total)], [None] * total, set()
                at, began = key, True
                if b2 is not None:
                    seen.add((b, t, b2, t2))
                elif t is None:
                    more[b] = w
                else:
                    options[b].append((w, t, v, json.loads(v) if rules else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (kind, *kinds))], names=names)
        if began:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(closed()), (kind, *kinds))], names=names)

    return run
