"""Percentiles of very large columns from deterministic, mergeable rank summaries.

A summary of n values is a list of tuples in order of their value v. Each tuple holds
intervals for two ranks: how many values lie below v, and how many up to v. A task
sorts what it reads and so starts from exact ranks; it then leaves out tuples as long
as the ranks between two neighbours stay within the permitted uncertainty. Summaries
merge by adding the intervals; the uncertainty of the merged one is tracked, not
assumed, and its half bounds the rank error of any percentile. The permitted
uncertainty grows from level to level of the merge tree up to the final bound.

Repeated values are one tuple, so ties cost nothing and are answered exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 32
#: Values that a task sorts at once.
LEAF_VALUES = 4_000_000
BOUNDS = ("below_lo", "below_hi", "upto_lo", "upto_hi")


class Summary:
    """Values with rank intervals; every array has one entry per tuple."""

    __slots__ = ("n", "v", "below_lo", "below_hi", "upto_lo", "upto_hi")

    def __init__(self, n: int, v: np.ndarray, below_lo: np.ndarray, below_hi: np.ndarray, upto_lo: np.ndarray, upto_hi: np.ndarray) -> None:
        self.n, self.v = n, v
        self.below_lo, self.below_hi, self.upto_lo, self.upto_hi = below_lo, below_hi, upto_lo, upto_hi

    @classmethod
    def of_sorted(cls, values: np.ndarray) -> Summary:
        """The exact summary of sorted values."""
        first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.array([], dtype=np.int64)
        below = first.astype(np.int64)
        upto = np.append(below[1:], len(values)).astype(np.int64) if len(values) else below
        return cls(len(values), values[first], below, below, upto, upto)

    def rank_error(self) -> int:
        """Largest possible distance between an asked rank and the answer's ranks."""
        inner = (self.below_hi[1:] + 1 - self.upto_lo[:-1] + 1) // 2
        own = np.maximum(self.below_hi + 1 - self.upto_lo, 0)  # a tuple whose own ranks are unsure
        ends = [self.below_hi[0], self.n - self.upto_lo[-1]] if len(self.v) else [0]
        return int(max(0, inner.max(initial=0), (own.max(initial=0) + 1) // 2, *ends))

    def compressed(self, error: float) -> Summary:
        """As few tuples as keep the rank error within ``error`` (or what it is already)."""
        if len(self.v) < 3:
            return self
        room, keep, at, last = int(2 * error), [0], 0, len(self.v) - 1
        while at < last:
            # furthest tuple whose ranks begin within the room after this one's end
            ahead = int(np.searchsorted(self.below_hi, self.upto_lo[at] + room - 1, side="right")) - 1
            at = min(last, max(at + 1, ahead))
            keep.append(at)
        k = np.array(keep)
        return Summary(self.n, self.v[k], *(getattr(self, b)[k] for b in BOUNDS))

    def _at(self, values: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rank intervals of any values within this summary."""
        left, right = np.searchsorted(self.v, values, side="left"), np.searchsorted(self.v, values, side="right")
        hit = right > left
        here = np.minimum(left, max(len(self.v) - 1, 0))
        lo = np.where(left > 0, self.upto_lo[np.maximum(left - 1, 0)], 0)
        hi = np.where(right < len(self.v), self.below_hi[np.minimum(right, len(self.v) - 1)], self.n)
        return (
            np.where(hit, self.below_lo[here], lo),
            np.where(hit, self.below_hi[here], hi),
            np.where(hit, self.upto_lo[here], lo),
            np.where(hit, self.upto_hi[here], hi),
        )

    def merged(self, other: Summary) -> Summary:
        if not self.n or not other.n:
            return self if self.n else other
        v = np.union1d(self.v, other.v)
        return Summary(self.n + other.n, v, *(a + b for a, b in zip(self._at(v), other._at(v))))

    def quantile(self, q: float) -> float:
        """A value whose rank is within rank_error() of ceil(q * n)."""
        rank = max(1, int(np.ceil(q * self.n - 1e-9)))
        off = np.maximum(np.maximum(self.below_hi + 1 - rank, rank - self.upto_lo), 0)
        return float(self.v[int(np.argmin(off))])


def merge_all(parts: list[Summary]) -> Summary:
    """Pairwise, so that each tuple takes part in few merges."""
    while len(parts) > 1:
        parts = [parts[i].merged(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _schema(keys: str) -> str:
    return f"{keys}, part bigint, n bigint, v array<double>, " + ", ".join(f"{b} array<bigint>" for b in BOUNDS)


def _row(s: Summary) -> dict:
    return {"n": s.n, "v": s.v.astype(float)} | {b: getattr(s, b) for b in BOUNDS}


def _read(table: pa.Table) -> list[Summary]:
    cols = [table.column("v").combine_chunks(), *(table.column(b).combine_chunks() for b in BOUNDS)]
    ends = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(cols[0])))))
    flat = [np.asarray(c.flatten()) for c in cols]
    return [Summary(n, *(f[a:b] for f in flat)) for n, a, b in zip(table.column("n").to_pylist(), ends[:-1], ends[1:])]


def summarize(df: DataFrame, groups: Sequence[str], value: str, error: float = 0.002) -> DataFrame:
    """One summary per group with a rank error of at most ``error`` times its size.

    Null and NaN values don't count; a group without values has no row. Nulls in the
    grouping columns form a group. Each task reads its rows once and hands on one small
    summary per group, so a group with a third of all rows is spread over all tasks;
    the partial summaries meet FAN_IN at a time. Clashing column names can't occur, as
    only the named columns are read.
    """
    rows = df.select(*[F.col(f"`{g}`") for g in groups], F.col(f"`{value}`").cast("double").alias("__value")).filter("__value IS NOT NULL AND NOT isnan(__value)")
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__value").schema.fields)
    parts = max(1, rows.rdd.getNumPartitions())
    levels = 1
    while FAN_IN**levels < parts:
        levels += 1
    #: permitted error after the leaves (0) and after each level of merging
    allowed = [error * (0.5 + 0.5 * i / levels) for i in range(levels + 1)]
    schema, g = _schema(keys), list(groups)

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            code = np.zeros(table.num_rows, dtype=np.int64)
            for name in g:
                col = table.column(name).combine_chunks().dictionary_encode()
                at = np.asarray(pc.fill_null(col.indices, len(col.dictionary)), dtype=np.int64)
                code = np.unique(code * (len(col.dictionary) + 1) + at, return_inverse=True)[1]
            values = np.asarray(table.column("__value").combine_chunks())
            order = np.lexsort((values, code))
            code, values = code[order], values[order]
            first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            ends = np.append(first[1:], len(code))
            out = [_row(Summary.of_sorted(values[a:b]).compressed(allowed[0] * (b - a))) for a, b in zip(first, ends)]
            picked = table.select(g).take(pa.array(order[first]))
            columns = [*(picked.column(name).combine_chunks() for name in g), pa.array([part] * len(out), pa.int64()), pa.array([o["n"] for o in out], pa.int64()), pa.array([o["v"] for o in out], pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array([o[b] for o in out], pa.list_(pa.int64())) for b in BOUNDS)], names=[*g, "part", "n", "v", *BOUNDS])

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= LEAF_VALUES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    out = rows.mapInArrow(leaf, schema)
    for level in range(1, levels + 1):
        out = merge_summaries(out.withColumn("part", F.floor(F.col("part") / FAN_IN)), [*g, "part"], allowed[level], schema)
    return out


def merge_summaries(df: DataFrame, by: Sequence[str], error: float, schema: str) -> DataFrame:
    """Summaries merged within each value of ``by`` and compressed to ``error``."""

    def merge(table: pa.Table) -> pa.Table:
        s = merge_all(_read(table))
        s = s.compressed(error * s.n)
        out = table.slice(0, 1)
        for name, value in _row(s).items():
            at = out.schema.get_field_index(name)
            kind = out.schema.field(at)
            out = out.set_column(at, kind, pa.array([value], kind.type))
        return out

    return df.groupBy(*[F.col(f"`{c}`") for c in by]).applyInArrow(merge, schema)


def combine(summaries: DataFrame, keep: Sequence[str], over: str, error: float) -> DataFrame:
    """Summaries of several days (or whatever date ``over`` is) combined to those of ``keep``.

    Days meet a month's worth at a time, then these. The error is that of the parts
    plus half of ``error``.
    """
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in summaries.select(*keep).schema.fields)
    schema = _schema(keys)
    cols = [*keep, "part", "n", "v", *BOUNDS]
    days = summaries.withColumn("part", F.coalesce(F.floor(F.unix_date(F.col(f"`{over}`")) / FAN_IN), F.lit(0))).select(*cols)
    months = merge_summaries(days, [*keep, "part"], error * 1.25, schema)
    return merge_summaries(months.withColumn("part", F.lit(0).cast("bigint")), [*keep, "part"], error * 1.5, schema)


def percentiles(summaries: DataFrame, keep: Sequence[str], qs: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Percentiles and the tracked rank error of each summary.

    pNN is a value whose rank differs from ceil(q * n) by at most rank_error.
    """
    names = [f"p{round(q * 100):02d}" for q in qs]
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in summaries.select(*keep).schema.fields)
    schema = f"{keys}, n bigint, " + ", ".join(f"{x} double" for x in names) + ", rank_error bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = _read(pa.Table.from_batches([batch]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep))), pa.array([s.n for s in parts], pa.int64()), *(pa.array([s.quantile(q) for s in parts], pa.float64()) for q in qs), pa.array([s.rank_error() for s in parts], pa.int64())],
                names=[*keep, "n", *names, "rank_error"],
            )

    return summaries.select(*keep, "n", "v", *BOUNDS).mapInArrow(read, schema)
