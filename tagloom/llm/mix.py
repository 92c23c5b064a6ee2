"""Mixing sources to target weights by pivotal dependent rounding.

Each source is to contribute its share of a total number of tokens. The wanted
tokens divided by the available ones are the copies that each of its documents
should have on average: a whole part that all get, and a fraction. The fractions are
rounded by the pivotal method: two documents trade probability mass, so that the
tokens of the pair stay what they were, until the copy of one of them is certain;
the other goes on to the next document. A task keeps one undecided document per
source; these residuals meet in a reduction tree of fixed fan-in. The tokens of a
source so differ from what was wanted by less than one document, and each document's
expected copies are exactly its fraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import durable

FAN_IN = 64
#: Rows of a run that are rounded at once; a longer run goes on with its open row and its series of draws.
PIECE = 50_000
SCHEMA = "doc_id bigint, source string, n_tokens bigint, base int, p double, bucket bigint, done boolean"


def _round_run(p: np.ndarray, w: np.ndarray, random: np.random.Generator, last: bool) -> np.ndarray:
    """Pivotal rounding of one run of (probability, weight); at most one stays open.

    With ``last`` the open one is rounded too, by a draw of its own probability.
    """
    p = p.astype(float).copy()
    draws = random.random(len(p) + 1)
    i = -1
    for j in range(len(p)):
        if not 0 < p[j] < 1:
            continue
        if i < 0:
            i = j
            continue
        wi, wj = w[i], w[j]
        mi, mj = p[i] * wi, p[j] * wj
        up, down = min(wi - mi, mj), min(mi, wj - mj)
        if draws[j] * (up + down) < down:
            # mass moves from j to i
            if wi - mi <= mj:
                p[i], p[j] = 1.0, max(0.0, (mj - up) / wj)
            else:
                p[i], p[j] = (mi + up) / wi, 0.0
        elif mi <= wj - mj:
            p[i], p[j] = 0.0, min(1.0, (mj + down) / wj)
        else:
            p[i], p[j] = (mi - down) / wi, 1.0
        if not 0 < p[i] < 1:
            i = j if 0 < p[j] < 1 else -1
    if last and i >= 0:
        p[i] = float(draws[-1] < p[i])
    return p


def _round_level(df: DataFrame, partitions: int, seed: int, level: int, last: bool, piece: int = PIECE) -> DataFrame:
    """One level of the tree: every (bucket, source) leaves at most one open row.

    Rows are sorted before they are rounded and the draws depend on the bucket, the
    source and the level only, so a task that runs again decides as before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: tuple | None = None
        random = np.random.default_rng(0)

        def settle(end: bool) -> pa.RecordBatch:
            ids, sources, tokens, bases, p, buckets = (np.array(x, dtype=object) for x in zip(*held))
            out = _round_run(p.astype(float), tokens.astype(float), random, last and end)
            done = (out <= 0) | (out >= 1)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids.tolist(), pa.int64()), pa.array(sources.tolist(), pa.string()), pa.array(tokens.tolist(), pa.int64()), pa.array((bases.astype(np.int64) + (out >= 1)).tolist(), pa.int32()), pa.array(np.where(done, 0.0, out)), pa.array(buckets.tolist(), pa.int64()), pa.array(done)],
                names=["doc_id", "source", "n_tokens", "base", "p", "bucket", "done"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[:6])):
                at = (row[5], row[1])
                if held and at != group:
                    yield settle(True)
                    held = []
                elif len(held) >= piece:
                    # a long run is settled in pieces: its open row goes on into the next one
                    out = settle(False)
                    held = [tuple(r[k] for k in ("doc_id", "source", "n_tokens", "base", "p", "bucket")) for r in out.filter(pc.invert(out.column("done"))).to_pylist()]
                    yield out.filter(out.column("done"))
                if at != group:
                    # one series of draws per run, which its pieces go on with
                    random = np.random.default_rng([seed, level, *f"{at[0]}|{at[1]}".encode()])
                    group = at
                held.append(row)
        if held:
            yield settle(True)

    cols = ["doc_id", "source", "n_tokens", "base", "p", "bucket"]
    return df.select(*cols).repartition(partitions, "bucket").sortWithinPartitions("bucket", "source", "doc_id").mapInArrow(run, SCHEMA)


def plan_shares(counts: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """Per target source: share, max_repeats, wanted and available tokens, copies on average."""
    # per-source sums are made on the map side; what is left has a row per source
    have = counts.groupBy("source").agg(F.sum("n_tokens").alias("have_tokens"))
    if total_tokens is None:
        total_tokens = have.agg(F.sum("have_tokens")).first()[0] or 0  # one number
    wanted = targets.select("source", "target_share", "max_repeats").join(have, "source", "left")
    want = F.col("target_share") * F.lit(total_tokens)
    got = F.coalesce("have_tokens", F.lit(0))
    return wanted.select(
        "source",
        "target_share",
        "max_repeats",
        want.alias("want_tokens"),
        got.alias("have_tokens"),
        F.when(got > 0, F.least(want / got, F.col("max_repeats").cast("double"))).otherwise(0.0).alias("copies"),
    )


def mix_sources(counts: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7) -> DataFrame:
    """The selection: doc_id, source, n_tokens, copies (at least 1) of each chosen document.

    ``counts`` has doc_id, source and n_tokens; ``targets`` source, target_share and
    max_repeats. The total defaults to the tokens of all of ``counts``. Documents of
    null or unlisted sources and those without tokens are never chosen; a source whose
    documents don't suffice even at max_repeats is used in full and falls short. Equal
    sizes, repeated rows and empty tables need no special care; the same input and
    seed give the same selection.
    """
    spark = counts.sparkSession
    plan = plan_shares(counts, targets, total_tokens)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    base = F.floor(F.col("copies") + F.lit(1e-12)).cast("int")
    rows = counts.filter("n_tokens > 0").join(plan.select("source", "copies"), "source")
    rows = rows.select("doc_id", "source", "n_tokens", base.alias("base"), F.greatest(F.lit(0.0), F.col("copies") - base).alias("p"), F.pmod(F.xxhash64("doc_id"), F.lit(n)).alias("bucket"))
    level, leaves = 0, durable(_round_level(rows, n, seed, 0, n == 1))
    parts, rest = [leaves.filter("done")], leaves.filter("NOT done")
    while n > 1:
        n, level = -(-n // FAN_IN), level + 1
        settled = _round_level(rest.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN)), n, seed, level, n == 1)
        parts.append(settled.filter("done"))
        rest = settled.filter("NOT done")
    chosen = reduce(DataFrame.unionByName, parts)
    return chosen.filter("base > 0").select("doc_id", "source", "n_tokens", F.col("base").alias("copies"))


def mix_shares(selection: DataFrame, counts: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """What came out, a row per target source.

    actual_share is the source's part of the tokens of the mix that came out, share_of_total its
    part of the total that was asked for: where a source falls short, the mix is smaller
    than the total, and the others' parts of it grow although they have no more tokens
    than they should. shortfall_tokens is what the source lacks of its target, 0 where
    it lacks less than a document; within_a_document says whether a source that has
    enough is within its longest document of the target.
    """
    got = selection.groupBy("source").agg(F.count("*").alias("n_docs"), F.max("copies").alias("most_copies"), F.max("n_tokens").alias("longest"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"))
    got = durable(got)
    mix_tokens = got.agg(F.sum("tokens")).first()[0] or 0  # one number
    out = plan_shares(counts, targets, total_tokens).join(got, "source", "left")
    tokens = F.coalesce("tokens", F.lit(0))
    lack = F.col("want_tokens") - tokens
    return out.select(
        "source",
        "target_share",
        "max_repeats",
        F.round("want_tokens").cast("bigint").alias("target_tokens"),
        "have_tokens",
        tokens.alias("actual_tokens"),
        (tokens / F.lit(max(1, mix_tokens)).cast("double")).alias("actual_share"),
        F.when(F.col("target_share") > 0, tokens * F.col("target_share") / F.col("want_tokens")).otherwise(0.0).alias("share_of_total"),
        F.when(lack > F.coalesce("longest", F.lit(0)), F.ceil(lack)).otherwise(0).cast("bigint").alias("shortfall_tokens"),
        ((lack <= F.coalesce("longest", F.lit(0))) & (-lack <= F.coalesce("longest", F.lit(0)))).alias("within_a_document"),
        F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
    )
