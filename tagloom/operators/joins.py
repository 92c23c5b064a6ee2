"""Joins of tag tables: group matching, annotation, overrides, assertions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_groups(tables: Sequence[DataFrame], key: str, columns: Sequence[Sequence[str]], keep: str = "full", size: int = 10_000) -> DataFrame:
    """(key, part, g0, g1, …): per key the rows of each table as an array of structs, sorted; empty
    where a table lacks the key.

    A key with up to ``size`` rows in each table is one row, part 0. A key with more comes
    in several parts of about that size, into which its rows go by a hash, so that no row
    gathers an unbounded group; the parts of a key are to be read together. Null keys are
    left out. ``keep`` is full, inner or first (keys of the first table), by key.
    """
    key_ = F.col(f"`{key}`")
    counts = None
    for i, df in enumerate(tables):
        one = df.filter(key_.isNotNull()).groupBy(key_.alias("__key")).agg(F.count("*").alias(f"__n{i}"))
        how = {"full": "full_outer", "inner": "inner", "first": "left"}[keep]
        counts = one if counts is None else counts.join(one, "__key", how)
    most = F.greatest(*[F.coalesce(f"__n{i}", F.lit(0)) for i in range(len(tables))], F.lit(0))
    parts = counts.select("__key", F.ceil(most / size).cast("int").alias("__p"))
    out = parts.select("__key", F.explode(F.sequence(F.lit(0), F.col("__p") - 1)).alias("part"))
    large = parts.filter("__p > 1").withColumnRenamed("__key", "__large")
    for i, (df, cols) in enumerate(zip(tables, columns)):
        row = F.struct(*cols)
        rows = df.filter(key_.isNotNull()).select(key_.alias("__key"), row.alias("__row")).join(large, F.col("__key") == F.col("__large"), "left")
        part = F.coalesce(F.pmod(F.xxhash64("__row"), F.col("__p")), F.lit(0)).cast("int")
        one = rows.groupBy("__key", part.alias("part")).agg(F.sort_array(F.collect_list("__row")).alias(f"g{i}"))
        out = out.join(one, ["__key", "part"], "left")
    empty = [F.coalesce(f"g{i}", F.array().cast(out.schema[f"g{i}"].dataType)).alias(f"g{i}") for i in range(len(tables))]
    return out.select(F.col("__key").alias(key), "part", *empty)


def count_groups(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n_left, n_right) of all keys of either side: a cogroup of any size of groups."""
    a, b = left.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n_left")), right.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n_right"))
    return a.join(b, "k", "full_outer").select(F.col("k").alias(key), F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))


def first_match(left: DataFrame, right: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str], prefix: str = "") -> DataFrame:
    """All rows of ``left`` with the ``columns`` of the first matching row of ``right``, else nulls."""
    rank = F.struct(*order)
    one = right.groupBy(*key).agg(F.min_by(F.struct(*columns), rank).alias("__r"))
    return left.join(one, list(key), "left").select(*[left[c] for c in left.columns], *[F.col(f"__r.{c}").alias(f"{prefix}{c}") for c in columns])


def override(base: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of ``new``'s keys, ``columns`` from ``new``, all others from ``base`` (null where absent)."""
    rest = [c for c in base.columns if c not in columns and c not in key]
    n = new.select(*key, *[F.col(c).alias(f"__n_{c}") for c in columns])
    return base.join(n, list(key), "right").select(*key, *[F.col(f"__n_{c}").alias(c) for c in columns], *rest)


def set_flag_where(df: DataFrame, ids: DataFrame, key: str, flags: str, bit: int) -> DataFrame:
    """Sets a flag bit on the rows whose key is listed; setting it twice changes nothing."""
    marks = ids.select(F.col(key).alias("__id")).distinct().withColumn("__hit", F.lit(True))
    new = F.when(F.col("__hit"), F.col(flags).bitwiseOR(F.lit(bit))).otherwise(F.col(flags))
    return df.join(marks, F.col(key) == F.col("__id"), "left").withColumn(flags, new).drop("__id", "__hit")


def require_subset(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inner join of two tables of which the first must be contained in the second.

    A row of ``left`` without partner raises when it is computed.
    """
    marked = right.withColumn("__there", F.lit(True))
    out = left.join(marked, list(key), "left")
    ok = F.assert_true(F.col("__there").isNotNull(), F.concat(F.lit("no partner for "), F.concat_ws(":", *[F.col(k).cast("string") for k in key])))
    return out.withColumn("__ok", ok).filter("__ok IS NULL").drop("__ok", "__there")


def whitelist(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed."""
    return df.join(ids.select(key), key, "left_semi")


def associate(tags: DataFrame, associations: DataFrame, key: Sequence[str], gene: str = "gene") -> DataFrame:
    """Tags with the genes that they are associated with."""
    return tags.join(associations.select(*key, gene, "ambig"), list(key))


def catalog(sources: DataFrame, tiles: DataFrame, source: str, blacklist: DataFrame | None = None) -> DataFrame:
    """Tile catalogue: every listed tile of every source, less the blacklisted ones.

    Each source lists its tiles as an array, exploded beside it: no cross join.
    """
    per = tiles.groupBy("kind").agg(F.collect_set("tile").alias("__t"))  # tiles of a kind: a few hundred names
    out = sources.join(per, "kind").select(*[sources[c] for c in sources.columns], F.explode("__t").alias("tile")).withColumn("id", F.concat_ws("", source, "tile"))
    return out if blacklist is None else out.join(blacklist.select("id"), "id", "left_anti")


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def assert_disjoint(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The keys that both sides have: an empty result means that they are disjoint."""
    return a.select(key).distinct().join(b.select(key), key, "left_semi")


def patched(base: Column, patch: Column, at: int) -> Column:
    """A text with part of it replaced from a 1-based position, where there is a patch."""
    return F.coalesce(F.overlay(base, patch, F.lit(at)), base)
