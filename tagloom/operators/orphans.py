"""References to records that do not exist.

Parent keys are whole numbers of 64 bits. The sorted keys are compressed into contiguous
runs, a row (start, end) each, cut only at the borders of buckets of fixed width. A
reference is matched as-of: it meets the runs of its bucket by equality, takes the one
with the last start not after its key, and is an orphan if its key lies beyond that
run's end. Only references that hit look up their parent's state, in a second equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Keys per bucket as a power of two: bounds the runs that a reference can meet (half of the bucket's width).
BITS = 8
_BLANKS = " \t\n\x0b\x0c\r"


def whole_number(text: Column) -> Column:
    """A dump id as a whole number: outer blanks, leading zeros and '.0' don't count.

    Null where the text is no whole number of 64 bits, however long it is.
    """
    s = F.btrim(text.cast("string"), F.lit(_BLANKS))
    digits = F.when(F.instr(s, ".") == 0, s).otherwise(F.regexp_extract(s, r"^([+-]?\d+)\.0*$", 1))
    return F.when(digits.rlike(r"^[+-]?[0-9]+$"), digits).try_cast("bigint")


def refers(text: Column) -> Column:
    """Whether a field refers to anything: null, empty, blank and the dump's \\N don't."""
    return F.coalesce(~F.btrim(text.cast("string"), F.lit(_BLANKS)).isin("", "\\N"), F.lit(False))


def parent_states(parents: Sequence[tuple[DataFrame, Column, Column, Column, Column]]) -> DataFrame:
    """(kind, key, first_loaded, all_deleted) of the keys of parent tables, given as (table,
    key, kind, load time, deletion time). Rows whose key is null or no 64-bit whole number
    are no parents."""
    rows = None
    for df, key, kind, loaded, deleted in parents:
        one = df.select(kind.alias("kind"), key.try_cast("bigint").alias("key"), loaded.alias("loaded"), deleted.isNotNull().alias("deleted"))
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.filter("key IS NOT NULL AND kind IS NOT NULL")
    return rows.groupBy("kind", "key").agg(F.min("loaded").alias("first_loaded"), F.min("deleted").alias("all_deleted"))


def key_runs(states: DataFrame) -> DataFrame:
    """(kind, bucket, start, end): the contiguous runs of the parents' keys, a row each."""
    keys = states.select("kind", "key", F.shiftright("key", BITS).alias("bucket"))
    # keys that follow each other keep their distance from their number in the bucket
    place = F.col("key") - F.row_number().over(W.partitionBy("kind", "bucket").orderBy("key"))
    return keys.withColumn("run", place).groupBy("kind", "bucket", "run").agg(F.min("key").alias("start"), F.max("key").alias("end")).drop("run")


def orphan_references(refs: DataFrame, ref: Column, ref_kind: Column, loaded: Column, states: DataFrame, keep: Sequence[Column]) -> DataFrame:
    """The bad references among ``refs``: ``keep`` columns, period (yyyy-MM) and kind.

    ``states`` comes from :func:`parent_states`. kind is 'missing' (no parent has the key),
    'deleted' (all its rows are deleted) or 'late' (its first row came after the
    referring row). A field that holds no reference is skipped; one that holds something
    else than a 64-bit whole number, or has a null kind, can't be found and is 'missing'.
    A null load time of either side is never late; the period of a null time is null.
    Every referring row counts, also repeated ones. Both joins are equi-joins with at
    most one match a row, so that adaptive skew handling splits a hot key's rows.
    """
    picked = refs.filter(refers(ref)).select(*keep, ref_kind.alias("__kind"), whole_number(ref).alias("__key"), loaded.alias("__loaded"))
    names = [f"`{c}`" for c in picked.columns if not c.startswith("__")]
    period = F.date_format("__loaded", "yyyy-MM").alias("period")
    # what can't match meets no bucket
    nowhere = F.col("__key").isNull() | F.col("__kind").isNull()
    lost = picked.filter(nowhere).select(*names, period, F.lit("missing").alias("kind"))
    found = picked.filter(~nowhere).withColumn("__bucket", F.shiftright("__key", BITS))
    # a run reaches, for the as-of match, to the next one's start
    following = F.lead("start").over(W.partitionBy("kind", "bucket").orderBy("start"))
    runs = key_runs(states).withColumn("until", following)
    runs = runs.select(F.col("kind").alias("__k"), F.col("bucket").alias("__b"), F.col("start").alias("__start"), F.col("end").alias("__end"), F.col("until").alias("__until"))
    same = (F.col("__kind") == F.col("__k")) & (F.col("__bucket") == F.col("__b"))
    met = found.join(runs, same & (F.col("__key") >= F.col("__start")) & (F.col("__until").isNull() | (F.col("__key") < F.col("__until"))), "left")
    hit = met.withColumn("__hit", F.when(F.col("__key") <= F.col("__end"), F.col("__key")))
    side = states.select(F.col("kind").alias("__sk"), F.col("key").alias("__s"), "first_loaded", "all_deleted")
    known = hit.join(side, (F.col("__kind") == F.col("__sk")) & (F.col("__hit") == F.col("__s")), "left")
    kind = F.when(F.col("__hit").isNull(), "missing").when(F.col("all_deleted"), "deleted").when(F.col("first_loaded") > F.col("__loaded"), "late")
    return known.select(*names, period, kind.alias("kind")).filter("kind IS NOT NULL").unionByName(lost)
