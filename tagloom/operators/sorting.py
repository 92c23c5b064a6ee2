"""Total orders over whole tables: a range-partitioned sort with the number of each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.session import durable


def numbered(df: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """Rows in order with their number from 0.

    The sort is range-partitioned; a row's number is that within its partition plus the
    sizes of the partitions before, so no window spans the table. ``order`` should tell
    all rows apart; rows that it doesn't are numbered in any order. An empty table stays
    empty.
    """
    at = durable(df.orderBy(*order)).withColumn("__id", F.monotonically_increasing_id())
    part, inside = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    rows = at.select("*", part.alias("__part"), inside.alias("__inside"))
    # a row per partition
    sizes = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return rows.join(before, F.col("__part") == F.col("__p")).withColumn(name, F.col("__before") + F.col("__inside")).drop("__id", "__part", "__inside", "__p", "__before")
