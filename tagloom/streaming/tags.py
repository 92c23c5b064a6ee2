"""Streaming forms of operators whose batch semantics have bounded state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState


def first_seen(stream: DataFrame, keys: Sequence[str], at: str, delay: str) -> DataFrame:
    """The first row of each key; a key's state ends with the watermark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, by: Sequence[str], at: str, size: str, delay: str, slide: str | None = None) -> DataFrame:
    """Rows per window and group; late rows beyond ``delay`` don't count."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    return stream.withWatermark(at, delay).groupBy(w, *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def sessions(stream: DataFrame, by: Sequence[str], at: str, gap: str, delay: str) -> DataFrame:
    """Runs of rows without a pause of ``gap``: the streaming form of islands."""
    return stream.withWatermark(at, delay).groupBy(F.session_window(at, gap), *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def capped_per_key(stream: DataFrame, bucket: Column, columns: Sequence[str], most: int) -> DataFrame:
    """At most ``most`` rows per bucket over the whole stream: fair sampling with a counter as state."""
    kept = stream.select(bucket.cast("string").alias("bucket"), *columns)
    schema = kept.schema

    def take(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (n,) = state.get if state.exists else (0,)
        for pdf in frames:
            part = pdf.sort_values(list(columns)).head(max(0, most - n))
            n += len(part)
            if len(part):
                yield part
        state.update((n,))

    return kept.groupBy("bucket").applyInPandasWithState(take, schema, "n int", "append", "NoTimeout")
