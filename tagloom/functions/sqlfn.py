"""Sequence functions for SQL: temporary functions that the optimizer inlines, and one in Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name(arguments) -> type, body. The bodies are plain SQL, so nothing leaves the engine.
FUNCTIONS = {
    "reverse_complement(s STRING)": ("STRING", "translate(reverse(s), 'ATUGCatugc', 'TAACGtaacg')"),
    "edit_within(a STRING, b STRING, k INT)": ("BOOLEAN", "levenshtein(a, b, k) >= 0"),
    "hamming_distance(a STRING, b STRING)": ("INT", "CASE WHEN least(length(a), length(b)) = 0 THEN 0 ELSE size(filter(sequence(1, greatest(1, least(length(a), length(b)))), i -> substr(a, i, 1) <> substr(b, i, 1))) END"),
    "trailing_run(s STRING, letters STRING)": ("INT", "length(s) - length(trim(TRAILING letters FROM s))"),
    "has_flag(flags INT, mask INT)": ("BOOLEAN", "(flags & mask) <> 0"),
    "bare_id(s STRING)": ("STRING", "split_part(s, '.', 1)"),
}


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session's SQL; registering them again replaces them."""
    for head, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    import pandas as pd
    from pyspark.sql import functions as F

    from tagloom.operators.reads import HEAD_SCORES, TAIL_SCORES, best_segments

    def best_segment(column):
        starts, ends = best_segments(column.where(column.notna(), None).tolist(), TAIL_SCORES, HEAD_SCORES, 5, 20)
        return pd.DataFrame({"start": starts.astype("int32"), "end": ends.astype("int32")})

    best_segment.__annotations__ = {"column": pd.Series, "return": pd.DataFrame}
    spark.udf.register("best_segment", F.pandas_udf(best_segment, "start int, end int"))
