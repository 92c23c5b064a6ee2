"""Sinks: partitioned tables and text formats, written by the engine's own writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_tags(df: DataFrame, path: str, by: Sequence[str] = ("sample", "tile")) -> None:
    """Parquet, partitioned so that later scans of a sample or tile read only its files."""
    df.repartition(*by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_tsv(df: DataFrame, path: str, header: bool = False, sep: str = "\t") -> None:
    """Delimited text; nulls and empty texts are both empty fields."""
    df.write.mode("overwrite").options(sep=sep, header=str(header).lower(), nullValue="", emptyValue="", quote="").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def trimmed_read3(seq: Column, delimiter_end: Column, read_start: Column, most: int = 100) -> Column:
    """The 3' read from the end of the delimiter, or from its own start where there is none."""
    start = F.when(delimiter_end >= 0, delimiter_end).otherwise(read_start)
    return F.substring(seq, start + 1, F.lit(most))


def write_seqqual(df: DataFrame, path: str, read5: tuple[int, int], delimiter_end: str, read3_start: int, most: int = 100, by: Sequence[str] = ("sample", "tile")) -> None:
    """Sequences and qualities of both reads as delimited text: cluster, seq5, qual5, seq3, qual3, a folder per sample and tile.

    ``read5`` is the 5' read's 0-based start and length in ``seq`` and ``qual``; the 3' read
    begins at the end of the delimiter or, without one, at ``read3_start``.
    """
    cut5 = lambda c: F.substring(F.col(c), read5[0] + 1, read5[1])
    cut3 = lambda c: trimmed_read3(F.col(c), F.col(delimiter_end), F.lit(read3_start), most)
    rows = df.select(*by, "cluster", cut5("seq").alias("seq5"), cut5("qual").alias("qual5"), cut3("seq").alias("seq3"), cut3("qual").alias("qual3"))
    rows.repartition(*by).write.mode("overwrite").partitionBy(*by).options(sep="\t", quote="", emptyValue="", nullValue="").csv(path)


def fastq_lines(name: Column, seq: Column, qual: Column) -> Column:
    return F.concat(F.lit("@"), name, F.lit("\n"), seq, F.lit("\n+\n"), qual)


def write_fastq(df: DataFrame, path: str, name: Column, seq: Column, qual: Column) -> None:
    """One four-line record per row, gzip-compressed parts."""
    df.select(fastq_lines(name, seq, qual).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def sam_lines(df: DataFrame, tags: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Alignments as text with more tags (name, type letter, value); null values give no tag."""
    fixed = [F.col(c).cast("string") for c in ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")]
    old = F.array_join(F.transform(F.map_entries("tags"), lambda e: F.concat(e["key"], F.lit(":Z:"), e["value"])), "\t")
    more = [F.when(v.isNotNull(), F.concat(F.lit(f"{n}:{t}:"), v.cast("string"))) for n, t, v in tags]
    return df.select(F.concat_ws("\t", *fixed, F.when(old != "", old), *more).alias("value"))


def fasta_lines(name: Column, seq: Column, width: int = 72) -> Column:
    from tagloom.operators.annot import wrapped

    return F.concat(F.lit(">"), name, F.lit("\n"), wrapped(seq, width))


def write_sorted(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Parquet sorted by those of the keys that the table has, so that row groups can be skipped."""
    have = [k for k in keys if k in df.columns]
    (df.repartitionByRange(*have).sortWithinPartitions(*have) if have else df).write.mode("overwrite").parquet(path)


def write_statistics(df: DataFrame, path: str) -> None:
    """Gene statistics as parquet and as CSV."""
    df.write.mode("overwrite").parquet(f"{path}.parquet")
    write_csv(df, f"{path}.csv")
