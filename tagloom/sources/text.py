"""Readers of text formats: tags, alignments, reads, sequences, annotation, database dumps.

All go through the engine's own readers (compression by file name, splittable where the
codec is), with explicit schemas; nothing is inferred by an extra pass.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from tagloom import schemas


def delimited(spark: SparkSession, path: str | list[str], schema: str, sep: str = "\t", null: str | None = None, comment: str | None = None) -> DataFrame:
    """A delimited file without quoting. Empty fields stay empty texts (null for numbers);
    only ``null`` stands for null. Lines with fewer fields have nulls, further fields are
    left out, and a field that doesn't cast is null."""
    rows = spark.read.text(path)
    if comment:
        rows = rows.filter(~F.col("value").startswith(comment))
    f = F.split(F.regexp_replace("value", "\r$", ""), re.escape(sep), -1)
    fields = StructType.fromDDL(schema).fields
    raw = rows.filter(F.length("value") > 0).select(f.alias("f"))

    def field(i: int, kind: DataType) -> Column:
        text = F.get("f", F.lit(i))
        text = text if null is None else F.when(text != null, text)
        return text if isinstance(kind, StringType) else text.try_cast(kind)

    return raw.select(*[field(i, x.dataType).alias(x.name) for i, x in enumerate(fields)])


def taginfo(spark: SparkSession, path: str, kind: str = "dedup") -> DataFrame:
    """Tag tables: raw, dedup or refined. Empty modifications are '', not null."""
    return delimited(spark, path, {"raw": schemas.TAGINFO_RAW, "dedup": schemas.TAGINFO, "refined": schemas.REFINED_TAGINFO}[kind])


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments as text: the eleven fields (pos 1-based), tags as a map, tile and cluster from the name."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("@") & (F.length("value") > 0)).select(f.alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    tags = F.filter(F.slice("f", F.lit(12), F.greatest(F.size("f"), F.lit(1))), lambda t: t.rlike("^[A-Za-z][A-Za-z0-9]:[A-Za-z]:"))
    keys = F.transform(tags, lambda t: F.substring(t, 1, 2))
    return rows.select(
        at(0).alias("qname"), at(1).cast("int").alias("flag"), at(2).alias("rname"), at(3).cast("int").alias("pos"), at(4).cast("int").alias("mapq"), at(5).alias("cigar"), at(6).alias("rnext"), at(7).cast("int").alias("pnext"), at(8).cast("int").alias("tlen"), at(9).alias("seq"), at(10).alias("qual"),
        F.map_from_arrays(F.array_distinct(keys), F.transform(F.array_distinct(keys), lambda k: F.substring(F.get(F.filter(tags, lambda t: F.substring(t, 1, 2) == k), F.lit(0)), 6, 1 << 30))).alias("tags"),
        F.split_part(at(0), F.lit(":"), F.lit(1)).alias("tile"), F.split_part(at(0), F.lit(":"), F.lit(2)).try_cast("bigint").alias("cluster"),
    )


def sam_filter(df: DataFrame, require: int = 0, exclude: int = 0, least_mapq: int = 0) -> DataFrame:
    """Alignments with all bits of ``require``, none of ``exclude`` and the least quality."""
    flag = F.col("flag")
    return df.filter((flag.bitwiseAND(F.lit(require)) == require) & (flag.bitwiseAND(F.lit(exclude)) == 0) & (F.col("mapq") >= least_mapq))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """Four-line records of all files of a path: name, seq, qual. Files are the partitions."""
    from tagloom.sources.binary import register

    register(spark)
    return spark.read.format("fastqfiles").load(path)


def fasta(spark: SparkSession, path: str, chunk: int = 100_000) -> DataFrame:
    """Sequences in pieces of at most ``chunk`` letters: chrom, chunk_no (from 0), seq."""
    rows = spark.read.option("lineSep", ">").text(path).filter(F.length(F.trim("value")) > 0)
    name = F.regexp_extract("value", r"^(\S+)", 1)
    seq = F.regexp_replace(F.substring(F.col("value"), F.instr("value", "\n") + 1, F.length("value")), r"\s", "")
    n = F.floor((F.greatest(F.length("seq"), F.lit(1)) - 1) / chunk)
    return rows.select(name.alias("chrom"), seq.alias("seq")).select("chrom", "seq", F.explode(F.sequence(F.lit(0).cast("bigint"), n)).alias("chunk_no")).select("chrom", "chunk_no", F.substring(F.col("seq"), (F.col("chunk_no") * chunk + 1).cast("int"), F.lit(chunk)).alias("seq"))


def fetch_sequences(regions: DataFrame, genome: DataFrame, chunk: int = 100_000, key: str = "name") -> DataFrame:
    """Sequences of (chrom, start, end, strand, key) regions, clamped to the sequence; - is reverse complemented.

    A region meets only the pieces it touches: an equi-join on (chrom, piece).
    """
    from tagloom.functions.seq import reverse_complement

    lo = F.greatest("start", F.lit(0))
    r = regions.select(key, "chrom", lo.alias("start"), "end", "strand").filter("start < end")
    pieces = r.withColumn("chunk_no", F.explode(F.sequence(F.floor(F.col("start") / chunk), F.floor((F.col("end") - 1) / chunk))))
    met = pieces.join(genome, ["chrom", "chunk_no"])
    first = F.greatest(F.col("start") - F.col("chunk_no") * chunk, F.lit(0))
    part = F.substring(F.col("seq"), (first + 1).cast("int"), (F.col("end") - F.col("chunk_no") * chunk - first).cast("int"))
    whole = met.groupBy(key, "strand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", part.alias("p")))), lambda x: x["p"]), "").alias("seq"))
    return whole.select(key, F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """Nine-column annotation (GTF or GFF3): 1-based inclusive coordinates as in the file."""
    return delimited(spark, path, schemas.GTF, comment="#")


def bed(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, schemas.INTERVALS, comment="#")


def dump(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of a database dump: tab-separated, \\N is null."""
    return delimited(spark, path, schemas.DUMPS[table], null="\\N")


def principal_isoforms(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, schemas.PRINCIPAL_ISOFORMS)


def contaminants(sequences: DataFrame, header: str, species: str, ids: DataFrame | None = None, key: str = "name") -> DataFrame:
    """Sequences whose header names a species (and whose id is listed), as DNA."""
    out = sequences.filter(F.col(header).contains(species))
    out = out if ids is None else out.join(ids.select(key), key, "left_semi")
    return out.withColumn("seq", F.translate("seq", "Uu", "Tt"))
