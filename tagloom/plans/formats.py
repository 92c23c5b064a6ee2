"""Queries that write and read interchange formats and run streaming operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import sinks
from tagloom.functions import seq as S
from tagloom.plans.common import dna, dna_sql
from tagloom.session import fresh_folder, table
from tagloom.sources import text
from tagloom.streaming import tags as T


def _folder(spark: SparkSession) -> str:
    """A new folder that all executors share: no two calls have the same."""
    return fresh_folder(spark, "formats")


def q_tsv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """taginfo written as text and read with its schema: empty texts stay empty, null lengths null; null texts come back empty."""
    path = f"{_folder(spark)}/taginfo"
    t = table(spark, folder, "taginfo")
    sinks.write_tsv(t.select("tile", "cluster", "pflags", "polya_len", "mods", "clones"), path)
    return text.taginfo(spark, path).groupBy("tile", "mods").agg(F.count("*").alias("n"), F.count("polya_len").alias("measured"), F.sum("polya_len").alias("total_len"))


def q_fastq_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{_folder(spark)}/fastq"
    o = table(spark, folder, "orders").select("o_orderkey", dna(F.col("o_orderkey"), 30).alias("seq"))
    sinks.write_fastq(o, path, S.read_name(F.lit("t1"), F.col("o_orderkey")), F.col("seq"), F.translate("seq", "ACGT", "@I5+"))
    return text.fastq(spark, path)


def q_sam_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{_folder(spark)}/sam"
    t = table(spark, folder, "tagcluster").filter("rname IS NOT NULL AND pos IS NOT NULL AND umi_rep IS NOT NULL AND umi_rep != ''")
    a = t.select(F.format_string("t1:%08d", "tag_id").alias("qname"), F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"), "rname", "pos", F.pmod("tag_id", F.lit(60)).cast("int").alias("mapq"), F.lit("20M").alias("cigar"), F.lit("*").alias("rnext"), F.lit(0).alias("pnext"), F.lit(0).alias("tlen"), dna(F.col("tag_id"), 20).alias("seq"), F.lit("IIIIIIIIIIIIIIIIIIII").alias("qual"), F.create_map(F.lit("RG"), F.lit("s1")).alias("tags"), "umi_rep")
    sinks.sam_lines(a, [("ZM", "Z", F.col("umi_rep")), ("ZA", "i", F.col("pos") % 7)]).write.mode("overwrite").text(path)
    s = text.sam_filter(text.sam(spark, path), exclude=20, least_mapq=15)
    return s.select("cluster", "rname", "pos", F.col("tags")["ZM"].alias("umi"), F.col("tags")["ZA"].cast("int").alias("za"), F.col("tags")["RG"].alias("rg"))


def q_partitioned_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned table of which one tile is read."""
    path = f"{_folder(spark)}/tags"
    t = table(spark, folder, "taginfo").select("sample", "tile", "cluster", "pflags", "polya_len")
    sinks.write_tags(t, path, ["tile"])
    return spark.read.parquet(path).filter("tile = 'a1107'").groupBy("sample").agg(F.count("*").alias("n"))


def q_fetch_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """A region of each part in a genome of all parts as chunks, across chunk borders, either strand."""
    chunk = 16
    genome = table(spark, folder, "part").select(F.lit("c1").alias("chrom"), F.col("p_partkey").alias("chunk_no"), dna(F.col("p_partkey"), chunk).alias("seq"))
    k = F.col("p_partkey")
    regions = table(spark, folder, "part").select(k.alias("name"), F.lit("c1").alias("chrom"), (k - 5).alias("start"), (k + 30).alias("end"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"))
    return text.fetch_sequences(regions, genome, chunk)


def _stream(spark: SparkSession, folder: str, out: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    """Runs a streaming query over the events table to its end and returns what it wrote."""
    base = _folder(spark)
    schema = table(spark, folder, "events").schema
    source = f"{base}/events-in"
    table(spark, folder, "events").write.mode("overwrite").parquet(source)
    stream = spark.readStream.schema(schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp"))
    path = f"{base}/stream-{out.__name__}"
    query = out(stream).writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{path}-state").option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(path)


def q_stream_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct event ids of a stream."""

    def first(stream: DataFrame) -> DataFrame:
        return T.first_seen(stream.select("event_id", "ts", "user_id"), ["event_id"], "ts", "30 days")

    return _stream(spark, folder, first, "append").select("event_id", "user_id")


def q_stream_capped(spark: SparkSession, folder: str) -> DataFrame:
    """At most three events per user over a whole stream; which ones depends on arrival."""

    def capped(stream: DataFrame) -> DataFrame:
        return T.capped_per_key(stream, F.col("user_id"), ["event_id"], 3)

    return _stream(spark, folder, capped, "append").groupBy("bucket").agg(F.count("*").alias("n"))


def q_stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Events per day and type of a stream; the last open windows aren't out yet when it ends."""

    def windows(stream: DataFrame) -> DataFrame:
        return T.windowed_counts(stream, ["event_type"], "ts", "1 day", "1 hour")

    return _stream(spark, folder, windows, "append").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def q_stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of a stream that had closed when it ended."""

    def closed(stream: DataFrame) -> DataFrame:
        return T.sessions(stream, ["user_id"], "ts", "30 minutes", "1 hour")

    return _stream(spark, folder, closed, "append").groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for k, v in globals().items() if k.startswith("q_")}

ORACLE: dict[str, str] = {
    "q_tsv_round_trip": "SELECT tile, coalesce(mods, '') AS mods, count(*) AS n, count(polya_len) AS measured, sum(polya_len)::BIGINT AS total_len FROM taginfo GROUP BY ALL",
    "q_fastq_round_trip": f"SELECT format('t1:{{:08d}}', o_orderkey) AS name, {dna_sql('o_orderkey', 30)} AS seq, translate({dna_sql('o_orderkey', 30)},'ACGT','@I5+') AS qual FROM orders",
    "q_sam_round_trip": "SELECT tag_id AS cluster, rname, pos, umi_rep AS umi, (pos % 7)::INT AS za, 's1' AS rg FROM tagcluster WHERE rname IS NOT NULL AND pos IS NOT NULL AND umi_rep IS NOT NULL AND umi_rep <> '' AND strand IS DISTINCT FROM '-' AND tag_id % 60 >= 15",
    "q_partitioned_scan": "SELECT sample, count(*) AS n FROM taginfo WHERE tile = 'a1107' GROUP BY sample",
    "q_fetch_sequences": f"WITH p AS (SELECT p_partkey AS k, {dna_sql('p_partkey', 16)} AS s FROM part), r AS (SELECT k AS name, greatest(k - 5, 0) AS a, k + 30 AS b FROM p), c AS (SELECT name, a, b, unnest(range(a // 16, (b - 1) // 16 + 1)) AS n FROM r), q AS (SELECT name, string_agg(substr(s, (greatest(a - n * 16, 0) + 1)::INT, (least(b - n * 16, 16) - greatest(a - n * 16, 0))::INT), '' ORDER BY n) AS q FROM c JOIN p ON p.k = n GROUP BY name) SELECT name, CASE WHEN name % 2 = 0 THEN q ELSE translate(reverse(q),'ACGT','TGCA') END AS seq FROM q",
    "q_stream_first_seen": "SELECT event_id, any_value(user_id) AS user_id FROM events GROUP BY event_id",
    # windows and sessions that end before the watermark, an hour behind the last event, are out
    "q_stream_windows": "WITH e AS (SELECT date_trunc('day', ts) AS day, event_type FROM events), m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events) SELECT strftime(day, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM e, m WHERE day + INTERVAL 1 DAY <= mark GROUP BY ALL",
    "q_stream_sessions": "WITH e AS (SELECT user_id, ts, coalesce((ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE)::INT, 1) AS new FROM events), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e), s AS (SELECT user_id, g, count(*) AS n, max(ts) AS last FROM g GROUP BY ALL), m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events) SELECT user_id, count(*) AS sessions, sum(n)::BIGINT AS n FROM s, m WHERE last + INTERVAL 30 MINUTE <= mark GROUP BY user_id",
    "q_stream_capped": "SELECT user_id::VARCHAR AS bucket, least(count(*),3) AS n FROM events GROUP BY user_id",
}
