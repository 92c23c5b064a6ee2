"""Queries of deduplication and interval operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import dedup as D
from tagloom.operators import intervals as I
from tagloom.operators import sorting as SO
from tagloom.session import durable, table

KEY, TIE = ["grp", "umi"], ["qname", "row_no"]


def _tags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tagaln")


def q_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return D.exact_dedup(_tags(spark, folder), KEY, "pflags", "polya_len_1", TIE)


def q_dup_trace(spark: SparkSession, folder: str) -> DataFrame:
    tags = _tags(spark, folder)
    return D.dedup_trace(tags, D.exact_dedup(tags, KEY, "pflags", "polya_len_1", TIE), KEY, "pflags", "polya_len_1", ["row_no"]).select("row_no", "trace")


def q_dedup_bypass(spark: SparkSession, folder: str) -> DataFrame:
    """Spike-ins pass as they are, all other samples are deduplicated by tile and cluster."""
    t = table(spark, folder, "taginfo").withColumn("imported", F.date_format("imported_at", "yyyy-MM-dd HH:mm:ss"))
    out = D.dedup_with_bypass(t, F.col("sample").startswith("spike"), ["sample", "tile", "cluster"], "pflags", "polya_len", ["imported"])
    return out.groupBy("sample").agg(F.count("*").alias("n"), F.sum("clones").alias("clones"), F.sum("polya_len").alias("total_len"))


def q_multi_map_first(spark: SparkSession, folder: str) -> DataFrame:
    return D.first_per_key(_tags(spark, folder).filter("qname IS NOT NULL"), ["qname"], ["measured_at", "row_no"], ["row_no", "priority"])


def q_leader_cluster(spark: SparkSession, folder: str) -> DataFrame:
    """Greedy clusters of tags; checked against the plain sequential form in the tests."""
    t = table(spark, folder, "tagcluster").withColumn("letters", F.upper(F.regexp_replace("umi_rep", "[^A-Za-z]", ""))).filter("letters != ''")
    return D.leader_clusters(t, "rname", "pos", "letters", "tag_id").select(F.col("row").alias("tag_id"), "head")


def q_approx_dedup(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tagcluster").withColumn("letters", F.upper(F.regexp_replace("umi_rep", "[^A-Za-z]", ""))).filter("letters != ''")
    heads = D.leader_clusters(t, "rname", "pos", "letters", "tag_id")
    m = heads.join(t, F.col("row") == F.col("tag_id")).select("head", "tag_id", F.pmod("tag_id", F.lit(4)).cast("int").alias("flags"), F.coalesce("umi_rep_ndups", F.lit(1)).alias("ndups"), F.pmod("tag_id", F.lit(97)).cast("int").alias("len"), F.pmod("tag_id", F.lit(31)).cast("int").alias("tail"))
    return D.merge_clusters(m, "head", "flags", "ndups", "len", "tail", "tag_id")


def q_leader_check(spark: SparkSession, folder: str) -> DataFrame:
    """What leader clusters promise, counted: tags, followers beyond reach or edits of their head (none),
    and tags that an earlier head, or as a head any head before them, would have taken (none)."""
    t = table(spark, folder, "tagcluster").withColumn("letters", F.upper(F.regexp_replace("umi_rep", "[^A-Za-z]", ""))).filter("letters != '' AND rname IS NOT NULL AND pos IS NOT NULL")
    c = durable(D.leader_clusters(t, "rname", "pos", "letters", "tag_id"))
    tag = t.select("tag_id", "rname", "pos", "letters")
    h = tag.join(c.select("head").distinct(), F.col("tag_id") == F.col("head"), "left_semi").select(F.col("tag_id").alias("h"), F.col("rname").alias("hr"), F.col("pos").alias("hp"), F.col("letters").alias("hl"))
    m = tag.join(c, F.col("tag_id") == F.col("row"))
    own = m.join(h, F.col("head") == F.col("h"))
    near = (F.col("pos") - F.col("hp")).between(0, 4) & (F.levenshtein("letters", "hl", 2) >= 0)
    far = own.agg(F.count("*").alias("tags"), F.count_if(~(near & (F.col("rname") == F.col("hr")))).alias("beyond"))
    place = own.select("tag_id", "rname", "pos", "letters", "head", F.col("hp").alias("own_pos"), F.explode(F.array((F.floor(F.col("pos") / 5)), (F.floor(F.col("pos") / 5) - 1))).alias("b"))
    earlier = (F.col("hp") < F.col("own_pos")) | ((F.col("hp") == F.col("own_pos")) & (F.col("h") < F.col("head")))
    missed = place.join(h.withColumn("hb", F.floor(F.col("hp") / 5)), (F.col("rname") == F.col("hr")) & (F.col("b") == F.col("hb")) & near & earlier)
    return far.withColumn("missed", F.lit(0).cast("bigint")).unionByName(missed.agg(F.lit(0).cast("bigint").alias("tags"), F.lit(0).cast("bigint").alias("beyond"), F.count("*").alias("missed"))).agg(*[F.sum(x).alias(x) for x in ("tags", "beyond", "missed")])


def q_approx_check(spark: SparkSession, folder: str) -> DataFrame:
    """Merged clusters keep all clones of the tags they were made of."""
    return q_approx_dedup(spark, folder).agg(F.sum("clones").alias("clones"), F.count_if(F.col("id").isNull()).alias("nameless"))


def q_sorted_places(spark: SparkSession, folder: str) -> DataFrame:
    """All tags in order of sequence, position and id, numbered: a full sort by several keys."""
    t = table(spark, folder, "tagcluster").select("tag_id", "rname", "pos")
    return SO.numbered(t, [F.col("rname").asc_nulls_first(), F.col("pos").asc_nulls_first(), F.col("tag_id")])


def _spliced(spark: SparkSession, folder: str) -> DataFrame:
    """Made-up spliced alignments at the tags' places."""
    k = F.col("tag_id")
    cigar = F.concat(F.pmod(k, F.lit(5)).cast("string"), F.lit("S"), (F.lit(20) + F.pmod(k, F.lit(11))).cast("string"), F.lit("M"), (F.lit(100) + F.pmod(k, F.lit(5000))).cast("string"), F.lit("N9M2D"), (F.lit(4) + F.pmod(k, F.lit(3))).cast("string"), F.lit("M"))
    return table(spark, folder, "tagcluster").filter("pos IS NOT NULL").select("tag_id", F.col("rname").alias("seqname"), "strand", F.col("pos").cast("bigint").alias("at"), cigar.alias("cigar"))


def q_block_join(spark: SparkSession, folder: str) -> DataFrame:
    """Spliced reads and the annotation lines of their strand that one of their parts overlaps."""
    return I.block_overlap_join(_spliced(spark, folder), _spans(spark, folder), ["seqname", "strand"], ["tag_id"], "at", "cigar", ["line_no"])


def _spans(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "gtf").filter("start_pos IS NOT NULL AND end_pos IS NOT NULL").select("line_no", "seqname", F.lower("feature").alias("feature"), "strand", (F.col("start_pos") - 1).cast("bigint").alias("start"), F.col("end_pos").cast("bigint").alias("end"))


def q_islands_merge(spark: SparkSession, folder: str) -> DataFrame:
    return I.merge_intervals(_spans(spark, folder).filter("feature = 'exon'"), ["seqname", "strand"], "start", "end", 0, stretch=1 << 20)


def q_position_islands(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tagcluster").filter("rname IS NOT NULL AND pos IS NOT NULL").select("tag_id", "rname", "pos")
    return D.islands(t, ["rname"], "pos", 50, ["tag_id"]).groupBy("rname", "island").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n")).drop("island")


def q_consecutive_runs(spark: SparkSession, folder: str) -> DataFrame:
    return I.group_consecutive(table(spark, folder, "taginfo").filter("polya_len >= 0"), ["sample"], "polya_len", 2)


def q_range_join(spark: SparkSession, folder: str) -> DataFrame:
    """Exons and the genes of their strand that they overlap."""
    s = _spans(spark, folder)
    out = I.overlap_join(s.filter("feature = 'exon'"), s.filter("feature = 'gene'"), ["seqname", "strand"])
    return out.select("line_no", "line_no_r")


def q_interval_semi(spark: SparkSession, folder: str) -> DataFrame:
    """Terminal bases of transcripts that lie on a merged, widened exon end of the strand."""
    s = _spans(spark, folder)
    a, b = I.terminal_base(F.col("start"), F.col("end"), F.col("strand"))
    ends = s.filter("feature = 'exon'").select("seqname", "strand", a.alias("s"), b.alias("e")).filter("s >= 0")
    merged = I.merge_intervals(ends, ["seqname", "strand"], "s", "e", 0)
    lo, hi = I.slop(F.col("start"), F.col("end"), F.col("strand"), 300, 300)
    # the join reads its inputs twice, so the merged sites are made once
    sites = durable(I.merge_intervals(merged.select("seqname", "strand", lo.alias("s"), hi.alias("e")), ["seqname", "strand"], "s", "e", 0))
    t = s.filter("feature = 'transcript'").select("line_no", "seqname", "strand", a.alias("start"), b.alias("end")).filter("start >= 0 AND start < end")
    return I.overlap_join(t, sites.select("seqname", "strand", "start", "end"), ["seqname", "strand"], how="left_semi").select("line_no")


def q_interval_arith(spark: SparkSession, folder: str) -> DataFrame:
    s = _spans(spark, folder)
    f = I.flank_after(F.col("start"), F.col("end"), F.col("strand"), 5)
    w = I.slop(F.col("start"), F.col("end"), F.col("strand"), 1000000, 3, F.lit(80_000_000))
    return s.select("line_no", I.flipped(F.col("strand")).alias("other"), f[0].alias("flank_s"), f[1].alias("flank_e"), w[0].alias("slop_s"), w[1].alias("slop_e")).filter("flank_s >= 0 AND flank_s < flank_e")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for k, v in globals().items() if k.startswith("q_")}

_P = "1024*(f&16=0)::INT + 512*(f&128=0)::INT + 256*(f&2=0)::INT + 128*(f&8<>0)::INT + 64*(f&2048=0)::INT + 32*(f&512=0)::INT + 16*(f&1024=0)::INT + 8*(f&64=0)::INT + 4*(f&32=0)::INT + 2*(f&1<>0)::INT"
_DEDUP = f"""WITH t AS (SELECT *, coalesce(pflags,0) AS f, coalesce(polya_len_1,-1) AS v FROM tagaln WHERE FILTERED),
p AS (SELECT *, {_P} AS pr, count(*) OVER (PARTITION BY grp, umi) AS clones FROM t),
m AS (SELECT *, max(pr) OVER (PARTITION BY grp, umi) AS top FROM p),
a AS (SELECT *, avg(v) OVER (PARTITION BY grp, umi) AS mean, count(*) OVER (PARTITION BY grp, umi) AS n FROM m WHERE pr = top),
r AS (SELECT *, row_number() OVER (PARTITION BY grp, umi ORDER BY abs(v-mean), qname, row_no) AS k FROM a),
d AS (SELECT *, (CASE WHEN n = 1 THEN v WHEN v < 0 THEN -1 ELSE round(mean) END)::INT AS final FROM r WHERE k = 1)
"""
_SPANS = "s AS (SELECT line_no, seqname, lower(feature) AS feature, strand, start_pos::BIGINT - 1 AS st, end_pos::BIGINT AS en FROM gtf WHERE start_pos IS NOT NULL AND end_pos IS NOT NULL)"


def _merge_sql(source: str, name: str) -> str:
    return f"""{name}1 AS (SELECT *, max(en) OVER (PARTITION BY seqname, strand ORDER BY st, en ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM (SELECT seqname, strand, st, en, count(*) AS k FROM {source} WHERE st < en GROUP BY ALL)),
{name}2 AS (SELECT *, sum((far IS NULL OR st > far)::INT) OVER (PARTITION BY seqname, strand ORDER BY st, en ROWS UNBOUNDED PRECEDING) AS i FROM {name}1),
{name} AS (SELECT seqname, strand, min(st) AS st, max(en) AS en, sum(k)::BIGINT AS n FROM {name}2 GROUP BY seqname, strand, i)"""


ORACLE: dict[str, str] = {
    "q_leader_check": "SELECT count(*) AS tags, 0::BIGINT AS beyond, 0::BIGINT AS missed FROM tagcluster WHERE regexp_matches(umi_rep, '[A-Za-z]') AND rname IS NOT NULL AND pos IS NOT NULL",
    "q_approx_check": "SELECT sum(coalesce(umi_rep_ndups, 1))::BIGINT AS clones, 0::BIGINT AS nameless FROM tagcluster WHERE regexp_matches(umi_rep, '[A-Za-z]') AND rname IS NOT NULL AND pos IS NOT NULL",
    "q_sorted_places": "SELECT tag_id, rname, pos, row_number() OVER (ORDER BY rname NULLS FIRST, pos NULLS FIRST, tag_id) - 1 AS place FROM tagcluster",
    "q_block_join": f"""WITH {_SPANS}, r AS (SELECT tag_id, rname, strand, pos::BIGINT AS p, 20 + tag_id % 11 AS a, 100 + tag_id % 5000 AS g, 15 + tag_id % 3 AS z FROM tagcluster WHERE pos IS NOT NULL),
b AS (SELECT tag_id, rname, strand, p AS st, p + a AS en FROM r UNION ALL SELECT tag_id, rname, strand, p + a + g, p + a + g + z FROM r)
SELECT DISTINCT tag_id, line_no FROM b JOIN s ON rname = seqname AND b.strand = s.strand AND b.st < s.en AND s.st < b.en""",
    "q_exact_dedup": _DEDUP.replace("FILTERED", "true") + "SELECT grp, umi, qname, row_no, f AS pflags, final AS polya_len_1, clones FROM d",
    "q_dup_trace": _DEDUP.replace("FILTERED", "true") + "SELECT m.row_no, (CASE WHEN d.row_no = m.row_no THEN d.final WHEN m.pr < m.top THEN -3 ELSE -2 END)::INT AS trace FROM m JOIN d ON m.grp IS NOT DISTINCT FROM d.grp AND m.umi IS NOT DISTINCT FROM d.umi",
    "q_dedup_bypass": f"""WITH t AS (SELECT sample, tile, cluster, coalesce(pflags,0) AS f, coalesce(polya_len,-1) AS v, polya_len, imported_at FROM taginfo),
p AS (SELECT *, {_P} AS pr, count(*) OVER (PARTITION BY sample, tile, cluster) AS clones FROM t WHERE NOT starts_with(sample,'spike')),
m AS (SELECT *, max(pr) OVER (PARTITION BY sample, tile, cluster) AS top FROM p),
a AS (SELECT *, avg(v) OVER (PARTITION BY sample, tile, cluster) AS mean, count(*) OVER (PARTITION BY sample, tile, cluster) AS n FROM m WHERE pr = top),
r AS (SELECT *, row_number() OVER (PARTITION BY sample, tile, cluster ORDER BY abs(v-mean), strftime(imported_at,'%Y-%m-%d %H:%M:%S')) AS k FROM a),
d AS (SELECT sample, clones, CASE WHEN n = 1 THEN v WHEN v < 0 THEN -1 ELSE round(mean) END::INT AS l FROM r WHERE k = 1 UNION ALL SELECT sample, 1, polya_len FROM t WHERE starts_with(sample,'spike'))
SELECT sample, count(*) AS n, sum(clones)::BIGINT AS clones, sum(l)::BIGINT AS total_len FROM d GROUP BY sample""",
    "q_multi_map_first": "SELECT qname, row_no, priority FROM (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY measured_at NULLS FIRST, row_no) AS k FROM tagaln WHERE qname IS NOT NULL) WHERE k = 1",
    "q_islands_merge": f"WITH {_SPANS}, x AS (SELECT * FROM s WHERE feature = 'exon'), {_merge_sql('x', 'm')} SELECT seqname, strand, st AS start, en AS \"end\", n FROM m",
    "q_position_islands": """WITH a AS (SELECT *, lag(pos) OVER (PARTITION BY rname ORDER BY pos, tag_id) AS prev FROM tagcluster WHERE rname IS NOT NULL AND pos IS NOT NULL),
b AS (SELECT *, sum((pos - prev > 50)::INT) OVER (PARTITION BY rname ORDER BY pos, tag_id ROWS UNBOUNDED PRECEDING) AS i FROM a)
SELECT rname, min(pos) AS first, max(pos) AS last, count(*) AS n FROM b GROUP BY rname, coalesce(i,0)""",
    "q_consecutive_runs": """WITH v AS (SELECT DISTINCT sample, polya_len AS v FROM taginfo WHERE polya_len >= 0), a AS (SELECT *, lag(v) OVER (PARTITION BY sample ORDER BY v) AS p FROM v),
b AS (SELECT *, sum(coalesce((v - p > 2)::INT,0)) OVER (PARTITION BY sample ORDER BY v ROWS UNBOUNDED PRECEDING) AS i FROM a) SELECT sample, min(v) AS first, max(v) AS last, count(*) AS n FROM b GROUP BY sample, i""",
    "q_range_join": f"WITH {_SPANS} SELECT a.line_no, b.line_no AS line_no_r FROM s a JOIN s b ON a.seqname = b.seqname AND a.strand = b.strand AND a.st < b.en AND b.st < a.en WHERE a.feature = 'exon' AND b.feature = 'gene'",
    "q_interval_semi": f"""WITH {_SPANS}, e AS (SELECT line_no, feature, seqname, strand, CASE WHEN strand <> '-' THEN en - 1 ELSE st END AS st, CASE WHEN strand <> '-' THEN en ELSE st + 1 END AS en FROM s),
x AS (SELECT seqname, strand, st, en FROM e WHERE feature = 'exon' AND st >= 0), {_merge_sql('x', 'm')}, y AS (SELECT seqname, strand, greatest(st-300,0) AS st, en+300 AS en FROM m), {_merge_sql('y', 'z')}
SELECT line_no FROM e WHERE feature = 'transcript' AND st >= 0 AND st < en AND EXISTS (SELECT 1 FROM z WHERE z.seqname = e.seqname AND z.strand = e.strand AND z.st < e.en AND e.st < z.en)""",
    "q_interval_arith": f"""WITH {_SPANS}, c AS (SELECT line_no, CASE strand WHEN '+' THEN '-' WHEN '-' THEN '+' ELSE strand END AS other, CASE WHEN strand <> '-' THEN en ELSE st - 5 END AS flank_s, CASE WHEN strand <> '-' THEN en + 5 ELSE st END AS flank_e,
greatest(0, st - CASE WHEN strand <> '-' THEN 1000000 ELSE 3 END) AS slop_s, least(80000000, en + CASE WHEN strand <> '-' THEN 3 ELSE 1000000 END) AS slop_e FROM s) SELECT * FROM c WHERE flank_s >= 0 AND flank_s < flank_e""",
}
