"""Queries of joins, set operations and annotation operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.operators import annot as A
from tagloom.operators import joins as J
from tagloom.operators.packed import first_values, packed_entries
from tagloom.plans.common import dna, dna_sql
from tagloom.plans.problems import entries_sql
from tagloom.session import table


def q_cogroup_full(spark: SparkSession, folder: str) -> DataFrame:
    """Tags and annotation lines per sequence, also of sequences that only one of both names."""
    t, g = table(spark, folder, "tagcluster").select(F.col("rname").alias("k")), table(spark, folder, "gtf").select(F.col("seqname").alias("k"))
    return J.count_groups(t.filter("k IS NOT NULL"), g.filter("k IS NOT NULL"), "k")


def q_merge_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables matched by nation: the suppliers listed; customers, of whom only the number is asked, counted."""
    n = table(spark, folder, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    s = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("k"), "s_suppkey")
    c = table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").cast("int").alias("n2"))
    parts = J.match_groups([n, s], "k", [["n_name"], ["s_suppkey"]])
    # the text that names all suppliers of a nation is made from its parts
    whole = parts.groupBy("k").agg(F.sum(F.size("g0")).cast("int").alias("n0"), F.flatten(F.collect_list(F.transform("g1", lambda x: x["s_suppkey"]))).alias("l"))
    out = whole.join(c, "k", "full_outer")
    suppliers = F.array_join(F.transform(F.array_sort("l"), lambda x: x.cast("string")), ",")
    return out.select("k", F.coalesce("n0", F.lit(0)).alias("n0"), F.coalesce(suppliers, F.lit("")).alias("suppliers"), F.coalesce("n2", F.lit(0)).alias("n2"))


def q_left_tag(spark: SparkSession, folder: str) -> DataFrame:
    """Tags with flags and length of the first read of their name in taginfo, if any."""
    t = table(spark, folder, "tagaln").filter("qname IS NOT NULL").select("row_no", "grp", F.split_part("qname", F.lit(":"), F.lit(1)).alias("tile"), F.split_part("qname", F.lit(":"), F.lit(2)).cast("bigint").alias("cluster"))
    i = table(spark, folder, "taginfo").select("tile", "cluster", "imported_at", "pflags", "polya_len", "sample")
    return J.first_match(t, i, ["tile", "cluster"], ["imported_at", "polya_len"], ["pflags", "polya_len", "sample"], "za_")


def q_right_override(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    n = table(spark, folder, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("price"))
    return J.override(o, n, ["o_orderkey"], ["price"])


def q_left_flag_or(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "taginfo").select("sample", S.read_name(F.col("tile"), F.col("cluster")).alias("id"), "pflags")
    short = table(spark, folder, "tagaln").filter("polya_len_1 BETWEEN 5 AND 200").select(F.col("qname").alias("id"))
    return J.set_flag_where(t, short, "id", "pflags", 8192).groupBy("pflags").agg(F.count("*").alias("n"))


def q_subset_assert(spark: SparkSession, folder: str) -> DataFrame:
    l = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return J.require_subset(l, o, ["o_orderkey"])


def q_whitelist(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    return J.whitelist(table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), ids, "o_orderkey")


def q_associate(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "taginfo").select("tile", "cluster", "sample", "polya_len")
    a = t.select("tile", "cluster").distinct().select("tile", "cluster", F.format_string("g%03d", F.pmod("cluster", F.lit(100))).alias("gene"), F.lit(1).alias("ambig"))
    return J.associate(t, a, ["tile", "cluster"]).groupBy("gene", "sample").agg(F.count("*").alias("n"))


def q_tile_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles of two made-up sources without the blacklisted ones."""
    t = table(spark, folder, "taginfo").select("tile").distinct().withColumn("kind", F.lit("miseq"))
    src = spark.createDataFrame([("a_", "miseq", 1), ("b_", "miseq", 2)], "source string, kind string, lane int")
    black = t.filter("tile LIKE '%7'").select(F.concat(F.lit("a_"), "tile").alias("id"))
    return J.catalog(src, t, "source", black)


def q_patched_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Base calls with cycles 5..8 replaced where another basecaller has them."""
    o = table(spark, folder, "orders").select("o_orderkey", dna(F.col("o_orderkey"), 16).alias("seq"))
    alt = table(spark, folder, "lineitem").filter("l_linenumber = 2").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("NNNN").alias("alt")).distinct()
    return o.join(alt, "o_orderkey", "left").select("o_orderkey", J.patched(F.col("seq"), F.col("alt"), 5).alias("seq"))


def q_union_all(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per nation and kind of two tables one after the other: a union keeps repeated rows."""
    c = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("c").alias("kind"))
    s = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("s").alias("kind"))
    return c.unionByName(s).groupBy("nation", "kind").agg(F.count("*").alias("n"))


def q_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """The different references of object_xref; null texts are equal to each other."""
    return table(spark, folder, "object_xref").select("ensembl_object_type", "xref_id").distinct()


def q_except_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Parts that were never shipped by the fifty (0), and those that were (1)."""
    p = table(spark, folder, "part").select(F.col("p_partkey").alias("k"))
    l = table(spark, folder, "lineitem").filter("l_quantity = 50").select(F.col("l_partkey").alias("k"))
    return J.difference(p, l, "k").withColumn("both", F.lit(0)).unionByName(J.assert_disjoint(p, l, "k").withColumn("both", F.lit(1)))


def q_object_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables that name each other, from the first to the last: nations, customers, orders."""
    n = table(spark, folder, "nation").select(F.col("n_nationkey").alias("gene_id"), F.col("n_name").alias("stable_id"))
    c = table(spark, folder, "customer").select(F.col("c_nationkey").alias("gene_id"), F.col("c_custkey").alias("transcript_id"), F.col("c_name").alias("stable_id"))
    o = table(spark, folder, "orders").select(F.col("o_custkey").alias("transcript_id"), F.col("o_orderkey").cast("string").alias("stable_id"))
    return A.object_chain(n, c, o)


def q_xref_details(spark: SparkSession, folder: str) -> DataFrame:
    """References with their database, and the identities or the linkage of their objects."""
    x = table(spark, folder, "xref")
    db = x.filter("external_db_id IS NOT NULL").select("external_db_id", F.format_string("db%d", "external_db_id").alias("db_name")).distinct()
    o = table(spark, folder, "object_xref").withColumn("xref_id", F.col("xref_id").try_cast("bigint"))
    i = table(spark, folder, "identity_xref").withColumn("object_xref_id", F.col("object_xref_id").try_cast("bigint"))
    t = o.filter("linkage_annotation IS NOT NULL").select("object_xref_id", F.col("linkage_annotation").alias("linkage_type"))
    out = A.xref_chain(db, x, o, i, t)
    return out.groupBy("db_name", "xref_id", "object_xref_id", "linkage_type").agg(F.count("*").alias("n"), F.sum("xref_identity").alias("identity"))


def q_transitive_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Final ids of all parts' made-up changes: id to twice the id, but every seventh id never changes."""
    p = table(spark, folder, "part").filter("p_partkey > 0 AND p_partkey % 7 != 3").select(F.col("p_partkey").alias("old_id"), (F.col("p_partkey") * 2).alias("new_id"))
    return A.resolve_transitively(p, "old_id", "new_id")


def q_xref_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    """External references joined to the object table of their own type."""
    o = table(spark, folder, "object_xref").select("row_no", F.lower(F.trim("ensembl_object_type")).alias("kind"), F.col("ensembl_id").try_cast("bigint").alias("ref")).filter("kind IS NOT NULL AND ref IS NOT NULL")
    e = table(spark, folder, "ensembl_object").filter("deleted_at IS NULL").select(F.lower("ensembl_object_type").alias("t"), F.col("ensembl_id").alias("id"), "stable_id")
    targets = {k: (e.filter(F.col("t") == k).select("id", "stable_id"), "id") for k in ("gene", "transcript", "translation")}
    return A.dispatch_xrefs(o, "kind", targets, "ref").select("row_no", "kind", "stable_id")


def q_xref_chain(spark: SparkSession, folder: str) -> DataFrame:
    """xref, object_xref and identity_xref joined: live references with their identity."""
    x = table(spark, folder, "xref").filter("deleted_at IS NULL").select("xref_id", "display_label").groupBy("xref_id").agg(F.min("display_label").alias("display_label"))
    o = table(spark, folder, "object_xref").filter("deleted_at IS NULL").select("object_xref_id", F.col("xref_id").try_cast("bigint").alias("xref_id")).distinct()
    i = table(spark, folder, "identity_xref").select(F.col("object_xref_id").try_cast("bigint").alias("object_xref_id"), "xref_identity", "row_no")
    return x.join(o, "xref_id").join(i, "object_xref_id").select("row_no", "xref_id", "object_xref_id", "display_label", "xref_identity")


def q_principal_pick(spark: SparkSession, folder: str) -> DataFrame:
    """One line item per part: most quantity, then the earliest order and line."""
    l = table(spark, folder, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return A.pick_first(l, ["l_partkey"], [-F.col("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber")], ["l_orderkey", "l_linenumber", "l_quantity"])


def _gtf(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their ids in whatever form they are written; an id that a line lacks is ''."""
    g = table(spark, folder, "gtf").filter("attribute IS NOT NULL").withColumn("ids", first_values(F.col("attribute"), ["transcript_id", "gene_id"]))
    return g.select("line_no", F.lower("feature").alias("feature"), "strand", "start_pos", "end_pos", F.coalesce("ids.transcript_id", F.lit("")).alias("tid"), F.coalesce("ids.gene_id", F.lit("")).alias("gid"), "attribute")


def q_principal_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    g = _gtf(spark, folder).filter("feature = 'transcript' AND tid != '' AND gid != ''").groupBy("gid", "tid").agg(F.max(F.col("end_pos") - F.col("start_pos")).alias("len"))
    labels = g.filter("length(tid) % 2 = 0 OR tid LIKE '%2.%'").select(F.col("tid").alias("transcript"), F.lit("P1").alias("label")).distinct()
    return A.principal_transcripts(g, labels, "tid", "gid", "len")


def q_ordered_concat(spark: SparkSession, folder: str) -> DataFrame:
    l = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", dna(F.col("l_partkey"), 15).alias("seq"))
    out = A.ordered_concat(l, ["l_orderkey"], "l_linenumber", "seq", "seq")
    return out.select("l_orderkey", A.wrapped(F.col("seq"), 20).alias("fasta"), F.substring("seq", -12, 12).alias("tail"))


def q_utr_classify(spark: SparkSession, folder: str) -> DataFrame:
    """Exons classed as before or after their transcript's coding parts."""
    g = _gtf(spark, folder).filter("tid != '' AND strand IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL")
    return A.utr_class(g.filter("feature = 'cds'"), g.filter("feature = 'exon'"), "tid", "start_pos", "end_pos", "strand").select("line_no", "utr")


def q_coalesce_exons(spark: SparkSession, folder: str) -> DataFrame:
    g = _gtf(spark, folder).filter("feature IN ('exon','cds') AND tid != '' AND start_pos IS NOT NULL AND end_pos IS NOT NULL")
    return A.coalesce_exons(g.select("tid", "start_pos", "end_pos"), "tid", "start_pos", "end_pos")


def q_exonic_length(spark: SparkSession, folder: str) -> DataFrame:
    return A.exonic_length(_gtf(spark, folder).filter("feature = 'exon' AND tid != ''"), "tid", "start_pos", "end_pos")


def q_case_augment(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select("o_orderkey", dna(F.col("o_orderkey"), 20).alias("seq"))
    return o.select("o_orderkey", A.recased(F.col("seq"), F.pmod("o_orderkey", F.lit(9)).cast("int"), F.pmod("o_orderkey", F.lit(13)).cast("int")).alias("seq"))


def q_description_join(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "ensembl_object").select("stable_id", "version", "ensembl_id")
    d = e.filter("ensembl_id % 2 = 0").select(F.when(F.col("ensembl_id") % 4 == 0, F.col("stable_id")).otherwise(F.concat_ws(".", "stable_id", F.col("version").cast("string"))).alias("key"), F.lit("found").alias("description")).distinct()
    return A.with_description(e, d, "stable_id", "version", "key").groupBy("ensembl_id").agg(F.count("description").alias("n"))


def q_attr_explode(spark: SparkSession, folder: str) -> DataFrame:
    """JSON properties of events as name and value rows."""
    e = table(spark, folder, "events").filter("props IS NOT NULL")
    return e.select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("name", "value"))


def q_gff_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with an id of the key=value style as maps, written anew in the other style."""
    g = table(spark, folder, "gtf").filter(F.col("attribute").rlike(r"(?i)_id\s*="))
    m = A.gff_attributes(F.col("attribute"), fold=True)
    return g.select("line_no", A.gtf_attributes([("gene_id", m["gene_id"]), ("transcript_id", m["transcript_id"])]).alias("gtf"))


def q_attr_types(spark: SparkSession, folder: str) -> DataFrame:
    """The types that the values of some attributes allow."""
    names = ["exon_number", "gene_id", "level"]
    g = table(spark, folder, "gtf").select(packed_entries(F.col("attribute")).alias("e"))
    cols = g.select(*[F.try_element_at(F.filter("e", _named(n)), F.lit(1))["value"].alias(n) for n in names])
    return spark.createDataFrame(sorted(A.infer_types(cols, names).items()), "attr_name string, inferred string")


def _named(name: str):
    return lambda e: e["name"] == name


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for k, v in globals().items() if k.startswith("q_")}

# the first value of either name, in whatever form it is written
_G = (
    entries_sql().strip().removeprefix("WITH ")
    + """, ids AS (SELECT line_no, arg_min(value, i) FILTER (name = 'transcript_id') AS tid, arg_min(value, i) FILTER (name = 'gene_id') AS gid FROM n GROUP BY line_no),
g AS (SELECT gtf.line_no, lower(feature) AS feature, strand, start_pos, end_pos, coalesce(tid, '') AS tid, coalesce(gid, '') AS gid FROM gtf LEFT JOIN ids ON ids.line_no = gtf.line_no WHERE attribute IS NOT NULL)"""
)
_WHOLE = "CASE WHEN regexp_full_match(trim({}),'[0-9]+') THEN {}::BIGINT END"

ORACLE: dict[str, str] = {
    "q_cogroup_full": "WITH a AS (SELECT rname AS k, count(*) AS n FROM tagcluster WHERE rname IS NOT NULL GROUP BY 1), b AS (SELECT seqname AS k, count(*) AS n FROM gtf WHERE seqname IS NOT NULL GROUP BY 1) SELECT coalesce(a.k,b.k) AS k, coalesce(a.n,0) AS n_left, coalesce(b.n,0) AS n_right FROM a FULL JOIN b ON a.k = b.k",
    "q_merge_groups": "WITH s AS (SELECT s_nationkey AS k, string_agg(s_suppkey::VARCHAR, ',' ORDER BY s_suppkey) AS l FROM supplier GROUP BY 1), c AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) SELECT n_nationkey AS k, 1::INT AS n0, coalesce(l,'') AS suppliers, coalesce(n,0)::INT AS n2 FROM nation LEFT JOIN s ON s.k = n_nationkey LEFT JOIN c ON c.k = n_nationkey",
    "q_left_tag": """WITH t AS (SELECT row_no, grp, split_part(qname,':',1) AS tile, split_part(qname,':',2)::BIGINT AS cluster FROM tagaln WHERE qname IS NOT NULL), i AS (SELECT *, row_number() OVER (PARTITION BY tile, cluster ORDER BY imported_at NULLS FIRST, polya_len NULLS FIRST) AS k FROM taginfo)
SELECT row_no, grp, t.tile, t.cluster, pflags AS za_pflags, polya_len AS za_polya_len, sample AS za_sample FROM t LEFT JOIN i ON i.tile = t.tile AND i.cluster = t.cluster AND k = 1""",
    "q_right_override": "SELECT l_orderkey AS o_orderkey, l_extendedprice AS price, o_orderstatus FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber = 1",
    "q_left_flag_or": "WITH s AS (SELECT DISTINCT qname AS id FROM tagaln WHERE polya_len_1 BETWEEN 5 AND 200 AND qname IS NOT NULL) SELECT CASE WHEN s.id IS NOT NULL THEN pflags | 8192 ELSE pflags END AS pflags, count(*) AS n FROM taginfo LEFT JOIN s ON s.id = format('{}:{:08d}', tile, cluster) GROUP BY 1",
    "q_subset_assert": "SELECT l_orderkey AS o_orderkey, l_linenumber, l_quantity, o_orderpriority FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
    "q_whitelist": "SELECT l_orderkey AS o_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    "q_associate": "SELECT printf('g%03d', cluster % 100) AS gene, sample, count(*) AS n FROM (SELECT tile, cluster, sample FROM taginfo WHERE tile IS NOT NULL AND cluster IS NOT NULL) GROUP BY ALL",
    "q_tile_catalog": "WITH t AS (SELECT DISTINCT tile FROM taginfo), s AS (SELECT 'a_' AS source, 1 AS lane UNION ALL SELECT 'b_', 2) SELECT source, 'miseq' AS kind, lane, tile, source || tile AS id FROM s, t WHERE NOT (source = 'a_' AND tile LIKE '%7')",
    "q_patched_calls": f"WITH o AS (SELECT o_orderkey, {dna_sql('o_orderkey', 16)} AS seq FROM orders), a AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber = 2) SELECT o_orderkey, CASE WHEN l_orderkey IS NULL THEN seq ELSE substr(seq,1,4) || 'NNNN' || substr(seq,9) END AS seq FROM o LEFT JOIN a ON l_orderkey = o_orderkey",
    "q_union_all": "SELECT nation, kind, count(*) AS n FROM (SELECT c_nationkey AS nation, 'c' AS kind FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier) GROUP BY ALL",
    "q_except_anti": "SELECT k, 0 AS both FROM (SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity = 50) UNION ALL SELECT k, 1 FROM (SELECT p_partkey AS k FROM part INTERSECT SELECT l_partkey FROM lineitem WHERE l_quantity = 50)",
    "q_distinct": "SELECT DISTINCT ensembl_object_type, xref_id FROM object_xref",
    "q_object_chain": "SELECT n_name AS gene, c_name AS transcript, o_orderkey::VARCHAR AS translation FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey",
    "q_xref_details": f"""WITH db AS (SELECT DISTINCT external_db_id, 'db' || external_db_id AS db_name FROM xref), o AS (SELECT object_xref_id, linkage_annotation, {_WHOLE.format('xref_id', 'xref_id')} AS xref_id FROM object_xref),
d AS (SELECT {_WHOLE.format('object_xref_id', 'object_xref_id')} AS object_xref_id, xref_identity, NULL AS linkage_type FROM identity_xref UNION ALL SELECT object_xref_id, NULL, linkage_annotation FROM o WHERE linkage_annotation IS NOT NULL)
SELECT db_name, x.xref_id, o.object_xref_id, linkage_type, count(*) AS n, sum(xref_identity)::BIGINT AS identity FROM xref x JOIN db USING (external_db_id) JOIN o ON o.xref_id = x.xref_id JOIN d ON d.object_xref_id = o.object_xref_id GROUP BY ALL""",
    "q_transitive_ids": "WITH RECURSIVE e AS (SELECT p_partkey AS a, p_partkey*2 AS b FROM part WHERE p_partkey > 0 AND p_partkey % 7 <> 3), r(s, n) AS (SELECT a, b FROM e UNION SELECT s, b FROM r JOIN e ON n = a) SELECT s AS old_id, n AS new_id FROM r WHERE n NOT IN (SELECT a FROM e)",
    "q_xref_dispatch": "WITH o AS (SELECT row_no, lower(trim(ensembl_object_type)) AS kind, CASE WHEN regexp_full_match(trim(ensembl_id),'[0-9]+') THEN ensembl_id::BIGINT WHEN regexp_full_match(trim(ensembl_id),'[0-9]+\\.[0-9]*') THEN NULL END AS ref FROM object_xref) SELECT row_no, kind, stable_id FROM o JOIN ensembl_object e ON kind = lower(e.ensembl_object_type) AND ref = e.ensembl_id WHERE e.deleted_at IS NULL",
    "q_xref_chain": """WITH n AS (SELECT xref_id, min(display_label) AS display_label FROM xref WHERE deleted_at IS NULL GROUP BY 1), o AS (SELECT DISTINCT object_xref_id, CASE WHEN regexp_full_match(trim(xref_id),'[0-9]+') THEN xref_id::BIGINT END AS xref_id FROM object_xref WHERE deleted_at IS NULL),
i AS (SELECT row_no, xref_identity, CASE WHEN regexp_full_match(trim(object_xref_id),'[0-9]+') THEN object_xref_id::BIGINT END AS object_xref_id FROM identity_xref) SELECT row_no, n.xref_id, o.object_xref_id, display_label, xref_identity FROM n JOIN o USING (xref_id) JOIN i USING (object_xref_id)""",
    "q_principal_pick": "SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1",
    "q_principal_transcripts": f"WITH {_G}, t AS (SELECT gid, tid, max(end_pos - start_pos) AS len, CASE WHEN length(tid) % 2 = 0 OR tid LIKE '%2.%' THEN 'P1' END AS label FROM g WHERE feature = 'transcript' AND tid <> '' AND gid <> '' GROUP BY gid, tid), b AS (SELECT DISTINCT split_part(tid,'.',1) AS bare, label FROM t WHERE label IS NOT NULL), m AS (SELECT gid, tid, len, b.label FROM t LEFT JOIN b ON bare = split_part(tid,'.',1)) SELECT gid, tid, label, len FROM (SELECT *, row_number() OVER (PARTITION BY gid ORDER BY coalesce(label,'~'), -len NULLS FIRST, tid) AS k FROM m) WHERE k = 1",
    "q_ordered_concat": f"WITH l AS (SELECT l_orderkey, string_agg({dna_sql('l_partkey', 15)}, '' ORDER BY l_linenumber, {dna_sql('l_partkey', 15)}) AS seq FROM lineitem GROUP BY 1) SELECT l_orderkey, regexp_replace(regexp_replace(seq,'(.{{20}})','\\1\n','g'),'\n$','') AS fasta, substr(seq,-12) AS tail FROM l",
    "q_utr_classify": f"WITH {_G}, v AS (SELECT * FROM g WHERE tid <> '' AND strand IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL), c AS (SELECT tid, min(start_pos) AS lo, max(end_pos) AS hi FROM v WHERE feature = 'cds' GROUP BY tid) SELECT line_no, CASE WHEN end_pos < lo THEN CASE WHEN strand <> '-' THEN 'five_prime_utr' ELSE 'three_prime_utr' END WHEN start_pos > hi THEN CASE WHEN strand <> '-' THEN 'three_prime_utr' ELSE 'five_prime_utr' END END AS utr FROM v LEFT JOIN c USING (tid) WHERE feature = 'exon'",
    "q_coalesce_exons": f"WITH {_G}, a AS (SELECT tid, start_pos, end_pos, max(end_pos) OVER (PARTITION BY tid ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM (SELECT DISTINCT tid, start_pos, end_pos FROM g WHERE feature IN ('exon','cds') AND tid <> '' AND start_pos IS NOT NULL AND end_pos IS NOT NULL)), b AS (SELECT *, sum(coalesce((start_pos > far + 1)::INT,0)) OVER (PARTITION BY tid ORDER BY start_pos, end_pos ROWS UNBOUNDED PRECEDING) AS i FROM a) SELECT tid, min(start_pos) AS start_pos, max(end_pos) AS end_pos, (i + 1)::INT AS exon_number FROM b GROUP BY tid, i",
    "q_exonic_length": f"WITH {_G} SELECT tid, sum(end_pos - start_pos + 1)::BIGINT AS length FROM g WHERE feature = 'exon' AND tid <> '' GROUP BY tid",
    "q_case_augment": f"WITH r AS (SELECT o_orderkey, {dna_sql('o_orderkey', 20)} AS s, o_orderkey%9 AS a, least(o_orderkey%13, 20 - o_orderkey%9) AS b FROM orders) SELECT o_orderkey, upper(substr(s,1,a)) || lower(substr(s,a+1,20-a-b)) || upper(substr(s,21-b,b)) AS seq FROM r",
    "q_description_join": "WITH d AS (SELECT DISTINCT CASE WHEN ensembl_id % 4 = 0 THEN stable_id ELSE concat_ws('.', stable_id, version) END AS k FROM ensembl_object WHERE ensembl_id % 2 = 0) SELECT ensembl_id, count(*) FILTER (stable_id IN (SELECT k FROM d) OR concat_ws('.', stable_id, version) IN (SELECT k FROM d)) AS n FROM ensembl_object GROUP BY 1",
    "q_attr_explode": "SELECT event_id, 'k' AS name, json_extract_string(props,'$.k') AS value FROM events WHERE props IS NOT NULL",
    "q_gff_attributes": entries_sql(";")
    + r""", g AS (SELECT line_no FROM gtf WHERE regexp_matches(attribute, '(?i)_id\s*=')), v AS (SELECT line_no, arg_max(value, i) FILTER (name = 'gene_id') AS a, arg_max(value, i) FILTER (name = 'transcript_id') AS b FROM n GROUP BY line_no)
SELECT g.line_no, concat_ws(' ', 'gene_id "' || a || '";', 'transcript_id "' || b || '";') AS gtf FROM g LEFT JOIN v ON v.line_no = g.line_no""",
    "q_attr_types": entries_sql()
    + r""", f AS (SELECT line_no, name, arg_min(value, i) AS v FROM n WHERE name IN ('exon_number', 'gene_id', 'level') GROUP BY ALL), k AS (SELECT unnest(['exon_number', 'gene_id', 'level']) AS attr_name)
SELECT attr_name, CASE WHEN coalesce(bool_and(regexp_matches(v, '^\s*[+-]?\d{1,9}\s*$')), true) THEN 'int' WHEN bool_and(regexp_matches(v, '^\s*[+-]?\d{1,18}\s*$')) THEN 'bigint' WHEN bool_and(regexp_matches(v, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')) THEN 'double' ELSE 'string' END AS inferred
FROM k LEFT JOIN f ON name = attr_name GROUP BY attr_name""",
}
