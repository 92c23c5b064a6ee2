"""Queries of the per-read operators and sequence functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import flags as FL
from tagloom.functions import seq as S
from tagloom.functions import sqlfn
from tagloom.functions.special import required_letters
from tagloom.operators import annot as A
from tagloom.operators import reads as R
from tagloom.operators.packed import first_values
from tagloom.plans.common import dna, dna_sql
from tagloom.plans.problems import entries_sql
from tagloom.session import table

SAMPLES = [R.Sample("s1", "ATCACG", 2), R.Sample("s2", "CGATGT", 2), R.Sample("s3", "TTAGGC", 2), R.Sample("s4", "TGACCA", 2)]
#: Letters that make tail-like reads: mostly T.
TAILY = "TTTTTTTTTTTTACGN"
QUALITY = "!#%')+-/13579;=?"
REQUIRED = required_letters(100)


def q_flag_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Reads per sample that pass the bad-flag mask, and those with an intact end."""
    t = table(spark, folder, "taginfo").filter(FL.passes(F.col("pflags")))
    return t.groupBy("sample").agg(F.count("*").alias("n_good"), F.count_if(FL.intact_end(F.coalesce("polya_len", F.lit(-1)), F.col("pflags"))).alias("n_intact"))


def q_priority_score(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tagaln").select("row_no", FL.priority_score(F.col("pflags")).alias("score"))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")


def q_demux_hamming(spark: SparkSession, folder: str) -> DataFrame:
    reads = _orders(spark, folder).withColumn("idx", dna(F.col("o_orderkey"), 6)).withColumn("pflags", F.lit(0))
    out = R.demultiplex(reads, "idx", SAMPLES, control=F.col("idx").startswith("AA"), flags="pflags")
    return out.select("o_orderkey", "sample", "mismatches", "pflags")


def q_demux_counters(spark: SparkSession, folder: str) -> DataFrame:
    reads = _orders(spark, folder).withColumn("idx", dna(F.col("o_orderkey"), 6)).withColumn("seq", dna(F.col("o_orderkey"), 30))
    qual = F.translate(F.substring(F.md5(F.col("seq")), 1, 20), "0123456789abcdef", QUALITY)
    reads = R.demultiplex(reads.withColumn("qual", qual), "idx", SAMPLES)
    counts = R.demux_counters(
        reads, ["sample", "o_orderstatus"], R.fixed_sequence_ok(F.col("seq"), "ACG", 10, 2), R.quality_ok(F.col("qual"), 0, 20, 14, 0.5), R.find_delimiter(F.col("seq"), "GTC", F.lit(15), 1)["end"] >= 0
    )
    sums = [c for c in counts.columns if c.startswith("cln_")]
    return R.with_totals(counts, "sample", "o_orderstatus", sums)


def q_fixed_seq_filter(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "customer").withColumn("seq", dna(F.col("c_custkey")))
    return t.filter(R.fixed_sequence_ok(F.col("seq"), "ACAGTAGCTC", 5, 6)).select("c_custkey", "seq")


def q_quality_pass(spark: SparkSession, folder: str) -> DataFrame:
    qual = F.translate(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 30), "0123456789abcdef", QUALITY)
    t = _orders(spark, folder).withColumn("qual", qual)
    return t.select("o_orderkey", S.count_phred(F.col("qual"), 14, F.lit(2), 20).alias("n_good"), R.quality_ok(F.col("qual"), 2, 20, 14, 0.6).alias("ok"))


def q_delimiter_find(spark: SparkSession, folder: str) -> DataFrame:
    t = _orders(spark, folder).withColumn("seq", dna(F.col("o_orderkey"), 30))
    d = R.find_delimiter(F.col("seq"), "GTNAG", F.lit(8), 1)
    return t.select("o_orderkey", d["end"].alias("delim_end"), d["flags"].alias("flags"))


def _tails(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_partkey", dna(F.col("p_partkey"), 24, TAILY).alias("seq"))


def q_best_segment(spark: SparkSession, folder: str) -> DataFrame:
    t = _tails(spark, folder).withColumn("b", R.best_segment(F.col("seq")))
    start, n = F.coalesce("b.start", F.lit(0)), F.coalesce(F.col("b.end") - F.col("b.start"), F.lit(0))
    return t.select("p_partkey", F.col("b.start").alias("seg_start"), F.col("b.end").alias("seg_end"), R.segment_flags(F.lit(0), start, n).alias("flags"), R.modification(F.col("seq"), F.lit(0), F.col("b.start")).alias("mods"))


def q_revcomp(spark: SparkSession, folder: str) -> DataFrame:
    return _tails(spark, folder).select("p_partkey", S.reverse_complement(F.col("seq")).alias("rc"), S.only_bases(F.col("seq")).alias("bases"))


def q_umi_concat(spark: SparkSession, folder: str) -> DataFrame:
    t = _orders(spark, folder).withColumn("seq", dna(F.col("o_orderkey"), 32))
    return t.select("o_orderkey", S.ranges_of(F.col("seq"), [(2, 6), (15, 20)]).alias("umi"))


def q_composition(spark: SparkSession, folder: str) -> DataFrame:
    t = _orders(spark, folder).withColumn("seq", dna(F.col("o_orderkey"), 16))
    return t.select("o_orderkey", R.composition_ok(F.col("seq"), 3).alias("balanced"), S.count_letter(F.col("seq"), "A").alias("n_a"))


def q_dark_flags(spark: SparkSession, folder: str) -> DataFrame:
    dark = F.pmod(F.col("cluster"), F.lit(8)).cast("int")
    return table(spark, folder, "taginfo").select("tile", "cluster", R.dark_flags(F.col("pflags"), dark).alias("flags")).groupBy("flags").agg(F.count("*").alias("n"))


def q_trailing_run(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "taginfo").filter("mods IS NOT NULL").select("mods").groupBy("mods").agg(F.count("*").alias("n"))
    return t.select("mods", "n", *[S.trailing_run(F.col("mods"), c).alias(f"run_{c.lower()}") for c in "TGC"], S.strip_trailing_homopolymer(F.col("mods")).alias("body"))


def q_tail_reeval(spark: SparkSession, folder: str) -> DataFrame:
    t = _orders(spark, folder).withColumn("bases", dna(F.col("o_orderkey"), 12, "AAAAAAAAAATTTGGC")).withColumn("len0", F.pmod("o_orderkey", F.lit(12)).cast("int"))
    return t.select("o_orderkey", R.reevaluated_tail(F.col("len0"), F.col("bases"), REQUIRED).cast("int").alias("new_len"))


def q_required_letters(spark: SparkSession, folder: str) -> DataFrame:
    """The table of required letters, beside how many modifications have each length."""
    need = F.get(F.array(*[F.lit(x) for x in REQUIRED]), F.length("mods"))
    t = table(spark, folder, "taginfo").filter("mods IS NOT NULL")
    return t.groupBy(F.length("mods").alias("n"), need.alias("needed")).agg(F.count("*").alias("reads"))


def _cigars(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    cigar = F.concat(F.pmod(k, F.lit(7)).cast("string"), F.lit("S"), (F.lit(20) + F.pmod(k, F.lit(11))).cast("string"), F.lit("M"), F.pmod(k, F.lit(3)).cast("string"), F.lit("I5M"), F.pmod(k, F.lit(100)).cast("string"), F.lit("N9M2D3M"), F.pmod(k, F.lit(5)).cast("string"), F.lit("S"))
    return _orders(spark, folder).withColumn("cigar", cigar)


def q_cigar(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col("cigar")
    return _cigars(spark, folder).select("o_orderkey", S.reference_span(c).alias("ref_span"), S.match_span(c).alias("m_span"), S.read_span(c).alias("read_len"))


def q_tail_bases(spark: SparkSession, folder: str) -> DataFrame:
    """Non-templated bases of synthetic alignments, either strand."""
    k = F.col("o_orderkey")
    t = _orders(spark, folder).select("o_orderkey", dna(k, 20).alias("seq"), dna(k + 1, 2, "ACGTACGTACGTACGT").alias("ref"), (F.pmod(k, F.lit(2)) == 0).alias("rev"), F.concat(F.pmod(k, F.lit(4)).cast("string"), F.lit("S12M"), F.pmod(k, F.lit(5)).cast("string"), F.lit("S")).alias("cigar"))
    return t.select("o_orderkey", R.tail_bases(F.col("cigar"), F.col("rev"), F.col("seq"), F.col("ref")).alias("tail"))


def q_version_strip(spark: SparkSession, folder: str) -> DataFrame:
    g = table(spark, folder, "gtf").filter("attribute IS NOT NULL")
    tid = first_values(F.col("attribute"), ["transcript_id"])["transcript_id"]
    return g.select("line_no", tid.alias("transcript_id"), S.without_version(tid).alias("bare")).filter("transcript_id != ''")


def q_id_format(spark: SparkSession, folder: str) -> DataFrame:
    """Names of all reads; an unknown length is -1, unknown modifications are none."""
    t = table(spark, folder, "taginfo").withColumns({"polya_len": F.coalesce("polya_len", F.lit(-1)), "mods": F.coalesce("mods", F.lit(""))})
    c = F.col
    return t.select("sample", S.read_name(c("tile"), c("cluster")).alias("short_name"), S.verbose_name(c("tile"), c("cluster"), c("pflags"), c("clones"), c("polya_len"), c("mods")).alias("long_name"))


def q_parse_read_id(spark: SparkSession, folder: str) -> DataFrame:
    q = F.col("qname")
    return table(spark, folder, "tagaln").select("row_no", F.split_part(q, F.lit(":"), F.lit(1)).alias("tile"), F.split_part(q, F.lit(":"), F.lit(2)).try_cast("bigint").alias("cluster"))


def q_levenshtein_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Bounded edit distance of all pairs of umis that share their place; -1 beyond 2 edits.

    An equi-join on the place: every pair of a place is a row, so rows grow with the
    square of a place's tags.
    """
    t = table(spark, folder, "tagcluster").filter("umi_rep IS NOT NULL AND rname IS NOT NULL").select("tag_id", "rname", "pos", "umi_rep")
    a, b = t.alias("a"), t.alias("b")
    met = a.join(b, (F.col("a.rname") == F.col("b.rname")) & (F.col("a.pos") == F.col("b.pos")) & (F.col("a.tag_id") < F.col("b.tag_id")))
    d = S.edit_within(F.col("a.umi_rep"), F.col("b.umi_rep"), 2)
    return met.select(F.col("a.tag_id").alias("id_a"), F.col("b.tag_id").alias("id_b"), d.alias("d"), S.hamming(F.col("a.umi_rep"), F.col("b.umi_rep")).alias("h"))


def q_trimer_l1(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part").select("p_partkey", dna(F.col("p_partkey"), 12).alias("a"), dna(F.col("p_partkey") + 1, 12).alias("b"))
    return p.select("p_partkey", S.trimer_distance(F.col("a"), F.col("b")).alias("d"))


def q_chimera(spark: SparkSession, folder: str) -> DataFrame:
    """Users none of whose errors lies within an hour of one of their purchases."""
    e = table(spark, folder, "events").select("user_id", F.lit("x").alias("place"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("pos"), "event_type")
    out = R.has_chimera(e.filter("event_type = 'error'"), e.filter("event_type = 'purchase'"), "user_id", "place", "pos", 36000)
    return out.groupBy("user_id").agg(F.count("*").alias("n"))


def q_sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    """The functions that are registered for SQL."""
    sqlfn.register(spark)
    _tails(spark, folder).createOrReplaceTempView("tagloom_tails")
    return spark.sql("SELECT p_partkey, reverse_complement(seq) AS rc, hamming_distance(seq, reverse(seq)) AS h, trailing_run(seq, 'T') AS t, bare_id(concat(seq, '.1')) AS bare, edit_within(seq, concat(seq, 'A'), 1) AS near, has_flag(CAST(p_partkey AS INT), 4) AS four, coalesce(best_segment(seq).start, -1) AS seg FROM tagloom_tails")


def q_best_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """The best alignment of each customer's reads: longest match, then quality, then first."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    c = _cigars(spark, folder).select("o_orderkey", "cigar").join(o, "o_orderkey")
    quality = F.pmod("o_orderkey", F.lit(60)).cast("int")
    return A.pick_first(c.withColumn("mapq", quality).withColumn("span", S.match_span(F.col("cigar"))), ["o_custkey"], [-F.col("span"), -F.col("mapq"), F.col("o_orderkey")], ["o_orderkey", "span", "mapq"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for k, v in globals().items() if k.startswith("q_")}

def _mm(word: str, col: str = "idx", at: int = 1) -> str:
    return " + ".join(f"(substr({col},{at + i},1)<>'{c}')::INT" for i, c in enumerate(word))


_DEMUX = f"""WITH r AS (SELECT o_orderkey, o_orderstatus, {dna_sql("o_orderkey", 6)} AS idx, {dna_sql("o_orderkey", 30)} AS seq FROM orders),
d AS (SELECT *, [{", ".join("{{'mm': " + _mm(s.index).replace("{", "").replace("}", "") + ", 's': '" + s.name + "'}}" for s in SAMPLES).replace("{{", "{").replace("}}", "}")}] AS ds FROM r),
b AS (SELECT *, list_min(list_transform(ds, lambda x: x.mm)) AS m FROM d),
c AS (SELECT *, list_filter(ds, lambda x: x.mm = m) AS hit FROM b),
a AS (SELECT o_orderkey, o_orderstatus, idx, seq, CASE WHEN len(hit) = 1 AND m <= 2 THEN hit[1].s WHEN WITHCONTROL THEN 'PhiX' ELSE 'Unknown' END AS sample,
  CASE WHEN len(hit) = 1 AND m <= 2 THEN m ELSE -1 END AS mismatches FROM c)
"""
_QUAL = f"translate(substr(md5({{}}),1,{{}}),'0123456789abcdef','{QUALITY.replace(chr(39), chr(39) * 2)}')"
_GOOD = "len(list_filter(string_split(substr({},{},20),''), lambda x: ascii(x) - 33 >= 14))"


def _delim(pattern: str, at: int) -> str:
    return " + ".join("0" if c == "N" else f"(substr(seq,{at + 1 + i},1)<>'{c}')::INT" for i, c in enumerate(pattern))


_CNT = ", ".join(
    f"count(*) FILTER ({cond}) AS {name}"
    for name, cond in (
        ("cln_no_index_mm", "mismatches <= 0"),
        ("cln_1_index_mm", "mismatches = 1"),
        ("cln_2_index_mm", "mismatches > 1"),
        ("cln_fp_mm", "NOT fp"),
        ("cln_qc_fail", "fp AND NOT qc"),
        ("cln_no_delim", "fp AND qc AND NOT dl"),
        ("cln_passed", "fp AND qc AND dl"),
    )
)
_MODS = "regexp_replace({}, '(T+|G+|C+)$', '')"
_RC = "translate(reverse({}),'ATUGCatugc','TAACGtaacg')"

ORACLE: dict[str, str] = {
    "q_flag_filter": "SELECT sample, count(*) AS n_good, count(*) FILTER (coalesce(polya_len,-1) >= 5 OR pflags & 8192 <> 0) AS n_intact FROM taginfo WHERE pflags & 8064 = 0 GROUP BY sample",
    "q_priority_score": "SELECT row_no, 1024*(pflags&16=0)::INT + 512*(pflags&128=0)::INT + 256*(pflags&2=0)::INT + 128*(pflags&8<>0)::INT + 64*(pflags&2048=0)::INT + 32*(pflags&512=0)::INT + 16*(pflags&1024=0)::INT + 8*(pflags&64=0)::INT + 4*(pflags&32=0)::INT + 2*(pflags&1<>0)::INT AS score FROM tagaln",
    "q_demux_hamming": _DEMUX.replace("WITHCONTROL", "starts_with(idx,'AA')") + "SELECT o_orderkey, sample, mismatches, CASE WHEN mismatches > 0 THEN 16 ELSE 0 END AS pflags FROM a",
    "q_demux_counters": _DEMUX.replace("WITHCONTROL", "false")
    + f", f AS (SELECT *, ({_mm('ACG', 'seq', 11)}) <= 2 AS fp, {_GOOD.format(_QUAL.format('seq', 20), 1)} >= 10 AS qc, least({', '.join(_delim('GTC', 15 + o) for o in (0, -1, 1))}) <= 1 AS dl FROM a) "
    + f"SELECT sample, CASE WHEN grouping(o_orderstatus) = 1 THEN '(total)' ELSE o_orderstatus END AS o_orderstatus, {_CNT} FROM f GROUP BY GROUPING SETS ((sample), (sample, o_orderstatus))",
    "q_fixed_seq_filter": f"SELECT * FROM (SELECT c_custkey, {dna_sql('c_custkey')} AS seq FROM customer) WHERE {_mm('ACAGTAGCTC', 'seq', 6)} <= 6",
    "q_quality_pass": f"SELECT o_orderkey, n_good, n_good >= 12 AS ok FROM (SELECT o_orderkey, {_GOOD.format(_QUAL.format('CAST(o_orderkey AS VARCHAR)', 30), 3)} AS n_good FROM orders)",
    "q_delimiter_find": f"""WITH r AS (SELECT o_orderkey, {dna_sql("o_orderkey", 30)} AS seq FROM orders), m AS (SELECT o_orderkey, {", ".join(f"{_delim('GTNAG', 8 + o)} AS m{i}" for i, o in enumerate((0, -1, 1)))} FROM r)
SELECT o_orderkey, CASE WHEN m0 <= 1 THEN 13 WHEN m1 <= 1 THEN 12 WHEN m2 <= 1 THEN 14 ELSE -1 END AS delim_end,
  CASE WHEN m0 <= 1 THEN 2*(m0>0)::INT WHEN m1 <= 1 THEN 32 + 2*(m1>0)::INT WHEN m2 <= 1 THEN 32 + 2*(m2>0)::INT ELSE 128 END AS flags FROM m""",
    "q_best_segment": f"""WITH r AS (SELECT p_partkey, {dna_sql("p_partkey", 24, TAILY)} AS seq FROM part),
c AS (SELECT p_partkey, seq, i, CASE substr(seq,i,1) WHEN 'T' THEN 2 WHEN 'N' THEN -1 ELSE -9 END AS pw, CASE substr(seq,i,1) WHEN 'T' THEN -1 WHEN 'A' THEN 0 WHEN 'N' THEN 0 ELSE -4 END AS hw FROM r, range(1,25) t(i)),
s AS (SELECT *, sum(pw) OVER w AS p, sum(hw) OVER w AS h FROM c WINDOW w AS (PARTITION BY p_partkey ORDER BY i)),
k AS (SELECT a.p_partkey, a.i - 1 AS st, b.i AS en, (a.h - a.hw) - (a.p - a.pw) + b.p AS score FROM s a JOIN s b ON a.p_partkey = b.p_partkey AND b.i >= a.i + 4 WHERE a.i <= 20),
z AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, st, en) AS k FROM k)
SELECT r.p_partkey, st::INT AS seg_start, en::INT AS seg_end, CASE WHEN st IS NULL THEN 0 ELSE 1 + 4*(st>0)::INT END AS flags, {_RC.format("substr(seq,1,st)")} AS mods FROM r LEFT JOIN z ON r.p_partkey = z.p_partkey AND k = 1 AND score >= 1""",
    "q_revcomp": f"WITH r AS (SELECT p_partkey, {dna_sql('p_partkey', 24, TAILY)} AS seq FROM part) SELECT p_partkey, {_RC.format('seq')} AS rc, seq AS bases FROM r",
    "q_umi_concat": f"SELECT o_orderkey, substr(seq,2,5) || substr(seq,15,6) AS umi FROM (SELECT o_orderkey, {dna_sql('o_orderkey', 32)} AS seq FROM orders)",
    "q_composition": f"SELECT o_orderkey, {' AND '.join(f'length(seq)-length(replace(seq,{chr(39)}{c}{chr(39)},{chr(39) * 2})) >= 3' for c in 'ACGT')} AS balanced, length(seq)-length(replace(seq,'A','')) AS n_a FROM (SELECT o_orderkey, {dna_sql('o_orderkey', 16)} AS seq FROM orders)",
    "q_dark_flags": "SELECT pflags | CASE WHEN cluster%8>=1 THEN 64 ELSE 0 END | CASE WHEN cluster%8>=5 THEN 2048 ELSE 0 END AS flags, count(*) AS n FROM taginfo GROUP BY 1",
    "q_trailing_run": f"SELECT mods, count(*) AS n, {', '.join(f'least(20, length(mods)-length(rtrim(mods,{chr(39)}{c}{chr(39)}))) AS run_{c.lower()}' for c in 'TGC')}, {_MODS.format('mods')} AS body FROM taginfo WHERE mods IS NOT NULL GROUP BY mods",
    "q_tail_reeval": f"""WITH r AS (SELECT o_orderkey, o_orderkey % 12 AS len0, {_MODS.format(dna_sql("o_orderkey", 12, "AAAAAAAAAATTTGGC"))} AS body FROM orders),
n AS (SELECT *, length(body) AS n, length(body)-length(replace(body,'A','')) AS a, length(body)-length(rtrim(body,'A')) AS run FROM r)
SELECT o_orderkey, (CASE WHEN len0 > 7 THEN len0 WHEN n = 0 THEN 0 WHEN a >= [{",".join(map(str, REQUIRED))}][n+1] THEN a WHEN run >= 3 THEN run ELSE 0 END)::INT AS new_len FROM n""",
    "q_required_letters": f"SELECT length(mods) AS n, [{','.join(map(str, REQUIRED))}][length(mods)+1] AS needed, count(*) AS reads FROM taginfo WHERE mods IS NOT NULL GROUP BY 1, 2",
    "q_cigar": """WITH r AS (SELECT o_orderkey AS k FROM orders)
SELECT k AS o_orderkey, (20 + k%11) + 5 + k%100 + 9 + 2 + 3 AS ref_span, (20 + k%11) + 5 + 9 + 3 AS m_span, k%7 + (20 + k%11) + k%3 + 5 + 9 + 3 + k%5 AS read_len FROM r""",
    "q_tail_bases": f"""WITH r AS (SELECT o_orderkey, o_orderkey % 2 = 0 AS rev, {dna_sql("o_orderkey", 20)} AS s, {dna_sql("o_orderkey + 1", 2)} AS f, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5 ELSE o_orderkey % 4 END AS clip FROM orders),
d AS (SELECT o_orderkey, clip, CASE WHEN rev THEN s ELSE {_RC.format("s")} END AS q, CASE WHEN rev THEN f ELSE {_RC.format("f")} END AS w FROM r),
a AS (SELECT *, CASE WHEN substr(q, 19 - clip::INT, 1) <> substr(w,1,1) THEN 2 WHEN substr(q, 20 - clip::INT, 1) <> substr(w,2,1) THEN 1 ELSE 0 END AS more FROM d)
SELECT o_orderkey, substr(q, 21 - (clip + more)::INT) AS tail FROM a""",
    "q_version_strip": entries_sql() + ", t AS (SELECT line_no, arg_min(value, i) AS t FROM n WHERE name = 'transcript_id' GROUP BY line_no) SELECT line_no, t AS transcript_id, split_part(t,'.',1) AS bare FROM t WHERE t <> ''",
    "q_id_format": "SELECT sample, format('{}:{:08d}', tile, cluster) AS short_name, format('{}:{:08d}:{:04x}:{:d}:{:d}:{}', tile, cluster, pflags, clones, coalesce(polya_len, -1), coalesce(mods, '')) AS long_name FROM taginfo",
    "q_parse_read_id": "SELECT row_no, split_part(qname,':',1) AS tile, TRY_CAST(split_part(qname,':',2) AS BIGINT) AS cluster FROM tagaln",
    "q_levenshtein_pairs": """WITH t AS (SELECT * FROM tagcluster WHERE umi_rep IS NOT NULL AND rname IS NOT NULL), m AS (SELECT a.tag_id AS a, b.tag_id AS b, a.umi_rep AS x, b.umi_rep AS y FROM t a JOIN t b ON a.rname=b.rname AND a.pos=b.pos AND a.tag_id<b.tag_id)
SELECT a AS id_a, b AS id_b, CASE WHEN levenshtein(x,y) <= 2 THEN levenshtein(x,y) ELSE -1 END AS d, CASE WHEN least(length(x),length(y)) = 0 THEN 0 ELSE hamming(substr(x,1,least(length(x),length(y))), substr(y,1,least(length(x),length(y)))) END AS h FROM m""",
    "q_trimer_l1": f"""WITH p AS (SELECT p_partkey, {dna_sql("p_partkey", 12)} AS a, {dna_sql("p_partkey + 1", 12)} AS b FROM part),
w AS (SELECT p_partkey, substr(a,i,3) AS t, 1 AS k FROM p, range(1,11) r(i) UNION ALL SELECT p_partkey, substr(b,i,3), -1 FROM p, range(1,11) r(i))
SELECT p_partkey, sum(abs(c))::INT AS d FROM (SELECT p_partkey, t, sum(k) AS c FROM w GROUP BY ALL) GROUP BY p_partkey""",
    "q_sql_functions": f"""WITH r AS (SELECT p_partkey, {dna_sql("p_partkey", 24, TAILY)} AS seq FROM part), BESTSEGMENT
SELECT r.p_partkey, {_RC.format("seq")} AS rc, hamming(seq, reverse(seq))::INT AS h, (length(seq) - length(rtrim(seq,'T')))::INT AS t, seq AS bare, true AS near, r.p_partkey & 4 <> 0 AS four, coalesce(st, -1)::INT AS seg FROM r LEFT JOIN z ON z.p_partkey = r.p_partkey AND k = 1 AND score >= 1""",
    "q_best_alignment": """WITH a AS (SELECT o_custkey, o_orderkey, (20 + o_orderkey%11) + 5 + 9 + 3 AS span, (o_orderkey % 60)::INT AS mapq FROM orders)
SELECT o_custkey, o_orderkey, span, mapq FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY span DESC, mapq DESC, o_orderkey) AS k FROM a) WHERE k = 1""",
    "q_chimera": """WITH e AS (SELECT user_id, epoch(ts)::BIGINT AS pos, event_type FROM events WHERE event_type IN ('error','purchase')), l AS (SELECT * FROM e WHERE event_type='error'), r AS (SELECT * FROM e WHERE event_type='purchase')
SELECT user_id, count(*) AS n FROM l WHERE user_id IN (SELECT user_id FROM r) AND user_id NOT IN (SELECT l.user_id FROM l JOIN r ON l.user_id=r.user_id AND abs(l.pos-r.pos)<36000) GROUP BY user_id""",
}

# the segment search is the same text in both
_SEGMENT = ORACLE["q_best_segment"]
ORACLE["q_sql_functions"] = ORACLE["q_sql_functions"].replace("BESTSEGMENT", _SEGMENT[_SEGMENT.index("c AS (") : _SEGMENT.rindex("SELECT r.p_partkey")])
