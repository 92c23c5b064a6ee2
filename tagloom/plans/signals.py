"""Queries of signal operators and sampling; embeddings stand in for signals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import signal as S
from tagloom.plans.common import dna, dna_sql
from tagloom.session import table

MATRIX = [1.0, 0.1, 0.0, 0.0, 0.2, 1.0, 0.0, 0.0, 0.0, 0.1, 1.0, 0.1, 0.0, 0.0, 0.3, 1.0]
INVERSE = S.inverse_of(MATRIX)
LOW, BAND = [-0.3, -0.3, -0.3, -0.3], [0.6, 0.6, 0.6, 0.6]
CONTROL = "GAGTTTTATCGCTTCCATGACGCAGAAGTTAACACTTTCGG"


def _values(spark: SparkSession, folder: str) -> DataFrame:
    """Scores in [0, 1], rounded so that every engine has the same doubles."""
    e = table(spark, folder, "embeddings").filter("embedding IS NOT NULL")
    return e.select("vec_id", F.coalesce("label", F.lit(0)).alias("label"), F.transform("embedding", lambda x: F.round(x.cast("double") + 0.5, 4)).alias("v"))


def _cycles(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen cycles of four channels from each embedding."""
    e = table(spark, folder, "embeddings").filter("embedding IS NOT NULL")
    v = F.transform("embedding", lambda x: F.round(x.cast("double"), 4))
    return e.select("vec_id", v.alias("v")).select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.slice("v", i * 4 + 1, F.lit(4))).alias("cycles"))


def q_color_correction(spark: SparkSession, folder: str) -> DataFrame:
    """The four channels of every cycle of every signal, corrected."""
    c = _cycles(spark, folder).select("vec_id", F.posexplode("cycles").alias("cycle_no", "cycle")).select("vec_id", "cycle_no", S.corrected(F.col("cycle"), INVERSE).alias("s"))
    return c.select("vec_id", "cycle_no", *[F.round(F.get("s", F.lit(k)), 8).alias(f"s{k}") for k in range(4)])


def q_entropy_downhill(spark: SparkSession, folder: str) -> DataFrame:
    n = S.normalized(F.col("cycle"), LOW, BAND)
    c = _cycles(spark, folder).select("vec_id", F.posexplode("cycles").alias("cycle_no", "cycle")).withColumn("e", S.entropy_score(n))
    from pyspark.sql import Window as W

    w = W.partitionBy("vec_id").orderBy("cycle_no")
    return c.select("vec_id", "cycle_no", F.round("e", 8).alias("entropy_score"), F.coalesce(F.round("e", 8) < F.lag(F.round("e", 8)).over(w), F.lit(False)).alias("downhill"))


def q_polya_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = _cycles(spark, folder).select("vec_id", S.tail_scores(F.col("cycles"), LOW, BAND, None, 0.05).alias("s"))
    each = scored.select("vec_id", F.posexplode("s").alias("cycle_no", "x"))
    return each.select("vec_id", "cycle_no", F.round("x.score", 7).alias("score"), (S.quantised(F.col("x.score")) == 0).alias("dark"))


def q_score_bins(spark: SparkSession, folder: str) -> DataFrame:
    return S.score_bins(_values(spark, folder), ["label"], "v", 50)


def q_rank_mean(spark: SparkSession, folder: str) -> DataFrame:
    v = _values(spark, folder)
    return v.select("vec_id", F.round(S.ranked_mean(F.col("v"), 4, False), 8).alias("low"), F.round(S.ranked_mean(F.col("v"), 2, True), 8).alias("high"))


def q_contrast(spark: SparkSession, folder: str) -> DataFrame:
    c = _values(spark, folder).select("vec_id", S.contrast(F.col("v"), 5, 5).alias("c"))
    return c.select("vec_id", F.round(F.col("c.contrast") + 1e-7, 5).alias("contrast"))


def q_ruler(spark: SparkSession, folder: str) -> DataFrame:
    v = _values(spark, folder)
    down = F.transform("v", lambda x, i: F.coalesce(x < F.get("v", i - 1), F.lit(False)))
    return v.select("vec_id", S.tail_length(F.col("v"), down, F.transform("v", lambda x: F.lit(0.48))).alias("length"))


def q_interp_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Mean length per day of each sample, days of few reads filled from their neighbours."""
    t = table(spark, folder, "taginfo").filter("polya_len >= 0").groupBy("sample", F.unix_date("run_day").alias("day")).agg(F.count("*").alias("k"), F.avg("polya_len").alias("m"))
    t = t.select("sample", "day", F.when(F.pmod("day", F.lit(3)) != 0, F.col("m")).alias("m"))
    return S.infer_missing(t, ["sample"], "day", "m").select("sample", "day", F.round("m", 6).alias("m"))


def q_equal_odds(spark: SparkSession, folder: str) -> DataFrame:
    """Cut-offs per tile and cycle from two classes of synthetic scores; checked in the tests."""
    t = table(spark, folder, "taginfo").filter("tile IS NOT NULL").select("tile", F.pmod("cluster", F.lit(4)).cast("int").alias("cycle"), (F.pmod("cluster", F.lit(2)) == 0).alias("positive"), (F.pmod(F.xxhash64("cluster"), F.lit(300)) + F.when(F.pmod("cluster", F.lit(2)) == 0, 250).otherwise(50)).cast("int").alias("bin"))
    both = t.withColumn("cycle", (F.col("cycle") / 2).cast("int"))
    return S.fit_cutoffs(both.groupBy("tile", "cycle", "positive", "bin").agg(F.count("*").alias("n")), least=100)


def q_refine_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Two rounds of measuring and fitting over synthetic signals."""
    v = _values(spark, folder).select(F.col("label").cast("string").alias("tile"), "vec_id", F.col("v").alias("scores"), F.transform("v", lambda x, i: F.coalesce(x < F.get("v", i - 1), F.lit(False))).alias("downhill"))
    h = S.score_bins(v, ["tile"], "scores").withColumn("positive", F.col("bin") >= 480)
    return S.refine_rounds(v, h.select("tile", "cycle", "positive", "bin", "n"), "vec_id", 1).select("vec_id", "length")


def q_control_align(spark: SparkSession, folder: str) -> DataFrame:
    """Reads that align to a control sequence, exactly or nearly; checked in the tests."""
    k = F.col("p_partkey")
    cut = F.substring(F.lit(CONTROL), (F.pmod(k, F.lit(20)) + 1).cast("int"), F.lit(20))
    read = F.when(F.pmod(k, F.lit(3)) == 0, cut).when(F.pmod(k, F.lit(3)) == 1, F.concat(F.substring(cut, 1, 8), F.lit("A"), F.substring(cut, 10, 11))).otherwise(dna(k, 20))
    p = table(spark, folder, "part").select("p_partkey", read.alias("read"))
    return p.select("p_partkey", S.matches_control(F.col("read"), CONTROL).alias("control"))


def q_fair_sample(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").withColumn("seq", dna(F.col("o_orderkey"), 4))
    return S.bucket_sample(o, F.col("seq"), ["o_orderkey"], 5).select("o_orderkey", "seq")


def q_hash_fair_sample(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "tagcluster").filter("umi_rep IS NOT NULL")
    return S.fair_sample(t, "umi_rep", ["tag_id"], 2, 512).select("tag_id", "umi_rep")


def q_reservoir(spark: SparkSession, folder: str) -> DataFrame:
    return S.reservoir(table(spark, folder, "orders"), ["o_orderkey"], 100).select("o_orderkey", "o_orderstatus")


def q_smoothed(spark: SparkSession, folder: str) -> DataFrame:
    v = _values(spark, folder).select("vec_id", S.smoothed(F.col("v"), [1.0, 2.0, 1.0]).alias("s"))
    return v.select("vec_id", F.posexplode("s").alias("place", "x")).select("vec_id", "place", F.round("x", 6).alias("x"))


def q_seed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """First counts for the fit, over short synthetic signals; checked in the tests."""
    v = _values(spark, folder).select("vec_id", F.col("label").cast("string").alias("tile"), "v", F.when(F.pmod("vec_id", F.lit(2)) == 0, 20).otherwise(0).alias("len"), F.lit(0).alias("start"), F.md5(F.col("vec_id").cast("string")).alias("fp"))
    return S.seed_counts(v, "tile", "v", "len", "start", "fp", ["vec_id"], boundary=10, gap=3, least_contrast=0.0, guards=(5, 5))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for k, v in globals().items() if k.startswith("q_")}

_V = "v AS (SELECT vec_id, coalesce(label,0) AS label, list_transform(embedding, lambda x: round(x::DOUBLE + 0.5, 4)) AS v FROM embeddings WHERE embedding IS NOT NULL)"
_E = f"{_V}, e AS (SELECT vec_id, label, i - 1 AS i, v[i] AS x, len(v) AS n FROM v, range(1, len(v) + 1) t(i))"
_C = "c AS (SELECT vec_id, cy, [round(embedding[cy*4+1]::DOUBLE,4), round(embedding[cy*4+2]::DOUBLE,4), round(embedding[cy*4+3]::DOUBLE,4), round(embedding[cy*4+4]::DOUBLE,4)] AS c FROM embeddings, range(0,16) t(cy) WHERE embedding IS NOT NULL)"
_SH = f"{_C}, g AS (SELECT *, list_transform(c, lambda x: greatest(0.0, (x + 0.3) / 0.6)) AS g FROM c), p AS (SELECT *, CASE WHEN list_sum(g) > 0 THEN list_transform(g, lambda x: x / list_sum(g)) END AS p FROM g), s AS (SELECT *, 1 + list_sum(list_transform(p, lambda x: CASE WHEN x > 0 THEN x * ln(greatest(x,1e-300)) ELSE 0 END)) / ln(4) AS en FROM p)"

ORACLE: dict[str, str] = {
    "q_color_correction": f"WITH {_C} SELECT vec_id, cy::INT AS cycle_no, " + ", ".join("round(" + " + ".join(f"c[{k + 1}] * {INVERSE[4 * r + k]!r}::DOUBLE" for k in range(4)) + f", 8) AS s{r}" for r in range(4)) + " FROM c",
    "q_entropy_downhill": f"WITH {_SH} SELECT vec_id, cy::INT AS cycle_no, round(en,8) AS entropy_score, coalesce(round(en,8) < lag(round(en,8)) OVER (PARTITION BY vec_id ORDER BY cy), false) AS downhill FROM s",
    "q_polya_score": f"WITH {_SH}, d AS (SELECT *, list_sum(list_transform(c, lambda x: greatest(x,0.0))) >= 0.05 AND p IS NOT NULL AS lit, floor(p[4]*200) AS b FROM s), z AS (SELECT vec_id, cy, CASE WHEN lit THEN en * CASE WHEN b >= 200 THEN 1.0 ELSE 1/(1+exp(-17.0*((b+0.5)/200-0.6))) END END AS score FROM d) SELECT vec_id, cy::INT AS cycle_no, round(score,7) AS score, score IS NULL AS dark FROM z",
    "q_score_bins": f"WITH {_E} SELECT label, i::INT AS cycle, least(floor(x*50),49)::INT AS bin, count(*) AS n FROM e GROUP BY ALL",
    "q_rank_mean": f"WITH {_V} SELECT vec_id, round(list_avg(list_sort(v)[1:4]),8) AS low, round(list_avg(list_reverse_sort(v)[1:2]),8) AS high FROM v",
    "q_contrast": f"WITH {_E}, s AS (SELECT *, sum(x) OVER (PARTITION BY vec_id ORDER BY i) AS p, sum(x) OVER (PARTITION BY vec_id) AS t FROM e) SELECT vec_id, round(max(p/i - (t-p)/(n-i)) + 1e-7,5) AS contrast FROM s WHERE i >= 5 AND i < n - 5 AND i > 0 GROUP BY vec_id",
    "q_ruler": f"""WITH {_E}, s AS (SELECT *, sum(CASE WHEN x >= 0.48 THEN 1 ELSE -1 END) OVER (PARTITION BY vec_id ORDER BY i) AS s, coalesce(x < lag(x) OVER (PARTITION BY vec_id ORDER BY i), false) AS d FROM e),
m AS (SELECT vec_id, max(s) AS top, min_by(i, (-s, i)) AS m, max(n) AS n FROM s GROUP BY vec_id), x AS (SELECT m.vec_id, m.top, m.m, m.n, coalesce(min(s.i) FILTER (s.i > m.m AND NOT s.d), m.n) - 1 AS e FROM m JOIN s ON s.vec_id = m.vec_id GROUP BY m.vec_id, m.top, m.m, m.n)
SELECT vec_id, (CASE WHEN top > 0 THEN m + 1 + round((e-m)*0.49) ELSE 0 END)::INT AS length FROM x""",
    "q_interp_gaps": """WITH t AS (SELECT sample, date_diff('day', DATE '1970-01-01', run_day) AS day, avg(polya_len) AS a FROM taginfo WHERE polya_len >= 0 GROUP BY ALL), k AS (SELECT sample, day, CASE WHEN day % 3 <> 0 THEN a END AS m FROM t),
w AS (SELECT *, max(CASE WHEN m IS NOT NULL THEN day END) OVER (PARTITION BY sample ORDER BY day) AS pd, min(CASE WHEN m IS NOT NULL THEN day END) OVER (PARTITION BY sample ORDER BY day DESC) AS nd FROM k),
j AS (SELECT w.*, p.m AS pm, n.m AS nm FROM w LEFT JOIN k p ON p.sample = w.sample AND p.day = w.pd LEFT JOIN k n ON n.sample = w.sample AND n.day = w.nd),
r AS (SELECT sample, m, row_number() OVER (PARTITION BY sample ORDER BY day) AS a, row_number() OVER (PARTITION BY sample ORDER BY day DESC) AS z FROM k WHERE m IS NOT NULL),
h AS (SELECT sample, median(m) FILTER (a <= 5) AS hm, median(m) FILTER (z <= 5) AS tm FROM r GROUP BY sample)
SELECT j.sample, day::INT AS day, round(CASE WHEN m IS NOT NULL THEN m WHEN pd IS NOT NULL AND nd IS NOT NULL THEN pm + (nm-pm)*(day-pd)/(nd-pd)::DOUBLE WHEN pd IS NULL THEN hm ELSE tm END,6) AS m FROM j LEFT JOIN h ON j.sample = h.sample""",
    "q_smoothed": f"WITH {_E}, s AS (SELECT vec_id, i, (coalesce(lag(x) OVER w, lead(x) OVER w) + 2*x + coalesce(lead(x) OVER w, lag(x) OVER w))/4 AS x FROM e WINDOW w AS (PARTITION BY vec_id ORDER BY i)) SELECT vec_id, i::INT AS place, round(x,6) AS x FROM s",
    "q_fair_sample": f"SELECT o_orderkey, seq FROM (SELECT o_orderkey, {dna_sql('o_orderkey', 4)} AS seq, row_number() OVER (PARTITION BY {dna_sql('o_orderkey', 4)} ORDER BY o_orderkey) AS k FROM orders) WHERE k <= 5",
}
