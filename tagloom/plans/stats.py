"""Queries of weighted statistics and gene-level analytics."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import flags as FL
from tagloom.operators import genes as G
from tagloom.operators import wstats as S
from tagloom.session import table

GRID = [float(x) for x in range(0, 260, 20)]
SAMPLES = ["ctrl_r1", "kd_r1", "liver_a"]


def _good(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "taginfo").filter(FL.passes(F.col("pflags")) & F.col("polya_len").isNotNull())


def q_length_hist(spark: SparkSession, folder: str) -> DataFrame:
    """Length histogram per sample, every length of 0..300 that is within the longest."""
    return S.dense_histogram(S.histogram(_good(spark, folder), ["sample"], "polya_len"), "sample", "polya_len", 300)


def q_length_hist_wide(spark: SparkSession, folder: str) -> DataFrame:
    long = q_length_hist(spark, folder).filter(F.col("sample").isin(SAMPLES))
    return long.groupBy("polya_len").pivot("sample", SAMPLES).agg(F.sum("n")).na.fill(0)


def _hist(spark: SparkSession, folder: str) -> DataFrame:
    t = _good(spark, folder).filter("polya_len >= 0")
    return t.groupBy("sample", "polya_len").agg(F.sum(F.coalesce("clones", F.lit(1))).alias("w"))


def q_weighted_stats(spark: SparkSession, folder: str) -> DataFrame:
    m = S.weighted_moments(_hist(spark, folder), ["sample"], "polya_len", "w", center=60.0)
    return m.select("sample", *[F.round(c, 6).alias(c) for c in ("weight", "mean", "geomean", "mode", "rmse", "mae")])


def q_weighted_quantile(spark: SparkSession, folder: str) -> DataFrame:
    return S.weighted_quantiles(_hist(spark, folder), ["sample"], "polya_len", "w", (0.1, 0.5, 0.9))


def q_accuracy_table(spark: SparkSession, folder: str) -> DataFrame:
    return S.accuracy_table(_hist(spark, folder).filter("sample LIKE 'spike%'"), "sample", "polya_len", "w")


def q_cdf(spark: SparkSession, folder: str) -> DataFrame:
    return S.cumulative_shares(_hist(spark, folder), ["sample"], "polya_len", "w").select("sample", "polya_len", F.round("share", 9).alias("share"))


def q_kde_grid(spark: SparkSession, folder: str) -> DataFrame:
    k = S.weighted_kde(_hist(spark, folder), ["sample"], "polya_len", "w", GRID, "scott")
    return k.select("sample", "x", F.round("density", 9).alias("density"))


def q_gel_lanes(spark: SparkSession, folder: str) -> DataFrame:
    g = S.gel_lanes(_hist(spark, folder), "sample", "polya_len", "w", [1.0, 4.0, 16.0, 64.0, 144.0], None, 0.3)
    return g.select("sample", "length", F.round("density", 9).alias("density"), F.round("intensity", 9).alias("intensity"))


def q_transforms(spark: SparkSession, folder: str) -> DataFrame:
    h = _hist(spark, folder)
    return h.select("sample", "polya_len", F.round(S.log2_clipped(F.col("polya_len")), 9).alias("log2_len"), F.round(S.migration(F.col("polya_len"), 1.0, 256.0), 9).alias("place"))


def q_geomean_ci(spark: SparkSession, folder: str) -> DataFrame:
    """Geometric mean with its interval."""
    g = S.geometric_mean_ci(_hist(spark, folder), ["sample"], "polya_len", "w")
    return g.select("sample", "count", *[F.round(c, 4).alias(c) for c in ("mean", "ci_lo", "ci_hi")])


def _tags(spark: SparkSession, folder: str) -> DataFrame:
    """Reads with a gene: a stand-in for associations, made from the cluster number."""
    t = table(spark, folder, "taginfo").filter("mods IS NOT NULL AND polya_len IS NOT NULL")
    return t.withColumn("gene", F.format_string("g%04d", F.pmod("cluster", F.lit(200))))


def q_ambiguity(spark: SparkSession, folder: str) -> DataFrame:
    """Genes per referring record of object_xref."""
    o = table(spark, folder, "object_xref").filter("xref_id IS NOT NULL")
    return G.ambiguity(o, ["xref_id"], "ensembl_id")


def q_refined_pick(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "taginfo").filter("mods IS NOT NULL").withColumn("other_len", F.pmod("cluster", F.lit(50)).cast("int")).withColumn("other_mods", F.when(F.pmod("cluster", F.lit(3)) == 0, "TT").otherwise(""))
    length, mods = G.refined("polya_len", "mods", "other_len", "other_mods")
    return t.groupBy(length.alias("length"), mods.alias("mods")).agg(F.count("*").alias("n"))


def q_count_cube(spark: SparkSession, folder: str) -> DataFrame:
    return G.count_cube(_tags(spark, folder), "gene", "polya_len", "mods", "pflags")


def q_gene_stats(spark: SparkSession, folder: str) -> DataFrame:
    g = G.gene_statistics(G.count_cube(_tags(spark, folder), "gene", "polya_len", "mods", "pflags"))
    rounded = lambda c: F.round(F.col(f"`{c}`"), 4 if c.startswith("polyA_mean") else 6).alias(c) if c.startswith(("polyA_mean", "average")) else F.col(f"`{c}`")
    return g.select(*[rounded(c) for c in g.columns])


def q_wide_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Three samples' counts side by side with the gene's name, most tags first."""
    t = _tags(spark, folder).filter(FL.passes(F.col("pflags")))
    long = t.groupBy("gene", "sample").agg(F.count("*").alias("tags"), F.count_if(F.col("polya_len") >= 5).alias("tails"))
    names = t.select("gene").distinct().select(F.col("gene").alias("id"), F.upper("gene").alias("gene_name"))
    out = G.merge_samples(long.filter(F.col("sample").isin(SAMPLES)), "gene", "sample", SAMPLES, ["tags", "tails"], "tags", names, "id")
    return out.drop("id")


def q_topk_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """The ten genes with most tags: a top-k report."""
    t = _tags(spark, folder).groupBy("gene").agg(F.count("*").alias("n"))
    return t.orderBy(F.col("n").desc(), "gene").limit(10)


def q_span_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Exonic length of each strand of each sequence and source."""
    g = table(spark, folder, "gtf").filter(F.lower("feature") == "exon")
    return g.groupBy("seqname", "source", "strand").agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).cast("bigint").alias("span"))


def q_min_dist_hist(spark: SparkSession, folder: str) -> DataFrame:
    """Histogram of each order's least distance of days from order to shipment."""
    o, l = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    d = F.abs(F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")))
    near = o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey").agg(F.min(d).alias("d"))
    return near.groupBy(F.floor(F.col("d") / 30).cast("bigint").alias("months")).agg(F.count("*").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for k, v in globals().items() if k.startswith("q_")}

_GOOD = "good AS (SELECT * FROM taginfo WHERE pflags & 8064 = 0 AND polya_len IS NOT NULL)"
_DENSE = f"""WITH {_GOOD}, h AS (SELECT sample, polya_len, count(*) AS n FROM good WHERE polya_len BETWEEN 0 AND 300 GROUP BY ALL),
ax AS (SELECT s.sample, t.v AS polya_len FROM (SELECT DISTINCT sample FROM h) s, range(0, (SELECT max(polya_len) FROM h)::BIGINT + 1) t(v)), d AS (SELECT ax.sample, ax.polya_len::INT AS polya_len, coalesce(n,0) AS n FROM ax LEFT JOIN h USING (sample, polya_len))
"""
_H = f"WITH {_GOOD}, h AS (SELECT sample, polya_len, sum(coalesce(clones,1))::BIGINT AS w FROM good WHERE polya_len >= 0 GROUP BY ALL)"
_QS = """, c AS (SELECT sample, polya_len AS x, w, sum(w) OVER (PARTITION BY sample ORDER BY polya_len) / sum(w) OVER (PARTITION BY sample)::DOUBLE AS r FROM h WHERE w > 0)"""
_KDE = """, s AS (SELECT sample, {x} AS x, sum(w)::DOUBLE AS w FROM h {where} GROUP BY ALL), t AS (SELECT sample, sum(w) AS t, sum(w*w) AS s2, sum(w*x)/sum(w) AS m FROM s GROUP BY sample),
v AS (SELECT s.sample, any_value(t) AS t, sqrt(sum(w*(x-m)*(x-m))/any_value(t)/(1-any_value(s2)/any_value(t)/any_value(t))) * {factor} AS h FROM s JOIN t USING (sample) GROUP BY s.sample),
k AS (SELECT s.sample, g.g AS pt, sum(s.w/v.t*exp(-0.5*((g.g-s.x)/v.h)*((g.g-s.x)/v.h))/(v.h*sqrt(2*pi()))) AS density FROM s JOIN v USING (sample), (SELECT unnest([{grid}])::DOUBLE AS g) g WHERE v.h > 0 AND NOT isnan(v.h) GROUP BY ALL)"""
_T = "t AS (SELECT *, printf('g%04d', cluster % 200) AS gene FROM taginfo WHERE mods IS NOT NULL AND polya_len IS NOT NULL)"
_CUBE = f"""{_T}, g AS (SELECT gene, polya_len AS length, mods, CASE WHEN polya_len >= 5 OR pflags & 8192 <> 0 THEN 'canonical' ELSE 'noncanonical' END AS tailtype FROM t WHERE pflags & 8064 = 0),
m AS (SELECT *, CASE c WHEN 'T' THEN 'U' ELSE c END AS modtype, least(20, length(mods) - length(rtrim(mods, c)))::INT AS modcount FROM g, (SELECT unnest(['T','G','C']) AS c)),
cube AS (SELECT gene, modtype, tailtype, length, modcount, count(*) AS n FROM m WHERE length BETWEEN 0 AND CASE tailtype WHEN 'canonical' THEN 232 ELSE 4 END GROUP BY ALL)"""
def _t95(df: int) -> float:
    """One-sided 95 % quantile of Student's t by bisection on its finite trigonometric series (whole degrees of freedom)."""

    def between(t: float) -> float:
        angle = math.atan2(t, math.sqrt(df))
        c, term = math.cos(angle), math.cos(angle) if df % 2 else 1.0
        total = 0.0
        for k in range(1 if df % 2 else 0, df - 1, 2):
            total += term
            term *= c * c * (k + 1) / (k + 2)
        return 2 / math.pi * (angle + math.sin(angle) * total) if df % 2 else math.sin(angle) * total

    lo, hi = 0.0, 10.0
    while hi - lo > 1e-14 * hi:
        lo, hi = ((lo + hi) / 2, hi) if between((lo + hi) / 2) < 0.9 else (lo, (lo + hi) / 2)
        if (lo + hi) / 2 in (lo, hi):
            break
    return lo


# few degrees of freedom from the list, then the series in 1/df
_Q = "1.6448536269514722::DOUBLE"
_T95 = (
    f"CASE WHEN n <= 1 THEN 0 WHEN n <= 60 THEN [{', '.join(repr(_t95(k)) for k in range(1, 60))}][n::BIGINT - 1] ELSE "
    f"{_Q} + (pow({_Q},3) + {_Q})/(4*(n-1)) + (5*pow({_Q},5) + 16*pow({_Q},3) + 3*{_Q})/(96*pow(n-1,2)) + (3*pow({_Q},7) + 19*pow({_Q},5) + 17*pow({_Q},3) - 15*{_Q})/(384*pow(n-1,3)) + (79*pow({_Q},9) + 776*pow({_Q},7) + 1482*pow({_Q},5) - 1920*pow({_Q},3) - 945*{_Q})/(92160*pow(n-1,4)) END"
)


def _ci_sql(source: str, key: str, length: str, n: str) -> str:
    """SQL tables ending in ci (key, n, mean, ci_lo, ci_hi): the geometric mean of lengths from 5 on."""
    return f"""lg AS (SELECT {key}, coalesce(sum({n}) FILTER ({length} >= 5), 0)::DOUBLE AS n, sum({n}*ln({length})) FILTER ({length} >= 5) AS s, sum({n}*ln({length})*ln({length})) FILTER ({length} >= 5) AS ss FROM {source} GROUP BY {key}),
lm AS (SELECT {key}, n, s/n AS m, CASE WHEN n > 1 THEN ({_T95}) * sqrt(greatest(ss/n - (s/n)*(s/n), 0)/n) ELSE 0 END AS half FROM lg), ci AS (SELECT {key}, n::BIGINT AS n, exp(m) AS mean, exp(m - half) AS ci_lo, exp(m + half) AS ci_hi FROM lm)"""


_N = "coalesce(sum(n) FILTER ({}),0)::BIGINT"


def _inside(window: tuple[int, int]) -> str:
    return f"tailtype='canonical' AND length >= {window[0]} AND length < {window[1]}"


def _average(cond: str) -> str:
    return f"round(sum(n*modcount) FILTER ({cond})/sum(n) FILTER ({cond}),6)"


ORACLE: dict[str, str] = {
    "q_length_hist": _DENSE + "SELECT * FROM d",
    "q_length_hist_wide": _DENSE + f", w AS (SELECT polya_len, {', '.join(f'coalesce(sum(n) FILTER (sample = {chr(39)}{s}{chr(39)}),0)::BIGINT AS {s}' for s in SAMPLES)} FROM d WHERE sample IN ({','.join(repr(s) for s in SAMPLES)}) GROUP BY polya_len) SELECT * FROM w",
    "q_weighted_stats": _H
    + """, a AS (SELECT sample, sum(w)::DOUBLE AS weight, sum(w*polya_len)/sum(w)::DOUBLE AS mean, exp(sum(w*ln(greatest(polya_len,1)))/sum(w)) AS geomean, sqrt(sum(w*(polya_len-60.0)*(polya_len-60.0))/sum(w)) AS rmse, sum(w*abs(polya_len-60.0))/sum(w) AS mae, max(w) AS top FROM h GROUP BY sample),
b AS (SELECT h.sample, avg(polya_len) AS mode FROM h JOIN a ON h.sample = a.sample AND h.w = a.top GROUP BY h.sample) SELECT sample, round(weight,6) AS weight, round(mean,6) AS mean, round(geomean,6) AS geomean, round(mode,6) AS mode, round(rmse,6) AS rmse, round(mae,6) AS mae FROM a JOIN b USING (sample)""",
    "q_weighted_quantile": _H + _QS + "SELECT sample, " + ", ".join(f"min(x) FILTER (r > {q}) AS q{round(q * 100):02d}" for q in (0.1, 0.5, 0.9)) + " FROM c GROUP BY sample",
    "q_accuracy_table": _H
    + _QS
    + ", q AS (SELECT sample, " + ", ".join(f"min(x) FILTER (r > {q})::DOUBLE AS q{round(q * 100):02d}" for q in (0.1, 0.25, 0.5, 0.75, 0.9))
    + """ FROM c GROUP BY sample), a AS (SELECT sample, sum(w*polya_len)/sum(w)::DOUBLE AS mean, exp(sum(w*ln(greatest(polya_len,1)))/sum(w)) AS geomean, max(w) AS top FROM h GROUP BY sample),
e AS (SELECT h.sample, sqrt(sum(w*(polya_len-mean)*(polya_len-mean))/sum(w)) AS rmse, sum(w*abs(polya_len-mean))/sum(w) AS mae, avg(polya_len) FILTER (w = top) AS mode FROM h JOIN a USING (sample) GROUP BY h.sample)
SELECT sample, q10, q25, q50, q75, q90, round(mean,2) AS mean, round(geomean,2) AS geomean, round(mode,2) AS mode, round(rmse,2) AS rmse, round(mae,2) AS mae FROM q JOIN a USING (sample) JOIN e USING (sample) WHERE starts_with(sample,'spike')""",
    "q_cdf": _H + "SELECT sample, polya_len, round(sum(w) OVER (PARTITION BY sample ORDER BY polya_len) / sum(w) OVER (PARTITION BY sample)::DOUBLE, 9) AS share FROM h",
    "q_kde_grid": _H + _KDE.format(x="polya_len::DOUBLE", where="", factor="pow(any_value(t)*any_value(t)/any_value(s2), -0.2)", grid=",".join(map(str, GRID))) + "SELECT sample, pt AS x, round(density,9) AS density FROM k",
    "q_gel_lanes": _H + _KDE.format(x="sqrt(polya_len)", where="WHERE polya_len >= 1", factor="0.3", grid="1,2,4,8,12") + "SELECT sample, pt*pt AS length, round(density,9) AS density, round(density/max(density) OVER (),9) AS intensity FROM k",
    "q_transforms": _H + "SELECT sample, polya_len, round(log2(greatest(polya_len,1)),9) AS log2_len, round((sqrt(polya_len)-1)/15,9) AS place FROM h",
    "q_geomean_ci": _H + ", " + _ci_sql("h", "sample", "polya_len", "w") + " SELECT sample, n AS count, round(mean,4) AS mean, round(ci_lo,4) AS ci_lo, round(ci_hi,4) AS ci_hi FROM ci",
    "q_ambiguity": "WITH p AS (SELECT DISTINCT xref_id, ensembl_id FROM object_xref WHERE xref_id IS NOT NULL AND ensembl_id IS NOT NULL) SELECT *, (count(*) OVER (PARTITION BY xref_id))::INT AS ambig FROM p",
    "q_refined_pick": """WITH t AS (SELECT polya_len, mods, (cluster%50)::INT AS ol, CASE WHEN cluster%3=0 THEN 'TT' ELSE '' END AS om FROM taginfo WHERE mods IS NOT NULL)
SELECT CASE WHEN om <> '' AND polya_len <= 0 THEN ol ELSE polya_len END AS length, CASE WHEN om <> '' AND polya_len <= 0 THEN om ELSE mods END AS mods, count(*) AS n FROM t GROUP BY 1, 2""",
    "q_count_cube": f"WITH {_CUBE} SELECT * FROM cube",
    "q_gene_stats": f"""WITH {_CUBE}, w AS (SELECT gene, {_N.format("modtype='U' AND tailtype='canonical' AND length>=5")} AS "polyA_tag_count", {_N.format("modtype='U' AND tailtype='canonical' AND length<5")} AS "nonpolyA_tag_count", {_N.format("modtype='U' AND tailtype='noncanonical'")} AS "noncanonical_tag_count", {_N.format("modtype='U'")} AS total_tag_count,
{", ".join(_N.format(f"modtype='U' AND {_inside(w)}") + f' AS "polyA_tag_count_{n}"' for w, n in zip(G.LENGTH_WINDOWS, G.window_names()))},
{", ".join(_average(f"modtype='{c}' AND {_inside(w)}") + f' AS "average_{c}_{n}"' for w, n in zip(G.LENGTH_WINDOWS, G.window_names()) for c in "UGC")},
{", ".join(_average(f"modtype='{c}' AND tailtype='noncanonical'") + f' AS "average_{c}_noncanonical"' for c in "UGC")} FROM cube GROUP BY gene),
l AS (SELECT gene, length, sum(n) AS n FROM cube WHERE modtype='U' AND tailtype='canonical' GROUP BY ALL), {_ci_sql("l", "gene", "length", "n")}, gm AS (SELECT gene, round(mean,4) AS "polyA_mean", round(ci_lo,4) AS "polyA_mean_ci_lo", round(ci_hi,4) AS "polyA_mean_ci_hi" FROM ci),
c AS (SELECT gene, length, sum(n) OVER (PARTITION BY gene ORDER BY length)/sum(n) OVER (PARTITION BY gene)::DOUBLE AS r FROM l), d AS (SELECT gene, min(length) FILTER (r > 0.5) AS "polyA_median" FROM c GROUP BY gene)
SELECT * FROM w LEFT JOIN gm USING (gene) LEFT JOIN d USING (gene)""",
    "q_wide_merge": f"""WITH {_T}, l AS (SELECT gene, sample, count(*) AS tags, count(*) FILTER (polya_len >= 5) AS tails FROM t WHERE pflags & 8064 = 0 AND sample IN ({",".join(repr(s) for s in SAMPLES)}) GROUP BY ALL)
SELECT gene, {", ".join(f'max({m}) FILTER (sample={chr(39)}{s}{chr(39)}) AS "{s}:{m}"' for m in ("tags", "tails") for s in SAMPLES)}, sum(tags)::BIGINT AS total_tags, upper(gene) AS gene_name FROM l GROUP BY gene""",
    "q_topk_sorted": f"WITH {_T} SELECT gene, count(*) AS n FROM t GROUP BY gene ORDER BY n DESC, gene LIMIT 10",
    "q_span_sum": "SELECT seqname, source, strand, sum(end_pos - start_pos + 1)::BIGINT AS span FROM gtf WHERE lower(feature) = 'exon' GROUP BY ALL",
    "q_min_dist_hist": "WITH n AS (SELECT o_orderkey, min(abs(date_diff('day', o_orderdate::DATE, l_shipdate::DATE))) AS d FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) SELECT d // 30 AS months, count(*) AS n FROM n GROUP BY 1",
}
