"""Queries of the training-data problems and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.flags import priority_score
from tagloom.llm import editjoin, langid, mix, quantiles, survivors, tokenize
from tagloom.session import durable, table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of tags at about the same place whose umis differ by at most two edits."""
    links = editjoin.edit_links(table(spark, folder, "tagcluster"), "tag_id", "rname", "pos", "umi_rep")
    return links.select(F.col("id_a").alias("tag_id_a"), F.col("id_b").alias("tag_id_b"))


def p2_members(spark: SparkSession, folder: str) -> DataFrame:
    """A row per tag: its class of copies and the number of tags that it is linked to; as large as the table."""
    out = editjoin.edit_degrees(table(spark, folder, "tagcluster"), "tag_id", "rname", "pos", "umi_rep")
    return out.select(F.col("id").alias("tag_id"), "class_id", "n_links")


#: Rank error of p4's percentiles, as a part of the values: per day, and per sample.
P4_ERROR = 0.002
P4_SAMPLE_ERROR = 1.5 * P4_ERROR


def _tag_rank() -> tuple[list[Column], Column]:
    """Order of the versions of a tag: priority (computed where null), latest, most copies, first row."""
    trust = F.coalesce(F.col("priority"), priority_score(F.coalesce(F.col("pflags"), F.lit(0)))).cast("int")
    return [trust, F.col("measured_at"), F.col("ndups"), -F.col("row_no")], trust


def _tag_bundles() -> list[survivors.Bundle]:
    length = lambda c: F.col(c) >= 0
    return [
        survivors.Bundle("record", ("qname",), F.lit(True)),
        survivors.Bundle("polya_len_1", ("polya_len_1", "qname"), length("polya_len_1")),
        survivors.Bundle("polya_len_2", ("polya_len_2", "qname"), length("polya_len_2")),
        survivors.Bundle("umi", ("umi", "qname"), F.col("umi").rlike("^[ACGT]+$")),
    ]


#: A row names one read: bundles from the same row must agree on its name.
TAG_DEPENDENCIES = [("row_no", "qname")]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Where each field of each group's survivor comes from: the sources of the chosen bundles."""
    order, _ = _tag_rank()
    bundles = _tag_bundles()
    best = survivors.survivors(table(spark, folder, "tagaln"), "grp", "row_no", bundles, order, functional=TAG_DEPENDENCIES, least_rows=2)
    fields = F.array(*[F.struct(F.lit(b.name).alias("field"), F.col(b.name).getField("qname").alias("qname"), F.col(b.name).isNotNull().alias("has")) for b in bundles])
    return best.select("grp", F.explode(fields).alias("f")).filter("f.has").select("grp", "f.field", "f.qname")


def p3_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """One survivor per group: both lengths from one row, and a umi seen with these lengths."""
    order, _ = _tag_rank()
    bundles = [
        survivors.Bundle("lengths", ("polya_len_1", "polya_len_2"), (F.col("polya_len_1") >= 0) & (F.col("polya_len_2") >= 0)),
        survivors.Bundle("umi", ("umi",), F.col("umi").rlike("^[ACGT]+$")),
    ]
    best = survivors.survivors(table(spark, folder, "tagaln"), "grp", "row_no", bundles, order, depends=[("lengths", "umi")])
    return best.select("grp", "n_rows", F.col("lengths.id").alias("lengths_row"), "lengths.polya_len_1", "lengths.polya_len_2", F.col("umi.id").alias("umi_row"), "umi.umi", "trust")


def _p4_days(spark: SparkSession, folder: str) -> DataFrame:
    measured = table(spark, folder, "taginfo").filter("polya_len >= 0")
    return durable(quantiles.summarize(measured, ["sample", "run_day"], "polya_len", P4_ERROR))


def p4_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Median, 90th and 99th percentile per (sample, run_day) and, combined from these, per sample.

    rank_error is the tracked bound of a percentile's rank, error_bound the promised
    one as a part of n.
    """
    days = _p4_days(spark, folder)
    samples = quantiles.combine(days, ["sample"], "run_day", P4_ERROR)
    by_day = quantiles.percentiles(days, ["sample", "run_day"]).select(F.lit("sample_day").alias("scope"), "*", F.lit(P4_ERROR).alias("error_bound"))
    by_sample = quantiles.percentiles(samples, ["sample"]).select(F.lit("sample").alias("scope"), "sample", F.lit(None).cast("date").alias("run_day"), "n", "p50", "p90", "p99", "rank_error", F.lit(P4_SAMPLE_ERROR).alias("error_bound"))
    return by_day.unionByName(by_sample)


def p4_bound_check(spark: SparkSession, folder: str) -> DataFrame:
    """For each percentile of p4_percentiles: whether its true rank keeps the tracked and the stated bound."""
    got = p4_percentiles(spark, folder)
    rows = table(spark, folder, "taginfo").filter("polya_len >= 0")
    counts = rows.groupBy("sample", "run_day", "polya_len").agg(F.count("*").alias("k"))
    both = counts.select(F.lit("sample_day").alias("scope"), "*").unionByName(counts.groupBy("sample", "polya_len").agg(F.sum("k").alias("k")).select(F.lit("sample").alias("scope"), "sample", F.lit(None).cast("date").alias("run_day"), "polya_len", "k"))
    met = both.join(got.select(F.col("scope").alias("s"), F.col("sample").alias("sa"), F.col("run_day").alias("d"), "n", "p50", "p90", "p99", "rank_error", "error_bound"), (F.col("scope") == F.col("s")) & F.col("sample").eqNullSafe(F.col("sa")) & F.col("run_day").eqNullSafe(F.col("d")))
    parts = []
    for q, p in ((0.5, "p50"), (0.9, "p90"), (0.99, "p99")):
        rank = F.ceil(F.lit(q) * F.col("n") - 1e-9)
        below, upto = F.sum(F.when(F.col("polya_len") < F.col(p), F.col("k")).otherwise(0)), F.sum(F.when(F.col("polya_len") <= F.col(p), F.col("k")).otherwise(0))
        parts.append((rank, below, upto))
    out = met.groupBy("scope", "sample", "run_day", "n", "rank_error", "error_bound").agg(F.sum("k").alias("rows"), *[F.greatest(b + 1 - F.first(r), F.first(r) - u, F.lit(0)).alias(f"e{i}") for i, (r, b, u) in enumerate(parts)])
    worst = F.greatest("e0", "e1", "e2")
    return out.select("scope", "sample", "run_day", "n", ((F.col("rows") == F.col("n")) & (worst <= F.col("rank_error")) & (F.col("rank_error") <= F.ceil(F.col("error_bound") * F.col("n")))).alias("within"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document's text."""
    return tokenize.encode_corpus(table(spark, folder, "documents"))


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document; kept in the shared folder, as it is read several times."""
    return durable(tokenize.count_tokens(table(spark, folder, "documents"), ["doc_id", "source"]))


def p8_selection(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    return mix.mix_sources(_counts(spark, folder), table(spark, folder, "mix_targets"))


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual shares of the mix, shortfalls included."""
    counts, targets = _counts(spark, folder), table(spark, folder, "mix_targets")
    return mix.mix_shares(mix.mix_sources(counts, targets), counts, targets)


def p8_check(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix promises, per source: repeats kept, and the target met or all used up."""
    counts, targets = _counts(spark, folder), table(spark, folder, "mix_targets")
    out = mix.mix_shares(mix.mix_sources(counts, targets), counts, targets)
    full = F.col("actual_tokens") == F.col("have_tokens") * F.col("max_repeats")
    short = F.col("have_tokens") * F.col("max_repeats") < F.col("target_share") * out.select(F.sum("target_tokens").alias("t")).first()["t"]
    return out.select("source", "max_repeats", (F.col("most_copies") <= F.col("max_repeats")).alias("repeats_kept"), F.when(short, full).otherwise(F.col("within_a_document")).alias("target_kept"))


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    codes = langid.label_codes(table(spark, folder, "languages"))
    counts = langid.label_counts(documents, codes)
    return langid.judge_documents(documents, langid.train(langid.sample_texts(documents, codes, counts=counts), counts), codes)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Texts whose label is missing or wrong, and passages in another language than their text."""
    return langid.wrong_labels(_judged(spark, folder))


def p9_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Language and confidence of each text (para_no 0) and each of its prose passages."""
    return _judged(spark, folder).select("doc_id", "para_no", "lang", "confidence")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_members": p2_members,
    "p3_found": p3_found,
    "p3_survivors": p3_survivors,
    "p4_percentiles": p4_percentiles,
    "p4_bound_check": p4_bound_check,
    "p7_ids": p7_ids,
    "p8_selection": p8_selection,
    "p8_shares": p8_shares,
    "p8_check": p8_check,
    "p9_found": p9_found,
    "p9_languages": p9_languages,
}

_SCORE = "1024*(pflags&16=0)::INT + 512*(pflags&128=0)::INT + 256*(pflags&2=0)::INT + 128*(pflags&8<>0)::INT + 64*(pflags&2048=0)::INT + 32*(pflags&512=0)::INT + 16*(pflags&1024=0)::INT + 8*(pflags&64=0)::INT + 4*(pflags&32=0)::INT + 2*(pflags&1<>0)::INT"
_FIRST = """
SELECT grp, '{field}' AS field, qname FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY pri DESC, measured_at DESC NULLS LAST, ndups DESC, row_no) AS k
  FROM ranked WHERE n > 1 AND {valid}) WHERE k = 1"""

# all pairs of neighbouring places, compared in full
_P2 = r"""
WITH r AS (SELECT tag_id, rname, pos, regexp_replace(umi_rep, '^[^A-Za-z]+|[^A-Za-z]+$', '', 'g') AS core FROM tagcluster WHERE tag_id IS NOT NULL AND rname IS NOT NULL AND pos IS NOT NULL AND regexp_matches(umi_rep, '[A-Za-z]')),
f AS (SELECT tag_id, rname, pos, upper(regexp_replace(core, '[^A-Za-z]', '', 'g')) AS s0, CASE WHEN regexp_matches(core, '[^A-Za-z]') THEN upper(regexp_replace(regexp_extract(core, '^[A-Za-z]+[^A-Za-z]+(.*)$', 1), '[^A-Za-z]', '', 'g') || regexp_extract(core, '^([A-Za-z]+)', 1)) END AS s1 FROM r),
n AS (SELECT a.tag_id AS tag_id_a, b.tag_id AS tag_id_b, a.s0 AS a0, a.s1 AS a1, b.s0 AS b0, b.s1 AS b1 FROM (SELECT *, unnest([pos // 5 - 1, pos // 5, pos // 5 + 1]) AS k FROM f) a JOIN (SELECT *, pos // 5 AS k FROM f) b
  ON a.rname = b.rname AND a.k = b.k AND abs(a.pos - b.pos) <= 4 AND a.tag_id < b.tag_id),
p AS (SELECT tag_id_a, tag_id_b FROM n WHERE levenshtein(a0, b0) <= 2 OR levenshtein(a1, b0) <= 2 OR levenshtein(a0, b1) <= 2)
"""

ORACLE: dict[str, str] = {
    "p2_found": _P2 + "SELECT * FROM p",
    "p2_members": _P2
    + """, d AS (SELECT tag_id_a AS tag_id FROM p UNION ALL SELECT tag_id_b FROM p), m AS (SELECT tag_id, count(*) AS n FROM d GROUP BY 1)
SELECT f.tag_id, min(f.tag_id) OVER (PARTITION BY rname, pos, s0, s1) AS class_id, coalesce(n, 0) AS n_links FROM f LEFT JOIN m USING (tag_id)""",
    "p3_found": f"WITH ranked AS (SELECT *, coalesce(priority, {_SCORE}) AS pri, count(*) OVER (PARTITION BY grp) AS n FROM tagaln)"
    + " UNION ALL ".join(_FIRST.format(field=f, valid=v) for f, v in (("record", "true"), ("polya_len_1", "polya_len_1 >= 0"), ("polya_len_2", "polya_len_2 >= 0"), ("umi", "regexp_full_match(umi, '[ACGT]+')"))),
    # the joint optimum by plain enumeration of what occurred together, and of either bundle alone
    "p3_survivors": f"""WITH ranked AS (SELECT *, coalesce(priority, {_SCORE.replace('pflags', 'coalesce(pflags,0)')}) AS pri, polya_len_1 >= 0 AND polya_len_2 >= 0 AS has_l, regexp_full_match(umi, '[ACGT]+') AS has_u FROM tagaln WHERE grp IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY pri DESC NULLS LAST, measured_at DESC NULLS LAST, ndups DESC NULLS LAST, row_no) AS k FROM ranked),
l AS (SELECT grp, polya_len_1 AS l1, polya_len_2 AS l2, min(k) AS kl, max(coalesce(pri,0)) AS wl, arg_min(row_no, k) AS lengths_row FROM r WHERE has_l GROUP BY ALL),
u AS (SELECT grp, umi, min(k) AS ku, max(coalesce(pri,0)) AS wu, arg_min(row_no, k) AS umi_row FROM r WHERE has_u GROUP BY ALL),
p AS (SELECT DISTINCT grp, polya_len_1 AS l1, polya_len_2 AS l2, umi FROM r WHERE has_l AND has_u),
c AS (SELECT l.grp, kl, ku, wl + wu AS trust, lengths_row, l1, l2, umi_row, umi FROM p JOIN l USING (grp, l1, l2) JOIN u USING (grp, umi)
  UNION ALL SELECT grp, kl, NULL, wl, lengths_row, l1, l2, NULL, NULL FROM l UNION ALL SELECT grp, NULL, ku, wu, NULL, NULL, NULL, umi_row, umi FROM u UNION ALL SELECT DISTINCT grp, NULL::BIGINT, NULL::BIGINT, 0, NULL, NULL, NULL, NULL, NULL FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY trust DESC, kl NULLS LAST, ku NULLS LAST) AS i FROM c),
n AS (SELECT grp, count(*) AS n_rows FROM r GROUP BY grp)
SELECT grp, n_rows, lengths_row, l1 AS polya_len_1, l2 AS polya_len_2, umi_row, umi, trust::DOUBLE AS trust FROM b JOIN n USING (grp) WHERE i = 1""",
    "p8_check": "SELECT source, max_repeats, true AS repeats_kept, true AS target_kept FROM mix_targets",
    "p4_bound_check": """SELECT 'sample_day' AS scope, sample, run_day, count(*) AS n, true AS within FROM taginfo WHERE polya_len >= 0 GROUP BY ALL
UNION ALL SELECT 'sample', sample, NULL, count(*), true FROM taginfo WHERE polya_len >= 0 GROUP BY ALL""",
}
