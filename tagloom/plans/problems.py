"""Queries of the general data-shaping problems (p1, p5, p6) over the domain tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import orphans, packed, wide
from tagloom.session import spread, table

#: Fixed values of the gtf tables: list-valued names, whole-number names, entity ids.
LIST_NAMES = ("tag", "ont", "ccdsid")
NUMBER_NAMES = ("level", "exon_number", "gene_version", "transcript_version", "transcript_support_level")
ENTITY_ID = {"gene": "gene_id", "transcript": "transcript_id", "exon": "exon_id", "cds": "protein_id"}
TEXT_NAMES = ("gene_id", "transcript_id", "exon_id", "protein_id", "gene_name", "gene_type", "gene_biotype", "transcript_name", "note")
WIDE_COLUMNS = {n: "string" for n in TEXT_NAMES} | {n: "bigint" for n in NUMBER_NAMES}


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of gtf.attribute with its line and position."""
    return packed.explode_packed(spread(table(spark, folder, "gtf").select("line_no", "attribute")), "attribute", ["line_no"], LIST_NAMES)


def gtf_wide(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (feature, entity) of gtf with typed attribute columns."""
    gtf = spread(table(spark, folder, "gtf").select("line_no", F.lower("feature").alias("feature"), "loaded_at", "attribute").filter(F.col("feature").isin(*ENTITY_ID)))
    cells = F.filter(packed.packed_entries(F.col("attribute")), lambda e: ~e["name"].isin(*LIST_NAMES))
    id_name = F.element_at(F.create_map(*[F.lit(x) for kv in ENTITY_ID.items() for x in kv]), F.col("feature"))
    # a generator of one row keeps the optimizer from writing the parse into each of its uses
    lines = gtf.select("line_no", "feature", "loaded_at", id_name.alias("id_name"), F.explode(F.array(cells)).alias("cells"))
    own = F.try_element_at(F.filter("cells", lambda e: (e["name"] == F.col("id_name")) & wide.has_value(e["value"])), F.lit(-1))["value"]
    long = lines.withColumn("entity_id", own).filter("entity_id IS NOT NULL").select("feature", "entity_id", "line_no", "loaded_at", F.posexplode("cells").alias("pos", "c"))
    pairs = long.select("feature", "entity_id", "line_no", "loaded_at", F.col("c.name").alias("attr_name"), F.col("c.value").alias("attr_value"), "pos")
    return wide.widen(pairs, ["feature", "entity_id"], "attr_name", "attr_value", WIDE_COLUMNS, [F.col("loaded_at"), F.col("line_no"), F.col("pos")])


def p1_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The wide table itself; maps as sorted text so that any engine can compare them."""
    out = gtf_wide(spark, folder)
    shown = lambda c: F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "; ")
    return out.withColumn("other", shown("other")).withColumn("cast_failures", shown("cast_failures"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every filled cell of the wide tables."""
    return wide.unpivot_wide(gtf_wide(spark, folder), ["feature", "entity_id"], WIDE_COLUMNS)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Bad references of object_xref and identity_xref, one row each."""
    xref, obj, ident, ens = (table(spark, folder, t) for t in ("xref", "object_xref", "identity_xref", "ensembl_object"))
    clean = lambda c: F.lower(F.trim(F.col(c)))
    parents = [
        (xref, F.col("xref_id"), F.lit("xref")),
        (obj, F.col("object_xref_id"), F.lit("object_xref")),
        (ens, F.col("ensembl_id"), F.concat(F.lit("ensembl:"), clean("ensembl_object_type"))),
    ]
    states = orphans.parent_states([(df, key, kind, F.col("loaded_at"), F.col("deleted_at")) for df, key, kind in parents])
    # one pass over each referring table: its references side by side, then exploded
    ref = lambda table_, field, kind, value: F.struct(F.lit(table_).alias("src_table"), F.lit(field).alias("ref_field"), kind.alias("target"), value.alias("ref"))
    two = F.array(
        ref("object_xref", "xref_id", F.lit("xref"), F.col("xref_id")),
        ref("object_xref", "ensembl_id", F.concat(F.lit("ensembl:"), clean("ensembl_object_type")), F.col("ensembl_id")),
    )
    refs = obj.select("row_no", "loaded_at", F.explode(two).alias("r")).unionByName(
        ident.select("row_no", "loaded_at", ref("identity_xref", "object_xref_id", F.lit("object_xref"), F.col("object_xref_id")).alias("r"))
    )
    return orphans.orphan_references(
        refs, F.col("r.ref"), F.col("r.target"), F.col("loaded_at"), states, [F.col("r.src_table").alias("src_table"), F.col("r.ref_field").alias("ref_field"), F.col("row_no")]
    ).select("src_table", "ref_field", "row_no", "period", "kind")


def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    """Bad references per table, field, month and kind."""
    return p6_found(spark, folder).groupBy("src_table", "ref_field", "period", "kind").agg(F.count("*").alias("n_refs"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_wide": p1_wide,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_report": p6_report,
}

_P6 = r"""
WITH num AS (SELECT row_no, src_table, ref_field, target, loaded_at, trim(ref) AS ref FROM (
    SELECT row_no, 'object_xref' AS src_table, 'xref_id' AS ref_field, 'xref' AS target, loaded_at, xref_id AS ref FROM object_xref
    UNION ALL SELECT row_no, 'object_xref', 'ensembl_id', 'ensembl:' || lower(trim(ensembl_object_type)), loaded_at, ensembl_id FROM object_xref
    UNION ALL SELECT row_no, 'identity_xref', 'object_xref_id', 'object_xref', loaded_at, object_xref_id FROM identity_xref)
  WHERE trim(ref) NOT IN ('', '\N')),
parents AS (
    SELECT 'xref' AS target, xref_id AS k, loaded_at, deleted_at FROM xref
    UNION ALL SELECT 'object_xref', object_xref_id, loaded_at, deleted_at FROM object_xref
    UNION ALL SELECT 'ensembl:' || lower(trim(ensembl_object_type)), ensembl_id, loaded_at, deleted_at FROM ensembl_object),
keys AS (SELECT target, k, count(*) = count(deleted_at) AS gone, min(loaded_at) AS first_loaded FROM parents GROUP BY ALL),
found AS (SELECT src_table, ref_field, row_no, strftime(num.loaded_at, '%Y-%m') AS period,
    CASE WHEN k IS NULL THEN 'missing' WHEN gone THEN 'deleted' WHEN first_loaded > num.loaded_at THEN 'late' END AS kind
  FROM num LEFT JOIN keys ON num.target = keys.target AND TRY_CAST(regexp_extract(ref, '^(\d+)(\.0*)?$', 1) AS BIGINT) = k)
"""

# entries are matched whole here, instead of lifting quoted spans out first
_ENTRY = r"""[^\s=;|]+(?:\s*=\s*|\s+)?(?:"(?:[^"\\]|\\.|"")*"|''(?:[^''\\]|\\.|'''')*''|[^;|]*)"""
_ENTRIES = r"""
WITH l AS (SELECT line_no, lower(feature) AS feature, loaded_at, regexp_extract_all(attribute, 'ENTRY') AS es FROM gtf WHERE attribute IS NOT NULL),
e AS (SELECT line_no, feature, loaded_at, i, es[i] AS e FROM l, range(1, len(es) + 1) t(i)),
r AS (SELECT *, lower(regexp_extract(e, '^([^\s=]+)', 1)) AS name, regexp_replace(regexp_extract(e, '^[^\s=]+(?:\s*=\s*|\s+)?(.*)$', 1), '\s+$', '') AS raw FROM e),
q AS (SELECT *, CASE WHEN length(raw) > 1 AND raw[1] IN ('"', '''') AND raw[1] = raw[-1] THEN raw[1] END AS quote FROM r),
n AS (SELECT line_no, feature, loaded_at, i, name, CASE WHEN quote IS NULL THEN raw ELSE
  regexp_replace(replace(regexp_replace(substr(raw, 2, length(raw) - 2), '\\(["''])', '\1', 'g'), quote || quote, quote), '^\s+|\s+$', '', 'g') END AS value FROM q WHERE name <> '')
"""


def entries_sql(delimiters: str = ";|") -> str:
    """SQL text of the entries of gtf.attribute, ending in the table n (line_no, feature, loaded_at, i, name, value)."""
    return _ENTRIES.replace("ENTRY", _ENTRY.replace(";|", delimiters))


_P5 = entries_sql()
_LISTS = ", ".join(f"'{n}'" for n in LIST_NAMES)
_NUMBERS = ", ".join(f"'{n}'" for n in NUMBER_NAMES)
_ID = "CASE feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ENTITY_ID.items()) + " END"

_P1 = (
    _P5
    + rf""", c AS (SELECT line_no, feature, loaded_at, i, name, CASE WHEN name IN ({_NUMBERS}) THEN nullif(regexp_extract(value, '^0*(\d+)', 1), '')
  WHEN regexp_matches(value, '[A-Za-z0-9]') AND lower(value) NOT IN ('na', 'n/a', 'null') THEN value END AS v, value FROM n WHERE name NOT IN ({_LISTS}) AND {_ID} IS NOT NULL),
o AS (SELECT line_no, max_by(v, i) AS entity_id FROM c WHERE v IS NOT NULL AND name = {_ID} GROUP BY line_no),
k AS (SELECT feature, entity_id, name, v, row_number() OVER (PARTITION BY feature, entity_id, name ORDER BY loaded_at DESC NULLS LAST, line_no DESC, i DESC) AS k FROM c JOIN o USING (line_no) WHERE v IS NOT NULL)
"""
)

ORACLE: dict[str, str] = {
    "p1_found": _P1 + "SELECT feature, entity_id, name AS attr_name, v AS attr_value FROM k WHERE k = 1",
    "p1_wide": _P1
    + rf""", w AS (SELECT * FROM k WHERE k = 1), f AS (SELECT feature, entity_id, name, value, row_number() OVER (PARTITION BY feature, entity_id, name ORDER BY loaded_at DESC NULLS LAST, line_no DESC, i DESC) AS k
  FROM c JOIN o USING (line_no) WHERE name IN ({_NUMBERS}) AND v IS NULL AND regexp_matches(value, '[A-Za-z0-9]') AND lower(value) NOT IN ('na', 'n/a', 'null')),
x AS (SELECT feature, entity_id, string_agg(name || '=' || value, '; ' ORDER BY name || '=' || value) AS cast_failures FROM f WHERE k = 1 GROUP BY ALL)
SELECT w.feature, w.entity_id, {", ".join(f"max(v) FILTER (name = '{n}'){'::BIGINT' if t != 'string' else ''} AS {n}" for n, t in WIDE_COLUMNS.items())},
  coalesce(string_agg(name || '=' || v, '; ' ORDER BY name || '=' || v) FILTER (name NOT IN ({", ".join(f"'{n}'" for n in WIDE_COLUMNS)})), '') AS other, coalesce(any_value(cast_failures), '') AS cast_failures
FROM w LEFT JOIN x ON x.feature = w.feature AND x.entity_id = w.entity_id GROUP BY w.feature, w.entity_id""",
    "p5_found": _P5
    + rf""", m AS (SELECT line_no, i, name, value, CASE WHEN name IN ({_LISTS}) THEN regexp_extract_all(value, '[A-Za-z0-9_:.\-]+') ELSE [] END AS ms FROM n),
x AS (SELECT line_no, i, name, CASE WHEN len(ms) > 0 THEN ms ELSE [value] END AS vs FROM m), y AS (SELECT line_no, i, j, name, vs[j] AS v FROM x, range(1, len(vs) + 1) t(j))
SELECT line_no, (row_number() OVER (PARTITION BY line_no ORDER BY i, j))::INT AS pos, name AS attr_name, v AS attr_value FROM y""",
    "p6_found": _P6 + "SELECT * FROM found WHERE kind IS NOT NULL",
    "p6_report": _P6 + "SELECT src_table, ref_field, period, kind, count(*) AS n_refs FROM found WHERE kind IS NOT NULL GROUP BY ALL",
}
