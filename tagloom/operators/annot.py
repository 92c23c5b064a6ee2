"""Annotation: id resolution, cross references, transcripts, annotation formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.operators.packed import packed_entries
from tagloom.session import durable


def resolve_transitively(changes: DataFrame, old: str, new: str) -> DataFrame:
    """(old, final): every final id that an id's chain of changes ends in.

    A final id is one that isn't changed any more. Steps are doubled every round: a pair
    (start, now) is as many changes long as the pairs it is joined with, until it ends
    in a final id. So a chain of n changes takes log2(n) rounds, and an id that changes into
    one other is one row all the while. A round that ends no further pair ends the
    search, exactly: were there a longer chain, its last part would have ended in that
    round. Ids that only go round in a circle have no final id and no row. Null ids and
    ids changed into themselves are no changes. Lineage is cut in the shared folder
    every round.
    """
    edges = changes.select(F.col(f"`{old}`").alias("a"), F.col(f"`{new}`").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct()
    going = edges.select(F.col("a").alias("e")).distinct().withColumn("__on", F.lit(True))
    state = durable(edges.join(going, F.col("b") == F.col("e"), "left").select(F.col("a").alias("start"), F.col("b").alias("now"), F.col("__on").isNull().alias("done")))
    ended = state.filter("done").count()
    while True:
        far = state.select(F.col("start").alias("mid"), F.col("now").alias("next"), F.col("done").alias("end"))
        step = state.filter("NOT done").join(far, F.col("now") == F.col("mid")).select("start", F.col("next").alias("now"), F.col("end").alias("done"))
        state = durable(state.filter("done").unionByName(step).distinct())
        before, ended = ended, state.filter("done").count()
        if ended == before:
            return state.filter("done").select(F.col("start").alias(old), F.col("now").alias(new))


def object_chain(genes: DataFrame, transcripts: DataFrame, translations: DataFrame) -> DataFrame:
    """Names of genes beside those of their transcripts and of these' translations: (gene,
    transcript, translation). Tables as in a database dump (gene_id, transcript_id, stable_id …);
    transcripts without a gene or a translation are left out."""
    g = genes.select("gene_id", F.col("stable_id").alias("gene"))
    t = transcripts.select("gene_id", "transcript_id", F.col("stable_id").alias("transcript"))
    p = translations.select("transcript_id", F.col("stable_id").alias("translation"))
    return g.join(t, "gene_id").join(p, "transcript_id").select("gene", "transcript", "translation")


def xref_chain(databases: DataFrame, xrefs: DataFrame, objects: DataFrame, identities: DataFrame, ontologies: DataFrame) -> DataFrame:
    """External references with their database and their object, of either kind of detail.

    An object reference has a row for each of its identities and each of its ontology
    terms: (object_xref_id, ensembl_id, ensembl_object_type, xref_id, dbprimary_acc,
    display_label, db_name, xref_identity, ensembl_identity, linkage_type), the columns of
    the other kind null. References without either detail are left out.
    """
    x = databases.select("external_db_id", "db_name").join(xrefs.select("xref_id", "external_db_id", "dbprimary_acc", "display_label"), "external_db_id")
    o = x.join(objects.select("object_xref_id", "ensembl_id", "ensembl_object_type", "xref_id"), "xref_id")
    i = identities.select("object_xref_id", "xref_identity", "ensembl_identity", F.lit(None).cast("string").alias("linkage_type"))
    t = ontologies.select("object_xref_id", F.lit(None).cast("int").alias("xref_identity"), F.lit(None).cast("int").alias("ensembl_identity"), "linkage_type")
    return o.join(i.unionByName(t), "object_xref_id").drop("external_db_id")


def dispatch_xrefs(refs: DataFrame, kind: str, targets: Mapping[str, tuple[DataFrame, str]], ref: str, strict: bool = True) -> DataFrame:
    """References joined to the table that their type names; union over the types.

    ``targets`` maps a type to (table, key column); the tables have the same columns. With
    ``strict`` an unknown type raises when the result is computed; else it is left out.
    """
    parts = [refs.filter(F.col(kind) == name).join(table, refs[ref] == table[key]).drop(table[key]) if ref == key else refs.filter(F.col(kind) == name).join(table, F.col(ref) == F.col(key)) for name, (table, key) in targets.items()]
    out = reduce(DataFrame.unionByName, parts)
    if not strict:
        return out
    unknown = refs.filter(~F.col(kind).isin(*targets) | F.col(kind).isNull())
    failing = unknown.select(F.assert_true(F.lit(False), F.concat(F.lit("unknown type of reference: "), F.coalesce(F.col(kind), F.lit("null")))).alias("x"))
    return _guarded(out, failing)


def _guarded(out: DataFrame, failing: DataFrame) -> DataFrame:
    """``out``, and an error if ``failing`` has a row: the rows of failing raise as they are computed."""
    nothing = failing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema.fields], F.col("x")).filter("x IS NOT NULL").drop("x")
    return out.unionByName(nothing)


def pick_first(df: DataFrame, key: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """One row per key, the first by an explicit order: a partial minimum."""
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    out = df.groupBy(*key).agg(F.min_by(F.struct(*columns), rank).alias("__r"))
    return out.select(*key, *[F.col(f"__r.{c}").alias(c) for c in columns])


def ordered_concat(df: DataFrame, key: Sequence[str], order: str, text: str, name: str = "text") -> DataFrame:
    """Texts of a key joined in order (ties by text). A key's rows form one value by definition."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(*key).agg(F.array_join(F.transform(parts, lambda p: p["t"]), "").alias(name))


def wrapped(seq: Column, width: int = 72) -> Column:
    """Text in lines of a width."""
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")


def recased(seq: Column, utr5: Column, utr3: Column) -> Column:
    """Untranslated ends in upper, the rest in lower case; the length stays."""
    n = F.length(seq)
    head, tail = F.least(utr5, n), F.least(utr3, n - F.least(utr5, n))
    return F.concat(F.upper(F.substring(seq, F.lit(1), head)), F.lower(F.substring(seq, head + 1, n - head - tail)), F.upper(F.substring(seq, n - tail + 1, tail)))


def utr_class(cds: DataFrame, utr: DataFrame, transcript: str, start: str, end: str, strand: str) -> DataFrame:
    """UTRs as five_prime_utr or three_prime_utr by where they lie beside their transcript's CDS.

    UTRs that overlap the CDS, or of transcripts without one, have a null class.
    """
    span = cds.groupBy(transcript).agg(F.min(start).alias("__lo"), F.max(end).alias("__hi"))
    met = utr.join(span, transcript, "left")
    before, after = F.col(end) < F.col("__lo"), F.col(start) > F.col("__hi")
    plus = F.col(strand) != "-"
    kind = F.when(before, F.when(plus, "five_prime_utr").otherwise("three_prime_utr")).when(after, F.when(plus, "three_prime_utr").otherwise("five_prime_utr"))
    return met.withColumn("utr", kind).drop("__lo", "__hi")


def coalesce_exons(parts: DataFrame, transcript: str, start: str, end: str) -> DataFrame:
    """CDS and UTR parts of a transcript (1-based, inclusive) that follow each other directly, as exons."""
    w = W.partitionBy(transcript).orderBy(start, end)
    new = F.coalesce((F.col(start) > F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1)) + 1).cast("int"), F.lit(0))
    parts = parts.select(transcript, start, end).distinct()  # equal parts would have no order
    marked = parts.withColumn("__n", new).withColumn("__i", F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, 0)))
    out = marked.groupBy(transcript, "__i").agg(F.min(start).alias(start), F.max(end).alias(end))
    return out.withColumn("exon_number", (F.col("__i") + 1).cast("int")).drop("__i")


def exonic_length(exons: DataFrame, transcript: str, start: str, end: str) -> DataFrame:
    """Sum of end - start + 1 per transcript."""
    return exons.groupBy(transcript).agg(F.sum(F.col(end) - F.col(start) + 1).cast("bigint").alias("length"))


def with_description(genes: DataFrame, descriptions: DataFrame, gene_id: str, version: str, key: str) -> DataFrame:
    """Descriptions joined by id, or by id.version where the id alone isn't known."""
    d = descriptions.select(F.col(key).alias("__d"), "description")
    whole = F.when(F.col(version).isNotNull(), F.concat_ws(".", gene_id, F.col(version).cast("string"))).otherwise(F.col(gene_id))
    first = genes.join(d, F.col(gene_id) == F.col("__d"), "left").withColumnRenamed("description", "__one").drop("__d")
    return first.withColumn("__w", F.when(F.col("__one").isNull(), whole)).join(d, F.col("__w") == F.col("__d"), "left").withColumn("description", F.coalesce("__one", "description")).drop("__one", "__w", "__d")


def gff_attributes(text: Column, fold: bool = False) -> Column:
    """key=value;… as a map; a key that occurs again keeps its last value.

    ``fold`` puts the keys in lower case. Delimiters in quotes are part of the value, which comes out without the quotes. Of a
    line of both styles, entries of the form name value are in the map, too.
    """

    def as_map(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["name"]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["name"] == k), -1)["value"]))

    # bound once through a one-element array, as in packed_entries
    once = F.get(F.transform(F.array(packed_entries(text, ";", fold=fold)), as_map), F.lit(0))
    return F.when(text.isNotNull(), once)


def gtf_attributes(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Attribute field name "value"; … of the pairs that aren't null."""
    return F.concat_ws(" ", *[F.when(v.isNotNull(), F.concat(F.lit(f'{k} "'), v.cast("string"), F.lit('";'))) for k, v in pairs])


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest type that holds all values of text columns: int, bigint, double or string.

    One aggregation over all columns with a result of one row.
    """
    fits = lambda c, t: F.min((F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast(t).isNotNull()).cast("int"))
    ok = [fits(c, t).alias(f"c{i}_{t}") for i, c in enumerate(columns) for t in ("int", "bigint", "double")]
    row = df.agg(*ok).first()
    return {c: next((t for t in ("int", "bigint", "double") if row[f"c{i}_{t}"] == 1), "string") for i, c in enumerate(columns)}


def principal_transcripts(transcripts: DataFrame, labels: DataFrame, key: str, gene: str, length: str) -> DataFrame:
    """Each gene's principal transcript: best label first, then the longest, then by id.

    Keys are compared without versions; transcripts without a label come last.
    """
    bare = F.split_part(F.col(key), F.lit("."), F.lit(1))
    l = labels.select(F.split_part(F.col("transcript"), F.lit("."), F.lit(1)).alias("__b"), "label")
    met = transcripts.join(l, bare == F.col("__b"), "left").drop("__b")
    return pick_first(met, [gene], [F.coalesce("label", F.lit("~")), -F.col(length), F.col(key)], [key, "label", length])


def adopt_gff3(lines: DataFrame) -> DataFrame:
    """GFF3 lines (attribute: key=value;…) as GTF rows: gene, transcript and exon lines.

    Transcripts (mRNA) take their gene's id and name by Parent; the CDS and UTR parts of a
    transcript that follow each other directly are one exon. Parts of unknown transcripts
    are left out.
    """
    a = gff_attributes(F.col("attribute"))
    rows = lines.withColumn("__a", a)
    at = lambda k: F.col("__a")[k]
    fixed = ["seqname", "source", "start", "end", "strand"]
    genes = rows.filter("feature = 'gene'").select(*fixed, at("ID").alias("gene_id"), F.coalesce(at("Name"), at("ID")).alias("gene_name"))
    names = genes.select("gene_id", "gene_name")
    trs = rows.filter("feature = 'mRNA'").select(*fixed, at("ID").alias("transcript_id"), at("Parent").alias("gene_id")).join(names, "gene_id", "left")
    parts = rows.filter("feature IN ('CDS', 'five_prime_UTR', 'three_prime_UTR')").select(F.explode(F.split(at("Parent"), ",")).alias("transcript_id"), "start", "end")
    known = trs.select("transcript_id", "gene_id", "gene_name", "seqname", "source", "strand")
    exons = coalesce_exons(parts, "transcript_id", "start", "end").join(known, "transcript_id")
    c = F.col

    def line(df: DataFrame, feature: str, pairs: Sequence[tuple[str, Column]]) -> DataFrame:
        return df.select("seqname", "source", F.lit(feature).alias("feature"), "start", "end", "strand", gtf_attributes(pairs).alias("attribute"))

    g, n, t = ("gene_id", c("gene_id")), ("gene_name", c("gene_name")), ("transcript_id", c("transcript_id"))
    return line(genes, "gene", [g, n]).unionByName(line(trs, "transcript", [g, t, n])).unionByName(line(exons, "exon", [g, t, ("exon_number", c("exon_number")), n]))
