"""Queries that must do their whole job: small tables against brute force, the given ones against uncut SQL."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tagloom.operators import annot
from tagloom.plans import annotation as PA
from tagloom.plans import formats as PF
from tagloom.plans import reads as PR
from tagloom.plans import signals as PS


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_levenshtein_pairs_with_edits_at_the_start(spark, tmp_path):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("ACGT") for _ in range(12)) for _ in range(4)]
    umis = [*base, *("T" + u[1:] for u in base), *(u[1:] for u in base), *("GG" + u for u in base), *(u[:-1] for u in base), "", "", base[0]]
    rows = [(i, rnd.choice(["c1", "c2"]), rnd.randint(1, 2), u) for i, u in enumerate(umis)] + [(90, None, 1, base[0]), (91, "c1", None, base[0]), (92, "c1", 1, None)]
    spark.createDataFrame(rows, "tag_id long, rname string, pos int, umi_rep string").write.parquet(f"{tmp_path}/tagcluster.parquet")
    got = {(r["id_a"], r["id_b"]): r["d"] for r in PR.q_levenshtein_pairs(spark, str(tmp_path)).collect()}
    known = [r for r in rows if None not in r]
    want = {(a[0], b[0]): d if (d := edits(a[3], b[3])) <= 2 else -1 for a in known for b in known if a[1:3] == b[1:3] and a[0] < b[0]}
    assert got == want
    assert any(d >= 0 and umis[a][:3] != umis[b][:3] for (a, b), d in want.items())


def test_transitive_ids_of_large_ids(spark, tmp_path):
    keys = [*range(40), *range(1990, 2010), *range(3000, 3005), 6000, 6002, 12000, 24000, 250_000]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    edges = {k: 2 * k for k in keys if k > 0 and k % 7 != 3}

    def last(k: int) -> int:
        return last(edges[k]) if k in edges else k

    assert {tuple(r) for r in PA.q_transitive_ids(spark, str(tmp_path)).collect()} == {(k, last(k)) for k in edges}


def test_fetched_sequences_of_all_parts(spark, tmp_path):
    n = 1700
    spark.range(n).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    letters = str.maketrans("0123456789abcdef", "ACGT" * 4)
    genome = "".join(hashlib.md5(str(k).encode()).hexdigest()[:16].translate(letters) for k in range(n))
    want = {k: genome[max(k - 5, 0) : k + 30] for k in range(n)}
    want |= {k: s[::-1].translate(str.maketrans("ACGT", "TGCA")) for k, s in want.items() if k % 2}
    assert {r["name"]: r["seq"] for r in PF.q_fetch_sequences(spark, str(tmp_path)).collect()} == want


def test_merged_groups_of_all_nations(spark, tmp_path):
    nations, suppliers = [(0, "a"), (3, "b"), (7, "c"), (24, "d")], [(5, 7), (4, 7), (11, 3), (9, 30)]
    customers = [(i, k) for i, k in enumerate([0, 0, 3, 7, 7, 7, 24, 31, 31])]
    for name, rows, schema in (("nation", nations, "n_nationkey long, n_name string"), ("supplier", suppliers, "s_suppkey long, s_nationkey long"), ("customer", customers, "c_custkey long, c_nationkey long")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {tuple(r) for r in PA.q_merge_groups(spark, str(tmp_path)).collect()}
    assert got == {(0, 1, "", 2), (3, 1, "11", 1), (7, 1, "4,5", 3), (24, 1, "", 1), (30, 0, "9", 0), (31, 0, "", 2)}


def test_merged_groups_have_all_customers(spark, data):
    out = PA.q_merge_groups(spark, data)
    assert out.agg({"n2": "sum"}).first()[0] == spark.read.parquet(f"{data}/customer.parquet").count()


GFF = {
    "gene_id=g1;transcript_id=t1.2;level=3": 'gene_id "g1"; transcript_id "t1.2";',
    'transcript_id=t2;gene_id=g2;note="merged from a; gene_id=wrong; c";': 'gene_id "g2"; transcript_id "t2";',
    "exon_id=e;gene_id=g3;transcript_id=t3;exon_number=1 (assigned to previous version 1)": 'gene_id "g3"; transcript_id "t3";',
    ' gene_id  "g4"; ;transcript_id = "t4.1";;': 'gene_id "g4"; transcript_id "t4.1";',
    ';transcript_id t5;gene_id="g5"; ;level 1': 'gene_id "g5"; transcript_id "t5";',
    'GENE_ID="g9"; transcript_id=t9': 'gene_id "g9"; transcript_id "t9";',
    "gene_id=g6;gene_id=g7": 'gene_id "g7";',
    'gene_id "g8"; transcript_id "t8";': None,
}


def test_gff_attributes_of_quoted_and_blank_values(spark, tmp_path):
    lines = [*GFF, None]
    spark.createDataFrame(list(enumerate(lines)), "line_no long, attribute string").write.parquet(f"{tmp_path}/gtf.parquet")
    got = {lines[r["line_no"]]: r["gtf"] for r in PA.q_gff_attributes(spark, str(tmp_path)).collect()}
    assert got == {k: v for k, v in GFF.items() if v}
    cases = {'ID=t1;Note="a; b=c";x=1 (d e);x=2;Alias=': {"ID": "t1", "Note": "a; b=c", "x": "2", "Alias": ""}, "": {}, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "a string").select("a", annot.gff_attributes(F.col("a")).alias("m"))
    assert {r["a"]: r["m"] for r in df.collect()} == cases


def test_gff_attributes_of_all_given_lines(spark, data):
    g = [r["attribute"] for r in spark.read.parquet(f"{data}/gtf.parquet").collect()]
    want = [a for a in g if a and re.search(r"(?i)_id\s*=", a)]
    got = [r["gtf"] for r in PA.q_gff_attributes(spark, data).collect()]
    found = sum(bool(re.search(r"(?i)(?<!\w)transcript_id[\s=]", a)) for a in want)
    assert len(got) == len(want) and sum("transcript_id" in x for x in got) == found


def test_ids_of_gtf_lines_in_any_form(spark, tmp_path):
    forms = ['gene_id "g{g}"; transcript_id "t{t}.1";', "gene_id=g{g};transcript_id=t{t}.1", "gene_id  g{g} ; transcript_id   t{t}.1", "transcript_id 't{t}.1' ;GENE_ID = \"g{g}\"", 'note "transcript_id no; x";TRANSCRIPT_ID "t{t}.1"|gene_id "g{g}"']
    rows = []
    for t in range(5):
        for k, (feature, lo, hi) in enumerate([("transcript", 1, 100 + t), ("exon", 1, 10), ("exon", 11, 20), ("exon", 50, 60), ("CDS", 12, 18)]):
            rows.append((len(rows), feature, lo, hi, "+", forms[(t + k) % 5].format(g=t // 3, t=t)))
    rows += [(len(rows), "exon", 5, 9, "+", 'gene_id "g0";'), (len(rows) + 1, "exon", 5, 9, "+", None)]
    spark.createDataFrame(rows, "line_no long, feature string, start_pos long, end_pos long, strand string, attribute string").write.parquet(f"{tmp_path}/gtf.parquet")
    run = lambda q: sorted(tuple(r) for r in q(spark, str(tmp_path)).collect())
    assert run(PA.q_exonic_length) == [(f"t{t}.1", 31) for t in range(5)]
    assert run(lambda *a: PA.q_coalesce_exons(*a).select("tid", "start_pos", "end_pos", "exon_number")) == [x for t in range(5) for x in ((f"t{t}.1", 1, 20, 1), (f"t{t}.1", 50, 60, 2))]
    assert run(PA.q_utr_classify) == [x for t in range(5) for x in ((5 * t + 1, "five_prime_utr"), (5 * t + 2, None), (5 * t + 3, "three_prime_utr"))]
    assert sorted(r["gid"] for r in PA.q_principal_transcripts(spark, str(tmp_path)).collect()) == ["g0", "g1"]
    assert run(PR.q_version_strip) == [(i, f"t{i // 5}.1", f"t{i // 5}") for i in range(25)]


def test_names_and_genes_of_all_reads(spark, tmp_path):
    rows = [("s", "a1", 7, 9, 20, "TG", 3), ("s", "a1", 8, 128, None, "", 1), ("r", "a2", 10, 0, -1, None, 1), ("r", "a2", 10, 0, 200, "T", 1), ("s", "a2", 107, 0, 3, "C", 2)]
    spark.createDataFrame(rows, "sample string, tile string, cluster long, pflags int, polya_len int, mods string, clones int").write.parquet(f"{tmp_path}/taginfo.parquet")
    names = sorted(tuple(r) for r in PR.q_id_format(spark, str(tmp_path)).select("sample", "short_name", "long_name").collect())
    want = [(s, f"{t}:{c:08d}", f"{t}:{c:08d}:{f:04x}:{n}:{-1 if p is None else p}:{m or ''}") for s, t, c, f, p, m, n in rows]
    assert names == sorted(want)
    assert {tuple(r) for r in PA.q_associate(spark, str(tmp_path)).select("gene", "sample", "n").collect()} == {("g007", "s", 2), ("g008", "s", 1), ("g010", "r", 2)}


def test_colour_correction_of_all_cycles(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(i, [round(rnd.uniform(-0.5, 0.5), 4) for _ in range(64)]) for i in range(6)]
    spark.createDataFrame([*rows, (9, None)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r["vec_id"], r["cycle_no"]): [r[f"s{k}"] for k in range(4)] for r in PS.q_color_correction(spark, str(tmp_path)).collect()}
    want = {(i, c): [sum(v[4 * c + k] * PS.INVERSE[4 * r + k] for k in range(4)) for r in range(4)] for i, v in rows for c in range(16)}
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 1e-7 for k in want for x, y in zip(got[k], want[k]))
