"""Hand-checked cases and properties of the core operators."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom import config
from tagloom.functions import flags as FL
from tagloom.functions import seq as S
from tagloom.functions import special
from tagloom.operators import annot, dedup, intervals, joins, reads, signal, wstats


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_best_segment_cases(spark):
    cases = {"AATTTTTTTTTTCG": (2, 12, "TT"), "CATTTTTCTTTTTTG": (2, 14, "TG"), "GTTTTTTTTNTTTTAC": (1, 14, "C"), "NNTTTTTT": (2, 8, "NN"), "TTTTT": (0, 5, ""), "TTTT": None, "ACGTACGT": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "s string").withColumn("b", reads.best_segment(F.col("s")))
    for r in df.select("s", "b", reads.modification(F.col("s"), F.lit(0), F.col("b.start")).alias("m")).collect():
        want = cases[r["s"]]
        assert (None if r["b"] is None else (r["b"]["start"], r["b"]["end"], r["m"])) == want


@settings(max_examples=300, deadline=None)
@given(st.text("ACGTN", max_size=40), st.integers(1, 6), st.integers(1, 8))
def test_best_segments_by_double_loop(text, least, before):
    best, want = 0, (-1, -1)
    for i in range(min(before, len(text))):
        for j in range(i + least - 1, len(text)):
            s = sum(reads.HEAD_SCORES[c] for c in text[:i]) + sum(reads.TAIL_SCORES[c] for c in text[i : j + 1])
            if s > best:
                best, want = s, (i, j + 1)
    s, e = reads.best_segments([text], reads.TAIL_SCORES, reads.HEAD_SCORES, least, before)
    assert (int(s[0]), int(e[0])) == want


def test_flags(spark):
    scores = {9: 2046, 1: 1918, 25: 1022, 0: 1916, 128: 1404}
    df = spark.createDataFrame([(k,) for k in (*scores, None)], "f int").select("f", FL.priority_score(F.col("f")).alias("p"))
    assert {r["f"]: r["p"] for r in df.collect()} == scores | {None: None}
    assert one(spark, FL.passes(F.lit(4096)), FL.passes(F.lit(8192)), FL.with_flag(F.lit(8193), "intact_end")) == (False, True, 8193)


def test_exact_dedup(spark):
    rows = [("u", "t1", 1, 9, 20), ("u", "t1", 5, 9, 24), ("u", "t2", 3, 9, 25), ("u", "t2", 4, 1, 90), ("v", "t1", 7, 9, None), (None, "t9", 1, None, 3)]
    df = spark.createDataFrame(rows, "umi string, tile string, cluster long, pflags int, polya int")
    out = {r["umi"]: tuple(r)[1:] for r in dedup.exact_dedup(df, ["umi"], "pflags", "polya", ["tile", "cluster"]).collect()}
    assert out == {"u": ("t1", 5, 9, 23, 4), "v": ("t1", 7, 9, -1, 1), None: ("t9", 1, 0, 3, 1)}
    trace = {(r["tile"], r["cluster"]): r["trace"] for r in dedup.dedup_trace(df.filter("umi = 'u'"), dedup.exact_dedup(df, ["umi"], "pflags", "polya", ["tile", "cluster"]), ["umi"], "pflags", "polya", ["tile", "cluster"]).collect()}
    assert trace == {("t1", 5): 23, ("t1", 1): -2, ("t2", 3): -2, ("t2", 4): -3}
    assert dedup.exact_dedup(df.limit(0), ["umi"], "pflags", "polya", ["tile", "cluster"]).count() == 0


def test_leader_case(spark):
    tags = [(100, "AAAAAAAA"), (101, "AAAAAACC"), (103, "AAAACCCC"), (104, "AAAAAAAC"), (105, "AAAAAAAA"), (120, "AAAAAAAA")]
    assert dedup.leaders(tags, 4, 2) == [0, 0, 2, 0, 4, 5]
    df = spark.createDataFrame([("c", p, t, i) for i, (p, t) in enumerate(tags)] + [("c", None, "A", 9), (None, 1, "A", 10)], "place string, pos int, text string, row int")
    assert {r["row"]: r["head"] for r in dedup.leader_clusters(df, "place", "pos", "text", "row").collect()} == dict(enumerate([0, 0, 2, 0, 4, 5]))


def test_leaders_against_sequential(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("xy"), rnd.randint(0, 9000), "".join(rnd.choice("ACN") for _ in range(rnd.randint(4, 7))), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "place string, pos int, text string, row int")
    got = {r["row"]: r["head"] for r in dedup.leader_clusters(df, "place", "pos", "text", "row", 6, 2).collect()}
    pdf, want = pd.DataFrame(rows, columns=["place", "pos", "text", "row"]), {}
    for _, g in pdf.groupby("place"):
        o = dedup.leader_frame(g, 6, 2)
        want |= dict(zip(o["row"], o["head"]))
    assert got == want


def test_merge_clusters(spark):
    rows = [(1, 10, 9, 2, 30, 12), (1, 11, 9, 1, 33, 15), (1, 12, 1, 5, 99, 99), (2, 20, 9, 4, 7, 0), (2, 21, 9, 4, 8, 0)]
    df = spark.createDataFrame(rows, "head int, id int, f int, c int, l int, t int")
    out = {r["head"]: tuple(r)[1:] for r in dedup.merge_clusters(df, "head", "f", "c", "l", "t", "id").collect()}
    assert out == {1: (10, 9, 8, 31, 13), 2: (20, 9, 8, 7, 0)}


def test_weighted_quantile_cases(spark):
    rows = [("a", 1, 1), ("a", 2, 1), ("a", 10, 2), ("b", 5, 1), ("b", 6, 2), ("b", 9, 1), ("c", 0, 3), ("c", 7, 1), ("d", 1, 0)]
    df = spark.createDataFrame(rows, "g string, x int, w int")
    assert {r["g"]: r["q50"] for r in wstats.weighted_quantiles(df, ["g"], "x", "w", (0.5,)).collect()} == {"a": 10, "b": 6, "c": 0}
    m = {r["g"]: r for r in wstats.weighted_moments(df, ["g"], "x", "w").collect()}
    assert m["a"]["mean"] == 5.75 and m["a"]["mode"] == 10 and m["d"]["mean"] is None


def test_histogram_case(spark):
    df = spark.createDataFrame([("s", x) for x in (-1, 0, 3, 3, None)], "s string, x int")
    out = wstats.dense_histogram(wstats.histogram(df, ["s"], "x"), "s", "x", 5)
    assert sorted((r["x"], r["n"]) for r in out.collect()) == [(0, 1), (1, 0), (2, 0), (3, 2)]
    assert wstats.dense_histogram(wstats.histogram(df.limit(0), ["s"], "x"), "s", "x", 5).count() == 0


def test_density_integrates_to_one(spark):
    rnd = np.random.default_rng(1)
    df = spark.createDataFrame([("g", float(x), 1) for x in rnd.normal(50, 10, 300)] + [("one", 1.0, 5)], "g string, x double, w int")
    grid = np.linspace(0, 100, 401)
    out = [r["density"] for r in wstats.weighted_kde(df, ["g"], "x", "w", grid.tolist(), "silverman").collect()]
    assert len(out) == 401 and abs(sum(out) * (grid[1] - grid[0]) - 1) < 0.01


def test_geometric_mean(spark):
    df = spark.createDataFrame([("a", 10, 1), ("a", 1000, 1), ("b", 7, 1), ("c", 2, 5)], "g string, x int, n int")
    out = {r["g"]: r for r in wstats.geometric_mean_ci(df, ["g"], "x", "n").collect()}
    half = special.t_quantile(0.95, 1) * math.log(10) / math.sqrt(2)
    assert abs(out["a"]["mean"] - 100) < 1e-9 and abs(math.log(out["a"]["ci_hi"]) - math.log(100) - half) < 1e-9
    assert abs(out["b"]["mean"] - 7) < 1e-9 and out["b"]["ci_lo"] == out["b"]["ci_hi"] and math.isnan(out["c"]["mean"])


def test_special_functions():
    for p, df, want in ((0.95, 1, 6.313752), (0.975, 10, 2.228139), (0.95, 30, 1.697261), (0.05, 5, -2.015048)):
        assert abs(special.t_quantile(p, df) - want) < 1e-5
    assert special.required_letters(20) == (0, 1, 2, 2, 3, 3, 4, 5, 5, 6, 7, 7, 8, 9, 10, 10, 11, 12, 12, 13, 14)


def test_ruler_cases(spark):
    s = [0.9, 0.8, 0.9, 0.2, 0.9, 0.9, 0.1, 0.1]
    rows = [(1, s, [False] * 8), (2, s, [False] * 6 + [True] * 2), (3, [0.1, 0.1], [False] * 2), (4, [], []), (5, [0.9, None, 0.9], [False] * 3)]
    df = spark.createDataFrame(rows, "i int, s array<double>, d array<boolean>")
    out = df.select("i", signal.tail_length(F.col("s"), F.col("d"), F.transform("s", lambda x: F.lit(0.5))).alias("n"))
    assert {r["i"]: r["n"] for r in out.collect()} == {1: 6, 2: 7, 3: 0, 4: 0, 5: 1}


def test_sequence_functions(spark):
    r = one(spark, S.trailing_run(F.lit("AATTGTT"), "T"), S.trailing_run(F.lit(""), "T"), S.trailing_run(F.lit("T" * 30), "T"), S.reverse_complement(F.lit("AcgUx")), S.hamming(F.lit("ACG"), F.lit("ATG")), S.hamming(F.lit(""), F.lit("A")))
    assert tuple(r) == (2, 0, 20, "xAcgT", 1, 0)
    assert tuple(one(spark, S.reference_span(F.lit("5S10M2I3D4N6S")), S.match_span(F.lit("*")), S.count_phred(F.lit("I#II"), 30, F.lit(0), 4))) == (17, 0, 3)
    # one edit never moves two trimer profiles further apart than six
    assert one(spark, S.trimer_distance(F.lit("ACGTACGT"), F.lit("ACGAACGT")))[0] <= 6


def test_delimiter_cases(spark):
    find = lambda text: tuple(one(spark, reads.find_delimiter(F.lit(text), "GTCAG", F.lit(5), 1))[0])
    assert find("AAAAAGTCAGTT") == (10, 0)
    assert find("AAAAGTCAGTTT") == (9, 0x20)
    assert find("AAAAAGTCTGTT") == (10, 0x02)
    assert find("AAAAAAAAAAAA") == (-1, 0x80)


def test_demultiplexing(spark):
    samples = [reads.Sample("a", "ATCACG", 1), reads.Sample("b", "CGATGT", 1)]
    df = spark.createDataFrame([("ATCACG",), ("ATCACC",), ("ATCAGG",), ("CGATCC",), (None,), ("",)], "i string")
    out = [(r["sample"], r["mismatches"]) for r in reads.demultiplex(df, "i", samples).collect()]
    assert out == [("a", 0), ("a", 1), ("a", 1), ("Unknown", -1), ("Unknown", -1), ("Unknown", -1)]


def test_interval_cases(spark):
    plus = [c for c in intervals.terminal_base(F.lit(100), F.lit(150), F.lit("+"))]
    minus = [c for c in intervals.terminal_base(F.lit(100), F.lit(150), F.lit("-"))]
    assert tuple(one(spark, *plus, *minus)) == (149, 150, 100, 101)


def brute_overlap(a, b):
    return {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3]}


def test_overlap_join_against_all_pairs(spark):
    rnd = random.Random(9)

    def make(n, base):
        out = []
        for i in range(n):
            s = rnd.randint(-2000, 200_000)
            out.append((base + i, rnd.choice("pq"), s, s + rnd.choice([0, 1, 50, 3000, 90_000, 30_000_000])))
        return out

    a, b = make(150, 0), make(150, 1000)
    left = spark.createDataFrame(a + [(500, None, 1, 5), (501, "p", None, 5)], "id long, k string, start long, end long")
    right = spark.createDataFrame(b, "id long, k string, start long, end long")
    got = [(r["id"], r["id_r"]) for r in intervals.overlap_join(left, right, ["k"]).collect()]
    want = brute_overlap(a, b)
    assert len(got) == len(set(got)) and set(got) == want
    semi = {r["id"] for r in intervals.overlap_join(left.filter("id < 500"), right, ["k"], how="left_semi").collect()}
    assert semi == {x for x, _ in want}
    assert intervals.overlap_join(left, right.limit(0), ["k"]).count() == 0


def test_merge_and_islands_across_stretches(spark):
    rnd = random.Random(4)
    rows = [("k", s, s + rnd.randint(1, 40)) for s in (rnd.randint(0, 4000) for _ in range(200))]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    got = sorted(tuple(r)[1:] for r in intervals.merge_intervals(df, ["k"], "s", "e", 0, stretch=64).collect())
    want = []
    for _, s, e in sorted(rows):
        if want and s <= want[-1][1]:
            want[-1] = (want[-1][0], max(want[-1][1], e), want[-1][2] + 1)
        else:
            want.append((s, e, 1))
    assert got == want
    pts = spark.createDataFrame([("k", s, i) for i, (_, s, _) in enumerate(rows)], "k string, p long, i int")
    out = dedup.islands(pts, ["k"], "p", 9, ["i"], stretch=64).groupBy("island").agg(F.min("p").alias("a"), F.max("p").alias("b"), F.count("*").alias("n"))
    expected, prev = [], None
    for _, s, _ in sorted(rows):
        if prev is not None and s - prev <= 9:
            expected[-1][1:] = [s, expected[-1][2] + 1]
        else:
            expected.append([s, s, 1])
        prev = s
    assert sorted(tuple(r)[1:] for r in out.collect()) == sorted(map(tuple, expected))


def test_transitive_ids_with_a_cycle(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("y", "z"), ("q", "q"), (None, "r")], "old string, new string")
    assert {tuple(r) for r in annot.resolve_transitively(df, "old", "new").collect()} == {("a", "c"), ("b", "c"), ("x", "z"), ("y", "z")}


def test_assertions_raise(spark):
    import pytest

    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="no partner"):
        joins.require_subset(a, b, ["k"]).collect()
    t = spark.createDataFrame([(1, "x")], "id int, v string")
    with pytest.raises(Exception, match="unknown type"):
        annot.dispatch_xrefs(spark.createDataFrame([(1, "odd")], "ref int, kind string"), "kind", {"gene": (t, "id")}, "ref").collect()
    known = annot.dispatch_xrefs(spark.createDataFrame([(1, "gene")], "ref int, kind string"), "kind", {"gene": (t, "id")}, "ref")
    assert [r["v"] for r in known.collect()] == ["x"]


def test_tail_reevaluation(spark):
    need = special.required_letters(100)
    cases = [(9, "AAA", 9), (3, "", 0), (3, "AAAAATTT", 5), (3, "CCCAAA", 3), (3, "CCCCAAG", 0)]
    df = spark.createDataFrame(cases, "n int, b string, want int")
    assert all(r["want"] == r["got"] for r in df.withColumn("got", reads.reevaluated_tail(F.col("n"), F.col("b"), need)).collect())


def test_control_alignment():
    control = "GAGTTTTATCGCTTCCATGACGCAGAAGTTAACACTTTCGG"
    assert signal.control_score("TCGCTTCC", control) == 8
    assert signal.control_score("TCGCATCC", control) == 5 and signal.control_score("AAAA", "CCCC") == 0
    assert signal.control_score("GAGTTTTATCGCTTCATGACGC", control) == 22 - 4


def test_equal_odds_cutoff():
    x = np.arange(1000.0)
    pos, neg = np.exp(-0.5 * ((x - 450) / 60) ** 2) * 1000, np.exp(-0.5 * ((x - 150) / 60) ** 2) * 1000
    assert abs(signal.equal_odds(x, pos, x, neg) - 0.3) < 0.02


def test_measured_tails_of_known_length(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for i in range(200):
        n = int(rnd.choice([0, 8, 16, 32, 64]))
        rows.append((i, n, np.concatenate([rnd.normal(0.8, 0.08, n), rnd.normal(0.2, 0.08, 80 - n)]).clip(0, 1).tolist()))
    df = spark.createDataFrame(rows, "i int, n int, s array<double>")
    off = F.transform("s", lambda x: F.lit(False))
    out = df.select(F.abs(signal.tail_length(F.col("s"), off, F.transform("s", lambda x: F.lit(0.5))) - F.col("n")).alias("d"))
    assert out.agg(F.avg("d")).first()[0] < 0.2


def test_configuration(tmp_path):
    (tmp_path / "base.yaml").write_text("qc: {a: 1, b: 2}\nreads: {R5: [1, 51]}\n")
    (tmp_path / "own.yaml").write_text("include: base.yaml\nqc: {b: 3}\nexperimental_samples: {x: 1, y: 2}\nspikein_samples: {s: 3}\nlimits: {_exp: 2, _spk: {deep: {_all: 1}}}\n")
    c = config.with_samples(config.load(str(tmp_path / "own.yaml")))
    assert c["qc"] == {"a": 1, "b": 3} and c["reads"] == {"R5": [1, 51]}
    assert c["limits"] == {"x": 2, "y": 2, "s": {"deep": {"x": 1, "y": 1, "s": 1}}}
    assert config.spikeins_first({"s": 8, "t": 0}, ["x", "s", "t"]) == ["t", "s", "x"]


def test_gff3_adoption(spark):
    rows = [
        ("c", "s", "gene", 1, 100, "+", "ID=g1;Name=abc"),
        ("c", "s", "mRNA", 1, 100, "+", "ID=t1;Parent=g1;x=1;x=2"),
        ("c", "s", "five_prime_UTR", 1, 10, "+", "Parent=t1"),
        ("c", "s", "CDS", 11, 40, "+", "Parent=t1"),
        ("c", "s", "CDS", 60, 80, "+", "Parent=t1"),
        ("c", "s", "three_prime_UTR", 81, 100, "+", "Parent=t1"),
        ("c", "s", "CDS", 5, 9, "+", "Parent=unknown"),
    ]
    df = spark.createDataFrame(rows, "seqname string, source string, feature string, start int, end int, strand string, attribute string")
    out = sorted((r["feature"], r["start"], r["end"], r["attribute"]) for r in annot.adopt_gff3(df).collect())
    assert out == [
        ("exon", 1, 40, 'gene_id "g1"; transcript_id "t1"; exon_number "1"; gene_name "abc";'),
        ("exon", 60, 100, 'gene_id "g1"; transcript_id "t1"; exon_number "2"; gene_name "abc";'),
        ("gene", 1, 100, 'gene_id "g1"; gene_name "abc";'),
        ("transcript", 1, 100, 'gene_id "g1"; transcript_id "t1"; gene_name "abc";'),
    ]


def test_seed_counts(spark):
    high, low = [0.9] * 15 + [0.1] * 25, [0.2] * 40
    rows = [("t", high, 12, 2, "a", 1), ("t", low, 0, 0, "a", 2), ("t", low, 0, 0, "a", 3), ("t", low[:10], 0, 0, "b", 4), ("t", high, 5, 0, "c", 5)]
    df = spark.createDataFrame(rows, "tile string, s array<double>, n int, st int, fp string, i int")
    out = signal.seed_counts(df, "tile", "s", "n", "st", "fp", ["i"], boundary=12, gap=3, guards=(5, 5), most=1)
    got = {(r["cycle"], r["positive"], r["bin"]): r["n"] for r in out.collect()}
    assert {k: v for k, v in got.items() if k[1]} == {(c, True, 900): 1 for c in range(2, 9)}
    assert {k: v for k, v in got.items() if not k[1]} == {(c, False, 200): 1 for c in range(40)}


def test_smoothing(spark):
    w = signal.savitzky_golay(5, 2)
    assert abs(sum(w) - 1) < 1e-9 and abs(w[2] - 17 / 35) < 1e-9
    r = one(spark, signal.smoothed(F.array(*[F.lit(float(x)) for x in (1, 2, 4)]), [1.0, 2.0, 1.0]))
    assert r[0] == [1.5, 2.25, 3.0]
