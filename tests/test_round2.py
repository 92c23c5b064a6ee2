"""Regressions and properties of operators that were wrong or unbounded once."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.operators import annot, intervals, joins, orphans, signal, sorting, wide
from tagloom.plans import formats
from tagloom.session import fresh_folder, shared_folder


def test_utr_class_uses_the_last_end(spark):
    cds = spark.createDataFrame([("t", 100, 150, "+"), ("t", 120, 400, "+"), ("m", 10, 20, "-")], "t string, s int, e int, strand string")
    utr = spark.createDataFrame([("t", 200, 300, "+"), ("t", 401, 410, "+"), ("t", 10, 99, "+"), ("m", 21, 30, "-"), ("m", 1, 9, "-"), ("x", 1, 2, "+")], "t string, s int, e int, strand string")
    got = {(r["t"], r["s"]): r["utr"] for r in annot.utr_class(cds, utr, "t", "s", "e", "strand").collect()}
    assert got == {("t", 200): None, ("t", 401): "three_prime_utr", ("t", 10): "five_prime_utr", ("m", 21): "five_prime_utr", ("m", 1): "three_prime_utr", ("x", 1): None}


def finals(edges):
    going = {a for a, _ in edges}
    out = set()
    for start in going:
        seen, todo = set(), [start]
        while todo:
            x = todo.pop()
            for a, b in edges:
                if a == x and b not in seen:
                    seen.add(b)
                    todo.append(b)
        out |= {(start, x) for x in seen if x not in going}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_ids_resolve_through_splits_and_circles(spark, seed):
    rnd = random.Random(seed)
    edges = {(rnd.randint(0, 25), rnd.randint(0, 30)) for _ in range(28)} | {(100, 101), (101, 102), (102, 100), (102, 103)}
    edges = {(a, b) for a, b in edges if a != b}
    df = spark.createDataFrame([*edges, (7, 7), (None, 1), (1, None)], "a long, b long")
    assert {tuple(r) for r in annot.resolve_transitively(df, "a", "b").collect()} == finals(edges)


def test_long_chains_of_ids(spark):
    df = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = annot.resolve_transitively(df, "a", "b").collect()
    assert {r["a"] for r in got} == set(range(300)) and {r["b"] for r in got} == {300}
    assert annot.resolve_transitively(df.limit(0), "a", "b").count() == 0


def test_a_stream_can_be_read_again_from_another_folder(spark, data):
    small = formats.q_stream_first_seen(spark, data).count()
    formats.q_stream_first_seen(spark, data.replace("sf0.001", "sf0.01")).count()
    assert formats.q_stream_first_seen(spark, data).count() == small
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x") and fresh_folder(spark, "x").startswith(shared_folder(spark))


def test_references_of_any_length(spark):
    t = "timestamp'2024-01-01'"
    parents = spark.createDataFrame([(5,), (6,), (7,), (256,), (-3,), (None,), (9223372036854775807,)], "k long").selectExpr("k", "'p' AS kind", f"{t} AS l", "CAST(NULL AS TIMESTAMP) AS d")
    parents = parents.unionByName(spark.sql(f"SELECT 300L AS k, 'p' AS kind, {t} AS l, {t} AS d"))
    states = orphans.parent_states([(parents, F.col("k"), F.col("kind"), F.col("l"), F.col("d"))])
    refs = {"5": None, " 06.0 ": None, "8": "missing", "4": "missing", "255": "missing", "256": None, "-3": None, "+7": None, "9223372036854775807": None, "9" * 19: "missing", "1" * 36: "missing", "1" * 38: "missing", "1" * 60: "missing", "5.5": "missing", "x": "missing", "300": "deleted", "\\N": None, "": None, "  ": None}
    df = spark.createDataFrame([(i, r) for i, r in enumerate([*refs, None])], "i int, r string").withColumn("l", F.expr(t)).withColumn("start", F.lit("clash"))
    got = {r["i"]: r["kind"] for r in orphans.orphan_references(df, F.col("r"), F.lit("p"), F.col("l"), states, [F.col("i")]).collect()}
    assert got == {i: k for i, k in enumerate(refs.values()) if k}
    early = orphans.orphan_references(df.withColumn("l", F.expr("timestamp'2023-01-01'")), F.col("r"), F.lit("p"), F.col("l"), states, [F.col("i")])
    assert {r["kind"] for r in early.filter("i = 0").collect()} == {"late"}
    runs = {(r["start"], r["end"]) for r in orphans.key_runs(states).collect()}
    assert runs == {(5, 7), (256, 256), (-3, -3), (300, 300), (9223372036854775807, 9223372036854775807)}
    assert orphans.orphan_references(df, F.col("r"), F.lit("p"), F.col("l"), states.limit(0), [F.col("i")]).filter("kind != 'missing'").count() == 0


def test_cast_failures_stay(spark):
    rows = [("e", "level", "2", 1), ("e", "level", "high", 2), ("e", "rank", "7 of 9", 1), ("e", "rank", "99999999999999999999999", 3), ("e", "name", "x", 1), ("e", "name", "NA", 2), ("f", "level", "none", 1), ("f", "other", "y", 1), ("f", "rank", "", 1), ("f", "rank", None, 2)]
    df = spark.createDataFrame(rows, "id string, k string, v string, at int").withColumn("other", F.lit("clash"))
    columns = {"level": "bigint", "rank": "bigint", "name": "string"}
    table = wide.widen(df, ["id"], "k", "v", columns, [F.col("at")])
    got = {r["id"]: r for r in table.collect()}
    assert (got["e"]["level"], got["e"]["rank"], got["e"]["name"]) == (2, None, "x")
    assert got["e"]["cast_failures"] == {"level": "high", "rank": "99999999999999999999999"} and got["f"]["cast_failures"] == {"level": "none"} and got["f"]["other"] == {"other": "y"}
    cells = {tuple(r) for r in wide.unpivot_wide(table, ["id"], columns).collect()}
    assert cells == {("e", "level", "2"), ("e", "rank", "99999999999999999999999"), ("e", "name", "x"), ("f", "other", "y")}
    assert wide.widen(df.limit(0), ["id"], "k", "v", columns, [F.col("at")]).count() == 0


@pytest.mark.parametrize("size", [3, 10_000])
def test_matched_groups_in_parts(spark, size):
    rnd = random.Random(3)
    a, b = [(rnd.choice([1, 1, 1, 2, None]), i) for i in range(60)], [(rnd.choice([1, 3]), i % 5) for i in range(20)]
    x, y = spark.createDataFrame(a, "k int, v int"), spark.createDataFrame(b, "k int, w int")
    rows = joins.match_groups([x, y], "k", [["v"], ["w"]], size=size).collect()
    assert sorted((r["k"], e["v"]) for r in rows for e in r["g0"]) == sorted(r for r in a if r[0] is not None)
    assert sorted((r["k"], e["w"]) for r in rows for e in r["g1"]) == sorted(b)
    assert len(rows) == len({(r["k"], r["part"]) for r in rows}) and (size == 3 or len(rows) == 3)
    assert {r["k"] for r in joins.match_groups([x, y], "k", [["v"], ["w"]], "first", size).collect()} == {1, 2}


def merged(spans, gap):
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1] + gap:
            out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + 1)
        else:
            out.append((s, e, 1))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_intervals_merge_over_borders(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", None]), s := rnd.randint(-50, 400), s + rnd.choice([0, 1, 3, 9, 60])) for _ in range(70)]
    gap = seed % 3
    got = intervals.merge_intervals(spark.createDataFrame(rows, "k string, s int, e int"), ["k"], "s", "e", gap, stretch=8).collect()
    want = [(k, *m) for k in ("a", None) for m in merged([(s, e) for x, s, e in rows if x == k and s < e], gap)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_blocks_of_alignments(spark):
    cases = {"10M": [(100, 110)], "5S10M3I5M": [(100, 115)], "10M50N5M2D3M": [(100, 110), (160, 170)], "5N10M": [(105, 115)], "3M4N5N2=": [(100, 103), (112, 114)], "*": [], "": [], "4S": [], "2M3N": [(100, 102)], None: None}
    df = spark.createDataFrame([(c,) for c in cases], "c string").select("c", intervals.aligned_blocks(F.lit(100), F.col("c")).alias("b"))
    assert {r["c"]: None if r["b"] is None else [tuple(x) for x in r["b"]] for r in df.collect()} == cases
    reads = spark.createDataFrame([(1, "c", 100, "10M50N5M")], "id int, chrom string, at int, cigar string")
    exons = spark.createDataFrame([("in", "c", 105, 120), ("gap", "c", 120, 150), ("both", "c", 100, 300), ("end", "c", 164, 165), ("no", "d", 100, 300)], "g string, chrom string, start int, end int")
    got = {r["g"] for r in intervals.block_overlap_join(reads, exons, ["chrom"], ["id"], "at", "cigar", ["g"]).collect()}
    assert got == {"in", "both", "end"}


def test_cut_off_is_a_root_of_the_densities():
    rnd = np.random.default_rng(1)
    pos, neg = (np.bincount(np.clip(rnd.normal(m, 90, 4000), 0, 999).astype(int), minlength=1000) for m in (520, 300))
    x = np.arange(1000.0)
    cut = signal.equal_odds(x, pos.astype(float), x, neg.astype(float))
    a, b = (signal._density(x / 1000, n.astype(float), np.array([cut]), 0.1)[0] for n in (pos, neg))
    assert 0.3 < cut < 0.5 and abs(np.log(a / b)) < 1e-6
    assert signal.equal_odds(x, pos.astype(float), x, pos.astype(float) * 2) is None


def test_rows_are_numbered_in_order(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["b", "a", None]), rnd.randint(0, 9), i) for i in range(200)]
    df = spark.createDataFrame(rows, "r string, p int, i int").repartition(7)
    got = {r["i"]: r["place"] for r in sorting.numbered(df, [F.col("r").asc_nulls_first(), F.col("p").desc(), F.col("i")]).collect()}
    want = sorted(rows, key=lambda x: (x[0] is not None, x[0] or "", -x[1], x[2]))
    assert got == {r[2]: k for k, r in enumerate(want)}
    assert sorting.numbered(df.limit(0), [F.col("i")]).count() == 0


def test_rolling_hash(spark):
    def plain(text):
        v = 0
        for c in text[:30]:
            v = ((v << 3) | ((ord(c) & 7) ^ (v >> 60))) & ((1 << 63) - 1)
        return v

    texts = ["", "A", "ACGT" * 12, "T" * 31, "GATTACA" * 5]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", S.rolling_hash(F.col("t")).alias("h"))
    assert {r["t"]: r["h"] for r in df.collect()} == {t: plain(t) for t in texts} | {None: None}
    out = signal.fair_sample(spark.createDataFrame([(i, "ACGT" if i % 2 else "TTTT") for i in range(9)], "i int, t string"), "t", ["i"], 2, 1 << 20, 30, True)
    assert sorted(r["i"] for r in out.collect()) == [0, 1, 2, 3]
