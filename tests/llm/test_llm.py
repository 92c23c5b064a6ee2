"""The training-data operators: against brute force, the public tokenizer, held-out texts and stated bounds."""

from __future__ import annotations

import os
import random
import re
import sys
from array import array
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pyarrow.dataset as ds
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parity import compare  # noqa: E402

from tagloom.llm import bpe, editjoin, langid, mix, queries, quantiles, survivors, tokenize  # noqa: E402
from tagloom.session import table  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, data, name):
    compare(queries.QUERIES[name], queries.ORACLE[name], spark, data)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_runs(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() >= 0


# ---- p2


def edits(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def turned(umi):
    parts = re.split("[^A-Za-z]+", re.sub("^[^A-Za-z]+|[^A-Za-z]+$", "", umi), maxsplit=1)
    return (re.sub("[^A-Za-z]", "", parts[1]) + parts[0]).upper() if len(parts) > 1 else None


def brute_links(rows):
    out, by = set(), defaultdict(list)
    for i, place, pos, umi in rows:
        plain = re.sub("[^A-Za-z]", "", umi or "").upper()
        if i is not None and place is not None and pos is not None and plain:
            by[place].append((i, pos, plain, turned(umi)))
    for group in by.values():
        for k, (i, p, a, ra) in enumerate(group):
            for j, q, b, rb in group[k + 1 :]:
                if i != j and abs(p - q) <= 4 and (edits(a, b) <= 2 or (ra and edits(ra, b) <= 2) or (rb and edits(a, rb) <= 2)):
                    out.add((min(i, j), max(i, j)))
    return out


@pytest.mark.parametrize("heavy", [80_000, 40])
def test_edit_links_on_the_table(spark, data, heavy):
    t = table(spark, data, "tagcluster")
    rows = [(r["tag_id"], r["rname"], r["pos"], r["umi_rep"]) for r in t.collect()]
    got = [tuple(r) for r in editjoin.edit_links(t, "tag_id", "rname", "pos", "umi_rep", heavy=heavy).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_links(rows)


@pytest.mark.parametrize("heavy", [80_000, 20])
def test_edit_links_on_odd_rows(spark, heavy):
    rnd = random.Random(7)
    base = ["".join(rnd.choice("ACG") for _ in range(rnd.randint(1, 9))) for _ in range(25)]
    rows = [(i, rnd.choice(["x", "y"]), rnd.choice([250, 253, 255, 256, 258, 260, -3]), rnd.choice(base)[:: rnd.choice([1, -1])]) for i in range(160)]
    rows = [(i, a, p, u if i % 4 else u[:2] + "-_"[i % 8 // 4] + u[2:]) for i, a, p, u in rows]
    rows += [(900, "x", 255, None), (901, "x", 255, ""), (902, "x", 255, "--"), (903, None, 255, "ACG"), (904, "x", None, "ACG"), (905, "x", 256, "-acg+"), (906, "x", 256, "A" * 60), (907, "x", 257, "A" * 59 + "C"), (908, "x", 255, "A" * 44 + "CC"), (909, "x", 255, "C" + "A" * 44), (905, "x", 256, "-acg+")]
    df = spark.createDataFrame(rows, "id long, place string, pos int, umi string").withColumn("stretch", F.lit("clash")).withColumn("s0", F.lit(1))
    got = [tuple(r) for r in editjoin.edit_links(df, "id", "place", "pos", "umi", heavy=heavy).collect()]
    assert set(got) == brute_links(rows)
    assert editjoin.edit_links(df.limit(0), "id", "place", "pos", "umi").count() == 0


def test_both_sides_of_the_boundary():
    rnd = random.Random(5)
    # many short strings make long lists
    base = ["".join(rnd.choice("AC") for _ in range(n)) for n in (3, 4, 5, 6, 9, 12) for _ in range(60)] + ["".join(rnd.choice("ACGT") for _ in range(24)) for _ in range(20)]
    base += [b[:7] + b[8:] for b in base[-20:]]
    zeros, row = np.zeros(len(base), dtype=np.int64), np.arange(len(base))
    stats: dict = {}
    at_once = editjoin.PROBES_AT_ONCE
    try:
        editjoin.PROBES_AT_ONCE = 500
        got = {(int(a), int(b)) for x, y in editjoin.link_pairs(base, zeros > 0, row, zeros, zeros, 4, stats) for a, b in zip(x, y)}
    finally:
        editjoin.PROBES_AT_ONCE = at_once
    assert stats["small"] > 0 and stats["large"] > 0
    assert got == {(i, j) for i in row.tolist() for j in range(i + 1, len(base)) if edits(base[i], base[j]) <= 2}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("AC", min_size=1, max_size=11), min_size=2, max_size=40), st.integers(0, 12))
def test_any_boundary_finds_all_links(strings, upto):
    """Both halves by force: strings up to a length are enumerated, longer ones scan."""
    zeros, row = np.zeros(len(strings), dtype=np.int64), np.arange(len(strings))
    kept = editjoin.cheapest
    try:
        sizes = np.unique([len(s) for s in strings])
        editjoin.cheapest = lambda scan, enum: int((sizes <= upto).sum())
        editjoin.CHECKED, known = 1e6, editjoin.CHECKED
        got = {(int(a), int(b)) for x, y in editjoin.link_pairs(strings, zeros > 0, row, zeros, zeros, 4) for a, b in zip(x, y)}
    finally:
        editjoin.cheapest, editjoin.CHECKED = kept, known
    assert got == {(i, j) for i in row.tolist() for j in range(i + 1, len(strings)) if edits(strings[i], strings[j]) <= 2}


def test_both_halves_work_on_the_table(data):
    """The crowded stretches of tagcluster enumerate, the quiet ones scan; by cost, at the largest size."""
    import pyarrow.parquet as pq

    path = data.replace("sf0.001", "check_l") + "/tagcluster.parquet"
    if not os.path.exists(path):
        pytest.skip("no larger table here")
    t = pq.read_table(path, columns=["rname", "pos", "umi_rep"]).to_pylist()
    known = sorted({(r["rname"], r["pos"] // 256, r["pos"], re.sub("[^A-Za-z]", "", r["umi_rep"] or "").upper()) for r in t if r["rname"] is not None and r["pos"] is not None})
    known = [k for k in known if k[3]]
    crowded = Counter(k[:2] for k in known).most_common(60)
    chosen = [k for k in known if k[:2] in {c for c, _ in crowded}]
    code = {c: i for i, (c, _) in enumerate(crowded)}
    stats: dict = {}
    zeros = np.zeros(len(chosen), dtype=bool)
    sum(len(a) for a, _ in editjoin.link_pairs([k[3] for k in chosen], zeros, np.arange(len(chosen)), np.array([code[k[:2]] for k in chosen]), np.array([k[2] for k in chosen]), 4, stats))
    assert stats["small"] > 0 and stats["large"] > 0


def test_boundary_of_crowded_stretches(spark):
    rnd = random.Random(6)
    short = ["".join(rnd.choice("ACGT") for _ in range(8)) for _ in range(3000)]
    long = ["".join(rnd.choice("ACGT") for _ in range(40)) for _ in range(300)]
    rows = [(i, 1, 5, True, False, s) for i, s in enumerate(short + long)]
    made = spark.createDataFrame(rows, "class_id long, area long, pos long, own boolean, turned boolean, s string")
    upto, sizes = editjoin.heavy_boundary(made, 4)
    assert upto == 8 and sizes == [8, 40]


def test_degrees_are_those_of_the_pairs(spark, data):
    t = table(spark, data, "tagcluster")
    n = Counter(x for r in editjoin.edit_links(t, "tag_id", "rname", "pos", "umi_rep").collect() for x in r)
    got = editjoin.edit_degrees(t, "tag_id", "rname", "pos", "umi_rep").collect()
    assert {r["id"]: r["n_links"] for r in got if r["n_links"]} == n and len({r["id"] for r in got}) == len(got)
    places = {r["tag_id"]: (r["rname"], r["pos"], re.sub("[^A-Za-z]", "", r["umi_rep"]).upper()) for r in t.filter("umi_rep IS NOT NULL").collect()}
    assert all(places[r["id"]] == places[r["class_id"]] for r in got)


# ---- p3


def test_survivors_by_search(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, 1, 2, 3, 4, 5]), rnd.randint(0, 5), rnd.choice([None, 1, 2, 3]), rnd.choice([None, "A", "C", "G"]), datetime(2023, 1, 1 + i % 5) if i % 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "row_no long, grp int, p int, x int, y string, at timestamp").withColumn("key", F.lit("clash")).withColumn("n_rows", F.lit(0))
    bundles = [survivors.Bundle("x", ("x",), F.col("x").isNotNull()), survivors.Bundle("y", ("y",), F.col("y").isNotNull())]
    order = [F.col("p"), F.col("at"), -F.col("row_no")]
    free = {r["grp"]: r for r in survivors.survivors(df, "grp", "row_no", bundles, order).collect()}
    tied = {r["grp"]: r for r in survivors.survivors(df, "grp", "row_no", bundles, order, depends=[("x", "y")]).collect()}
    assert set(free) == set(tied) == {g for _, g, *_ in rows if g is not None}
    rank = lambda r: (r[2], r[5] or datetime.min, -r[0])
    for g in free:
        mine = [r for r in rows if r[1] == g]
        assert free[g]["n_rows"] == len(mine)
        for name, at in (("x", 3), ("y", 4)):
            has = [r for r in mine if r[at] is not None]
            assert (free[g][name] and free[g][name]["id"]) == (max(has, key=rank)[0] if has else None)
        pairs = {(r[3], r[4]) for r in mine}
        weight = {r[0]: r[2] for r in mine}
        best = max((a[2] if a else 0) + (b[2] if b else 0) for a in [None, *[r for r in mine if r[3] is not None]] for b in [None, *[r for r in mine if r[4] is not None]] if not a or not b or (a[3], b[4]) in pairs)
        got = tied[g]
        assert sum(weight[got[n]["id"]] for n in ("x", "y") if got[n]) == best
        assert not got["x"] or not got["y"] or (got["x"]["x"], got["y"]["y"]) in pairs
    assert survivors.survivors(df.limit(0), "grp", "row_no", bundles, order, depends=[("x", "y")]).count() == 0


def best_choice(mine, rank, names, allowed):
    """The best choice of one group by trying all: (trust, then the ranks in order of the bundles)."""
    import itertools

    lists = []
    for at in names:
        by = {}
        for r in mine:
            if r[at] is not None and (r[at] not in by or rank(r) > rank(by[r[at]])):
                by[r[at]] = r
        lists.append([None, *by.values()])
    low = (-1,)
    score = lambda c: (sum(r[2] for r in c if r), [rank(r) if r else low for r in c])
    return max((c for c in itertools.product(*lists) if allowed(c)), key=score)


@pytest.mark.parametrize("block", [1, 2, 32])
def test_search_of_three_bundles(spark, block):
    """Blocks that are too small at first must not change the choice."""
    rnd = random.Random(4)
    rows = [(i, i % 4, rnd.randint(0, 3), rnd.choice([None, *range(9)]), rnd.choice([None, *range(9)]), rnd.choice([None, *range(9)])) for i in range(120)]
    df = spark.createDataFrame(rows, "row_no long, grp int, p int, x int, y int, z int")
    bundles = [survivors.Bundle(c, (c,), F.col(c).isNotNull()) for c in "xyz"]
    order = [F.col("p"), -F.col("row_no")]
    got = {r["grp"]: r for r in survivors.survivors(df, "grp", "row_no", bundles, order, depends=[("x", "y"), ("y", "z")], block=block).collect()}
    rank = lambda r: (r[2], -r[0])
    branched = 0
    for g in range(4):
        mine = [r for r in rows if r[1] == g]
        xy, yz = {(r[3], r[4]) for r in mine}, {(r[4], r[5]) for r in mine}
        want = best_choice(mine, rank, (3, 4, 5), lambda c: not (c[0] and c[1] and (c[0][3], c[1][4]) not in xy) and not (c[1] and c[2] and (c[1][4], c[2][5]) not in yz))  # noqa: B023
        assert [got[g][n] and got[g][n]["id"] for n in "xyz"] == [w and w[0] for w in want]
        assert got[g]["trust"] == sum(w[2] for w in want if w) <= got[g]["bound"]
        branched += got[g]["nodes"] > 3
    assert branched


def test_functional_dependency_makes_p3_branch(spark, tmp_path):
    """A row id that names two reads: its bundles may not be combined; groups without that are closed at the root."""
    at = datetime(2023, 1, 1)
    rows = [
        # grp 1: the best record and the best length have the same row id and different names
        (7, 1, "a", 0, 90, 3, None, None, "ACGT", at), (7, 1, "b", 0, 80, 3, 20, 9, None, at), (9, 1, "c", 0, 10, 3, 21, None, "AC", at),
        (3, 2, "d", 0, 50, 1, 5, None, "", at), (4, 2, "e", None, None, 1, None, 6, "GG", None), (5, 3, "f", 0, 1, 1, 1, 1, "A", at),
    ]
    spark.createDataFrame(rows, "row_no long, grp long, qname string, pflags int, priority int, ndups int, polya_len_1 int, polya_len_2 int, umi string, measured_at timestamp").write.parquet(f"{tmp_path}/tagaln.parquet")
    got = {(r["grp"], r["field"]): r["qname"] for r in queries.p3_found(spark, str(tmp_path)).collect()}
    # 90 + 80 + 80 + 90 is forbidden; b's record (80) with b's lengths and the other umi is best
    assert got == {(1, "record"): "b", (1, "polya_len_1"): "b", (1, "polya_len_2"): "b", (1, "umi"): "c", (2, "record"): "e", (2, "polya_len_1"): "d", (2, "polya_len_2"): "e", (2, "umi"): "e"}
    order, _ = queries._tag_rank()
    proof = {r["grp"]: r for r in survivors.survivors(table(spark, str(tmp_path), "tagaln"), "grp", "row_no", queries._tag_bundles(), order, functional=queries.TAG_DEPENDENCIES).collect()}
    assert proof[1]["nodes"] > 4 and proof[1]["trust"] < proof[1]["bound"]
    assert proof[2]["nodes"] == 4 and proof[2]["trust"] == proof[2]["bound"]


def test_every_group_of_p3_is_proven_best(spark, data):
    order, _ = queries._tag_rank()
    got = survivors.survivors(table(spark, data, "tagaln"), "grp", "row_no", queries._tag_bundles(), order, functional=queries.TAG_DEPENDENCIES, least_rows=2)
    assert got.filter("trust < bound OR nodes < 4").count() == 0 < got.count()


# ---- p4


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 30), st.floats(-1e6, 1e6)), min_size=1, max_size=300), min_size=1, max_size=9), st.sampled_from([0.002, 0.02, 0.1]))
def test_summaries_keep_their_error(parts, error):
    merged = quantiles.merge_all([quantiles.Summary.of_sorted(np.sort(np.array(p, dtype=float))).compressed(error / 2 * len(p)) for p in parts])
    merged = merged.compressed(error * merged.n)
    values = np.sort(np.concatenate([np.array(p, dtype=float) for p in parts]))
    assert merged.n == len(values) and merged.rank_error() <= max(1, np.ceil(error * merged.n))
    for q in (0.0, 0.1, 0.5, 0.9, 0.99, 1.0):
        v, rank = merged.quantile(q), max(1, int(np.ceil(q * len(values) - 1e-9)))
        below, upto = int((values < v).sum()), int((values <= v).sum())
        assert max(below + 1 - rank, rank - upto, 0) <= merged.rank_error()


def test_percentiles_on_odd_rows(spark):
    rows = [("a", 1.0)] * 50 + [("a", 2.0)] * 50 + [("b", None), ("b", float("nan")), (None, 5.0)]
    df = spark.createDataFrame(rows, "g string, x double").withColumn("part", F.lit(1)).withColumn("n", F.lit("clash"))
    out = {r["g"]: r for r in quantiles.percentiles(quantiles.summarize(df, ["g"], "x"), ["g"]).collect()}
    assert set(out) == {"a", None} and out["a"]["p50"] == 1.0 and out["a"]["p90"] == 2.0 and out["a"]["n"] == 100 and out["a"]["rank_error"] <= 1
    assert quantiles.summarize(df.limit(0), ["g"], "x").count() == 0


# ---- p7, p8


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.VOCABULARY)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_public_tokenizers(spark, data, public):
    folder = data.replace("0.001", "0.01")
    texts = {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").select("doc_id", "text").collect()}
    got = queries.p7_ids(spark, folder).collect()
    assert len(got) == len(texts)
    assert all(r["ids"] == (public(texts[r["doc_id"]]) if texts[r["doc_id"]] else []) for r in got)


PIECES = ["a", "b", "the", " ", "  ", "\n", "\r\n", "\t", "\xa0", "　", "²", "½", "Ⅷ", "\x1c", "\x85", "'s", "'ll", "1", "23", "!", "_", "__", "é", "ё", "日本", "\U0001f600", "​", "́", "\U000105c0", "<|endoftext|>", "٣", "—", "ab_c", "\u2003", "\u2028", "\u200a"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=20))
def test_any_text_is_encoded_alike(parts):
    from tokenizers import Tokenizer

    global _PUBLIC
    if "_PUBLIC" not in globals():
        _PUBLIC = Tokenizer.from_file(bpe.VOCABULARY)
        _PUBLIC.encode_special_tokens = True
    text = "".join(parts)
    assert list(array("i", bpe.encoder().encode_bytes(text))) == _PUBLIC.encode(text, add_special_tokens=False).ids


def test_very_long_texts(public):
    rnd = random.Random(3)
    for text in ("".join(rnd.choice("abcdefgh") for _ in range(60_000)), "a" * 60_000, " " * 50_000 + "x", "\n" * 30_000, "x " * 30_000):
        assert list(array("i", bpe.encoder().encode_bytes(text))) == public(text)


def test_encoding_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hello world"), (3, "hello world")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = [tuple(r) for r in tokenize.encode_corpus(df).collect()]
    assert sorted(got) == [(1, []), (2, []), (3, [31373, 995]), (3, [31373, 995])]
    assert [r["n_tokens"] for r in tokenize.count_tokens(df).orderBy("doc_id").collect()] == [0, 0, 2, 2]
    assert tokenize.encode_corpus(df.limit(0)).count() == 0


def test_mix_hits_its_targets(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c", None]), rnd.randint(0, 400)) for i in range(3000)]
    counts = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 3), ("c", 0.25, 1), ("none", 0.05, 2)], "source string, target_share double, max_repeats int")
    chosen = mix.mix_sources(counts, targets, seed=3)
    got, again = sorted(map(tuple, chosen.collect())), sorted(map(tuple, mix.mix_sources(counts, targets, seed=3).collect()))
    assert got == again and len({g[0] for g in got}) == len(got)
    have = Counter()
    for _, s, n in rows:
        have[s] += n
    total, used, most = sum(have.values()), Counter(), {"a": 1, "b": 3, "c": 1}
    for _, source, n, copies in got:
        assert 1 <= copies <= most[source] and n > 0
        used[source] += n * copies
    for source, share in (("a", 0.4), ("b", 0.3), ("c", 0.25)):
        assert abs(used[source] - min(share * total, have[source] * most[source])) <= 400
    report = {r["source"]: r for r in mix.mix_shares(chosen, counts, targets).collect()}
    assert report["none"]["shortfall_tokens"] == int(np.ceil(0.05 * total)) and report["a"]["shortfall_tokens"] == 0
    assert abs(sum(r["actual_share"] for r in report.values()) - 1) < 1e-9
    assert report["c"]["shortfall_tokens"] > 0 and report["c"]["actual_tokens"] == have["c"]
    assert mix.mix_sources(counts.limit(0), targets).count() == 0


def test_rounding_keeps_each_probability():
    w, p = np.array([3.0, 5.0, 2.0, 7.0, 4.0]), np.array([0.2, 0.5, 0.9, 0.3, 0.6])
    hits = np.zeros(5)
    for seed in range(4000):
        out = mix._round_run(p, w, np.random.default_rng(seed), True)
        assert set(out.tolist()) <= {0.0, 1.0} and abs(out @ w - p @ w) <= 7
        hits += out
    assert np.abs(hits / 4000 - p).max() < 0.04


def test_pieces_of_a_run_draw_anew(spark):
    """Over 50,000 rows in one bucket: every document's probability holds, no piece repeats another's draws."""
    n, p = 120_000, 0.3
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(10).cast("bigint").alias("n_tokens"), F.lit(0).alias("base"), F.lit(p).alias("p"), F.lit(0).cast("bigint").alias("bucket"))
    got = mix._round_level(rows, 1, 5, 0, True).toPandas().sort_values("doc_id")
    chosen = got["base"].to_numpy() > 0
    assert len(got) == n and got["done"].all() and abs(int(chosen.sum()) - n * p) <= 1
    pieces = [chosen[k : k + 40_000] for k in (0, 50_000)]
    assert 0.3 < (pieces[0] == pieces[1]).mean() < 0.7
    small = mix._round_level(rows.limit(2_000).coalesce(1), 1, 5, 0, True, piece=100).toPandas()
    assert len(small) == 2_000 and small["done"].all() and abs(int((small["base"] > 0).sum()) - 600) <= 1
    hits = np.zeros(40)
    few = rows.limit(40).cache()
    for seed in range(60):
        hits += mix._round_level(few, 1, seed, 0, True, piece=7).toPandas().sort_values("doc_id")["base"].to_numpy() > 0
    assert abs(hits.mean() / 60 - p) < 0.02 and np.abs(hits / 60 - p).max() < 0.25


# ---- p9


def test_held_out_texts_get_their_language(spark, data):
    """Trained on a sample; texts outside of it whose label isn't in doubt must be recognised."""
    folder = data.replace("0.001", "0.01")
    docs = table(spark, folder, "documents")
    codes = langid.label_codes(table(spark, folder, "languages"))
    sample = langid.sample_texts(docs, codes, 20)
    trees = langid.train(sample)
    seen = {i for i, _, _ in sample}
    rows = [r for r in langid.judge_documents(docs, trees, codes).collect() if r["para_no"] == 0 and r["doc_id"] not in seen and r["label"] in trees.languages]
    right = sum(r["label"] == r["lang"] for r in rows)
    # about a tenth of the labels is wrong on purpose
    assert len(rows) > 150 and right > 0.8 * len(rows)
    assert all(0 < r["confidence"] <= 1 for r in rows)


def test_passages_and_sentences():
    text = "== A b ==\r\n\r\nOne two three. Four five six!\r\n \r\n* x y z. a b c.\r\n\r\n\r\n{{t|One two three. Four five six.}} Only one here now."
    assert len(langid.passages(text)) == 4
    assert [k for k, _ in langid.judged(text)] == [2]
    assert not langid.full_sentences("3.14 is a number and no end.") and langid.full_sentences("この寺は狭いがまだ住んでいた。この城は美しいが当時は住んでいた。")
    assert langid.prose("[[a|b c]] '''d''' <ref>x. y.</ref>[[Category:Z]] e") .split() == ["b", "c", "d", "e"]


def test_labels(spark):
    codes = langid.label_codes(spark.createDataFrame([("en", "eng", "English"), ("pt", "por", "Portuguese")], "code string, code3 string, lang_name string"))
    rows = ["en", " EN ", "eng", "english", "en-GB", "en_US", "pt_BR", "und", "", None, "N/A", "-"]
    df = spark.createDataFrame([(r,) for r in rows], "l string").select(langid.label_code(F.col("l"), codes).alias("c"))
    assert [r["c"] for r in df.collect()] == ["en"] * 6 + ["pt"] + [None] * 5


def test_code_lengths_are_those_of_the_trees():
    trees = langid.Trees.fit({"x": Counter({"aba": 3}), "y": Counter({"bab": 1, "b": 1})})
    # a share of a byte after a context and its escape add up to one
    for at in range(2):
        for ctx in (b" ", b"a", b"b", b""):
            known = [g for g in trees.grams if g[:-1] == ctx and len(g) == len(ctx) + 1]
            sure = sum(2.0 ** -float(trees.bits[trees.grams[g]][at]) for g in known)
            assert sure <= 1 + 1e-5
    best, sure = langid.Judge(trees)(["aba", "aba"])
    assert trees.languages[best] == "x" and sure > 0.5
    assert langid.train([]).languages == []


def test_judging_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "no prose", "en")], "doc_id long, text string, lang string").withColumn("label", F.lit("clash")).withColumn("para_no", F.lit(9))
    trees = langid.Trees.fit({"en": Counter({"the": 3}), "de": Counter({"der": 3})})
    assert langid.judge_documents(docs, trees, {"en": "en"}).count() == 0
    assert langid.judge_documents(docs, langid.Trees.fit({}), {"en": "en"}).count() == 0


def test_wrong_label_and_foreign_passage(spark):
    en, de = "The man was in the house. The house was on the hill.", "Der Mann war in dem Haus. Das Haus war auf dem Berg."
    trees = langid.Trees.fit({"en": Counter(langid.words(en)), "de": Counter(langid.words(de))})
    docs = spark.createDataFrame([(1, f"{en}\n\n{en}\n\n{de}", "en"), (2, de, "en"), (3, de, None), (4, en, "EN")], "doc_id long, text string, lang string")
    got = {tuple(r) for r in langid.wrong_labels(langid.judge_documents(docs, trees, {"en": "en", "de": "de"})).collect()}
    assert got == {(1, 3, "de"), (2, 0, "de"), (3, 0, "de")}


def test_a_label_that_is_only_ever_wrong_is_no_language():
    rnd = random.Random(8)
    vocabulary = {"en": "the man was in house and road stood near old mill with many people", "de": "der mann war nicht auf dem berg und die alte stadt lag neben einem fluss", "fr": "la vieille ville est dans une vallée avec beaucoup de maisons et un pont"}

    def text(language):
        sentence = lambda: " ".join(rnd.choice(vocabulary[language].split()) for _ in range(9)).capitalize() + "."
        return "\n\n".join(f"{sentence()} {sentence()}" for _ in range(4))

    sample = [(i, language, text(language)) for i, language in enumerate(["en", "de", "fr"] * 40)]
    # a tenth of every label is wrong, and "ca" is given to texts of all three, as often as the others
    sample += [(1000 + i, "ca", text(rnd.choice(["en", "de", "fr"]))) for i in range(40)]
    sample += [(2000 + i, rnd.choice(["en", "de", "fr"]), text(rnd.choice(["en", "de", "fr"]))) for i in range(15)]
    trees = langid.train(sample, {"en": 900, "de": 500, "fr": 300, "ca": 60})
    assert trees.languages == ["de", "en", "fr"]
    judge = langid.Judge(trees)
    assert all(trees.languages[judge(langid.words(text(x)))[0]] == x for x in vocabulary for _ in range(20))


def test_a_language_of_one_text_is_found():
    """A single document of a language of its own is enough; a single wrong label isn't one."""
    rnd = random.Random(9)
    vocabulary = {"en": "the man was in house and road stood near old mill with many people", "de": "der mann war nicht auf dem berg und die alte stadt lag neben einem fluss", "fi": "vanha kylä sijaitsee järven rannalla eikä siellä ollut yhtään kauppaa silloin"}

    def text(language):
        sentence = lambda: " ".join(rnd.choice(vocabulary[language].split()) for _ in range(9)).capitalize() + "."
        return "\n\n".join(f"{sentence()} {sentence()}" for _ in range(4))

    sample = [(i, language, text(language)) for i, language in enumerate(["en", "de"] * 40)] + [(900, "fi", text("fi")), (901, "ca", text("de"))]
    trees = langid.train(sample, {"en": 900, "de": 500, "fi": 1, "ca": 1})
    assert trees.languages == ["de", "en", "fi"]
    judge = langid.Judge(trees)
    assert all(trees.languages[judge(langid.words(text(x)))[0]] == x for x in vocabulary for _ in range(20))


def test_the_sample_is_bounded_and_whole_where_few(spark):
    rows = [(i, "en" if i % 50 else "de", f"text {i}") for i in range(5000)] + [(9000, None, "x"), (9001, "xx", "y"), (None, "en", "z"), (9002, "de", None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = Counter(c for _, c, _ in langid.sample_texts(docs, {"en": "en", "de": "de"}, 120))
    assert got == {"en": 120, "de": 100}
    assert langid.sample_texts(docs.limit(0), {"en": "en"}) == []
