"""Packed fields, wide tables, orphan references: against plain Python, and on odd inputs."""

from __future__ import annotations

import re
from datetime import datetime

import pyarrow.dataset as ds
from pyspark.sql import functions as F

from tagloom.operators import orphans, packed, wide
from tagloom.plans import problems

LISTS = set(problems.LIST_NAMES)


def parse(text):
    """Entries of an attribute field, letter by letter."""
    out, i, entry = [], 0, []
    text = text or ""
    spans = []
    while i < len(text):
        c = text[i]
        if c in "\"'" and (not entry or entry[-1] in " \t=\n"):
            j, inside = i + 1, []
            while j < len(text):
                if text[j] == "\\" and j + 1 < len(text):
                    inside.append(text[j + 1] if text[j + 1] in "\"'" else text[j : j + 2])
                    j += 2
                elif text[j] == c and text[j + 1 : j + 2] == c:
                    inside.append(c)
                    j += 2
                elif text[j] == c:
                    break
                else:
                    inside.append(text[j])
                    j += 1
            if j < len(text):
                spans.append("".join(inside))
                entry.append(chr(0xE000 + len(spans) - 1))
                i = j + 1
                continue
        if c in ";|":
            out.append("".join(entry))
            entry = []
        else:
            entry.append(c)
        i += 1
    out.append("".join(entry))
    rows = []
    for e in (x.strip() for x in out):
        if not e:
            continue
        m = re.match(r"([^\s=]+)(?:\s*=\s*|\s+)?(.*)$", e, re.S)
        name, value = m.group(1).lower(), m.group(2)
        value = re.sub("[\ue000-\uf8ff]", lambda k: spans[ord(k.group()) - 0xE000], value).strip()
        members = re.findall(r"[A-Za-z0-9_:.\-]+", value) if name in LISTS else []
        rows += [(name, x) for x in members] or [(name, value)]
    return rows


def gtf_rows(folder):
    return ds.dataset(f"{folder}/gtf.parquet").to_table().to_pylist()


def expected_p1(rows):
    best = {}
    for r in rows:
        feature = (r["feature"] or "").lower()
        if feature not in problems.ENTITY_ID:
            continue
        cells, entity = [], None
        for pos, (name, value) in enumerate(x for x in parse(r["attribute"]) if x[0] not in LISTS):
            if name in problems.NUMBER_NAMES:
                m = re.match(r"\d+", value)
                value = str(int(m.group())) if m else None
            elif not re.search("[A-Za-z0-9]", value) or value.lower() in ("na", "n/a", "null"):
                value = None
            if value is not None:
                cells.append((name, value, pos))
                if name == problems.ENTITY_ID[feature]:
                    entity = value
        if entity is None:
            continue
        for name, value, pos in cells:
            key, rank = (feature, entity, name), (r["loaded_at"] or datetime.min, r["line_no"], pos)
            if key not in best or rank > best[key][0]:
                best[key] = (rank, value)
    return {(*k, v[1]) for k, v in best.items()}


def test_packed_against_a_plain_parser(spark, data):
    rows = gtf_rows(data.replace("0.001", "0.01"))
    want = {(r["line_no"], i, n, v) for r in rows for i, (n, v) in enumerate(parse(r["attribute"]), 1)}
    got = problems.p5_found(spark, data.replace("0.001", "0.01")).collect()
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_wide_against_plain_python(spark, data):
    folder = data.replace("0.001", "0.01")
    got = problems.p1_found(spark, folder).collect()
    want = expected_p1(gtf_rows(folder))
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_packed_odd_fields(spark):
    long = 'note "' + 'a\\"b' * 30000 + '"; x "y"'
    rows = [(1, long), (2, 'n "a""b"'), (3, 'a "x\x010\x02y"; b \x010\x02'), (4, None), (5, 'a "open; b c'), (6, "c 'it''s'|d e"), (7, " ;; "), (8, 'k ""'), (8, 'k ""'), (9, "tag=A,B ; tag"), (10, 'q "1;2|3"')]
    # columns that could clash with the operator's own names are not looked at
    df = spark.createDataFrame(rows, "line_no long, attribute string").withColumn("pos", F.lit("p")).withColumn("attr_name", F.lit(1))
    got = {}
    for r in packed.explode_packed(df, "attribute", ["line_no"], ["tag"]).collect():
        got.setdefault(r["line_no"], []).append((r["pos"], r["attr_name"], r["attr_value"]))
    assert got[1] == [(1, "note", 'a"b' * 30000), (2, "x", "y")]
    assert got[2] == [(1, "n", 'a"b')]
    assert got[3] == [(1, "a", "x\x010\x02y"), (2, "b", "\x010\x02")]
    assert 4 not in got and 7 not in got
    assert got[5] == [(1, "a", '"open'), (2, "b", "c")]
    assert got[6] == [(1, "c", "it's"), (2, "d", "e")]
    assert got[8] == [(1, "k", "")] * 2
    assert got[9] == [(1, "tag", "A"), (2, "tag", "B"), (3, "tag", "")]
    assert got[10] == [(1, "q", "1;2|3")]
    empty = spark.createDataFrame([], "line_no long, attribute string")
    assert packed.explode_packed(empty, "attribute", ["line_no"]).count() == 0


def test_wide_keeps_what_does_not_cast(spark):
    rows = [("e", "n", "7", 1), ("e", "n", "99999999999999999999", 2), ("e", "t", "x", 1), ("e", "u", "y", 1), (None, "t", "z", 1)]
    df = spark.createDataFrame(rows, "entity string, name string, value string, at int")
    table = wide.widen(df, ["entity"], "name", "value", {"n": "bigint", "t": "string"}, [F.col("at")])
    out = {r["entity"]: r for r in table.collect()}
    assert out["e"]["n"] is None and out["e"]["cast_failures"] == {"n": "99999999999999999999"}
    assert out["e"]["t"] == "x" and out["e"]["other"] == {"u": "y"}
    assert out[None]["t"] == "z"
    cells = {tuple(r) for r in wide.unpivot_wide(table, ["entity"], ["n", "t"]).collect()}
    assert cells == {("e", "n", "99999999999999999999"), ("e", "t", "x"), ("e", "u", "y"), (None, "t", "z")}


def test_orphans_on_odd_keys(spark):
    early, late = datetime(2023, 1, 1), datetime(2023, 5, 1)
    parents = spark.createDataFrame([(1, early, None), (2, late, None), (2, late, early), (3, early, early), (1023, early, None), (1024, early, None), (None, early, None)], "k long, loaded timestamp, deleted timestamp")
    states = orphans.parent_states([(parents, F.col("k"), F.lit("t"), F.col("loaded"), F.col("deleted"))])
    spans = {(r["bucket"], r["start"], r["end"]) for r in orphans.key_runs(states).collect()}
    assert spans == {(0, 1, 3), (3, 1023, 1023), (4, 1024, 1024)}
    march = datetime(2023, 3, 1)
    values = [" 1", "001", "2.0", "3", "4", "1023", "1024", "1025", "-5", "x", "", " ", "\\N", None, "9" * 60]
    refs = spark.createDataFrame([(i, v, "t", march) for i, v in enumerate(values)] + [(90, "1", None, march), (91, "1", "other", march), (92, "2", "t", None)], "row_no long, ref string, kind string, loaded timestamp")
    got = {r["row_no"]: (r["period"], r["kind"]) for r in orphans.orphan_references(refs, F.col("ref"), F.col("kind"), F.col("loaded"), states, [F.col("row_no")]).collect()}
    want = {2: "late", 3: "deleted", 4: "missing", 7: "missing", 8: "missing", 9: "missing", 14: "missing", 90: "missing", 91: "missing"}
    assert got == {k: ("2023-03", v) for k, v in want.items()}
    none = orphans.parent_states([(parents.limit(0), F.col("k"), F.lit("t"), F.col("loaded"), F.col("deleted"))])
    assert orphans.orphan_references(refs.filter("row_no < 2"), F.col("ref"), F.col("kind"), F.col("loaded"), none, [F.col("row_no")]).count() == 2
