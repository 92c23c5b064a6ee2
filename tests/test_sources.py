"""Readers and writers on synthetic files."""

from __future__ import annotations

import gzip
import os
import struct

import numpy as np
from pyspark.sql import functions as F

from tagloom import sinks
from tagloom.sources import binary, text


def test_binary_calls_and_intensities(spark, tmp_path):
    n, cycles = 70_000, 3
    rnd = np.random.default_rng(0)
    calls = rnd.integers(0, 256, (cycles, n), dtype=np.uint8)
    cube = rnd.integers(-500, 500, (cycles, 4, n), dtype=np.int16)
    for c in range(cycles):
        for name, data in ((binary.call_file(str(tmp_path), 1, c + 1, 1101), struct.pack("<I", n) + calls[c].tobytes()), (binary.intensity_file(str(tmp_path), 1, c + 1, 1101), struct.pack("<3sBBHHI", b"CIF", 1, 2, c + 1, 1, n) + cube[c].tobytes())):
            os.makedirs(os.path.dirname(name), exist_ok=True)
            if c == 1 and name.endswith(".bcl"):
                with gzip.open(name + ".gz", "wb") as f:
                    f.write(data)
            else:
                with open(name, "wb") as f:
                    f.write(data)
    binary.register(spark)
    options = {"lane": "1", "cycles": "1-3", "tiles": "1101"}
    seqs = spark.read.format("basecalls").options(**options).load(str(tmp_path))
    assert seqs.count() == n
    for r in seqs.filter("cluster IN (0, 7, 69999)").collect():
        column = calls[:, r["cluster"]]
        assert r["seq"] == "".join("N" if b == 0 else "ACGT"[b & 3] for b in column)
        assert r["qual"] == "".join("#" if b == 0 else chr((b >> 2) + 33) for b in column)
    raw = spark.read.format("intensities").options(**options).load(str(tmp_path)).filter("cluster IN (3, 69998)").collect()
    assert all(r["cycles"] == cube[:, :, r["cluster"]].tolist() for r in raw) and len(raw) == 2


def test_signal_packs(spark, tmp_path):
    length = 4
    data = struct.pack("<3I", 4, 9, length)
    data += struct.pack("<Ihh4I", 5, 20, 3, (7 << 1) | 1, 0, 100 << 1, 999)
    data += struct.pack("<Ihh4I", 6, 21, 0, 1, 1, 1, 1)
    (tmp_path / "t1101.sigpack").write_bytes(data)
    got = [tuple(r) for r in binary.signal_packs(spark, str(tmp_path)).collect()]
    assert [(t, c, f, [tuple(p) for p in ps]) for t, c, f, ps in got] == [("t1101", 5, 20, [(7, True), (0, False), (100, False)]), ("t1101", 6, 21, [])]


def test_text_formats(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("1\t\\N\tx\n2\t3\t\n")
    rows = text.delimited(spark, str(tmp_path / "d.tsv"), "a int, b int, c string", null="\\N").collect()
    assert [tuple(r) for r in rows] == [(1, None, "x"), (2, 3, "")]
    (tmp_path / "g.fa").write_text(">c1 first\nACGTACGTAC\nGTAC\n>c2\nTTTT\n")
    genome = text.fasta(spark, str(tmp_path / "g.fa"), 5)
    assert sorted(map(tuple, genome.collect())) == [("c1", 0, "ACGTA"), ("c1", 1, "CGTAC"), ("c1", 2, "GTAC"), ("c2", 0, "TTTT")]
    regions = spark.createDataFrame([("a", "c1", 3, 12, "+"), ("b", "c1", -4, 6, "-"), ("c", "c2", 2, 99, "+")], "name string, chrom string, start long, end long, strand string")
    assert {r["name"]: r["seq"] for r in text.fetch_sequences(regions, genome, 5).collect()} == {"a": "TACGTACGT", "b": "GTACGT", "c": "TT"}
    (tmp_path / "a.gtf").write_text("#!x\nchr1\ts\texon\t11\t20\t.\t+\t.\tgene_id \"g\";\n")
    r = text.gtf(spark, str(tmp_path / "a.gtf")).first()
    assert (r["start"], r["end"], r["attribute"]) == (11, 20, 'gene_id "g";')
    (tmp_path / "q.fastq").write_text("@r1 x\nACGT\n+\n@@II\n@r2\nTT\n+r2\n@I\n")
    assert [tuple(r) for r in text.fastq(spark, str(tmp_path / "q.fastq")).collect()] == [("r1", "ACGT", "@@II"), ("r2", "TT", "@I")]
    seqs = spark.createDataFrame([("x", "Homo sapiens rRNA", "ACUU"), ("y", "Mus", "A")], "name string, header string, seq string")
    assert [r["seq"] for r in text.contaminants(seqs, "header", "Homo sapiens").collect()] == ["ACTT"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "t1", 1, "ACGTAC", 2), ("s", "t2", 2, "TTTT", -1)], "sample string, tile string, cluster long, seq string, delim int")
    cut = df.select(sinks.trimmed_read3(F.col("seq"), F.col("delim"), F.lit(1), 3)).collect()
    assert [r[0] for r in cut] == ["GTA", "TTT"]
    sinks.write_tags(df, str(tmp_path / "tags"))
    assert spark.read.parquet(str(tmp_path / "tags")).filter("tile = 't2'").count() == 1
    sinks.write_sorted(df, str(tmp_path / "sorted"), ["tile", "nothing"])
    sinks.write_statistics(df, str(tmp_path / "stats"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "stats.csv")).count() == 2
    assert df.select(sinks.fasta_lines(F.col("tile"), F.col("seq"), 4)).first()[0] == ">t1\nACGT\nAC"


def test_signal_packs_round_trip(spark, tmp_path):
    rows = [("t1", 7, 3, [(5, True), (0, False)]), ("t1", 2, -1, []), ("t2", 9, 4, [((1 << 24) - 1, False)] * 4), ("t2", 10, 1, None), (None, 1, 1, [])]
    df = spark.createDataFrame(rows, "tile string, cluster long, first_cycle int, packets array<struct<score:int,downhill:boolean>>")
    written = binary.write_signal_packs(df, str(tmp_path / "packs"), 4)
    assert {(r["tile"], r["n"]) for r in written.collect()} == {("t1", 2), ("t2", 2)}
    got = {(t, c, f): [tuple(p) for p in ps] for t, c, f, ps in (tuple(r) for r in binary.signal_packs(spark, str(tmp_path / "packs")).collect())}
    assert got == {(t, c, f): p or [] for t, c, f, p in rows if t}
    import pytest

    with pytest.raises(ValueError):
        binary.pack_bytes(np.array([1]), np.array([2]), [[(1, True)] * 3], 2)


def test_score_counts(spark, tmp_path):
    counts = np.arange(12, dtype="<u4").reshape(3, 4)
    (tmp_path / "pos_x_t7.sigdists").write_bytes(gzip.compress(struct.pack("<3I", 4, 3, 4) + counts.tobytes()))
    (tmp_path / "neg_x_t7.sigdists").write_bytes(struct.pack("<3I", 4, 1, 2) + np.array([0, 9], dtype="<u4").tobytes())
    got = {tuple(r) for r in binary.score_counts(spark, str(tmp_path)).collect()}
    assert got == {("t7", "pos", c, b, int(counts[c, b])) for c in range(3) for b in range(4) if counts[c, b]} | {("t7", "neg", 0, 1, 9)}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "pos_x_t8.sigdists").write_bytes(struct.pack("<3I", 8, 1, 1) + b"0" * 8)
    try:
        binary.score_counts(spark, str(tmp_path / "bad")).collect()
        raise AssertionError("no error")
    except Exception as e:
        assert "8 bytes" in str(e)


def test_seqqual(spark, tmp_path):
    df = spark.createDataFrame([("s", "t", 1, "ACGTACGTAC", "ABCDEFGHIJ", 6), ("s", "t", 2, "ACGTACGTAC", "ABCDEFGHIJ", -1)], "sample string, tile string, cluster long, seq string, qual string, d int")
    sinks.write_seqqual(df, str(tmp_path / "q"), (0, 3), "d", 4, 3)
    got = spark.read.schema("cluster long, seq5 string, qual5 string, seq3 string, qual3 string, sample string, tile string").option("sep", "\t").csv(str(tmp_path / "q"))
    assert sorted(tuple(r)[:5] for r in got.collect()) == [(1, "ACG", "ABC", "GTA", "GHI"), (2, "ACG", "ABC", "ACG", "EFG")]


def test_many_sam_tags(spark, tmp_path):
    (tmp_path / "a.sam").write_text("t:1\t0\tc\t1\t9\t2M\t*\t0\t0\tAC\tII\t" + "\t".join(f"{a}{b}:i:{k}" for k, (a, b) in enumerate((chr(65 + i // 26 % 26), chr(97 + i % 26)) for i in range(600))) + "\nt:2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    rows = {r["cluster"]: r["tags"] for r in text.sam(spark, str(tmp_path)).collect()}
    assert len(rows[1]) == 600 and rows[1]["Aa"] == "0" and rows[2] == {}
