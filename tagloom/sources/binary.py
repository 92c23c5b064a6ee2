"""Readers of a sequencer's binary files: base calls, intensities, signal packs.

Base calls and intensities are stored by cycle, one file each; tables are wanted by
cluster. A partition is a range of clusters of a tile: its task reads that range of
every cycle's file and turns the block, so that nothing is shuffled and a tile of any
size is spread over tasks.
"""

from __future__ import annotations

import glob
import gzip
import itertools
import os
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tagloom.session import durable, keyed

BLOCK = 65_536
PACK_TYPE = "tile string, cluster bigint, first_cycle int, packets array<struct<score:int,downhill:boolean>>"


class _Range(InputPartition):
    def __init__(self, tile: str, files: list[str], start: int, stop: int) -> None:
        self.tile, self.files, self.start, self.stop = tile, files, start, stop


def _bytes(path: str, start: int, size: int) -> bytes:
    if os.path.exists(path):
        with open(path, "rb") as file:
            file.seek(start)
            return file.read(size)
    with gzip.open(f"{path}.gz", "rb") as file:
        file.seek(start)
        return file.read(size)


def call_file(root: str, lane: int, cycle: int, tile: int) -> str:
    return os.path.join(root, "BaseCalls", f"L{lane:03d}", f"C{cycle}.1", f"s_{lane}_{tile:04d}.bcl")


def intensity_file(root: str, lane: int, cycle: int, tile: int) -> str:
    return os.path.join(root, f"L{lane:03d}", f"C{cycle}.1", f"s_{lane}_{tile:04d}.cif")


def decode_calls(block: np.ndarray) -> tuple[list[str], list[str]]:
    """Sequences and qualities (Phred+33) of a (clusters x cycles) block of call bytes; byte 0 is N of quality 2."""
    bases, quals = np.frombuffer(b"ACGT", dtype=np.uint8)[block & 3], (block >> 2) + 33
    none = block == 0
    bases, quals = np.where(none, ord("N"), bases).astype(np.uint8), np.where(none, 35, quals).astype(np.uint8)
    width = block.shape[1]
    cut = lambda a: [x.decode("ascii") for x in np.ascontiguousarray(a).view(f"S{width}").ravel()] if width else [""] * len(block)
    return cut(bases), cut(quals)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.lane = options["path"], int(options.get("lane", "1"))
        first, last = (int(x) for x in options["cycles"].split("-"))
        self.cycles = range(first, last + 1)
        self.tiles = [int(x) for x in options["tiles"].split(",")]

    def partitions(self) -> Sequence[InputPartition]:
        out = []
        for tile in self.tiles:
            files = [self.name(self.root, self.lane, c, tile) for c in self.cycles]
            counts = {self.count(f) for f in files}
            if len(counts) != 1:
                raise ValueError(f"tile {tile}: cycles hold different numbers of clusters: {sorted(counts)}")
            n = counts.pop()
            out += [_Range(str(tile), files, s, min(n, s + BLOCK)) for s in range(0, n, BLOCK)]
        return out


class _CallReader(_Reader):
    name = staticmethod(call_file)

    @staticmethod
    def count(path: str) -> int:
        return struct.unpack("<I", _bytes(path, 0, 4))[0]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        size = part.stop - part.start
        block = np.stack([np.frombuffer(_bytes(f, 4 + part.start, size), dtype=np.uint8) for f in part.files], axis=1)
        seq, qual = decode_calls(block)
        yield pa.RecordBatch.from_arrays([pa.array([part.tile] * size), pa.array(np.arange(part.start, part.stop)), pa.array(seq), pa.array(qual)], names=["tile", "cluster", "seq", "qual"])


class _IntensityReader(_Reader):
    name = staticmethod(intensity_file)

    @staticmethod
    def count(path: str) -> int:
        magic, version, size, _, _, clusters = struct.unpack("<3sBBHHI", _bytes(path, 0, 13))
        if magic != b"CIF" or version != 1 or size != 2:
            raise ValueError(f"{path} is no intensity file of version 1 with two-byte values")
        return clusters

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        n, size = self.count(part.files[0]), part.stop - part.start
        # each file holds four planes of n values
        cube = np.stack([np.stack([np.frombuffer(_bytes(f, 13 + 2 * (plane * n + part.start), 2 * size), dtype="<i2") for plane in range(4)], axis=1) for f in part.files], axis=1)
        cells = pa.array(cube.astype(np.int16).ravel(), pa.int16())
        inner = pa.ListArray.from_arrays(pa.array(np.arange(0, size * len(part.files) * 4 + 1, 4, dtype=np.int32)), cells)
        outer = pa.ListArray.from_arrays(pa.array(np.arange(0, size * len(part.files) + 1, len(part.files), dtype=np.int32)), inner)
        yield pa.RecordBatch.from_arrays([pa.array([part.tile] * size), pa.array(np.arange(part.start, part.stop)), outer], names=["tile", "cluster", "cycles"])


class BaseCalls(DataSource):
    """Options: path, lane, cycles (first-last), tiles (comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return "basecalls"

    def schema(self) -> str:
        return "tile string, cluster bigint, seq string, qual string"

    def reader(self, schema) -> DataSourceReader:
        return _CallReader(dict(self.options))


class Intensities(DataSource):
    """Options as of BaseCalls; cycles are arrays of four channels."""

    @classmethod
    def name(cls) -> str:
        return "intensities"

    def schema(self) -> str:
        return "tile string, cluster bigint, cycles array<array<smallint>>"

    def reader(self, schema) -> DataSourceReader:
        return _IntensityReader(dict(self.options))


class _FastqReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path.removeprefix("file://").removeprefix("file:")

    def partitions(self) -> Sequence[InputPartition]:
        names = sorted(os.path.join(self.path, n) for n in os.listdir(self.path) if n[0] not in "._") if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        return [InputPartition(n) for n in names]

    def read(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        """Records by counting lines: quality lines may begin with any letter. A cut-off last record is an error."""
        opened = gzip.open if part.value.endswith(".gz") else open
        with opened(part.value, "rt", encoding="utf-8", newline="\n") as file:
            while lines := [x.rstrip("\r\n") for x in itertools.islice(file, 4 * BLOCK)]:
                while lines and not lines[-1]:
                    lines.pop()
                if len(lines) % 4 or any(not x.startswith("@") for x in lines[::4]):
                    raise ValueError(f"{part.value} isn't made of records of four lines")
                yield pa.RecordBatch.from_arrays([pa.array([x[1:].split(" ")[0] for x in lines[::4]]), pa.array(lines[1::4]), pa.array(lines[3::4])], names=["name", "seq", "qual"])


class FastqFiles(DataSource):
    """Option: path (a file, a folder or a pattern)."""

    @classmethod
    def name(cls) -> str:
        return "fastqfiles"

    def schema(self) -> str:
        return "name string, seq string, qual string"

    def reader(self, schema) -> DataSourceReader:
        return _FastqReader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqFiles)
    spark.dataSource.register(BaseCalls)
    spark.dataSource.register(Intensities)


def signal_packs(spark: SparkSession, path: str) -> DataFrame:
    """Signal packs (one file per tile, named by it): the size of a packet, the number of clusters and of
    packets a record, then records of fixed size.

    A record is cluster, first cycle, number of valid cycles and packets of one downhill
    bit and a 24-bit score (0: dark).
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_py()
                size, _, length = struct.unpack("<3I", data[:12])
                kind = np.dtype([("cluster", "<u4"), ("first", "<i2"), ("valid", "<i2"), ("packets", f"<u{size}", (length,))])
                records = np.frombuffer(data, dtype=kind, offset=12)
                tile = os.path.basename(name).split(".")[0]
                for s in range(0, len(records), BLOCK):
                    r = records[s : s + BLOCK]
                    valid = np.clip(r["valid"], 0, length)
                    keep = np.arange(length)[None, :] < valid[:, None]
                    packets = r["packets"][keep].astype(np.int64)
                    values = pa.StructArray.from_arrays([pa.array((packets >> 1) & 0xFFFFFF, pa.int32()), pa.array((packets & 1).astype(bool))], names=["score", "downhill"])
                    ends = np.concatenate(([0], np.cumsum(valid))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([tile] * len(r)), pa.array(r["cluster"].astype(np.int64)), pa.array(r["first"].astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), values)], names=["tile", "cluster", "first_cycle", "packets"])

    return files.mapInArrow(run, PACK_TYPE)


COUNTS_TYPE = "tile string, kind string, cycle int, bin int, n bigint"


def score_counts(spark: SparkSession, path: str) -> DataFrame:
    """Score counts per cycle and bin from binary matrices, one file per tile and kind.

    A file (plain or gzip-compressed, named <kind>_…_<tile>.<ext>) begins with the size of an
    element, the cycles and the bins, as four-byte numbers; another size than four, or a
    length that doesn't fit, is an error. Counts of 0 give no row: the long form of the
    matrix is what the cut-off fit takes.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                size, cycles, bins = struct.unpack("<3I", data[:12])
                if size != 4:
                    raise ValueError(f"{name}: elements of {size} bytes, not 4")
                if len(data) != 12 + size * cycles * bins:
                    raise ValueError(f"{name}: {len(data)} bytes don't hold {cycles} cycles of {bins} bins")
                counts = np.frombuffer(data, dtype="<u4", offset=12).reshape(cycles, bins)
                cycle, at = np.nonzero(counts)
                base = os.path.basename(name)
                tile, kind = base.rsplit("_", 1)[-1].split(".")[0], base.split("_", 1)[0]
                yield pa.RecordBatch.from_arrays([pa.array([tile] * len(at)), pa.array([kind] * len(at)), pa.array(cycle, pa.int32()), pa.array(at, pa.int32()), pa.array(counts[cycle, at].astype(np.int64))], names=["tile", "kind", "cycle", "bin", "n"])

    return files.mapInArrow(run, COUNTS_TYPE)


def pack_bytes(first: np.ndarray, cluster: np.ndarray, packets: list[list[tuple[int, bool]]], length: int) -> bytes:
    """Records of signal packs: packets over ``length`` are an error, missing ones are zeros."""
    kind = np.dtype([("cluster", "<u4"), ("first", "<i2"), ("valid", "<i2"), ("packets", "<u4", (length,))])
    out = np.zeros(len(cluster), dtype=kind)
    out["cluster"], out["first"] = cluster, first
    for i, own in enumerate(packets):
        if len(own) > length:
            raise ValueError(f"cluster {cluster[i]} has {len(own)} cycles, more than {length}")
        out["valid"][i] = len(own)
        out["packets"][i, : len(own)] = [(score << 1) | bool(down) for score, down in own]
    return out.tobytes()


def write_signal_packs(df: DataFrame, path: str, length: int) -> DataFrame:
    """Writes (tile, cluster, first_cycle, packets) as one file of signal packs per tile and
    returns (tile, path, n).

    The folder must be mounted on all machines. A tile is a file by the format's
    definition, so its rows stream through one task, in order of cluster; a file appears
    under its name only when it is whole, so a task that runs again does no harm. Rows
    with a null tile or cluster are left out, null packets are none.
    """
    folder = path.removeprefix("file://").removeprefix("file:")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        done: list[tuple[str, str, int]] = []
        tile, file, n = None, None, 0

        def close() -> None:
            if file is not None:
                file.seek(4)
                file.write(struct.pack("<I", n))
                file.close()
                target = os.path.join(folder, f"{tile}.sigpack")
                os.replace(file.name, target)
                done.append((tile, target, n))

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            start = 0
            while start < len(cols[0]):
                stop = next((i for i in range(start, len(cols[0])) if cols[0][i] != cols[0][start]), len(cols[0]))
                if cols[0][start] != tile:
                    close()
                    tile, n = cols[0][start], 0
                    file = open(os.path.join(folder, f".{tile}.{os.getpid()}.{uuid.uuid4().hex}"), "wb")  # noqa: SIM115
                    file.write(struct.pack("<3I", 4, 0, length))
                packets = [[(p["score"], p["downhill"]) for p in own or []] for own in cols[3][start:stop]]
                file.write(pack_bytes(np.array(cols[2][start:stop]), np.array(cols[1][start:stop]), packets, length))
                n += stop - start
                start = stop
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.int64())], names=["tile", "path", "n"])

    rows = df.select("tile", "cluster", "first_cycle", "packets").filter("tile IS NOT NULL AND cluster IS NOT NULL")
    return durable(keyed(rows, "tile").sortWithinPartitions("tile", "cluster").mapInArrow(run, "tile string, path string, n bigint"))
