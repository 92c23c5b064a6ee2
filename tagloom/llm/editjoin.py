"""Near-duplicate records with small edits: a size-aware heavy-light join.

A record is a short string (or two: the second is the first with its two segments
exchanged) at a place. Two records are linked if their places are at most ``reach``
apart and the strings at most ``edits`` (2) edits apart.

As a set, a string is its pieces. Two edits touch at most two pieces, so what is left is
shared, at places that are shifted by as much as the edits allow:

* Small sets: cut into four pieces, of which two survive. All subsets of the fixed size
  two are enumerated (six), and two small sets are candidates if they share a subset.
* Large sets: cut into three pieces, of which one survives. Each scans the inverted
  lists of the pieces of all sets of its own length or up to two letters shorter, large
  or small.

The boundary between small and large is a length, chosen by cost: scanning has few
probes, but long lists of candidates to check; subsets have more probes and lists that
are shorter by far. In a task the lists' lengths are known before they are scanned, and
each stretch of places gets the cheapest boundary: quiet places scan, crowded ones
enumerate. Candidates of either kind are verified by a banded edit distance.

Copies (the same string at the same position) are one class from the start; links are
found between classes, and rows are paired only at the last step, if at all.

Distribution: classes are shuffled once by stretch of places, the last ``reach`` places
of a stretch also to the next. A stretch of more than ``heavy`` classes never goes to
one task: its keys, whole numbers made in Arrow batches, are joined in the cluster, with
a boundary from the same costs and one aggregate of the lists' lengths.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import keyed, stored

EDITS = 2
STRETCH = 256
#: Classes of a stretch that one task takes at most; more are joined in the cluster.
HEAVY = 80_000
CHUNK_ROWS = 40_000
#: Probes looked up at once, and candidates held before they are verified.
PROBES_AT_ONCE = 4_000_000
CANDIDATES_AT_ONCE = 1_000_000
#: Measured costs, in units of a probe: an entry of an index, and a candidate that is checked.
LISTED, CHECKED = 1.3, 4.0
#: Candidates that subsets leave of those of the lists: two quarters instead of a third, by four times the probes.
LEFT = 1 / 16
_R = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(1, n + 1):
            out[i] = out[i - 1] * _R
    return out


class _Class:
    """All strings of one length: their letters and prefix hashes."""

    def __init__(self, length: int, at: np.ndarray, letters: np.ndarray) -> None:
        self.length, self.at, self.letters = length, at, letters
        self.prefix = np.zeros((len(at), length + 1), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(length):
                self.prefix[:, i + 1] = self.prefix[:, i] * _R + letters[:, i].astype(np.uint64) + np.uint64(1)

    def part(self, start: int, size: int, power: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return self.prefix[:, start + size] - self.prefix[:, start] * power[size]


def parts_of(length: int, count: int = EDITS + 1) -> list[tuple[int, int]]:
    """(start, size) of the pieces of a string; sizes differ by one at most."""
    small, extra = divmod(length, count)
    out, start = [], 0
    for i in range(count):
        size = small + (i >= count - extra)
        out.append((start, size))
        start += size
    return out


def starts_in(longer: int, shorter: int, i: int) -> range:
    """Where piece i of a string of length ``shorter`` can start in one of length
    ``longer``, if that piece is the one whose left and right sides have few edits."""
    start, size = parts_of(shorter)[i]
    more = longer - shorter
    lo = max(start - i, start + more - (EDITS - i), 0)
    hi = min(start + i, start + more + (EDITS - i), longer - size)
    return range(lo, hi + 1)


QUARTERS = EDITS + 2
SUBSETS = [(i, j) for i in range(QUARTERS) for j in range(i + 1, QUARTERS)]


@functools.cache
def subset_starts(longer: int, shorter: int, i: int, j: int) -> list[tuple[int, int]]:
    """Where quarters i and j of a string of length ``shorter`` can start in one of length
    ``longer`` if they are its first two that no edit touches: every quarter before or
    between them takes an edit, and so does every letter of shift."""
    quarters, more = parts_of(shorter, QUARTERS), longer - shorter
    out = []
    for a in range(-EDITS, EDITS + 1):
        for b in range(-EDITS, EDITS + 1):
            if max(i, abs(a)) + max(j - i - 1, abs(b - a)) + abs(more - b) <= EDITS:
                x, y = quarters[i][0] + a, quarters[j][0] + b
                if x >= 0 and x + quarters[i][1] <= y and y + quarters[j][1] <= longer:
                    out.append((x, y))
    return out


def _tag(*x: int) -> np.uint64:
    return _mix(np.uint64(hash(x) & 0xFFFFFFFFFFFFFFFF))


def listed_parts(c: _Class, power: np.ndarray) -> Iterator[np.ndarray]:
    """Keys of a class's inverted lists."""
    for i, (start, size) in enumerate(parts_of(c.length)):
        yield _mix(c.part(start, size, power) ^ _tag(c.length, i))


def listed_subsets(c: _Class, power: np.ndarray) -> Iterator[np.ndarray]:
    """Keys of a class's enumerated subsets."""
    q = parts_of(c.length, QUARTERS)
    for i, j in SUBSETS:
        yield _mix(_mix(c.part(*q[i], power) ^ _tag(c.length, i, j)) + c.part(*q[j], power))


def probed_parts(c: _Class, power: np.ndarray, lengths: Iterable[int]) -> Iterator[np.ndarray]:
    """Keys of the lists, of strings of ``lengths``, that a class scans."""
    for shorter in range(max(c.length - EDITS, 1), c.length + 1):
        if shorter in lengths:
            for i, (_, size) in enumerate(parts_of(shorter)):
                for s in starts_in(c.length, shorter, i):
                    yield _mix(c.part(s, size, power) ^ _tag(shorter, i))


def probed_subsets(c: _Class, power: np.ndarray, lengths: Iterable[int]) -> Iterator[np.ndarray]:
    """Keys of the subsets, of strings of ``lengths``, that a class can share."""
    for shorter in range(max(c.length - EDITS, 1), c.length + 1):
        if shorter in lengths:
            q = parts_of(shorter, QUARTERS)
            for i, j in SUBSETS:
                for x, y in subset_starts(c.length, shorter, i, j):
                    yield _mix(_mix(c.part(x, q[i][1], power) ^ _tag(shorter, i, j)) + c.part(y, q[j][1], power))


def costs(length: int, lengths: Iterable[int], hits: np.ndarray | float) -> tuple[np.ndarray | float, np.ndarray | float]:
    """Cost of scanning and of enumerating strings of a length that find ``hits`` candidates in the lists."""
    met = [m for m in range(max(length - EDITS, 1), length + 1) if m in lengths]
    scans = sum(len(starts_in(length, m, i)) for m in met for i in range(EDITS + 1))
    subsets = sum(len(subset_starts(length, m, i, j)) for m in met for i, j in SUBSETS)
    return LISTED * (EDITS + 1) + scans + CHECKED * hits, LISTED * len(SUBSETS) + subsets + CHECKED * LEFT * hits


def within_two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of letters a (m x la) and b (m x lb): is the edit distance at most 2?"""
    la, lb = a.shape[1], b.shape[1]
    if abs(la - lb) > EDITS:
        return np.zeros(len(a), dtype=bool)
    width, far = 2 * EDITS + 1, np.int8(100)
    # row[d] is the distance of the first i letters of a and the first i + d - EDITS of b
    row = [np.full(len(a), d - EDITS if d >= EDITS and d - EDITS <= lb else far, dtype=np.int8) for d in range(width)]
    for i in range(1, la + 1):
        new = []
        for d in range(width):
            j = i + d - EDITS
            if j < 0 or j > lb:
                new.append(np.full(len(a), far, dtype=np.int8))
                continue
            best = np.full(len(a), min(i, 100), dtype=np.int8) if j == 0 else row[d] + (a[:, i - 1] != b[:, j - 1])
            if d + 1 < width:
                best = np.minimum(best, row[d + 1] + np.int8(1))
            if d > 0 and j > 0:
                best = np.minimum(best, new[d - 1] + np.int8(1))
            new.append(np.minimum(best, far).astype(np.int8))
        row = new
    return row[lb - la + EDITS] <= EDITS


class _Lists:
    """Keys of an index, sorted; matches of probe keys are read off as ranges."""

    def __init__(self, keys: list[np.ndarray], at: list[np.ndarray]) -> None:
        key = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        own = np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
        order = np.argsort(key)
        key, self.at = key[order], own[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), dtype=bool), key[1:] != key[:-1])))
        # a last key that nothing equals spares a test of bounds
        self.key = np.concatenate((key[first], np.zeros(1, dtype=np.uint64)))
        self.start = np.append(first, len(key))
        self.known = len(first)

    def hits(self, probe: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(at, start, count) of the probes that meet a list; probes are looked up in order, which caches like."""
        order = np.argsort(probe)
        probe, at = probe[order], at[order]
        i = np.searchsorted(self.key[: self.known], probe)
        hit = np.flatnonzero((self.key[i] == probe) & (i < self.known))
        i = i[hit]
        return at[hit], self.start[i], self.start[i + 1] - self.start[i]

    def pairs(self, at: np.ndarray, start: np.ndarray, count: np.ndarray, size: int = 4_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ends = np.cumsum(count)
        first = 0
        while first < len(count):
            before = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
            part = count[first:stop]
            within = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
            yield np.repeat(at[first:stop], part), self.at[np.repeat(start[first:stop], part) + within]
            first = stop


class _Places:
    """Buckets of positions: each string is listed in its own and looked up there and, near a border, next door."""

    def __init__(self, area: np.ndarray, pos: np.ndarray, reach: int) -> None:
        width = 4 * (reach + 1)
        bucket, inside = np.floor_divide(pos, width), np.mod(pos, width)
        with np.errstate(over="ignore"):
            at = lambda d: _mix((area.astype(np.uint64) * _R) ^ _mix((bucket + d).astype(np.uint64) + np.uint64(1)))
            self.home = at(0)
            self.near = [(self.home, None), (at(-1), inside < reach), (at(1), inside >= width - reach)]

    def spread(self, keys: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Probes of keys of the strings ``at``."""
        for place, wanted in self.near:
            if wanted is None:
                yield place[at] ^ keys, at
            else:
                pick = np.flatnonzero(wanted[at])
                if len(pick):
                    yield place[at[pick]] ^ keys[pick], at[pick]


def _classes(strings: list[str]) -> tuple[dict[int, _Class], np.ndarray]:
    length = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    out: dict[int, _Class] = {}
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        letters = np.frombuffer("".join([strings[i] for i in at]).encode("utf-32-le"), dtype=np.uint32).reshape(len(at), n)
        out[int(n)] = _Class(int(n), at, letters)
    return out, length


def _looked_up(lists: _Lists, probes: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hits of probes, many at a time."""
    keys: list[np.ndarray] = []
    own: list[np.ndarray] = []
    held = 0
    for k, at in probes:
        keys.append(k)
        own.append(at)
        held += len(k)
        if held >= PROBES_AT_ONCE:
            yield lists.hits(np.concatenate(keys), np.concatenate(own))
            keys, own, held = [], [], 0
    if held:
        yield lists.hits(np.concatenate(keys), np.concatenate(own))


def link_pairs(strings: list[str], flipped: np.ndarray, row: np.ndarray, stretch: np.ndarray, pos: np.ndarray, reach: int, stats: dict | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (row, row) of distinct rows, each pair once.

    One entry per string; ``flipped`` marks the second string of a row: two flipped
    ones are never compared. Places are only compared within a stretch.
    """
    if not strings:
        return
    classes, length = _classes(strings)
    power = _powers(int(length.max()))
    places = _Places(stretch, pos, reach)

    keys, own = [], []
    for c in classes.values():
        for h in listed_parts(c, power):
            keys.append(places.home[c.at] ^ h)
            own.append(c.at)
    lists = _Lists(keys, own)
    probes = (x for c in classes.values() for h in probed_parts(c, power, classes) for x in places.spread(h, c.at))
    scans = list(_looked_up(lists, probes))

    # the lists' lengths are known: what does each boundary cost in each stretch?
    found = np.zeros(len(strings))
    for at, _, count in scans:
        found += np.bincount(at, count, len(strings))
    scan_cost, enum_cost = np.zeros(len(strings)), np.zeros(len(strings))
    for n, c in classes.items():
        # each string meets itself once in each of its own lists; that isn't checked
        scan_cost[c.at], enum_cost[c.at] = costs(n, classes, np.maximum(found[c.at] - EDITS - 1, 0))
    large = np.ones(len(strings), dtype=bool)
    codes, group = np.unique(stretch, return_inverse=True)
    gain = np.bincount(group, np.maximum(scan_cost - enum_cost, 0), len(codes))
    for g in np.flatnonzero(gain > 0):
        at = np.flatnonzero(group == g)
        sizes = np.unique(length[at])
        by = np.searchsorted(sizes, length[at])
        k = cheapest(np.bincount(by, scan_cost[at], len(sizes)), np.bincount(by, enum_cost[at], len(sizes)))
        large[at] = by >= k
    if stats is not None:
        stats["large"], stats["small"] = stats.get("large", 0) + int(large.sum()), stats.get("small", 0) + int((~large).sum())

    seen: list[np.ndarray] = []
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    total = int(row.max()) + 1

    def verify() -> None:
        nonlocal held
        held = 0
        if not waiting:
            return
        a, b = (np.concatenate(x) for x in zip(*waiting))
        waiting.clear()
        # one candidate per pair of strings
        code = np.unique(np.minimum(a, b) * len(strings) + np.maximum(a, b))
        a, b = code // len(strings), code % len(strings)
        rows = np.minimum(row[a], row[b]) * total + np.maximum(row[a], row[b])
        both = length[a] * (int(length.max()) + 1) + length[b]
        order = np.argsort(both, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(both[order])) + 1):
            ca, cb = classes[int(length[a[at[0]]])], classes[int(length[b[at[0]]])]
            step = max(1, 16_000_000 // ca.length)  # bounded slices: strings may be very long
            for s in range(0, len(at), step):
                part = at[s : s + step]
                good = within_two(ca.letters[np.searchsorted(ca.at, a[part])], cb.letters[np.searchsorted(cb.at, b[part])])
                seen.append(rows[part[good]])

    def candidates(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> None:
        nonlocal held
        for a, b in pairs:
            ok = np.flatnonzero((row[a] != row[b]) & (np.abs(pos[a] - pos[b]) <= reach) & ~(flipped[a] & flipped[b]) & (stretch[a] == stretch[b]))
            if len(ok):
                waiting.append((a[ok], b[ok]))
                held += len(ok)
            if held > CANDIDATES_AT_ONCE:
                verify()

    for at, start, count in scans:
        keep = np.flatnonzero(large[at])
        candidates(lists.pairs(at[keep], start[keep], count[keep]))
    del scans
    if not large.all():
        small = {n: np.flatnonzero(~large[c.at]) for n, c in classes.items()}
        keys, own = [], []
        for n, c in classes.items():
            if len(small[n]):
                for h in listed_subsets(c, power):
                    keys.append(places.home[c.at[small[n]]] ^ h[small[n]])
                    own.append(c.at[small[n]])
        lists = _Lists(keys, own)
        probes = (x for n, c in classes.items() if len(small[n]) for h in probed_subsets(c, power, classes) for x in places.spread(h[small[n]], c.at[small[n]]))
        for hit in _looked_up(lists, probes):
            candidates(lists.pairs(*hit))
    verify()
    if seen:
        code = np.unique(np.concatenate(seen))
        yield code // total, code % total


def cheapest(scan: np.ndarray, enum: np.ndarray) -> int:
    """How many of the sizes, from the least on, are small in the cheapest split; costs are given per size."""
    total = np.concatenate(([0], np.cumsum(enum))) + np.concatenate((np.cumsum(scan[::-1])[::-1], [0]))
    return int(np.argmin(total))


def forms(words: Column) -> tuple[Column, Column]:
    """Of a field's runs of letters: all of them in upper case, and the same with the first
    one behind the others, which exchanges the two segments around the first separator."""
    plain = F.upper(F.array_join(words, ""))
    return plain, F.when(F.size(words) > 1, F.upper(F.concat(F.array_join(F.slice(words, 2, F.size(words)), ""), F.get(words, F.lit(0))))).otherwise(plain)


def _rows(df: DataFrame, row_id: str, place: str, pos: str, text: str) -> DataFrame:
    rows = df.select(F.col(f"`{row_id}`").cast("bigint").alias("id"), F.col(f"`{place}`").cast("string").alias("place"), F.col(f"`{pos}`").cast("bigint").alias("pos"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter("id IS NOT NULL AND place IS NOT NULL AND pos IS NOT NULL AND text IS NOT NULL")
    # a generator of one row keeps the optimizer from writing the pattern into every filter and key
    made = rows.select("id", "place", "pos", F.explode(F.array(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)))).alias("words")).filter(F.size("words") > 0)
    plain, turned = forms(F.col("words"))
    return made.select("id", "place", "pos", plain.alias("s0"), turned.alias("s1"))


def edit_classes(df: DataFrame, row_id: str, place: str, pos: str, text: str, reach: int = 4, heavy: int = HEAVY) -> tuple[DataFrame, DataFrame]:
    """Classes of copies and the links between them.

    The first frame has (class_id, n_rows, place, pos, s0, s1): a row for every different
    string at a position, named by the least id of its rows; s1 is the string with its
    segments exchanged (s0 where it has one segment only). The second has (class_a,
    class_b), each linked pair of classes once, class_a < class_b. Rows with a null id,
    place, position or text, or a text without letters, are in no class. No bucket is
    capped; an empty table gives empty frames.
    """
    rows = _rows(df, row_id, place, pos, text)
    classes = rows.groupBy("place", "pos", "s0", "s1").agg(F.min("id").alias("class_id"), F.count("*").alias("n_rows"))
    classes = stored(classes.select("class_id", "n_rows", "place", "pos", "s0", "s1"))
    at = classes.drop("n_rows").withColumn("home", F.floor(F.col("pos") / STRETCH))
    halo = F.when(F.pmod("pos", F.lit(STRETCH)) >= STRETCH - reach, F.array("home", F.col("home") + 1)).otherwise(F.array("home"))
    spread = at.withColumn("stretch", F.explode(halo))
    # crowded stretches are a table, however many there are; the planner sees its size
    crowded = stored(spread.groupBy("place", "stretch").count().filter(F.col("count") > heavy).select("place", "stretch"))
    if crowded.isEmpty():
        return classes, _light_links(spread, reach)
    light = _light_links(spread.join(crowded, ["place", "stretch"], "left_anti"), reach)
    # a pair belongs to one stretch, so none is in both
    return classes, light.unionByName(_heavy_links(spread.join(crowded, ["place", "stretch"], "left_semi"), reach))


def edit_links(df: DataFrame, row_id: str, place: str, pos: str, text: str, reach: int = 4, heavy: int = HEAVY) -> DataFrame:
    """Linked pairs of rows: id_a < id_b.

    Which rows take part is said at :func:`edit_classes`. Copies are linked like any
    others; repeated ids count as rows of their own but give no pair with themselves.
    """
    classes, links = edit_classes(df, row_id, place, pos, text, reach, heavy)
    # classes of several rows are few as a rule: as tables their sizes tell the planner how to join
    copies = stored(edit_members(df, row_id, place, pos, text, stored(classes.filter("n_rows > 1"))))
    one, two = copies.select(F.col("class_id").alias("ka"), F.col("id").alias("a")), copies.select(F.col("class_id").alias("kb"), F.col("id").alias("b"))
    between = links.join(one, F.col("class_a") == F.col("ka"), "left").join(two, F.col("class_b") == F.col("kb"), "left")
    between = between.select(F.coalesce("a", "class_a").alias("a"), F.coalesce("b", "class_b").alias("b"))
    within = one.join(two, F.col("ka") == F.col("kb")).filter("a < b").select("a", "b")
    return between.unionByName(within).filter("a != b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))


def edit_members(df: DataFrame, row_id: str, place: str, pos: str, text: str, classes: DataFrame) -> DataFrame:
    """(id, class_id) of the rows of the given classes."""
    key = ["place", "pos", "s0", "s1"]
    return _rows(df, row_id, place, pos, text).join(classes.select(*key, "class_id"), key).select("id", "class_id")


def edit_degrees(df: DataFrame, row_id: str, place: str, pos: str, text: str, reach: int = 4, heavy: int = HEAVY) -> DataFrame:
    """A row per row of the input that is in a class: (id, class_id, n_links), the number of rows it is linked to.

    The result is as large as the input, however many copies there are.
    """
    classes, links = edit_classes(df, row_id, place, pos, text, reach, heavy)
    both = links.unionByName(links.select(F.col("class_b").alias("class_a"), F.col("class_a").alias("class_b")))
    sizes = classes.select(F.col("class_id").alias("other"), F.col("n_rows").alias("n_other"))
    n = both.join(sizes, F.col("class_b") == F.col("other")).groupBy(F.col("class_a").alias("k")).agg(F.sum("n_other").alias("n"))
    counted = classes.join(n, F.col("class_id") == F.col("k"), "left").select("class_id", "place", "pos", "s0", "s1", (F.col("n_rows") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    key = ["place", "pos", "s0", "s1"]
    return _rows(df, row_id, place, pos, text).join(counted, key).select("id", "class_id", "n_links")


def _light_links(spread: DataFrame, reach: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            t = pa.concat_tables(held)
            ids, pos, home, stretch = (t.column(c).to_numpy() for c in ("class_id", "pos", "home", "stretch"))
            s0, s1 = t.column("s0").to_pylist(), t.column("s1").to_pylist()
            place = np.asarray(t.column("place").combine_chunks().dictionary_encode().indices)
            code = np.unique(np.stack([place, stretch]), axis=1, return_inverse=True)[1].reshape(-1)
            turned = np.array([i for i in range(len(ids)) if s1[i] != s0[i]], dtype=np.int64)
            row = np.concatenate([np.arange(len(ids)), turned])
            texts = [*s0, *(s1[i] for i in turned)]
            for a, b in link_pairs(texts, np.arange(len(row)) >= len(ids), row, code[row], pos[row], reach):
                # a pair that lies wholly in the overlap belongs to the stretch it came from
                ok = (home[a] == stretch[a]) | (home[b] == stretch[b])
                a, b = ids[a[ok]], ids[b[ok]]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["class_a", "class_b"])

        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            if size >= CHUNK_ROWS:
                # go on to the end of the stretch that the chunk ends in
                last = (held[-1].column("place")[-1].as_py(), held[-1].column("stretch")[-1].as_py())
                stretch, place = t.column("stretch").to_numpy(), t.column("place").to_pylist()
                cut = next((i for i in range(t.num_rows) if (place[i], stretch[i]) != last), t.num_rows)
                held.append(t.slice(0, cut))
                size += cut
                if cut < t.num_rows:
                    yield from links(held)
                    held, size = [t.slice(cut)], t.num_rows - cut
            else:
                held.append(t)
                size += t.num_rows
        if held:
            yield from links(held)

    cols = spread.select("class_id", "place", "pos", "s0", "s1", "stretch", "home")
    return keyed(cols, "place", "stretch").sortWithinPartitions("place", "stretch").mapInArrow(run, "class_a bigint, class_b bigint")


_KEYED = "key bigint, area bigint, class_id bigint, pos bigint, own boolean, turned boolean, s string"


def _heavy_keys(made: DataFrame, reach: int, make, probing: bool) -> DataFrame:
    """Keys of the strings of ``made`` (class_id, area, pos, own, turned, s); ``make`` gives those of a class of a length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 5_000):
                t = batch.slice(first, 5_000)
                classes, length = _classes(t.column(5).to_pylist())
                power = _powers(int(length.max()))
                places = _Places(t.column(1).to_numpy(), t.column(2).to_numpy(), reach)
                for c in classes.values():
                    for h in make(c, power):
                        for k, at in places.spread(h, c.at) if probing else [(places.home[c.at] ^ h, c.at)]:
                            take = pa.array(at)
                            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), *(t.column(i).take(take) for i in (1, 0, 2, 3, 4, 5))], names=["key", "area", "class_id", "pos", "own", "turned", "s"])

    return made.select("class_id", "area", "pos", "own", "turned", "s").mapInArrow(run, _KEYED)


def heavy_boundary(made: DataFrame, reach: int) -> tuple[int, list[int]]:
    """The greatest length that counts as small among the strings of crowded stretches, and all lengths.

    One aggregate of the lists' lengths: a row per length reaches the driver.
    """
    keys = _heavy_keys(made, reach, listed_parts, False)
    lists = keys.groupBy(F.length("s").alias("n"), "key").agg(F.count("*").alias("c"))
    by = {r["n"]: (r["c"], r["cc"]) for r in lists.groupBy("n").agg(F.sum("c").alias("c"), F.sum(F.col("c").cast("double") * F.col("c")).alias("cc")).collect()}
    sizes = sorted(by)
    scan, enum = [], []
    for n in sizes:
        probes = sum(len(starts_in(n, m, i)) * (by[m][1] - by[m][0]) / by[m][0] for m in range(max(n - EDITS, 1), n + 1) if m in by for i in range(EDITS + 1))
        a, b = costs(n, by, probes)
        strings = by[n][0] / (EDITS + 1)
        scan.append(a * strings)
        enum.append(b * strings)
    k = cheapest(np.array(scan), np.array(enum)) if sizes else 0
    return (sizes[k - 1] if k else 0), sizes


def _heavy_links(spread: DataFrame, reach: int) -> DataFrame:
    """Links of crowded stretches: keys of lists and of subsets joined in the cluster, candidates checked as they meet."""
    area, own = F.xxhash64("place", "stretch"), F.col("home") == F.col("stretch")
    both = F.when(F.col("s1") != F.col("s0"), F.array(F.struct(F.lit(False).alias("turned"), F.col("s0").alias("s")), F.struct(F.lit(True).alias("turned"), F.col("s1").alias("s")))).otherwise(F.array(F.struct(F.lit(False).alias("turned"), F.col("s0").alias("s"))))
    made = stored(spread.select("class_id", area.alias("area"), "pos", own.alias("own"), F.explode(both).alias("x")).select("class_id", "area", "pos", "own", "x.*"))
    upto, sizes = heavy_boundary(made, reach)
    lengths = set(sizes)
    small, large = made.filter(F.length("s") <= upto), made.filter(F.length("s") > upto)
    sides = []
    if sizes and upto < sizes[-1]:
        # large sets scan the lists of all that aren't longer
        sides.append((_heavy_keys(made.filter(F.length("s") >= upto + 1 - EDITS), reach, listed_parts, False), _heavy_keys(large, reach, lambda c, power: probed_parts(c, power, lengths), True)))
    if upto:
        sides.append((_heavy_keys(small, reach, listed_subsets, False), _heavy_keys(small, reach, lambda c, power: probed_subsets(c, power, lengths), True)))
    pairs = None
    for index, probe in sides:
        two = probe.select(*[F.col(c).alias(f"{c}_2") for c in probe.columns])
        close = (F.abs(F.col("pos") - F.col("pos_2")) <= reach) & ~(F.col("turned") & F.col("turned_2")) & (F.col("class_id") != F.col("class_id_2")) & (F.col("own") | F.col("own_2"))
        met = index.join(two, (F.col("key") == F.col("key_2")) & (F.col("area") == F.col("area_2")) & close).filter(F.levenshtein("s", "s_2", EDITS) >= 0)
        one = met.select(F.least("class_id", "class_id_2").alias("class_a"), F.greatest("class_id", "class_id_2").alias("class_b"))
        pairs = one if pairs is None else pairs.unionByName(one)
    return pairs.distinct()
