"""Languages of documents and of their passages by prediction by partial matching.

Every language has a tree of byte contexts of variable order (up to ORDER bytes, within
a word and its borders). A byte that was seen after the longest known context is coded
with its share there; else an escape is coded and the next shorter context tried, down
to the uniform order -1. The escape's share is the number of distinct bytes seen after
the context (method C). The statistics are frozen after training, so a text's code
length under each language is exact and doesn't depend on what was read before. The
language with the shortest code wins.

As contexts begin at a word's border, the code length of a word is a vector over the
languages that is computed once per worker and looked up afterwards; so are the results
of passages that occur again, as in revisions of a page.

Training uses a bounded sample of labelled texts and doesn't trust the labels: the
sample is split in two, each half is coded by trees of the other, labels whose texts
other languages explain as well are dropped, and only passages that agree with their
label train the final trees. A label of few texts is judged by how badly the other
languages code them, which needs no trees of its own: one text is enough.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.session import spread

ORDER = 4
#: Labelled documents per language that are read for training, and the longest of them in characters.
SAMPLE_DOCS = 120
SAMPLE_CHARS = 20_000
#: A passage speaks for its label if its own trees code it in CLEARLY of the bits that any language
#: so far needs, or if these need more than STRANGE times the bits per letter that their own texts take.
CLEARLY, STRANGE = 0.85, 1.35
#: Part of a label's passages that must speak for it: labels are wrong for about a tenth of the texts,
#: never for most of those of a language that occurs.
SPEAK = 0.4
CACHED = 60_000

_WORD = re.compile(r"[^\W\d_]+")
_FORMAT = re.compile("[\xad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]")
_INNER = re.compile(r"\{\{[^{}]*\}\}|\{\{\{[^{}]*\}\}\}")
_REF = re.compile(r"<ref[^<>]*/>|<ref[^<>]*>.*?</ref>|<!--.*?-->", re.S | re.I)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_SPECIAL = re.compile(r"\[\[[^\[\]|:]+:[^\[\]]*\]\]")
_LINK = re.compile(r"\[\[(?:[^\[\]|]*\|)?:?([^\[\]|]*)\]\]")
_OUTER = re.compile(r"\[\w+://\S*\s*([^\]]*)\]|\w+://\S+")
_LINE = re.compile(r"(?m)^\s*(?:[=*#:;|!{}].*|\[\[[^\]]*$)\n?")
_END = re.compile(r"[.!?؟۔]+(?=[\s\"'»”’)\]]|$|[^\W\da-z_])|[。！？]+")
_QUOTES = re.compile("'{2,}")
_BLANK = re.compile(r"\n\s*\n")


def passages(text: str) -> list[str]:
    """The blocks between empty lines, whatever the line ends; the first is number 1."""
    plain = text.replace("\r\n", "\n").replace("\r", "\n").replace("\u2028", "\n").replace("\u2029", "\n").replace("\x85", "\n")
    return [b for b in _BLANK.split(plain) if b.strip()]


def prose(block: str) -> str:
    """What is left of a block without headings, lists, tables, templates, references and link markup."""
    if "{{" in block:
        before = None
        while before != block:
            before, block = block, _INNER.sub(" ", block)
    if "<" in block:
        block = _TAG.sub(" ", _REF.sub(" ", block))
    block = _LINE.sub("", block)
    if "[" in block:
        block = _OUTER.sub(r"\1", _LINK.sub(r"\1", _SPECIAL.sub(" ", block)))
    if not block.isascii():
        block = _FORMAT.sub("", block)
    return _QUOTES.sub("", block)


def full_sentences(text: str, enough: int = 2) -> bool:
    """Whether a text has ``enough`` full sentences: three words or more, or eight
    letters of a script without blanks, then an end mark."""
    n = start = 0
    for m in _END.finditer(text):
        found = _WORD.findall(text, start, m.start())
        start = m.end()
        n += len(found) >= 3 or (sum(map(len, found)) >= 8 and any(w[0] > "\u2e7f" for w in found))
        if n >= enough:
            return True
    return False


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Trees:
    """Frozen context trees of several languages, resolved to code lengths in bits."""

    languages: list[str]
    grams: dict[bytes, int]
    bits: np.ndarray
    escapes: dict[bytes, int]
    escape_bits: np.ndarray
    uniform: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))

    @classmethod
    def fit(cls, counts: dict[str, Counter], order: int = ORDER) -> Trees:
        languages = sorted(counts)
        n = len(languages)
        #: seen[k]: gram of k + 1 bytes -> language -> count
        seen: list[dict[bytes, dict[int, int]]] = [defaultdict(dict) for _ in range(order + 1)]
        for at, language in enumerate(languages):
            own: list[dict[bytes, int]] = [defaultdict(int) for _ in range(order + 1)]
            for word, times in counts[language].items():
                data = b" " + word.encode("utf-8", "surrogatepass") + b" "
                for i in range(1, len(data)):
                    for k in range(min(order, i) + 1):
                        own[k][data[i - k : i + 1]] += times
            for level, mine in zip(seen, own):
                for gram, c in mine.items():
                    level[gram][at] = c
        totals: dict[bytes, np.ndarray] = {}
        kinds: dict[bytes, np.ndarray] = {}
        for level in seen:
            for gram, by in level.items():
                total = totals.setdefault(gram[:-1], np.zeros(n))
                kind = kinds.setdefault(gram[:-1], np.zeros(n))
                for at, c in by.items():
                    total[at] += c
                    kind[at] += 1
        escape_rows = {ctx: i for i, ctx in enumerate(totals)}
        escape_bits = np.zeros((len(totals), n), dtype=np.float32)
        for ctx, i in escape_rows.items():
            known = kinds[ctx] > 0
            escape_bits[i, known] = -np.log2(kinds[ctx][known] / (totals[ctx][known] + kinds[ctx][known]))
        uniform = np.full(n, 8.0, dtype=np.float32)
        grams: dict[bytes, int] = {}
        rows: list[np.ndarray] = []
        for level in seen:
            for gram, by in level.items():
                ctx = gram[:-1]
                row = (rows[grams[gram[1:]]] if len(gram) > 1 else uniform) + escape_bits[escape_rows[ctx]]
                for at, c in by.items():
                    row[at] = -math.log2(c / (totals[ctx][at] + kinds[ctx][at]))
                grams[gram] = len(rows)
                rows.append(row)
        bits = np.array(rows, dtype=np.float32) if rows else np.zeros((0, n), dtype=np.float32)
        return cls(languages, grams, bits, escape_rows, escape_bits, uniform)

    def word_bits(self, word: str) -> np.ndarray:
        """Code length of a word, its end included, under each language."""
        data = b" " + word.encode("utf-8", "surrogatepass") + b" "
        hits: list[int] = []
        out = np.zeros(len(self.languages), dtype=np.float64)
        grams, escapes = self.grams, self.escapes
        for i in range(1, len(data)):
            start = max(0, i - ORDER)
            while True:
                row = grams.get(data[start : i + 1])
                if row is not None:
                    hits.append(row)
                    break
                ctx = escapes.get(data[start:i])
                if ctx is not None:
                    out += self.escape_bits[ctx]
                if start == i:
                    out += self.uniform
                    break
                start += 1
        if hits:
            out += self.bits[hits].sum(0)
        return out



class Judge:
    """Judges lists of words by trees; keeps the code lengths of the words it met."""

    def __init__(self, trees: Trees) -> None:
        self.trees = trees
        self.at: dict[str, int] = {}
        self.bits = np.zeros((1024, len(trees.languages)), dtype=np.float64)

    def _add(self, word: str) -> int:
        if len(self.at) >= CACHED:
            self.at.clear()
        i = len(self.at)
        if i >= len(self.bits):
            self.bits = np.concatenate([self.bits, np.zeros_like(self.bits)])
        self.bits[i] = self.trees.word_bits(word)
        self.at[word] = i
        return i

    def total(self, found: list[str]) -> np.ndarray:
        """Code length of a list of words under each language."""
        if len(self.at) + len(found) >= CACHED:
            self.at.clear()
        if len(found) > CACHED // 2:  # a very long passage: its words by number
            return sum(self.trees.word_bits(w) * k for w, k in Counter(found).items())
        at = self.at
        rows = [at[w] if w in at else self._add(w) for w in found]
        return self.bits[rows].sum(0)

    def __call__(self, found: list[str]) -> tuple[int, float]:
        """Best language of a list of words and the confidence in it.

        The confidence is the language's share of the probabilities that the code
        lengths stand for, per eight letters, so that it doesn't saturate with length.
        """
        total = self.total(found)
        best = int(total.argmin())
        odds = np.exp2((total[best] - total) / max(1, sum(map(len, found))) * 8)
        return best, float(1 / odds.sum())


def judged(text: str | None) -> Iterator[tuple[int, list[str]]]:
    """Number and words of each passage that is running prose of two full sentences or more."""
    for number, block in enumerate(passages(text or ""), 1):
        clean = prose(block)
        if full_sentences(clean):
            yield number, words(clean)


def train(sample: list[tuple[int, str, str]], frequency: dict[str, int] | None = None) -> Trees:
    """Trees from (id, label, text); labels that are no languages here and wrong labels are weeded out.

    Each half of the sample is coded by trees of the other half. The labels are then
    taken from the most frequent one on (``frequency``: documents per label, by default
    those of the sample). A label is a language if enough of its passages speak for it:
    they are coded clearly shorter by its own trees than by any language so far, or all of
    these code them far worse than texts of their own. The texts of a label that is only
    ever given wrongly are coded well by the languages that they are in. The final trees
    learn the passages whose shortest code is that of their label, and those that speak
    for it.
    """
    parts: list[tuple[int, str, list[str]]] = []
    turn: Counter = Counter()
    for _, label, text in sorted(sample):
        turn[label] += 1  # each label's texts go to the halves in turn
        parts += [(turn[label] % 2, label, found) for _, found in judged(text) if found]
    labels = sorted({label for _, label, _ in parts})
    if not labels:
        return Trees.fit({})

    def fit(chosen: Iterator[tuple[str, list[str]]], of: list[str]) -> Trees:
        counts: dict[str, Counter] = {label: Counter() for label in of}
        for label, found in chosen:
            counts[label].update(found)
        return Trees.fit(counts)

    judges = [Judge(fit(((label, found) for h, label, found in parts if h != half), labels)) for half in (0, 1)]
    letters = np.array([max(1, sum(map(len, found))) for _, _, found in parts])
    bits = np.array([judges[h].total(found) for h, _, found in parts]) / letters[:, None]
    own = np.array([labels.index(label) for _, label, _ in parts])
    often = frequency or Counter(label for _, label, _ in sample)
    alive: list[int] = []
    usual = np.full(len(labels), np.inf)
    speaks = np.zeros(len(parts), dtype=bool)
    for label in sorted(labels, key=lambda x: (-often.get(x, 0), x)):
        at = labels.index(label)
        mine = own == at
        if alive:
            others = bits[:, alive]
            strange = (others > STRANGE * usual[alive]).all(1)
            speaks[mine] = ((bits[:, at] < CLEARLY * others.min(1)) | strange)[mine]
        else:
            speaks[mine] = True
        if speaks[mine].sum() >= SPEAK * mine.sum():
            alive.append(at)
            # bits per letter that the language's own texts take: the median keeps wrong labels out
            usual[at] = np.median(bits[mine & speaks, at])
        else:
            speaks[mine] = False
    best = np.array(alive)[bits[:, alive].argmin(1)]
    names = sorted(labels[k] for k in alive)
    return fit(((label, found) for (_, label, found), b, o, ok in zip(parts, best, own, speaks) if o in alive and (b == o or ok)), names)


def label_codes(languages: DataFrame) -> dict[str, str]:
    """Every way to write a label (code, code3, name; lower case) -> code. The table is a fixed, small one."""
    out: dict[str, str] = {}
    for row in languages.select("code", "code3", "lang_name").collect():
        for written in (row["lang_name"], row["code3"], row["code"]):
            if written:
                out[written.strip().lower()] = row["code"]
    return out


def label_code(label: Column, codes: dict[str, str]) -> Column:
    """Code of a label, with or without a region after - or _; null if it names no known language."""
    known = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]) if codes else F.create_map().cast("map<string,string>")
    clean = F.lower(F.regexp_replace(label, r"^\s+|\s+$", ""))
    base = F.regexp_replace(F.regexp_extract(clean, "^([^-_]*)", 1), r"\s+$", "")
    return F.coalesce(known[clean], known[base])


def label_counts(df: DataFrame, codes: dict[str, str]) -> dict[str, int]:
    """Documents per known language label: as many numbers as there are known languages."""
    rows = df.groupBy(label_code(F.col("lang"), codes).alias("code")).agg(F.count("*").alias("n")).filter("code IS NOT NULL")
    return {r["code"]: r["n"] for r in rows.collect()}


#: Texts that a label's share of the hash range is chosen to hold, in multiples of those wanted.
SLACK = 3


def sample_texts(df: DataFrame, codes: dict[str, str], docs: int = SAMPLE_DOCS, counts: dict[str, int] | None = None) -> list[tuple[int, str, str]]:
    """At most ``docs`` labelled texts per language, those of the least hashes of the id.

    One pass: the number of documents per label (``counts``) tells below which hash
    enough of them lie, so neither ids nor further texts are gathered. A label with few
    documents is taken whole.
    """
    counts = label_counts(df, codes) if counts is None else counts
    if not counts:
        return []
    share = {c: min(1.0, SLACK * docs / n) for c, n in counts.items()}
    limit = F.create_map(*[x for c, s in share.items() for x in (F.lit(c), F.lit(int(s * (1 << 53))).cast("bigint"))])
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 11)
    rows = df.select("doc_id", label_code(F.col("lang"), codes).alias("code"), h.alias("h"), "text").filter("doc_id IS NOT NULL AND code IS NOT NULL").filter(F.col("h") <= limit[F.col("code")])
    rank = F.row_number().over(W.partitionBy("code").orderBy("h", "doc_id"))
    kept = rows.filter(F.length("text") <= SAMPLE_CHARS).withColumn("k", rank).filter(F.col("k") <= docs)
    return [tuple(r) for r in kept.select("doc_id", "code", "text").collect()]


SCHEMA = "doc_id bigint, label string, main string, para_no int, lang string, confidence double, letters bigint"


def judge_documents(df: DataFrame, trees: Trees, codes: dict[str, str]) -> DataFrame:
    """Rows (doc_id, label, main, para_no, lang, confidence, letters) of every judged passage and,
    with para_no 0, of every document that has one.

    A document's language is that of most letters of its judged passages (ties: the code
    that sorts first), its confidence their mean weighted by letters. ``label`` is the
    code of the document's own label, null if that is missing, ``main`` its language. Null, empty and
    prose-less texts have no row; repeated documents are judged each time.
    """
    shared = df.sparkSession.sparkContext.broadcast(trees)  # bounded by the training sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        judge = Judge(trees)
        blocks: dict[str, tuple[int, float, int] | None] = {}
        held = 0
        for batch in batches:
            out: list[tuple] = []
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, label, text in zip(ids, labels, (t.as_py() for t in batch.column(2))):
                if not text or not trees.languages:
                    continue
                by: dict[int, list[float]] = {}
                mixed: list[tuple] = []
                for number, block in enumerate(passages(text), 1):
                    found = blocks.get(block, 0)
                    if found == 0:
                        clean = prose(block)
                        found = None
                        if full_sentences(clean):
                            w = words(clean)
                            found = (*judge(w), sum(map(len, w)))
                        if len(block) < 8192:
                            held += len(block)
                            if held > 20_000_000:
                                blocks.clear()
                                held = len(block)
                            blocks[block] = found
                    if found:
                        best, sure, letters = found
                        mixed.append((number, trees.languages[best], sure, letters))
                        mine = by.setdefault(best, [0.0, 0.0])
                        mine[0] += letters
                        mine[1] += letters * sure
                if by:
                    best = min(by, key=lambda k: (-by[k][0], trees.languages[k]))
                    every = sum(x[0] for x in by.values())
                    main = trees.languages[best]
                    mixed.append((0, main, by[best][1] / max(1.0, every), int(every)))
                    out += [(doc, label, main, *m) for m in mixed]
            cols = list(zip(*out)) or [()] * 7
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "label", "main", "para_no", "lang", "confidence", "letters"])

    return spread(df.select("doc_id", label_code(F.col("lang"), codes).alias("label"), "text")).mapInArrow(run, SCHEMA)


def wrong_labels(judged_rows: DataFrame) -> DataFrame:
    """(doc_id, para_no, lang): para_no 0 where the label is missing or isn't the main
    language, para_no k for each passage in another language than the main one."""
    return judged_rows.filter("lang != main OR (para_no = 0 AND (label IS NULL OR label != lang))").select("doc_id", "para_no", "lang")
