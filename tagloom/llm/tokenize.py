"""Encoding a whole corpus with a public tokenizer, as Arrow batches.

Rows are encoded where they are read: no shuffle, columns other than the id and the
text never leave the scan. A null or empty text has an empty list of ids. Repeated
rows come out as often as they go in; columns of any other name may be present.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.bpe import VOCABULARY, encoder
from tagloom.session import spread

#: Characters of text encoded before the ids so far are passed on.
CHUNK_CHARS = 8_000_000


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Slices of a batch of at most CHUNK_CHARS bytes, or of one text that is longer."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > CHUNK_CHARS:
            yield start, texts.slice(start, i - start).to_pylist()
            start, total = i, 0
        total += size
    if start < len(texts):
        yield start, texts.slice(start).to_pylist()


def encode_corpus(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and the token ids (array<int>) of each row's text."""
    kept = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = kept.drop("__text").schema.add(ids, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_bytes
        for batch in batches:
            texts, n = batch.column(batch.num_columns - 1), batch.num_columns - 1
            if pa.types.is_large_string(texts.type):
                texts = texts.cast(pa.string())
            for start, part in _chunks(texts):
                out = [encode(t) for t in part]
                ends = np.zeros(len(out) + 1, dtype=np.int64)
                np.cumsum([len(x) // 4 for x in out], out=ends[1:])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(out), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(start, len(part)) for i in range(n)), lists], names=schema.names)

    return spread(kept).mapInArrow(run, schema)


def count_tokens(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", count: str = "n_tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and the number of tokens (bigint, 0 for null) of each row's text."""
    kept = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = kept.drop("__text").schema.add(count, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_bytes
        for batch in batches:
            texts, n = batch.column(batch.num_columns - 1), batch.num_columns - 1
            if pa.types.is_large_string(texts.type):
                texts = texts.cast(pa.string())
            sizes = [len(encode(t)) // 4 for _, part in _chunks(texts) for t in part]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(sizes, pa.int64())], names=schema.names)

    return spread(kept).mapInArrow(run, schema)
