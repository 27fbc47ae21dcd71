"""Token ids and token counts of whole text columns, by the automaton of ``automaton.py``.

Text is cut at single spaces between two other characters, where the split pattern always begins a
new word, and each distinct piece is encoded once in a Python worker and kept in a table of bounded
size. Nothing is shuffled; the automaton is broadcast and its size is that of the vocabulary.

Empty and null texts give the empty list and the count 0.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import DEFAULT_DIR, Automaton, load, splitter
from .words import slices

#: Pieces kept in one Python worker before the table is begun anew.
CACHED_PIECES = 300_000


def tokenizer_dir(spark: SparkSession, directory: str | None = None) -> str:
    return directory or spark.conf.get("lectern.tokenizer.dir", DEFAULT_DIR)


class _Pieces(dict):
    """Piece of text -> its number; -1 for one whose edge is not a safe cut. A missing piece is
    encoded as if a space came before it."""

    def __init__(self, encoder: Encoder, before: str):
        super().__init__()
        self.encoder, self.before = encoder, before

    def __missing__(self, piece: str) -> int:
        safe = piece and not piece[0].isspace() and not piece[-1].isspace()
        number = self[piece] = self.encoder.add(self.before + piece) if safe else -1
        return number


class _Words(dict):
    """Pre-split word -> its ids."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> list[int]:
        ids = self.automaton.encode_word(word.encode("utf-8", "replace"))
        if len(word) <= 64:
            self[word] = ids
        return ids


class _Joined(dict):
    """Stretch of text with its leading space, if any -> its number."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, text: str) -> int:
        number = self[text] = self.encoder.add(text)
        return number


class Encoder:
    """Encodes batches of texts; one per Python worker."""

    def __init__(self, automaton: Automaton, cached: int = CACHED_PIECES):
        self.automaton, self.cached = automaton, cached
        self._begin()

    def _begin(self) -> None:
        self.first, self.later = _Pieces(self, ""), _Pieces(self, " ")
        self.whole = _Joined(self)
        self.words = _Words(self.automaton)
        self.pool, self.starts, self.sizes = array("i"), array("q"), array("i")

    def add(self, text: str) -> int:
        start = len(self.pool)
        self.pool.extend(chain.from_iterable(map(self.words.__getitem__, splitter().findall(text))))
        self.starts.append(start)
        self.sizes.append(len(self.pool) - start)
        return len(self.starts) - 1

    def pieces(self, text: str) -> list[int]:
        """Numbers of the pieces of a text."""
        if not text:
            return []
        cut = text.split(" ")
        numbers = [self.first[cut[0]], *map(self.later.__getitem__, cut[1:])]
        return self._careful(cut, numbers) if -1 in numbers else numbers

    def _careful(self, cut: list[str], numbers: list[int]) -> list[int]:
        """Join each unsafe piece with both its neighbours; a longer piece is always right."""
        out, at, size = [], 0, len(cut)
        while True:
            try:
                bad = numbers.index(-1, at)
            except ValueError:
                out.extend(numbers[at:])
                return out
            begin = end = max(bad - 1, at)
            out.extend(numbers[at:begin])
            while end < size and (end <= bad or numbers[end] < 0 or numbers[end - 1] < 0):
                end += 1
            joined = " ".join(cut[begin:end])
            out.append(self.whole[joined if begin == 0 else " " + joined])
            at = end
            if at >= size:
                return out

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and flat ids of a batch."""
        numbers, counts = self._numbers(texts)
        sizes = np.frombuffer(self.sizes, np.int32)[numbers].astype(np.int64)
        starts = np.frombuffer(self.starts, np.int64)[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(starts - (ends - sizes), sizes) + np.arange(total)
        flat = np.frombuffer(self.pool, np.int32)[at] if total else np.zeros(0, np.int32)
        edges = np.concatenate([[0], np.cumsum(counts)])
        offsets = np.concatenate([[0], ends])[edges]
        del sizes, starts
        self._bound()
        return offsets, flat

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text of a batch."""
        numbers, counts = self._numbers(texts)
        sizes = np.frombuffer(self.sizes, np.int32)[numbers].astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(counts)])
        total = np.concatenate([[0], np.cumsum(sizes)])
        self._bound()
        return total[edges[1:]] - total[edges[:-1]]

    def _numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = array("i"), np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                own = self.pieces(text)
                counts[k] = len(own)
                flat.extend(own)
        if not flat:
            return np.zeros(0, np.int32), counts
        return np.frombuffer(flat, np.int32), counts

    def _bound(self) -> None:
        if len(self.starts) > self.cached or len(self.pool) > 16 * self.cached:
            self._begin()


def _text(column: pa.Array) -> list[str | None]:
    return column.to_pylist()


def _encoder(shared) -> Encoder:
    return Encoder(shared.value)


def with_ids(
    df: DataFrame, text: str, keep: list[str], out: str = "ids", tokenizer: str = "byte_bpe_50k", directory: str | None = None
) -> DataFrame:
    """``keep`` and the list of token ids of ``text`` for every row. Other columns are pruned from
    the scan, so clashing names among them do no harm."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(load(tokenizer_dir(spark, directory), tokenizer))
    source = df.select(*keep, df[text].alias("__text"))
    schema = T.StructType([*source.drop("__text").schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in slices(batches):
            offsets, flat = encoder.ids(_text(batch.column("__text")))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()), type=pa.list_(pa.field("element", pa.int32(), False))
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], [*keep, out])

    return source.mapInArrow(encode, schema)


def with_counts(
    df: DataFrame, text: str, keep: list[str], out: str = "n_tokens", tokenizer: str = "byte_bpe_50k", directory: str | None = None
) -> DataFrame:
    """``keep`` and the number of tokens of ``text`` for every row."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(load(tokenizer_dir(spark, directory), tokenizer))
    source = df.select(*keep, df[text].alias("__text"))
    schema = T.StructType([*source.drop("__text").schema.fields, T.StructField(out, T.LongType(), False)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in slices(batches):
            numbers = encoder.counts(_text(batch.column("__text")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(numbers, pa.int64())], [*keep, out])

    return source.mapInArrow(count, schema)


def decode_udf(spark: SparkSession, tokenizer: str = "byte_bpe_50k", directory: str | None = None):
    """A pandas UDF from lists of ids back to text; null for null. The labels of the arcs are broadcast."""
    shared = spark.sparkContext.broadcast(load(tokenizer_dir(spark, directory), tokenizer))

    def decode(lists: pd.Series) -> pd.Series:
        return lists.map(lambda ids: None if ids is None else shared.value.decode(ids))

    return F.pandas_udf(decode, "string")
