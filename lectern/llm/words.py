"""Words of batches of texts, each distinct word worked on once in a Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Distinct words kept in one worker before the table is begun anew.
KEPT_WORDS = 400_000


#: Rows, and bytes as Arrow holds them, worked on at once in a worker, so that its memory follows these and
#: not Spark's batches. A row of more bytes is worked on alone.
SLICE_ROWS, SLICE_BYTES = 1000, 8 << 20


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield from _halved(batch.slice(start, rows), size)


def _halved(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows < 2 or batch.nbytes <= size:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from _halved(batch.slice(0, half), size)
        yield from _halved(batch.slice(half), size)


class _Numbers(dict):
    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordTable:
    """word -> a row of features, by ``featurize(list of words) -> matrix``."""

    def __init__(self, featurize: Callable[[list[str]], np.ndarray], kept: int = KEPT_WORDS):
        self.featurize, self.kept = featurize, kept
        self._begin()

    def _begin(self) -> None:
        self.numbers = _Numbers()
        self.features: np.ndarray | None = None
        self.filled = 0

    def rows(self, words: list[str]) -> np.ndarray:
        """Row numbers into ``features`` of each word; valid until the next call."""
        if len(self.numbers) > self.kept:
            self._begin()
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if self.numbers.new or self.features is None:
            new = self.featurize(self.numbers.new)
            self.numbers.new = []
            need = self.filled + len(new)
            if self.features is None or need > len(self.features):
                grown = np.zeros((max(4096, 2 * need), *new.shape[1:]), new.dtype)
                if self.features is not None:
                    grown[: self.filled] = self.features[: self.filled]
                self.features = grown
            self.features[self.filled : need] = new
            self.filled = need
        return numbers


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows, ``counts`` rows each; an empty group gives 0."""
    out = np.zeros((len(counts), *values.shape[1:]), np.float64)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out
