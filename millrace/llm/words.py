"""Words, word hashes and sliding hashes of whole texts, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_MULT = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text: ``bytes.split`` cuts at exactly these six bytes."""
    return text.split() if text else []


class WordHashes(dict):
    """64-bit hash of each word, remembered; forgets all when it holds ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def sliding(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` values."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out *= _MULT
        out += values[j : j + m]
        out ^= out >> _SHIFT
    out *= _MULT
    out ^= out >> np.uint64(32)
    return out


def sliding_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """For every run of ``w`` values, the position of its smallest one (the leftmost of equals)."""
    m = len(values) - w + 1
    best = values[:m].copy()
    at = np.arange(m)
    for j in range(1, w):
        x = values[j : j + m]
        less = x < best
        best[less] = x[less]
        at[less] = np.nonzero(less)[0] + j
    return at


def shingles(words: list[bytes], hashes: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(sliding(hashes.of(words), min(n, len(words))))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that what is made of one slice stays small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
