"""Words are runs of characters other than ASCII white space, in Spark expressions and in tasks."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def word_array(text: Column) -> Column:
    """Words in order; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def worker_cache(name: str, make):
    """One object per Python worker that outlives a task; only for values any worker can rebuild.

    A worker that turns to another name, as between the stages of a pipeline, lets the one before go.
    """
    held = sys.modules.setdefault("_forumlens_held", types.ModuleType("_forumlens_held"))
    if getattr(held, "name", None) != name:
        held.name = held.value = None
        held.value = make()
        held.name = name
    return held.value


def byte_slices(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column back to back, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class WordHashes(dict):
    """64-bit hash per word, kept up to a bound and then started anew."""

    BOUND = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashed(words: list[bytes], table: WordHashes) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = 1
    for i in range(size):
        factor = factor * 0xD1342543DE82EF95 % (1 << 64) | 1
        total += hashes[i : i + n] * np.uint64(factor)
    return mixed(total)
