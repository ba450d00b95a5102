"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import shuffles_dropped as shuffles_dropped

#: Text bytes of one bucket of documents; what a Python worker holds at a time.
BUCKET_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, taken: list[str]) -> str:
    """A column name that does not clash with the given ones."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def refuse(names: Iterable[str], taken: Iterable[str]) -> None:
    """Raise if a column of one of these names exists (Spark tells no case apart)."""
    if clash := {n.lower() for n in names} & {t.lower() for t in taken}:
        raise ValueError(f"columns {sorted(clash)} exist")


def buckets_for(docs: DataFrame, text: str, size: int = BUCKET_BYTES) -> int:
    """How many buckets of about ``size`` text bytes the documents make."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0]
    return max(1, ceil((total or 0) / size))


class WordHashes(dict):
    """64-bit hash of each word (bytes), computed once per word; emptied when large."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (uint64)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = h[:n].copy()
    for i in range(1, k):
        g *= np.uint64(0x9E3779B97F4A7C15)
        g += h[i : n + i]
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(29)
    return g


def winnow(g: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` grams, the position of its smallest hash (the leftmost of equals)."""
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = g[:n].copy(), np.arange(n)
    for i in range(1, w):
        less = g[i : n + i] < best
        best[less] = g[i : n + i][less]
        at[less] = np.flatnonzero(less) + i
    return at


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of all given runs, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def text_runs(batch: pa.RecordBatch, column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` text bytes each, at least one row.

    After the last one, memory that Arrow keeps for later goes back to the system:
    workers live on between tasks, beside each other and the JVM.
    """
    sizes = np.array(pc.fill_null(pc.binary_length(batch[column]), 0))
    group = (np.cumsum(sizes) - sizes) // size
    cuts = np.flatnonzero(np.r_[True, np.diff(group) > 0, True]) if len(sizes) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


class WordBatch:
    """Words of several texts in one flat list, with their hashes and the text each is of."""

    def __init__(self, words_of_texts: list[list[bytes]], hashes: WordHashes):
        self.lengths = np.array([len(w) for w in words_of_texts], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.words = [w for mine in words_of_texts for w in mine]
        self.text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self._hashes = hashes

    @cached_property
    def hashes(self) -> np.ndarray:
        return self._hashes.of(self.words)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First positions of the ``k``-grams that lie in one text, and their hashes."""
        g = gram_hashes(self.hashes, k)
        at = np.flatnonzero(self.text[: len(g)] == self.text[k - 1 : k - 1 + len(g)])
        return at, g[at]

    def windows(self, size: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of ``size`` words that lie in one text: first positions, the positions of the
        ``k``-grams that winnowing selects in them, and the hashes of those."""
        g = gram_hashes(self.hashes, k)
        at = winnow(g, size - k + 1)
        inside = np.flatnonzero(self.text[: len(at)] == self.text[size - 1 : size - 1 + len(at)])
        return inside, at[inside], g[at[inside]]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in any of the given spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0
