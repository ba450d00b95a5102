"""Operator 12: periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words of smallest period q, as long as it can be, with at least
``EXPONENT`` periods. Its first place and the one a period later share all of the
run but one period, so they come into one class of suffixes when classes are
united by decreasing longest common prefix (LCP); no place between them is in that
class yet. So the runs are among the pairs of places that become neighbours in the
ordered set of a class, at a distance of at most the LCP at that moment.

All texts of a slice are worked on at once: words become numbers, different ones
in each text, and ranks of doubled lengths are refined in numpy for those places only
that are still alike. A place that shares fewer than ``LEAST_LCP`` words with every
other one of its text takes no part in any run and drops out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import covered, refuse, table, text_runs

#: A run has at least so many words, and so many periods.
SHORTEST, EXPONENT = 6, 4
#: Words that the first place of a run and the one a period later share at least: all but one period.
LEAST_LCP = min(max(SHORTEST, EXPONENT * q) - q for q in range(1, SHORTEST + 1))
#: Text bytes of a slice.
SLICE_BYTES = 1 << 20


def ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of the substrings of 1, 2, 4, ... symbols that start at each place, until all differ.

    The rank is the place of the first equal substring in sorted order. Places that are
    alone keep their rank; only the others are sorted again. Every substring must end
    before the symbols do or differ from all others; the last symbol must come only once.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.r_[True, np.diff(symbols[order]) != 0]
    heads = np.flatnonzero(first)
    rank = np.empty(n, np.int64)
    rank[order] = heads[np.cumsum(first) - 1]
    levels, length = [rank], 1
    alike = np.diff(np.r_[heads, n])[np.cumsum(first) - 1] > 1
    active = order[alike]  # in order of rank
    while len(active):
        now = rank[active]
        after = rank[np.minimum(active + length, n - 1)]
        by = np.lexsort((after, now))
        active, now, after = active[by], now[by], after[by]
        old = np.r_[True, np.diff(now) != 0]
        new = old | np.r_[True, np.diff(after) != 0]
        group = np.flatnonzero(old)[np.cumsum(old) - 1]
        at = np.flatnonzero(new)
        mine = np.cumsum(new) - 1
        rank = rank.copy()
        rank[active] = now + at[mine] - group
        levels.append(rank)
        length *= 2
        active = active[np.diff(np.r_[at, len(active)])[mine] > 1]
    return levels


def neighbours(levels: list[np.ndarray], least: int = LEAST_LCP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of places that follow each other among the sorted suffixes, with their LCP, where it is at least ``least``."""
    known = levels[min(least.bit_length() - 1, len(levels) - 1)]  # of the longest power of two within it
    order = np.argsort(known, kind="stable")
    same = np.r_[False, np.diff(known[order]) == 0]
    places = order[same | np.r_[same[1:], False]]
    places = places[np.argsort(levels[-1][places])]
    a, b = places[:-1], places[1:]
    shared = np.zeros(len(a), np.int64)
    for i in range(len(levels) - 1, -1, -1):
        # What is equal ends before the last symbol, so no place is beyond it.
        shared += (levels[i][a + shared] == levels[i][b + shared]).astype(np.int64) << i
    keep = shared >= least
    return a[keep], b[keep], shared[keep]


def runs(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period. Symbols are as ``ranks`` wants them."""
    a, b, shared = neighbours(ranks(symbols))
    order = np.argsort(-shared, kind="stable")
    members: dict[int, list[int]] = {}  # the ordered places of a class, by its name
    name: dict[int, int] = {}
    found = []

    def class_of(x: int) -> int:
        path = []
        while (up := name.setdefault(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            name[p] = x
        return x

    for x, y, lcp in zip(a[order].tolist(), b[order].tolist(), shared[order].tolist()):
        x, y = class_of(x), class_of(y)
        large, small = members.get(x) or [x], members.get(y) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        for i, place in enumerate(small):
            at = bisect_left(large, place)
            # Neighbours that both come from the smaller class were neighbours before.
            if at and (i == 0 or large[at - 1] != small[i - 1]):
                _seed(symbols, large[at - 1], place, lcp, found)
            if at < len(large) and (i + 1 == len(small) or small[i + 1] > large[at]):
                _seed(symbols, place, large[at], lcp, found)
            large.insert(at, place)
        name[y] = x
        members[x] = large
        members.pop(y, None)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _seed(symbols: np.ndarray, i: int, j: int, lcp: int, found: list[tuple[int, int, int]]) -> None:
    """Take the run of period j - i that starts at i, if there is one."""
    period = j - i
    if lcp >= max(SHORTEST, EXPONENT * period) - period and (i == 0 or symbols[i - 1] != symbols[j - 1]):
        found.append((i, period + lcp, period))


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, which is given as words."""
    numbers: dict[bytes, int] = {}
    flat = [numbers.setdefault(w, len(numbers)) for words in texts for w in words]
    sizes = np.array([len(w) for w in texts], np.int64)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    # Words of different texts differ, and each text ends with a symbol of its own.
    words = np.array(flat, np.int64) + text * len(numbers)
    symbols = np.empty(len(words) + len(texts), np.int64)
    symbols[np.arange(len(words)) + text] = words
    stops = ends + np.arange(len(texts))
    symbols[stops] = len(texts) * len(numbers) + np.arange(len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs(symbols) if len(symbols) else []:
        mine = int(np.searchsorted(stops, start))
        out[mine].append((start - (int(stops[mine - 1]) + 1 if mine else 0), length, period))
    return out


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run has after its first period, joined by one space."""
    if not found:
        return b" ".join(words)
    gone = covered(len(words), np.array([s + p for s, _, p in found]), np.array([s + n for s, n, _ in found]))
    return b" ".join([w for w, out in zip(words, gone.tolist()) if not out])


def find_runs(docs: DataFrame, text: str = "text", names: tuple[str, str, str] = ("runs", "best", "collapsed")) -> DataFrame:
    """Add to each row its text's runs (start, length, period; by start, then period), the one with the
    greatest length in periods (the first of equals, then the one of smaller period; null
    without runs), and the text without what repeats in runs, words joined by one space.

    Words are runs of characters other than space and \\t to \\r, places count from 0. Null
    and empty texts have no words. Rows are worked on alone, repeated ones too;
    all columns stay, and a name that is taken is refused.
    """
    refuse(names, docs.columns)
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([*docs.schema, T.StructField(names[0], T.ArrayType(run)), T.StructField(names[1], run), T.StructField(names[2], T.StringType())])
    arrow = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def row(r: tuple[int, int, int]) -> dict[str, int]:
        return dict(zip(("start", "length", "period"), r))

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_runs(whole, text, SLICE_BYTES):
                words = [t.encode().split() if t else [] for t in batch[text].to_pylist()]
                found = runs_of(words)
                best = [min(f, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None) for f in found]
                columns = [
                    pa.array([[row(r) for r in f] for f in found], pa.list_(arrow)), pa.array([b and row(b) for b in best], arrow),
                    pa.array([collapse(w, f).decode() for w, f in zip(words, found)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return docs.mapInArrow(worked, schema)


def planted(key: Column, text: Column) -> Column:
    """A tenth of the texts, by a checksum of the key, go round in a period from some word on; the others stay."""
    h = F.crc32(key.cast("string"))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    n, g = F.size(words), F.floor(h / 10)

    def turned(w: Column) -> Column:
        a, p = w["a"], 1 + F.floor((w["n"] - w["a"]) / (3 + w["g"] % 8))
        place = F.transform(F.sequence(F.lit(0).cast("long"), w["n"] - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(place, lambda i: F.get(w["words"], i.cast("int"))), " ")

    # An array of one, so that words and numbers are worked out once.
    made = F.transform(F.array(F.struct(words.alias("words"), n.cast("long").alias("n"), g.alias("g"), (g % n).alias("a"))), turned)[0]
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = find_runs(docs)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
