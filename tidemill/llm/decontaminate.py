"""Operator 8: benchmark decontamination by winnowing."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import WordBatch, WordHashes, covered, table, text_runs
from tidemill.session import materialise

WINDOW = 10
GRAM = 5
#: Text bytes of benchmark items that are broadcast at a time; larger benchmarks take several passes.
SLICE_BYTES = 32 << 20
#: Places of a 5-gram in the items up to which each is walked for itself.
CROWD = 16
#: Every byte that is no word byte becomes a space, and A-Z becomes a-z.
FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class Benchmark:
    """Fingerprints of a set of items, and the search of documents for them.

    Winnowing keeps the smallest 5-gram hash of every 10-word window. A window
    that a document shares with an item selects the same 5-gram at the same
    place in both, so that looking up the document's kept hashes misses none.
    Hits are extended word by word to both sides, on the words themselves; a
    shared run of 10 words or more is made of windows. A 5-gram that more than
    ``CROWD`` places of the items have (of a prompt template, for instance) is not
    walked place by place: the windows that select it are looked up whole, which
    costs the same however many items share them. Items of fewer words are one
    window each and are looked up whole, too. Equal items are one.
    """

    def __init__(self, items: list[tuple[str, str]]):
        equal: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for i, t in items:
            equal[tuple(words_of(t))].add(i)
        self.hashes = WordHashes()
        self.ids, self.words = list(equal.values()), list(equal)
        self.anchors: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.short: dict[int, dict[bytes, int]] = defaultdict(dict)
        short: dict[int, list[int]] = defaultdict(list)
        for item, mine in enumerate(self.words):
            batch = WordBatch([mine], self.hashes)
            if len(mine) >= WINDOW:
                _, at, kept = batch.windows(WINDOW, GRAM)
                for place, h in sorted(set(zip(at.tolist(), kept.tolist()))):
                    self.anchors[h].append((item, place))
            elif mine:
                self.short[len(mine)][b" ".join(mine)] = item
                short[len(mine)].append(int(batch.grams(len(mine))[1][0]))
        self.short_keys = {n: np.unique(np.array(of, np.uint64)) for n, of in short.items()}
        crowded = {h: places for h, places in self.anchors.items() if len(places) > CROWD}
        for h in crowded:
            del self.anchors[h]
        self.keys = np.array(sorted(self.anchors), np.uint64)
        self.crowded_keys = np.array(sorted(crowded), np.uint64)
        self._index(sorted({item for places in crowded.values() for item, _ in places}))

    def _index(self, items: list[int]) -> None:
        """The windows of crowded 5-grams, each with the number of a group of items; equal groups are one."""
        of: dict[bytes, list[int]] = defaultdict(list)
        for item in items:
            mine = self.words[item]
            at, _, kept = WordBatch([mine], self.hashes).windows(WINDOW, GRAM)
            for window in {b" ".join(mine[i : i + WINDOW]) for i in at[np.isin(kept, self.crowded_keys)].tolist()}:
                of[window].append(item)
        numbers: dict[tuple[int, ...], int] = {}
        self.windows = {window: numbers.setdefault(tuple(group), len(numbers)) for window, group in of.items()}
        self.groups = list(numbers)

    def search(self, texts: list[str | None]) -> list[tuple[int, list[int], list[int], list[str]]]:
        """Of each text: number of words, starts and ends of the words hit, items found."""
        batch = WordBatch([words_of(t) for t in texts], self.hashes)
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        items: dict[int, set[int]] = defaultdict(set)
        groups: dict[int, set[int]] = defaultdict(set)
        window, at, kept = batch.windows(WINDOW, GRAM)
        for place in window[np.isin(kept, self.crowded_keys)].tolist():
            group = self.windows.get(b" ".join(batch.words[place : place + WINDOW]))
            if group is not None:
                text = int(batch.text[place])
                start = place - int(batch.starts[text])
                spans[text].append((start, start + WINDOW))
                groups[text].add(group)
        hit = np.isin(kept, self.keys)
        reach: dict[tuple[int, int, int], int] = {}  # up to where an alignment of text and item is done
        for place, h in sorted(set(zip(at[hit].tolist(), kept[hit].tolist()))):
            text = int(batch.text[place])
            first, last = int(batch.starts[text]), int(batch.ends[text])
            for item, there in self.anchors[h]:
                if reach.get((text, item, place - there), -1) > place:
                    continue
                mine = self.words[item]
                a, b = place, there
                while a > first and b > 0 and batch.words[a - 1] == mine[b - 1]:
                    a, b = a - 1, b - 1
                c, d = place, there
                while c < last and d < len(mine) and batch.words[c] == mine[d]:
                    c, d = c + 1, d + 1
                reach[text, item, place - there] = c
                if c - a >= WINDOW:
                    spans[text].append((a - first, c - first))
                    items[text].add(item)
        for n, keys in self.short_keys.items():
            at, grams = batch.grams(n)
            for i in np.flatnonzero(np.isin(grams, keys)).tolist():
                place, text = int(at[i]), int(batch.text[at[i]])
                item = self.short[n].get(b" ".join(batch.words[place : place + n]))
                if item is not None:
                    start = place - int(batch.starts[text])
                    spans[text].append((start, start + n))
                    items[text].add(item)
        out = []
        for text, n in enumerate(batch.lengths.tolist()):
            found = np.array(spans.get(text, []), np.int64).reshape(-1, 2)
            edge = np.diff(np.r_[0, covered(n, found[:, 0], found[:, 1]).astype(np.int8), 0])
            mine = items.get(text, set()).union(*(self.groups[g] for g in groups.get(text, ())))
            names = set().union(*(self.ids[item] for item in mine))
            out.append((n, np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), sorted(names)))
        return out


def slices_of(benchmark: DataFrame, item: str, item_text: str, slice_bytes: int) -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """Number of slices, and the benchmark's (id, text) in lists of about ``slice_bytes`` of text, one list at least."""
    items = benchmark.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item).cast("string").alias("id"), F.col(item_text).alias("text")
    ).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(1, ceil(size / slice_bytes))
    dealt = items.withColumn("slice", F.pmod(F.xxhash64("id", "text"), F.lit(slices)))
    one = lambda i: sorted((r["id"], r["text"]) for r in dealt.where(F.col("slice") == i).select("id", "text").collect())
    return slices, map(one, range(slices))


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text",
    item: str = "item_id", item_text: str = "text", slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The documents without a hit, with all their columns. A pass for each slice of the benchmark, as in ``find``."""
    for i, items in enumerate(slices_of(benchmark, item, item_text, slice_bytes)[1]):
        docs = _without(materialise(docs) if i else docs, text, items)
    return docs


def _without(docs: DataFrame, text: str, items: list[tuple[str, str]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    built: list[Benchmark] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.append(Benchmark(shared.value))
        for whole in batches:
            for batch in text_runs(whole, text):
                yield batch.filter(pa.array([not found for *_, found in built[0].search(batch[text].to_pylist())]))

    return docs.mapInArrow(run, docs.schema)


_FOUND = "n_words long, starts array<int>, ends array<int>, items array<string>"


def _pass(docs: DataFrame, key: str, text: str, items: list[tuple[str, str]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    built: list[Benchmark] = []
    schema = T.StructType([docs.schema[key], docs.schema["_mark"], *T.StructType.fromDDL(_FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.append(Benchmark(shared.value))
        for whole in batches:
            for batch in text_runs(whole, text):
                n, starts, ends, names = zip(*built[0].search(batch[text].to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch[key], batch["_mark"], pa.array(n, pa.int64()), pa.array(starts, pa.list_(pa.int32())),
                     pa.array(ends, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))],
                    schema.names,
                )

    return docs.mapInArrow(run, schema)


def find(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Key, n_words, and what each document shares with the benchmark: starts and ends of the runs
    of words hit (in words, end exclusive, apart and in order), and items, sorted as strings.

    A document word is hit if it lies in an occurrence of a window of an item: 10
    consecutive words, or all words of an item of fewer. Null or wordless texts
    have no words, and such items no windows; items with a null id are left out.
    Items that share an id count as one. Each document row is taken for itself.
    The benchmark is broadcast in slices of ``slice_bytes`` of text (one item at
    least), a pass over the documents for each; with more than one, keys and texts are
    written once with a number for each row, by which results are put together. So
    one row comes out for each that goes in, for any number of slices.
    """
    slices, each = slices_of(benchmark, item, item_text, slice_bytes)
    rows = docs.select(key, F.monotonically_increasing_id().alias("_mark"), text)
    if slices == 1:
        return _pass(rows, key, text, next(each)).drop("_mark")
    rows, found = materialise(rows), None
    for items in each:
        part = _pass(rows, key, text, items)
        if found is not None:
            part = materialise(part.where(F.size("items") > 0))
        found = part if found is None else found.unionByName(part)
    runs = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    merged = found.groupBy("_mark").agg(
        F.first(key).alias(key), F.max("n_words").alias("n_words"), runs.alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    # Runs of different slices may touch or overlap; a run starts anew where it passes all ends before it.
    empty = F.array().cast("array<struct<starts:int,ends:int>>")

    def join(done, run):
        last = F.element_at(done, -1)
        apart = (F.size(done) == 0) | (run["starts"] > F.try_element_at(done, F.lit(-1))["ends"])
        wide = F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], run["ends"]).alias("ends"))
        return F.when(apart, F.concat(done, F.array(run))).otherwise(F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wide)))

    joined = F.aggregate("runs", empty, join)
    return merged.select(key, "n_words", joined["starts"].alias("starts"), joined["ends"].alias("ends"), "items")


def n_hit() -> Column:
    return F.aggregate(F.zip_with("ends", "starts", lambda e, s: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
with d as (select doc_id, {_WORDS} as k from documents),
     b as (select item_id::varchar as item, k, least(10, len(k)) as n from (select item_id, {_WORDS} as k from benchmark where item_id is not null) where len(k) > 0),
     sought as (select distinct item, n, array_to_string(k[i:i+n-1], ' ') as s from (select *, unnest(range(1, len(k) - n + 2)) as i from b)),
     sizes as (select distinct n from b),
     windows as (select doc_id, n, i, array_to_string(k[i:i+n-1], ' ') as s from (select doc_id, k, n, unnest(range(1, len(k) - n + 2)) as i from d, sizes)),
     hits as (select doc_id, item, i, n from windows join sought using (n, s)),
     places as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by 1),
     items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list from (select distinct doc_id, item from hits) group by 1)
select d.doc_id, len(k)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(list, '')) as items_sha256, n_hit is not null as contaminated
from d left join places using (doc_id) left join items using (doc_id)"""


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"),
    )
