"""Operator 4: substring dedup with repeated-phrase automata.

A phrase is a window of 13 consecutive words. Documents are dealt into buckets
of about ``BUCKET_BYTES`` of text once; that exchange serves all passes.

1. Winnowing picks a 4-gram (an anchor) in every window. Equal windows pick the
   same one, so a window can only recur if its anchor does. Anchor hashes are
   counted over all buckets; a bucket sends a hash once, so that an anchor which
   every document has comes as often as there are buckets.
2. Each bucket cuts out the passages around its recurring anchors: consecutive
   windows with the same anchor make one passage. Equal passages of a bucket go
   out once, with the places where they are. Passages are sent to the shard of
   their anchor. Windows whose anchor is frequent go each for itself to the shard
   of their own hash, so that a frequent anchor in ever new surroundings doesn't
   fill one shard.
3. A shard confirms on the words themselves which windows recur in two or more
   documents and which document is the first with each. Runs of such windows with
   the same first document are its phrases. It compiles them into Aho-Corasick
   automata (words become characters) and streams all passages through them.
   What is found in a later document comes back as spans.
4. Each bucket takes the spans out of its documents.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import WordBatch, WordHashes, buckets_for, covered, gram_hashes, table

WINDOW = 13
GRAM = 4
#: Buckets of documents that a partition holds, about.
BUCKETS_A_PARTITION = 8
#: From so many occurrences on, an anchor's windows are sent each for itself.
FREQUENT = 10_000
#: Words of the passages that one automaton is made from, about.
AUTOMATON_WORDS = 400_000

_HASHES = WordHashes()
_ANCHORS = "h long, bucket int, n long, several boolean"
_PASSAGES = "shard int, part short, bucket int, passage string, keys array<long>, rows array<int>, starts array<int>"
_SPANS = "bucket int, row int, start int, stop int"


class Bucket:
    """The documents of a bucket in a fixed order, as words. Row numbers are places in that order."""

    def __init__(self, rows: pa.Table):
        keys, texts = rows["key"].to_pylist(), rows["text"].to_pylist()
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0, texts[i] or "", texts[i] is None))
        self.keys = [keys[i] for i in order]
        self.batch = WordBatch([(texts[i] or "").encode().split() for i in order], _HASHES)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows, their anchors and the anchors' hashes. A document without a key neither
        has a place in the order nor repeats an earlier one, so its windows are left out."""
        keyed = np.array([k is not None for k in self.keys], bool)
        at, anchor, h = self.batch.windows(WINDOW, GRAM)
        ok = keyed[self.batch.text[at]] if len(at) else np.zeros(0, bool)
        return at[ok], anchor[ok], h[ok]


def _anchors(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The bucket's anchors: hash, number of them, and whether two documents have it."""
    bucket = Bucket(rows)
    place = np.unique(bucket.windows()[1])
    h = gram_hashes(bucket.batch.hashes, GRAM)[place]
    number = {k: i for i, k in enumerate(dict.fromkeys(bucket.keys))}
    doc = np.array([number[k] for k in bucket.keys], np.int64)[bucket.batch.text[place]] if len(place) else place
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    heads = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[heads, len(h)])
    several = doc[heads] != doc[heads + counts - 1] if len(h) else np.zeros(0, bool)
    return pa.table({
        "h": h[heads].view(np.int64), "bucket": np.full(len(heads), key[0].as_py(), np.int32),
        "n": counts.astype(np.int64), "several": several,
    })


def _passages(shards: int):
    def cut(key: tuple[pa.Scalar, ...], rows: pa.Table, recurring: pa.Table) -> pa.Table:
        """The bucket's passages around recurring anchors, equal ones together."""
        bucket, number = Bucket(rows), key[0].as_py()
        batch = bucket.batch
        at, anchor, h = bucket.windows()
        known = np.asarray(recurring["h"]).view(np.uint64)
        order = np.argsort(known)
        known, often = known[order], np.asarray(recurring["often"])[order]
        found: dict[tuple[int, bytes], list[tuple[int, int]]] = defaultdict(list)
        if len(known) and len(at):
            spot = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = np.flatnonzero(known[spot] == h)
            at, anchor, frequent, h = at[hit], anchor[hit], often[spot[hit]], h[hit]
            if frequent.any():
                h = np.where(frequent, gram_hashes(batch.hashes, WINDOW)[at], h)
            fresh = np.r_[True, (np.diff(at) != 1) | (np.diff(anchor) != 0)] | frequent if len(at) else np.zeros(0, bool)
            heads = np.flatnonzero(fresh)
            last = np.r_[heads[1:], len(at)] - 1
            text = batch.text[at[heads]]
            for start, stop, t, first, code in zip(
                at[heads].tolist(), (at[last] + WINDOW).tolist(), text.tolist(), batch.starts[text].tolist(), h[heads].tolist()
            ):
                found[code, b" ".join(batch.words[start:stop])].append((t, start - first))
        codes = np.array([c for c, _ in found], np.uint64)
        sizes = [len(v) for v in found.values()]
        offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        flat = [x for v in found.values() for x in v]
        lists = lambda values, kind: pa.ListArray.from_arrays(offsets, pa.array(values, kind))
        return pa.table({
            "shard": (codes % np.uint64(shards)).astype(np.int32), "part": (codes >> np.uint64(50)).astype(np.int16),
            "bucket": pa.array([number] * len(found), pa.int32()), "passage": pa.array([p.decode() for _, p in found], pa.string()),
            "keys": lists([bucket.keys[t] for t, _ in flat], pa.int64()), "rows": lists([t for t, _ in flat], pa.int32()),
            "starts": lists([s for _, s in flat], pa.int32()),
        })

    return cut


def _locate(rows: pa.Table) -> pa.Table:
    """Spans of a shard's passages whose windows occur in an earlier document."""
    out = ([], [], [], [])
    parts = 1 + rows.nbytes // (AUTOMATON_WORDS * 8)
    own = np.asarray(rows["part"]) % parts
    for p in range(parts):
        _stream(rows.filter(pa.array(own == p)) if parts > 1 else rows, out)
    return pa.table({n: pa.array(v, pa.int32()) for n, v in zip(["bucket", "row", "start", "stop"], out)})


class _Letters(dict):
    """A character for each word."""

    def __missing__(self, word: str) -> str:
        n = len(self) + 1
        self[word] = c = chr(n if n < 0xD800 else n + 0x800)
        return c


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks])


def _stream(rows: pa.Table, out: tuple[list, list, list, list]) -> None:
    if not len(rows):
        return
    texts, buckets = rows["passage"].to_pylist(), rows["bucket"].to_pylist()
    keys, ends = _flat(rows["keys"]), np.cumsum(np.asarray(pc.list_value_length(rows["keys"])))
    starts = np.r_[0, ends[:-1]]
    bounds: dict[str, tuple[int, int]] = {}  # smallest and largest key of each distinct passage
    for text, low, high in zip(texts, np.minimum.reduceat(keys, starts).tolist(), np.maximum.reduceat(keys, starts).tolist()):
        if (known := bounds.get(text)) is not None:
            low, high = min(low, known[0]), max(high, known[1])
        bounds[text] = low, high

    letters = _Letters()
    passages = {text: "".join(map(letters.__getitem__, text.split(" "))) for text in bounds}
    first: dict[str, int] = {}
    recurring: set[str] = set()
    for text, (low, high) in bounds.items():
        word = passages[text]
        for i in range(len(word) - WINDOW + 1):
            w = word[i : i + WINDOW]
            known = first.get(w)
            if known is None:
                first[w] = low
                if low != high:
                    recurring.add(w)
            elif not low == high == known:
                recurring.add(w)
                if low < known:
                    first[w] = low

    # A phrase is a run of recurring windows with the same first document, as long as a passage has it.
    automaton = ahocorasick.Automaton()
    for word in passages.values():
        begin, owner = 0, None
        for i in range(len(word) - WINDOW + 2):
            w = word[i : i + WINDOW]
            mine = first[w] if len(w) == WINDOW and w in recurring else None
            if mine != owner:
                if owner is not None:
                    automaton.add_word(word[begin : i + WINDOW - 1], (i + WINDOW - 1 - begin, owner))
                begin, owner = i, mine
    if not len(automaton):
        return
    automaton.make_automaton()
    found = {t: sorted((end - n + 1, end + 1, owner) for end, (n, owner) in automaton.iter(w)) for t, w in passages.items()}

    places, begins, keys = _flat(rows["rows"]).tolist(), _flat(rows["starts"]).tolist(), keys.tolist()
    buckets_out, rows_out, from_out, to_out = out
    for text, bucket, a, b in zip(texts, buckets, starts.tolist(), ends.tolist()):
        if not (runs := found[text]):
            continue
        for i in range(a, b):
            key, begin, stop = keys[i], begins[i], -1
            for at, end, owner in runs:
                if owner < key:
                    if at > stop:
                        buckets_out.append(bucket)
                        rows_out.append(places[i])
                        from_out.append(begin + at)
                        to_out.append(begin + end)
                        stop = end
                    elif end > stop:
                        to_out[-1] = begin + end
                        stop = end


def _strip(key: tuple[pa.Scalar, ...], rows: pa.Table, spans: pa.Table) -> pa.Table:
    """The bucket's documents without the words in the spans."""
    bucket = Bucket(rows)
    batch = bucket.batch
    first = batch.starts[np.asarray(spans["row"])] if len(spans) else np.zeros(0, np.int64)
    gone = covered(len(batch.words), first + np.asarray(spans["start"], np.int64), first + np.asarray(spans["stop"], np.int64))
    removed = np.add.reduceat(np.r_[gone, False].astype(np.int64), batch.starts) * (batch.lengths > 0) if len(batch.lengths) else batch.lengths
    kept = []
    for a, b in zip(batch.starts.tolist(), batch.ends.tolist()):
        left = ~gone[a:b]
        words = batch.words[a:b]
        kept.append(b" ".join(words if left.all() else [words[i] for i in np.flatnonzero(left).tolist()]).decode())
    return pa.table({
        "key": pa.array(bucket.keys, pa.int64()), "n_words": batch.lengths, "n_removed": removed, "kept": pa.array(kept, pa.string()),
    })


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_words, n_removed and kept: each text without words that repeat an earlier document.

    Words are runs of characters other than space and \\t to \\r. A word goes if it
    lies in a window of 13 words that also starts in a document with a smaller
    key; windows are judged on the input. Kept words are joined by one space.
    Texts that are null, empty or shorter than a window lose nothing. Rows that
    share a key never take words from each other, and a row without a key takes
    and loses nothing. One row comes out for each that goes in. The key is a long.
    """
    buckets = buckets_for(docs, text)
    width = max(1, -(-buckets // BUCKETS_A_PARTITION))
    dealt = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"),
    ).repartition(width, "bucket")
    anchors = dealt.groupBy("bucket").applyInArrow(_anchors, _ANCHORS)
    same = Window.partitionBy("h")
    recurring = (
        anchors.repartition(width, "h")
        .select("h", "bucket", F.count(F.lit(1)).over(same).alias("in"), F.sum("n").over(same).alias("n"), "several")
        .where((F.col("in") > 1) | F.col("several"))
        .select("bucket", "h", (F.col("n") >= FREQUENT).alias("often"))
    )
    passages = dealt.groupBy("bucket").cogroup(recurring.groupBy("bucket")).applyInArrow(_passages(2 * buckets), _PASSAGES)
    spans = passages.repartition(width, "shard").groupBy("shard").applyInArrow(_locate, _SPANS)
    schema = T.StructType.fromDDL("key long, n_words long, n_removed long, kept string")
    out = dealt.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(_strip, schema)
    return out.withColumnRenamed("key", key)


SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as k from documents),
     windows as (select doc_id, i, array_to_string(k[i:i+12], ' ') as s from (select doc_id, k, unnest(range(1, len(k) - 11)) as i from w)),
     firsts as (select s, min(doc_id) as first from windows group by s),
     gone as (select distinct doc_id, unnest(range(i, i + 13)) as p from windows join firsts using (s) where first < doc_id),
     words as (select doc_id, unnest(k) as word, unnest(range(1, len(k) + 1)) as p from w),
     marked as (select words.*, gone.p is not null as removed from words left join gone using (doc_id, p)),
     kept as (select doc_id, count(*) filter (where removed) as n_removed, string_agg(word, ' ' order by p) filter (where not removed) as text
              from marked group by 1)
select w.doc_id, len(k)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)"""


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
