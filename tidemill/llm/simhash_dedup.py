"""Operator 5: SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import shuffles_dropped, table, text_runs
from tidemill.llm.components import components
from tidemill.session import materialise, scratch_dir

SHINGLE = 4
RADIUS = 4
SEED = 42
#: The space of variants is worked off in so many parts, one after the other, to bound the disk.
ROUNDS = 8
#: Variants that one shard of a round holds, about.
SHARD_VARIANTS = 1_000_000


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority, bit by bit, of the XXH64 of all word shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    k = min(shingle, len(words))
    starts, ends = (ends - lengths)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for a in range(0, len(starts), 1 << 16):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[a : a + (1 << 16)], ends[a : a + (1 << 16)])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Key and ``fp`` (the 64 bits as a signed long) of each row."""
    schema = T.StructType([docs.schema[key], T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_runs(whole, text):
                prints = np.array([simhash(t, shingle) for t in batch[text].to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch[key], pa.array(prints)], schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def flips(half: int) -> np.ndarray:
    """All masks of up to ``half`` of 64 bits."""
    masks = [sum(1 << b for b in bits) for n in range(half + 1) for bits in combinations(range(64), n)]
    return np.array(masks, np.uint64)


def part_of(z: np.ndarray, rounds: int) -> np.ndarray:
    """The part of the space a word is in: its linear code syndrome (of x ^ y, the syndromes' xor)."""
    out = np.zeros(z.shape, np.int64)
    for bit in range(64):
        out ^= np.where((z >> np.uint64(bit)) & np.uint64(1), (bit * 5 + 1) % rounds, 0)
    return out


def mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return z ^ (z >> np.uint64(29))


def links(prints: DataFrame, radius: int = RADIUS, rounds: int = ROUNDS) -> DataFrame:
    """Links (a, b) that join distinct fingerprints ``fp`` with their neighbours within ``radius`` bits.

    Two words within the radius meet in a variant at most half of it from each.
    So every word emits all variants within half the radius, and the variants
    are shuffled; only the word and the number of the flip travel, the variant
    is made again where it arrives. All words that meet in a variant are within
    the radius of each other, which is verified, and the smallest stands for
    them: each other one is linked to it, so that a group of many words never
    makes all its pairs, and no connection is lost. A variant can't gather more
    words than there are flips, so no shard is hot.

    ``radius`` must be even, ``rounds`` a power of two: a round takes those
    variants whose syndrome is the round's number.
    """
    spark = prints.sparkSession
    masks = flips(radius // 2)
    by_part = [np.flatnonzero(part_of(masks, rounds) == p) for p in range(rounds)]
    shards = max(1, ceil(prints.count() * len(masks) / rounds / SHARD_VARIANTS))

    def emit(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = np.asarray(batch["fp"]).view(np.uint64)
                for a in range(0, len(words), 2048):
                    own = words[a : a + 2048]
                    home = part_of(own, rounds)
                    who, flip = [], []
                    for p in range(rounds):
                        mine, some = own[home == p], by_part[p ^ turn]
                        who.append(np.repeat(mine, len(some)))
                        flip.append(np.tile(some, len(mine)))
                    x, f = np.concatenate(who), np.concatenate(flip)
                    shard = (mixed(x ^ masks[f]) % np.uint64(shards)).astype(np.int32)
                    order = np.argsort(shard, kind="stable")
                    x, f, shard = x[order], f[order], shard[order]
                    cuts = np.flatnonzero(np.r_[True, np.diff(shard) > 0, True])
                    offsets = pa.array(cuts, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[cuts[:-1]]), pa.ListArray.from_arrays(offsets, pa.array(x.view(np.int64))),
                         pa.ListArray.from_arrays(offsets, pa.array(f.astype(np.int16)))],
                        ["shard", "fps", "flips"],
                    )

        return run

    def meet(group: pa.Table) -> pa.Table:
        x = np.concatenate([c.values.to_numpy() for c in group["fps"].chunks]).view(np.uint64)
        f = np.concatenate([c.values.to_numpy() for c in group["flips"].chunks])
        z = x ^ masks[f]
        order = np.argsort(z, kind="stable")
        x, z = x[order], z[order]
        heads = np.flatnonzero(np.r_[True, z[1:] != z[:-1]])
        least = np.repeat(np.minimum.reduceat(x, heads), np.diff(np.r_[heads, len(z)]))
        apart = (least != x) & (np.bitwise_count(least ^ x) <= radius)
        pairs = np.unique(np.stack([least[apart], x[apart]]), axis=1) if apart.any() else np.zeros((2, 0), np.uint64)
        return pa.table({"a": pairs[0].view(np.int64), "b": pairs[1].view(np.int64)})

    out = scratch_dir(spark, "links")
    with shuffles_dropped(spark):
        for turn in range(rounds):
            sent = prints.select("fp").mapInArrow(emit(turn), "shard int, fps array<long>, flips array<short>")
            sent.groupBy("shard").applyInArrow(meet, "a long, b long").write.mode("append").parquet(out)
    return spark.read.schema("a long, b long").parquet(out).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """Key, ``fp`` and ``component``: the smallest key that is reachable over links of ``radius`` bits or fewer.

    Equal fingerprints are one node. Null, empty and wordless texts have the
    fingerprint 0 and are linked like any other. Repeated rows come out as often
    as they go in. A null key never names a component, unless all keys in it are null.
    """
    marked = materialise(fingerprints(docs, key, text, shingle))
    nodes = materialise(marked.groupBy("fp").agg(F.min(key).alias("first")))
    groups = components(links(nodes, radius))
    joined = nodes.join(groups, nodes.fp == groups.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = joined.groupBy("root").agg(F.min("first").alias("component"))
    labels = materialise(joined.join(named, "root").select("fp", "component"))
    return marked.join(labels, "fp").select(key, "fp", "component")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )
