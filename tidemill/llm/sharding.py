"""Operator 6: rendezvous hashing of record keys over weighted shards. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import refuse, table
from tidemill.operators.scale import ranked

SHARDS = 24


def rendezvous(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """The shard with the highest score for the key, an int from 0.

    A shard's score is its weight over -ln(u), with u in (0, 1) from a hash of key
    and shard. Scores of other shards don't depend on how many there are, so that
    a further shard takes rows only into itself, and a shard gets rows in
    proportion to its weight. Of equal scores the smaller shard wins. A null key
    hashes like any other value, so all rows without a key share one shard. A
    shard of weight 0 gets nothing as long as another weighs more.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be above 0")

    def score(shard: int, weight: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(*keys, F.lit(shard)), 11).cast("double") + 0.5) / float(1 << 53)
        return F.struct((F.lit(float(weight)) / -F.ln(u)).alias("score"), F.lit(-shard).alias("shard"))

    scores = [score(i, w) for i, w in enumerate(weights)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return -best["shard"]


def assign(rows: DataFrame, keys: Sequence[str], weights: Sequence[float], shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add the shard of each row, and its place in the shard, gapless from 0.

    Places follow the order of the key, then of the other columns, so that they
    are the same in every run; equal rows are interchangeable. They are counted
    over ranges of (shard, key), so no task needs a whole shard. Names that are taken are refused.
    """
    refuse([shard, slot], rows.columns)
    put = rows.withColumn(shard, rendezvous([F.col(k) for k in keys], weights))
    order = [F.col(c) for c in [*keys, *(c for c in rows.columns if c not in keys)]]
    return ranked(put, order, slot, [shard]).withColumn(slot, F.col(slot) - 1)


def write_shards(rows: DataFrame, path: str, shard: str = "shard") -> None:
    """Write the rows as Parquet, a folder for each shard."""
    rows.write.partitionBy(shard).parquet(path)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law is `key`: doc_id and shard count decide. A null text has no bytes and the checksum 0."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32")
    )
    return assign(docs, ["doc_id"], [1.0] * SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        rendezvous([F.col("doc_id")], [1.0] * (SHARDS + 1)).alias("grown_shard"),
    )
