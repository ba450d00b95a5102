"""A table that grows by batches and is asked which keys it holds.

Layout: batch=N/depth=D/bucket=B. A batch is cut into 2^D buckets by a hash of the key, as
many as its rows ask for; so the number of buckets follows the size of what is stored,
and a small batch stays one file. A question about some keys reads, of each batch, only the
buckets that these keys fall into, and of those only the row groups whose Bloom filter
does not rule the keys out.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a bucket, about.
BUCKET_ROWS = 200_000
DEEPEST = 20
#: A question about more buckets or keys than this reads without a list of them.
LISTED = 2_000
HASH = "_k"
_LAYOUT = [T.StructField("batch", T.LongType()), T.StructField("depth", T.IntegerType()), T.StructField("bucket", T.IntegerType())]


def hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(HASH, F.xxhash64(*keys))


def _bucket(depth: int) -> Column:
    return F.col(HASH).bitwiseAND((1 << depth) - 1).cast("int")


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a hashed batch; doing it again replaces it."""
    n = rows.count()
    depth = min(DEEPEST, max(0, ceil(log2(max(n, 1) / BUCKET_ROWS))))
    cut = rows.withColumns({"depth": F.lit(depth), "bucket": _bucket(depth)})
    (
        cut.hint("rebalance", "bucket").sortWithinPartitions("bucket", HASH).write.mode("overwrite").partitionBy("depth", "bucket")
        .option(f"parquet.bloom.filter.enabled#{HASH}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{HASH}", str(min(max(n, 1), 2 * BUCKET_ROWS)))
        .parquet(f"{path}/batch={batch_id}")
    )


def stored(spark: SparkSession, path: str, batch_id: int, like: DataFrame) -> DataFrame | None:
    """Rows of earlier batches, with their places; none before the first. A batch that runs again does not see its own rows."""
    wide = T.StructType([*like.schema.fields, *_LAYOUT])
    try:
        return spark.read.schema(wide).parquet(path).where(F.col("batch") < batch_id)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def around(kept: DataFrame, asked: DataFrame) -> DataFrame:
    """The stored rows that may have one of the keys ``asked`` (hashed): those in their buckets, and,
    for few keys, those with their hashes."""
    depths = [r["depth"] for r in kept.select("depth").distinct().collect()]  # read off the folders
    few = asked.select(HASH).distinct().limit(LISTED + 1).collect()
    if len(few) <= LISTED:
        hashes = [r[HASH] for r in few]
        touched = F.lit(False)
        for d in depths:
            touched = touched | ((F.col("depth") == d) & F.col("bucket").isin(sorted({h & ((1 << d) - 1) for h in hashes})))
        return kept.where(touched & F.col(HASH).isin(hashes)) if hashes else kept.limit(0)
    touched = F.lit(False)
    for d in depths:
        buckets = [r[0] for r in asked.select(_bucket(d)).distinct().limit(LISTED + 1).collect()]
        here = F.col("depth") == d
        touched = touched | (here & F.col("bucket").isin(buckets) if len(buckets) <= LISTED else here)
    return kept.where(touched)


def append_unseen(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str]) -> None:
    """Append the rows of a batch, one per key and hashed, whose keys are not stored."""
    kept = stored(batch.sparkSession, path, batch_id, batch)
    fresh = batch if kept is None else batch.join(around(kept, batch).select(*keys), list(keys), "left_anti").select(*batch.columns)
    write_batch(fresh, path, batch_id)


def append_timed(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], time: str, bound: str) -> None:
    """The same where copies of a row come with times within ``bound`` of each other, mostly soon.

    A row is late if its time is more than ``bound`` before the newest one stored before this
    batch. Rows in time are held against stored rows within ``bound`` of the batch's
    oldest one in time; so the rest of the table need not be read. Late rows, however
    late, are held against all stored rows in the buckets of their keys. Neither are lost.
    """
    spark = batch.sparkSession
    kept = stored(spark, path, batch_id, batch)
    seen = f"{path}/_newest"
    newest = None
    if kept is not None:
        newest = spark.read.parquet(seen).where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
    fresh = batch
    if newest is not None:
        horizon = F.expr(f"timestamp '{newest}' - interval {bound}")
        at = F.col(time).cast("timestamp")
        is_late = F.coalesce(at < horizon, F.lit(True))
        in_time, late = batch.where(~is_late), batch.where(is_late)
        first = in_time.agg(F.min(at)).first()[0]
        recent = kept.limit(0) if first is None else kept.where(F.col(time) >= F.expr(f"cast(timestamp '{first}' - interval {bound} as {batch.schema[time].dataType.simpleString()})"))
        known = [in_time.join(recent.select(*keys), list(keys), "left_anti"), late.join(around(kept, late).select(*keys), list(keys), "left_anti")]
        fresh = known[0].select(*batch.columns).unionByName(known[1].select(*batch.columns))
    write_batch(fresh, path, batch_id)
    batch.agg(F.max(F.col(time).cast("timestamp")).alias("newest")).write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
