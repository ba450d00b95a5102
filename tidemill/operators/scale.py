"""Skew-safe building blocks used by the other operators.

``attach``       put one row of statistics per key onto every row of that key.
``ordered_scan`` running totals along an order, for one key or for the table.
``top_per_key``  best k rows per key.
``distinct_rows`` distinct rows of a frame whose rows are mostly distinct already.

None of them needs a whole key, or a whole table, in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import discard, materialise

HOT_ROWS = 4_000_000
SALTS = 512
#: Rows of one range of a scan: at least, while ranges are fewer than the session's
#: shuffle partitions, and at most, however large the table is.
RANGE_LEAST = 50_000
RANGE_MOST = 2_000_000


def _all_equal(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def _slot(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS))


def _common(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys in the type that a join of both sides compares, with one zero.

    A hash depends on the type, and on the sign of a zero; a join does not.
    """
    out = []
    for f in left.select(*keys).union(right.select(*keys)).schema.fields:
        c = F.col(f.name).cast(f.dataType)
        out.append(F.when(c == 0, F.lit(0).cast(f.dataType)).otherwise(c) if isinstance(f.dataType, T.FractionalType) else c)
    return out


def attach(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    weight: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of ``rows`` to ``stats``, which has one row per key.

    ``weight`` is the column of ``stats`` that counts the rows of the key. Keys
    above ``hot_rows`` number at most rows / hot_rows, so that part of ``stats``
    is bounded and is broadcast; the rows of those keys are then spread over
    salts so that the shuffle join of the remaining keys stays even. The salt
    mixes the row with its input partition, since the rows of a hot key may be
    copies of each other. Null keys match nothing. ``weight`` stays in the result.
    """
    keys = list(keys)
    values = [c for c in stats.columns if c not in keys]
    packed = stats.dropna(subset=keys).select(*keys, F.struct(*values).alias("_v"))
    hot = packed.where(F.col(f"_v.{weight}") > hot_rows).withColumnRenamed("_v", "_hot")
    # The salt of a cold key follows from the key. A constant would not do: the
    # optimizer would turn it into a filter and shuffle by the key alone.
    own = _slot(*_common(rows, stats, keys))
    cold = packed.where(F.col(f"_v.{weight}") <= hot_rows).withColumnRenamed("_v", "_cold").withColumn("_salt", own)
    idle = F.lit(False)
    for k in keys:
        idle = idle | F.col(k).isNull()
    spread = _slot(*[F.col(c) for c in rows.columns], F.spark_partition_id())
    tagged = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull() | idle, spread).otherwise(own)
    )
    return tagged.join(cold, [*keys, "_salt"], "left").select(
        *rows.columns, *[F.coalesce(f"_hot.{v}", f"_cold.{v}").alias(v) for v in values]
    )


def with_group_stats(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, **aggs: Column
) -> DataFrame:
    """Group aggregates on every row, without a window over whole groups."""
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in aggs.items()])
    return attach(df, stats, keys, "_n", hot_rows).drop("_n")


def ordered_scan(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, Column],
    keys: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Running (inclusive) sums of ``totals`` along ``order`` within ``keys``.

    Rows are written, which tells their number and so that of the ranges, then
    range-partitioned by keys and order and written again; each range runs its
    own sums; what earlier ranges of the same key sum to is carried in. A range
    boundary cuts at most one key, so there are fewer carries than ranges, and
    they are broadcast. ``order`` should be unique within a key.
    """
    keys = list(keys)
    order = list(order)
    staged = materialise(df.withColumns({f"_t_{n}": c for n, c in totals.items()}))
    parts = parts or ranges_for(staged)
    ranged = materialise(
        staged.repartitionByRange(parts, *[F.col(k) for k in keys], *order).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    discard(staged)
    local = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumns({f"_r_{n}": F.sum(f"_t_{n}").over(local) for n in totals})
    sums = ranged.groupBy(*keys, "_part").agg(*[F.sum(f"_t_{n}").alias(f"_c_{n}") for n in totals])
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        sums.withColumn("_before", F.count(F.lit(1)).over(earlier))
        .withColumns({f"_c_{n}": F.sum(f"_c_{n}").over(earlier) for n in totals})
        .where(F.col("_before") > 0)
        .drop("_before")
    )
    joined = running.alias("r").join(
        F.broadcast(carry).alias("c"), _all_equal("r", "c", [*keys, "_part"]), "left"
    )
    out = [F.col(f"r.{c}").alias(c) for c in df.columns]
    for n in totals:
        mine, before = F.col(f"r._r_{n}"), F.col(f"c._c_{n}")
        out.append(F.when(before.isNull(), mine).otherwise(F.coalesce(mine, F.lit(0)) + before).alias(n))
    return joined.select(*out)


def ranges_for(df: DataFrame) -> int:
    """Ranges for a written table, from its number of rows."""
    rows, width = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(width, ceil(rows / RANGE_LEAST)), ceil(rows / RANGE_MOST))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rn", keys: Sequence[str] = ()) -> DataFrame:
    """Row number along a total order, for whole tables or very large keys."""
    return ordered_scan(df, order, {name: F.lit(1).cast("long")}, keys)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table from Python values, made in the JVM (no Python workers)."""
    kind = f"array<struct<{','.join(':'.join(f.split(None, 1)) for f in schema.split(', '))}>>"
    packed = F.array(*[F.struct(*[F.lit(v) for v in row]) for row in rows]) if rows else F.array()
    return spark.range(1).select(F.inline(packed.cast(kind)))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows per key. Spark prunes each partition to ``k`` rows per
    key before the shuffle, so a hot key sends only a few rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows of a wide frame of which few repeat.

    Combining ahead of the shuffle would hold every different row of its task, and a task that reads
    well packed files has as many as a split makes. So rows are shuffled first, by all
    columns, and combined in parts that Spark cuts by size.
    """
    return df.hint("rebalance", *df.columns).distinct()
