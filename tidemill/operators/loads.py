"""Set operations, deduplication, upsert and load modes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.scale import top_per_key


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of same-shaped sets, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def append_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` does not hold."""
    return a.subtract(b)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    mode: str = "keep_existing",
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    keep_existing: a known key keeps its stored row (first write wins).
    replace:       a known key takes the new row.
    Several new rows with one key are settled by ``order``, first one wins.
    """
    keys = list(keys)
    if mode not in ("keep_existing", "replace"):
        raise ValueError(mode)
    rest = [F.col(c) for c in source.columns if c not in keys]
    batch = top_per_key(source, keys, [*(order or []), *rest] or [F.lit(0)])
    if mode == "keep_existing":
        fresh = batch.join(target.select(*keys), keys, "left_anti")
        return target.unionByName(fresh.select(*target.columns))
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns)).select(*target.columns)


def load(df: DataFrame, out: str, mode: str = "truncate_insert", partition_by: Sequence[str] = ()) -> None:
    """Write a table: truncate-and-insert, or append."""
    modes = {"truncate_insert": "overwrite", "append": "append"}
    writer = df.write.mode(modes[mode])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)
