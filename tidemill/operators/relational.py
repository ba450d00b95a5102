"""Projection, filter and conditional operators."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).dropDuplicates()


def keep(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(cond)


def keep_codes(df: DataFrame, col: str, include: Sequence | None = None, exclude: Sequence | None = None) -> DataFrame:
    """IN and NOT IN lists; a null code drops out, as in SQL."""
    if include is not None:
        df = df.where(F.col(col).isin(*include))
    if exclude is not None:
        df = df.where(~F.col(col).isin(*exclude))
    return df


def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def recent(df: DataFrame, col: str, days: int, as_of: str) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (a parameter, not today)."""
    return df.where(F.col(col) >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz"))


def overwrite_where(df: DataFrame, col: str, cond: Column, value) -> DataFrame:
    return df.withColumn(col, F.when(cond, F.lit(value)).otherwise(F.col(col)))


def clip(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    c = F.col(col)
    if lo is not None:
        c = F.greatest(c, F.lit(lo))
    if hi is not None:
        c = F.least(c, F.lit(hi))
    return df.withColumn(col, F.when(F.col(col).isNotNull(), c))


def map_codes(df: DataFrame, col: str, mapping: Mapping, default=None, out: str | None = None) -> DataFrame:
    """Code to label by a short fixed list; other codes get ``default``."""
    expr = None
    for code, label in mapping.items():
        test = F.col(col) == F.lit(code)
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return df.withColumn(out or col, expr.otherwise(F.lit(default)))


def safe_names(df: DataFrame) -> DataFrame:
    """Blanks and hyphens in column names become underscores."""
    return df.toDF(*[re.sub(r"[ \-]+", "_", c.strip()) for c in df.columns])


def drop_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def fill_cast(df: DataFrame, rules: Mapping[str, tuple]) -> DataFrame:
    """``{column: (fill value, type)}``: fill nulls, then cast."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)).cast(t) for c, (v, t) in rules.items()})


def bucket(df: DataFrame, col: str, edges: Sequence, names: Sequence[str], out: str) -> DataFrame:
    """Named half-open ranges: names[i] for edges[i] <= x < edges[i+1]."""
    if len(edges) != len(names) + 1:
        raise ValueError("need one more edge than names")
    expr = F.lit(None).cast("string")
    for lo, hi, name in reversed(list(zip(edges, edges[1:], names, strict=False))):
        expr = F.when((F.col(col) >= lo) & (F.col(col) < hi), name).otherwise(expr)
    return df.withColumn(out, expr)


def preview(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample_hash(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of ``n`` rows: the smallest seeded hashes of the key."""
    mark = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    return df.orderBy(mark, F.col(key)).limit(n)


def quad_expand(df: DataFrame, x: str, y: str) -> DataFrame:
    """Feature columns x, y, x², y², xy, 1."""
    a, b = F.col(x), F.col(y)
    return df.withColumns(
        {"q_x": a, "q_y": b, "q_xx": a * a, "q_yy": b * b, "q_xy": a * b, "q_one": F.lit(1.0)}
    )
