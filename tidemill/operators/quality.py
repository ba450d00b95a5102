"""Data-quality checks as result rows (Q01-Q06)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.aggregates import row_counts


class CheckFailed(AssertionError):
    """Raised by ``enforce`` with the failed checks."""


def check_nonempty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check, passed, actual, expected): every table has rows."""
    counts = row_counts(dict(tables))
    return counts.select(
        F.concat(F.lit("nonempty_"), "table_name").alias("check"), (F.col("n") > 0).alias("passed"),
        F.col("n").alias("actual"), F.lit(1).cast("bigint").alias("expected"),
    )


def check_expected(name: str, value: DataFrame, expected: int) -> DataFrame:
    """Compare a one-row, one-column result with an expected number."""
    actual = F.col(value.columns[0]).cast("bigint")
    want = F.lit(expected).cast("bigint")
    return value.select(F.lit(name).alias("check"), (actual == want).alias("passed"), actual.alias("actual"), want.alias("expected"))


def check_unique(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once; 0 expected."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n"))
    return check_expected(name, dup, 0)


def table_shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_columns, n): schema width and row count of every output."""
    counts = row_counts(dict(tables))
    width = F.create_map(*[x for k, v in tables.items() for x in (F.lit(k), F.lit(len(v.columns)))])
    return counts.select("table_name", F.element_at(width, F.col("table_name")).alias("n_columns"), "n")


def combine(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def enforce(checks: DataFrame) -> None:
    """Raise when any check failed; there are only a few check rows."""
    failed = [r["check"] for r in checks.where(~F.col("passed")).collect()]
    if failed:
        raise CheckFailed(", ".join(failed))
