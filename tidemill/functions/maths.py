"""Arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.vectors import let


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def sigmoid_slope(c: Column) -> Column:
    s = sigmoid(c)
    return s * (F.lit(1.0) - s)


def softmax(arr: Column) -> Column:
    """Softmax of an array, shifted by its maximum so that nothing overflows."""
    raised = let(F.array_max(arr), lambda top: F.transform(arr, lambda x: F.exp(x - top)))

    def share(r: Column) -> Column:
        return let(F.aggregate(r, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(r, lambda x: x / total))

    return let(raised, share)


def l1_loss(y: Column, p: Column) -> Column:
    return F.sum(F.abs(y - p))


def l2_loss(y: Column, p: Column) -> Column:
    return F.sum((y - p) * (y - p))


def log_loss(y: Column, p: Column, eps: float = 1e-15) -> Column:
    """Mean negative log likelihood of a 0/1 label under probability ``p``."""
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return F.avg(-(y * F.log(q) + (1 - y) * F.log(1 - q)))


def fit_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row of means and population deviations, to be learned on training rows."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in cols],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in cols],
    )


def standardise(df: DataFrame, cols: list[str], stats: DataFrame) -> DataFrame:
    """(x - mean) / std with learned values; ``stats`` is a single row."""
    joined = df.join(F.broadcast(stats))
    scaled = {f"{c}_z": (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std") for c in cols}
    return joined.withColumns(scaled).drop(*stats.columns)
