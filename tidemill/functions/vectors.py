"""Array expressions on dense vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once. Inside a lambda over an array
    an expression would be worked out again for every element."""
    return F.transform(F.array(value), body)[0]


def pad(arr: Column, n: int, fill) -> Column:
    """Cut to ``n`` elements, or pad at the end."""
    cut = F.slice(arr, 1, n)
    return F.concat(cut, F.array_repeat(F.lit(fill), F.lit(n) - F.size(cut)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null when a vector is all zeros."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def scale(a: Column, k: Column) -> Column:
    return let(k, lambda once: F.transform(a, lambda x: x * once))


def l2_normalise(a: Column) -> Column:
    """Unit length; a vector of zeros stays as it is."""
    return scale(a, F.coalesce(F.try_divide(F.lit(1.0), norm(a)), F.lit(0.0)))


def projection(e: Column, axis: Column) -> Column:
    return scale(axis, dot(e, axis) / dot(axis, axis))


def neutralise(e: Column, axis: Column) -> Column:
    """Component of ``e`` orthogonal to the axis."""
    return minus(e, projection(e, axis))


def equalise(df: DataFrame, e1: str, e2: str, axis: str, out1: str, out2: str) -> DataFrame:
    """Make a pair of columns differ only, and by the same amount, along the axis.

    Worked out in named steps, so that no shared term is computed twice.
    """
    a, b, g = F.col(e1), F.col(e2), F.col(axis)
    mid = df.withColumn("_mu", scale(add(a, b), F.lit(0.5)))
    on = mid.withColumns({"_mu_on": projection(F.col("_mu"), g), "_p1": projection(a, g), "_p2": projection(b, g)})
    off = on.withColumn("_off", minus(F.col("_mu"), F.col("_mu_on")))
    ready = off.withColumns(
        {
            "_size": F.sqrt(F.abs(F.lit(1.0) - dot(F.col("_off"), F.col("_off")))),
            "_far1": norm(minus(minus(a, F.col("_off")), F.col("_mu_on"))),
            "_far2": norm(minus(minus(b, F.col("_off")), F.col("_mu_on"))),
        }
    )

    def moved(p: str, far: str) -> Column:
        return add(scale(minus(F.col(p), F.col("_mu_on")), F.col("_size") / F.col(far)), F.col("_off"))

    done = ready.withColumns({out1: moved("_p1", "_far1"), out2: moved("_p2", "_far2")})
    return done.drop("_mu", "_mu_on", "_p1", "_p2", "_off", "_size", "_far1", "_far2")
