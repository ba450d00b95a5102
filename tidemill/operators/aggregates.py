"""Aggregation operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.scale import attach, ordered_scan
from tidemill.session import materialise


def _count(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def group_count(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(_count(out))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(_count()).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def group_max(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(c).alias(f"max_{c}") for c in cols])


def list_agg(df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str], sep: str = ",") -> DataFrame:
    """Values of a group joined by ``sep`` in the order of the columns ``order``: one row and one string per group.

    The string is the result, so a group's values have to fit one row.
    """
    item = F.struct(*order, F.col(col).cast("string").alias("_v"))
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_l")).select(
        *keys, F.concat_ws(sep, F.transform("_l", lambda s: s["_v"])).alias("items")
    )


def compare_sums(l: DataFrame, r: DataFrame, key: str, amount: str) -> DataFrame:
    """Totals per key on both sides as decimals, flagged where left exceeds right."""
    money = F.col(amount).cast("decimal(18,2)")
    a = l.groupBy(key).agg(F.sum(money).alias("left_sum"))
    b = r.groupBy(key).agg(F.sum(money).alias("right_sum"))
    return a.join(b, key).withColumn("left_greater", F.col("left_sum") > F.col("right_sum"))


def dup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return group_count(df, keys).where(F.col("n") > 1)


def pivot_count(df: DataFrame, row: Column, col: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts by row and column value, 0 where there is none. Unless they are
    stated, the values are found first, with a distinct pass (Spark refuses above
    spark.sql.pivotMaxValues of them)."""
    return df.groupBy(row).pivot(col, list(values) if values else None).agg(F.count(F.lit(1))).fillna(0)


def pivot_sum(df: DataFrame, row: str, col: str, val: Column, values: Sequence | None = None) -> DataFrame:
    return df.groupBy(row).pivot(col, list(values) if values else None).agg(F.sum(val))


def pivot_totals(df: DataFrame, levels: Sequence[str], col: str, val: Column, names: Mapping) -> DataFrame:
    """Sums of ``val`` per value of ``col`` (``names`` gives each value its column) and their total, for the
    groups of all ``levels``, of all but the last, and so on to the whole, which are told by ``level``, the
    number of columns they are grouped by; ``place`` ranks the groups of a level by their total
    (null where there is nothing to sum).

    Sums per cell are taken first, so the grouping sets expand cells and not rows.
    """
    levels = list(levels)
    cells = df.where(F.col(col).isin(list(names))).groupBy(*levels, col).agg(F.sum(val).alias("_s"))
    sums = [F.sum(F.when(F.col(col) == v, F.col("_s"))).alias(n) for v, n in names.items()]
    depth = sum((1 - F.grouping(c).cast("int") for c in levels), F.lit(0))
    out = materialise(cells.rollup(*levels).agg(depth.alias("level"), *sums, F.sum("_s").alias("total")))
    run = ordered_scan(out.groupBy("level", "total").agg(_count()), [F.desc("total")], {"_upto": F.col("n")}, ["level"])
    places = run.select("level", "total", (F.col("_upto") - F.col("n") + 1).alias("place"), "n")
    return attach(out, places, ["level", "total"], "n").drop("n")


def constant_groups(df: DataFrame, key: str, col: str) -> DataFrame:
    """Keys with exactly one distinct value; min = max needs no distinct pass."""
    lo_hi = df.groupBy(key).agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return lo_hi.where(F.col("lo") == F.col("hi")).select(key)


def series_variance(df: DataFrame, time: Column, val: Column) -> DataFrame:
    """Sample variance of the per-period sums."""
    return df.groupBy(time.alias("_t")).agg(F.sum(val).alias("_s")).agg(F.var_samp("_s").alias("variance"))


def margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cross table with margins in long form; a null level is written 'All'.

    The cells are counted first, so the grouping sets expand cells and not rows.
    """
    cells = df.groupBy(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b)).agg(_count("_n"))
    cube = cells.cube(a, b).agg(F.sum("_n").alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    return cube.select(
        F.when(F.col("_ga") == 1, "All").otherwise(F.col(a)).alias(a),
        F.when(F.col("_gb") == 1, "All").otherwise(F.col(b)).alias(b),
        "n",
    )


def _native_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, whole, real, text, n) in one pass: each column's values in a type that
    keeps them apart, whole numbers as bigint, doubles as they are, others as text."""

    def entry(c: str) -> Column:
        kind = df.schema[c].dataType
        whole, real = isinstance(kind, T.IntegralType), isinstance(kind, (T.FloatType, T.DoubleType))
        return F.struct(
            F.lit(c).alias("column"),
            (F.col(c) if whole else F.lit(None)).cast("bigint").alias("whole"),
            (F.col(c) if real else F.lit(None)).cast("double").alias("real"),
            (F.lit(None) if whole or real else F.col(c)).cast("string").alias("text"),
        )

    each = df.select(F.explode(F.array(*[entry(c) for c in cols])).alias("p")).select("p.*")
    return each.groupBy("column", "whole", "real", "text").agg(_count())


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) of numeric columns in one pass; nulls are counted too.

    Values are counted in their own type and become doubles afterwards, so whole
    numbers that share a double keep a row each.
    """
    value = F.coalesce(F.col("whole").cast("double"), "real", F.col("text").cast("double"))
    return _native_counts(df, cols).select("column", value.alias("value"), "n")


def percentiles(counts: DataFrame, fractions: dict[str, float], keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Exact interpolated percentiles from (keys, value, n) rows.

    Works on counts per distinct value and a distributed running sum, so no task
    holds all the values of a column.
    """
    keys = list(keys)
    run = ordered_scan(counts.where(F.col(value).isNotNull()), [F.col(value)], {"_upto": F.col("n")}, keys)
    total = counts.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.sum("n").alias("_total"))
    both = run.join(F.broadcast(total), keys) if keys else run.join(F.broadcast(total))
    first = F.col("_upto") - F.col("n")
    picks = []
    for name, p in fractions.items():
        pos = F.lit(p) * (F.col("_total") - 1)
        for tag, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            picks.append(F.max(F.when((first <= at) & (at < F.col("_upto")), F.col(value))).alias(f"{name}_{tag}"))
        picks.append(F.max(pos - F.floor(pos)).alias(f"{name}_w"))
    got = both.groupBy(*keys).agg(*picks)
    return got.select(
        *keys,
        *[(F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_w")).alias(n) for n in fractions],
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column, of any type: count, uniques and missing; of numbers the mean, std,
    min, quartiles and max; of other columns the most frequent value as text (the first
    in order of those that tie) and its frequency.

    The column list is short, so joins on it are broadcast.
    """
    cols = list(cols or df.columns)
    numbers = [c for c in cols if c in numeric_columns(df)]
    native = materialise(_native_counts(df, cols))
    number = F.col("column").isin(numbers)
    value = F.when(number, F.coalesce(F.col("whole").cast("double"), "real", F.expr("try_cast(text as double)")))
    counts = native.withColumn("value", value)
    w, v = F.col("n"), F.col("value")
    held = F.coalesce(F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("text").isNotNull(), F.lit(False))
    mean = F.sum(v * w) / F.sum(F.when(v.isNotNull(), w))
    common = F.when(held & ~number, F.struct(-w, F.col("text")))
    moments = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(held, w)), F.lit(0)).alias("count"),
        mean.alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(held).alias("uniques"),
        F.coalesce(F.sum(F.when(~held, w)), F.lit(0)).alias("missing"),
        F.min_by("text", common).alias("top"), F.max(F.when(held & ~number, w)).alias("freq"),
    )
    counts = counts.where(v.isNotNull())
    centred = counts.join(F.broadcast(moments.select("column", "mean")), "column")
    spread = centred.groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum((v - F.col("mean")) ** 2 * w), F.sum(F.when(v.isNotNull(), w)) - 1)).alias("std")
    )
    quart = percentiles(counts, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"])
    return moments.join(F.broadcast(spread), "column", "left").join(F.broadcast(quart), "column", "left")


def missing_ratio(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, ratio) of nulls, one pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    entries = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {entries}) as (column, ratio)")


def percentile_of(df: DataFrame, value: Column, p: float) -> DataFrame:
    """One row: the exact percentile ``p`` of an expression."""
    counts = df.groupBy(value.cast("double").alias("value")).agg(_count())
    return percentiles(counts, {"p": p})


def histogram(df: DataFrame, col: str, lo: float, hi: float, n: int) -> DataFrame:
    """Counts in ``n`` equal bins; 0 is below, n + 1 at or above ``hi``."""
    return df.groupBy(F.width_bucket(F.col(col).cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(n)).alias("bin")).agg(_count())


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(a, b).alias("r"))


def average_ranks(counts: DataFrame, col: str) -> DataFrame:
    """(col, value, rank, n): mean rank of each value of each column, from counts (col, value, n)."""
    run = ordered_scan(counts, [F.col("value")], {"_upto": F.col("n")}, [col])
    return run.select(col, "value", (F.col("_upto") - (F.col("n") - 1) / 2).alias("rank"), "n")


def spearman(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, rho) for every column pair: correlation of average ranks.

    Combinations of values are counted first, so repeated ones travel once. All columns are ranked
    together, in long form and one range scan, so there are as many shuffles for
    two columns as for two hundred. The columns share a numeric type, or are
    compared in the one that Spark gives an array of them.
    """
    cols = list(cols)
    counted = df.dropna(subset=cols).groupBy(*cols).agg(_count("_w"))
    rows = materialise(counted.select(F.monotonically_increasing_id().alias("_id"), "_w", F.array(*cols).alias("_values")))
    long = rows.select("_id", "_w", F.posexplode("_values").alias("_c", "value"))
    ranks = average_ranks(long.groupBy("_c", "value").agg(F.sum("_w").alias("n")), "_c")
    ranked_rows = attach(long, ranks, ["_c", "value"], "n")
    wide = [F.max(F.when(F.col("_c") == i, F.col("rank"))).alias(f"_rank_{c}") for i, c in enumerate(cols)]
    # Shuffled while long: a task holds rows of few values, so each id once, and combining there would keep them all.
    rows = ranked_rows.select("_id", "_w", "_c", "rank").repartition("_id").groupBy("_id").agg(F.first("_w").alias("_w"), *wide)
    w = F.col("_w")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    total = F.sum(w)
    aggs = []
    for a, b in pairs:
        x, y = F.col(f"_rank_{a}"), F.col(f"_rank_{b}")
        mx, my = F.sum(w * x) / total, F.sum(w * y) / total
        cov = F.sum(w * x * y) / total - mx * my
        aggs.append((cov / F.sqrt((F.sum(w * x * x) / total - mx * mx) * (F.sum(w * y * y) / total - my * my))).alias(f"{a}|{b}"))
    entries = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in pairs)
    return rows.agg(*aggs).selectExpr(f"stack({len(pairs)}, {entries}) as (a, b, rho)")


def weighted_median(df: DataFrame, col: str) -> DataFrame:
    """Value where the running weight 1/x (normalised) first passes 0.5.

    Sorted by weight ascending, that is by value descending.
    """
    counts = df.where(F.col(col) > 0).groupBy(F.col(col).alias("value")).agg(_count())
    weight = F.col("n") / F.col("value")
    run = ordered_scan(counts, [F.desc("value")], {"_cum": weight})
    total = counts.agg(F.sum(weight).alias("_total"))
    return run.join(F.broadcast(total)).where(F.col("_cum") / F.col("_total") > 0.5).agg(F.max("value").alias("weighted_median"))


def best_constants(df: DataFrame, col: str) -> DataFrame:
    """Constant that is best for squared error (mean) and for absolute error (median)."""
    mean = df.agg(F.avg(col).alias("mse_best"))
    median = percentile_of(df, F.col(col), 0.5).select(F.col("p").alias("mae_best"))
    return mean.join(F.broadcast(median))


def distinct_stats(df: DataFrame, col: str) -> DataFrame:
    """Distinct count, min and max; distinct values are grouped first."""
    return df.groupBy(col).agg(_count("_n")).agg(
        F.count(col).alias("n_distinct"), F.min(col).alias("lo"), F.max(col).alias("hi")
    )


def argmax_group(df: DataFrame, key: str, by: Sequence[Column], cols: Sequence[str]) -> DataFrame:
    """The row with the largest ``by`` per key, combined map-side."""
    best = F.max_by(F.struct(*cols), F.struct(*by))
    return df.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def coverage(tokens: DataFrame, vocab: DataFrame, col: str = "token") -> DataFrame:
    """Share of token occurrences that the vocabulary knows."""
    counts = tokens.groupBy(col).agg(_count())
    known = vocab.select(col).distinct().withColumn("_known", F.lit(1))
    hit = F.sum(F.when(F.col("_known") == 1, F.col("n")).otherwise(0))
    return counts.join(known, col, "left").agg((hit / F.sum("n")).alias("coverage"))
