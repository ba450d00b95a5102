"""Ordered and per-row statistics operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.scale import attach, ordered_scan, ranked, top_per_key, with_group_stats


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key after a sort with mixed directions."""
    return top_per_key(df, keys, order)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(df, keys, order)


def dup_flag(df: DataFrame, keys: Sequence[str], out: str = "is_dup") -> DataFrame:
    """Mark every member of a group that has more than one row."""
    return with_group_stats(df, keys, _size=F.count(F.lit(1))).withColumn(out, F.col("_size") > 1).drop("_size")


def daily_flags(df: DataFrame, key: str, date: str, flags: dict[str, Column]) -> DataFrame:
    """One row per key and day; a flag is set when any row of the day sets it.

    This bounds a key's series by the calendar, however many rows the key has.
    """
    return df.groupBy(key, F.col(date).cast("date").alias(date)).agg(
        *[F.max(c.cast("int")).alias(n) for n, c in flags.items()]
    )


def days_since(daily: DataFrame, key: str, date: str, flags: Sequence[str], prefix: str = "After") -> DataFrame:
    """Days since the flag was last set, 0 before its first time.

    ``daily`` has one row per key and day.
    """
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    seen = {f: F.last(F.when(F.col(f) > 0, F.col(date)), ignorenulls=True).over(w) for f in flags}
    return daily.withColumns({prefix + f: F.coalesce(F.datediff(date, c), F.lit(0)) for f, c in seen.items()})


def days_until(daily: DataFrame, key: str, date: str, flags: Sequence[str], prefix: str = "Before") -> DataFrame:
    """Row date minus the next date the flag is set (0 or negative); 0 after the last."""
    w = Window.partitionBy(key).orderBy(F.desc(date)).rowsBetween(Window.unboundedPreceding, 0)
    nxt = {f: F.last(F.when(F.col(f) > 0, F.col(date)), ignorenulls=True).over(w) for f in flags}
    return daily.withColumns({prefix + f: F.coalesce(F.datediff(date, c), F.lit(0)) for f, c in nxt.items()})


def rolling(daily: DataFrame, key: str, date: str, cols: Sequence[str], rows: int = 7) -> DataFrame:
    """Sums over the last and the next ``rows`` rows of the key, at least one row."""
    w = Window.partitionBy(key).orderBy(date)
    back, fwd = w.rowsBetween(-(rows - 1), 0), w.rowsBetween(0, rows - 1)
    exprs = {f"{c}_bw": F.sum(c).over(back) for c in cols} | {f"{c}_fw": F.sum(c).over(fwd) for c in cols}
    return daily.withColumns(exprs)


def contiguous_folds(df: DataFrame, order: Sequence[Column], k: int, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1 by position; the first n % k folds get one row more."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    pos = ranked(df, order, "_pos").join(F.broadcast(total))
    size, extra = F.expr(f"_total div {k}"), F.expr(f"_total % {k}")
    at = F.col("_pos") - 1
    edge = extra * (size + 1)
    fold = F.when(at < edge, F.floor(at / (size + 1))).otherwise(extra + F.floor((at - edge) / size))
    return pos.withColumn(out, fold.cast("int")).drop("_pos", "_total")


def target_encode(
    df: DataFrame,
    key: str,
    target: str,
    scheme: str = "mean",
    order: Sequence[Column] = (),
    k: int = 5,
    alpha: float = 100.0,
    fill: float = 0.3343,
    out: str = "enc",
) -> DataFrame:
    """Mean of the target per category, by one of five schemes.

    mean       plain group mean
    kfold      mean over the other folds (contiguous folds in ``order``)
    loo        mean over the other rows
    smooth     (mean * n + global * alpha) / (n + alpha)
    expanding  mean over the earlier rows in ``order`` (unique order needed)
    Rows with nothing to average get ``fill``.
    """
    y = F.col(target)
    known = F.count(target)
    if scheme == "mean":
        enc = with_group_stats(df, [key], _e=F.avg(target))
        return enc.withColumn(out, F.coalesce("_e", F.lit(fill))).drop("_e")
    if scheme == "loo":
        enc = with_group_stats(df, [key], _s=F.sum(target), _c=known)
        value = (F.col("_s") - y) / F.nullif(F.col("_c") - 1, F.lit(0))
        return enc.withColumn(out, F.coalesce(value, F.lit(fill))).drop("_s", "_c")
    if scheme == "smooth":
        enc = with_group_stats(df, [key], _s=F.sum(target), _c=known)
        enc = enc.join(F.broadcast(df.agg(F.avg(target).alias("_g"))))
        value = (F.col("_s") + F.col("_g") * alpha) / (F.col("_c") + alpha)
        return enc.withColumn(out, F.coalesce(value, F.lit(fill))).drop("_s", "_c", "_g")
    if scheme == "kfold":
        folded = contiguous_folds(df, order, k, "_fold")
        part = folded.groupBy(key, "_fold").agg(F.sum(target).alias("_fs"), known.alias("_fc"), F.count(F.lit(1)).alias("_n"))
        per_key = Window.partitionBy(key)  # at most k rows per key here
        stats = part.select(
            key, "_fold", "_n",
            (F.sum("_fs").over(per_key) - F.col("_fs")).alias("_s"),
            (F.sum("_fc").over(per_key) - F.col("_fc")).alias("_c"),
        )
        value = F.col("_s") / F.nullif(F.col("_c"), F.lit(0))
        enc = attach(folded, stats, [key, "_fold"], "_n")
        return enc.withColumn(out, F.coalesce(value, F.lit(fill))).drop("_fold", "_n", "_s", "_c")
    if scheme == "expanding":
        run = ordered_scan(df, order, {"_s": y, "_c": F.when(y.isNotNull(), 1).otherwise(0)}, [key])
        mine = F.when(y.isNotNull(), 1).otherwise(0)
        value = (F.col("_s") - F.coalesce(y, F.lit(0))) / F.nullif(F.col("_c") - mine, F.lit(0))
        return run.withColumn(out, F.coalesce(value, F.lit(fill))).drop("_s", "_c")
    raise ValueError(scheme)


def missing_dates(df: DataFrame, col: str) -> DataFrame:
    """Calendar days between first and last that have no row."""
    days = df.select(F.col(col).cast("date").alias("day")).where("day is not null").distinct()
    span = days.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return span.join(days, "day", "left_anti")


def char_windows(df: DataFrame, key: str, text: str, width: int, stride: int) -> DataFrame:
    """Every ``stride`` characters a window of ``width`` and the character after it."""
    last = F.length(text) - width - 1
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    at = df.select(key, text, F.explode(starts).alias("start"))
    return at.select(
        key, "start",
        F.substring(F.col(text), F.col("start") + 1, F.lit(width)).alias("window"),
        F.substring(F.col(text), F.col("start") + 1 + width, F.lit(1)).alias("next"),
    )


def best_split(df: DataFrame, x: str, y: str, min_leaf: int = 1) -> DataFrame:
    """Threshold on ``x`` that minimises the size-weighted deviation of ``y``.

    Rows are summed per distinct x first (ties cannot be split anyway), then
    prefix sums run over the distinct values. One row: x, split, score, n_left.
    """
    v = F.col(y).cast("double")
    per_x = df.groupBy(F.col(x).alias("x")).agg(F.count(F.lit(1)).alias("c"), F.sum(v).alias("s"), F.sum(v * v).alias("s2"))
    run = ordered_scan(per_x, [F.col("x")], {"lc": F.col("c"), "ls": F.col("s"), "ls2": F.col("s2")})
    total = per_x.agg(F.sum("c").alias("n"), F.sum("s").alias("ts"), F.sum("s2").alias("ts2"))
    j = run.join(F.broadcast(total))

    def weighted_dev(c: Column, s: Column, s2: Column) -> Column:
        return F.sqrt(F.greatest(s2 / c - (s / c) ** 2, F.lit(0.0))) * c

    rc = F.col("n") - F.col("lc")
    score = weighted_dev(F.col("lc"), F.col("ls"), F.col("ls2")) + weighted_dev(
        rc, F.col("ts") - F.col("ls"), F.col("ts2") - F.col("ls2")
    )
    ok = (F.col("lc") >= min_leaf) & (rc >= max(min_leaf, 1))
    scored = j.where(ok).select("x", "lc", score.alias("score"))
    best = scored.agg(F.min_by(F.struct("x", "score", "lc"), F.struct(F.round("score", 6), "x")).alias("b"))
    return best.select(F.lit(x).alias("column"), F.col("b.x").alias("split"), F.col("b.score").alias("score"), F.col("b.lc").alias("n_left"))


def time_split(df: DataFrame, order: Sequence[Column], n: int | None = None, frac: float | None = None, out: str = "is_valid") -> DataFrame:
    """Mark the last ``n`` rows, or the last ``frac`` of the rows, in time order."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    held = F.lit(n) if n is not None else F.floor(F.col("_total") * F.lit(frac))
    pos = ranked(df, order, "_pos").join(F.broadcast(total))
    return pos.withColumn(out, F.col("_pos") > F.col("_total") - held).drop("_pos", "_total")


def time_folds(df: DataFrame, order: Sequence[Column], n: int, out: str = "block") -> DataFrame:
    """Block 0..n in time order; fold i trains on blocks < i and tests on block i.

    The first block takes the remainder rows, the others have equal size.
    """
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    pos = ranked(df, order, "_pos").join(F.broadcast(total))
    size = F.expr(f"_total div {n + 1}")
    first = F.col("_total") - size * n
    block = F.when(F.col("_pos") <= first, 0).otherwise(1 + F.floor((F.col("_pos") - first - 1) / size))
    return pos.withColumn(out, block.cast("int")).drop("_pos", "_total")


def rank_by(df: DataFrame, cond: Column, score: Sequence[Column], n: int) -> DataFrame:
    """Top ``n`` rows by score among those that meet a condition."""
    return df.where(cond).orderBy(*score).limit(n)


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision and recall at every distinct threshold, highest first."""
    per = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    run = ordered_scan(per, [F.desc("threshold")], {"tp": F.col("pos"), "taken": F.col("n")})
    total = per.agg(F.sum("pos").alias("_all"))
    return run.join(F.broadcast(total)).select(
        "threshold", "pos", (F.col("tp") / F.col("taken")).alias("precision"), F.try_divide("tp", "_all").alias("recall")
    )


def average_precision(curve: DataFrame) -> DataFrame:
    """Sum of precision times the recall gained at each threshold."""
    return curve.agg(F.try_divide(F.sum(F.col("precision") * F.col("pos")), F.sum("pos")).alias("average_precision"))


def recall_at_precision(curve: DataFrame, least: float) -> DataFrame:
    """Largest recall whose precision is at least ``least``."""
    return curve.where(F.col("precision") >= least).agg(F.max("recall").alias("recall"))
