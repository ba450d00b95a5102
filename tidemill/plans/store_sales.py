"""Feature job for daily store sales (Q10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import dates
from tidemill.operators.relational import clip
from tidemill.operators.windows import days_since, days_until, rolling


# They must be these for the results to agree.
#: Year and month, or week, of an opening or promotion that is not known.
UNKNOWN_YEAR, UNKNOWN_MONTH, UNKNOWN_WEEK = 1900, 1, 1
#: Openings and promotions of earlier years count as just begun.
FIRST_YEAR = 1990
DAYS_A_MONTH, MOST_MONTHS = 30, 24
DAYS_A_WEEK, MOST_WEEKS = 7, 25


def daily_sales(rows: DataFrame, store: str, date: str, sales: Column, flags: dict[str, Column]) -> DataFrame:
    """One row per store and day: total sales and flags."""
    return rows.groupBy(F.col(store).alias("store"), F.col(date).cast("date").alias("day")).agg(
        F.sum(sales).alias("sales"), *[F.max(c.cast("int")).alias(n) for n, c in flags.items()]
    )


def open_since(df: DataFrame, year: str, month: str, day: str = "day") -> DataFrame:
    """Days and months since a competitor opened (mid month), floored and capped."""
    opened = dates.mid_month(F.coalesce(F.col(year), F.lit(UNKNOWN_YEAR)), F.coalesce(F.col(month), F.lit(UNKNOWN_MONTH)))
    since = F.when(F.coalesce(F.col(year), F.lit(UNKNOWN_YEAR)) < FIRST_YEAR, 0).otherwise(dates.days_between(F.col(day), opened))
    out = clip(df.withColumn("competition_days", since), "competition_days", lo=0)
    return clip(out.withColumn("competition_months", F.expr(f"competition_days div {DAYS_A_MONTH}")), "competition_months", hi=MOST_MONTHS)


def promo_weeks(df: DataFrame, year: str, week: str, day: str = "day") -> DataFrame:
    """Weeks since a running promotion began (ISO week), floored and capped."""
    began = dates.iso_monday(F.coalesce(F.col(year), F.lit(UNKNOWN_YEAR)), F.coalesce(F.col(week), F.lit(UNKNOWN_WEEK)))
    since = F.when(F.coalesce(F.col(year), F.lit(UNKNOWN_YEAR)) < FIRST_YEAR, 0).otherwise(dates.days_between(F.col(day), began))
    out = clip(df.withColumn("promo_days", since), "promo_days", lo=0)
    return clip(out.withColumn("promo_weeks", F.expr(f"promo_days div {DAYS_A_WEEK}")), "promo_weeks", lo=0, hi=MOST_WEEKS)


def store_features(daily: DataFrame, stores: DataFrame, flags: list[str]) -> DataFrame:
    """Sales days with store fields, event distances, rolling sums and date parts.

    All windows run over (store, day) rows, so a store has at most one row per
    calendar day. The three window steps share one partitioning by store.
    """
    seq = rolling(days_until(days_since(daily, "store", "day", flags), "store", "day", flags), "store", "day", flags)
    wide = seq.join(stores, "store", "left")
    wide = promo_weeks(open_since(wide, "open_year", "open_month"), "promo_year", "promo_week")
    return dates.add_datepart(wide, "day", "d_").where(F.col("sales") != 0)
