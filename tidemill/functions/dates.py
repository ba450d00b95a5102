"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_ms(c: Column) -> Column:
    """Milliseconds since 1970 (number or text, also ``1.54E+12``) to timestamp."""
    return F.timestamp_millis(c.cast("double").cast("bigint"))


def to_epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def time_parts(df: DataFrame, ts: str, sunday_first: bool = False) -> DataFrame:
    """hour, day, ISO week, month, year, weekday of a timestamp column.

    ``weekday`` counts from Monday = 0, or from Sunday = 0 as warehouses do.
    """
    c = F.col(ts)
    weekday = F.dayofweek(c) - 1 if sunday_first else F.weekday(c)
    return df.withColumns(
        {
            "hour": F.hour(c),
            "day": F.dayofmonth(c),
            "week": F.weekofyear(c),
            "month": F.month(c),
            "year": F.year(c),
            "weekday": weekday,
        }
    )


def sas_date(days: Column) -> Column:
    """Day count from 1960-01-01 to date."""
    return F.date_add(F.lit("1960-01-01").cast("date"), days.cast("int"))


def parse_date(c: Column, fmt: str) -> Column:
    """Date by format; unreadable text becomes null."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def add_datepart(df: DataFrame, date: str, prefix: str = "") -> DataFrame:
    """Date parts used as model features; ``elapsed`` is epoch seconds."""
    d = F.col(date).cast("date")
    month_end = F.last_day(d)
    quarter = F.trunc(d, "quarter")
    parts = {
        "year": F.year(d),
        "month": F.month(d),
        "week": F.weekofyear(d),
        "day": F.dayofmonth(d),
        "dayofweek": F.weekday(d),
        "dayofyear": F.dayofyear(d),
        "is_month_end": d == month_end,
        "is_month_start": F.dayofmonth(d) == 1,
        "is_quarter_end": d == F.date_sub(F.add_months(quarter, 3), 1),
        "is_quarter_start": d == quarter,
        "is_year_end": (F.month(d) == 12) & (F.dayofmonth(d) == 31),
        "is_year_start": F.dayofyear(d) == 1,
        "elapsed": F.unix_timestamp(d.cast("timestamp")),
    }
    return df.withColumns({prefix + k: v for k, v in parts.items()})


def mid_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(15))


def iso_monday(year: Column, week: Column) -> Column:
    """Monday of an ISO week: 4 January always lies in week 1."""
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    return F.date_add(first, ((week - 1) * 7).cast("int"))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def days_ceil(later: Column, earlier: Column) -> Column:
    """Days from the start of ``earlier``'s day, rounded up to whole days."""
    seconds = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(
        earlier.cast("date").cast("timestamp")
    )
    return F.ceil(seconds / F.lit(86400)).cast("bigint")


def swap_day_month(txn: Column, settled: Column) -> Column:
    """``txn`` with day and month exchanged when it lies after ``settled`` and
    the exchanged date exists and lies before; otherwise ``txn``."""
    txn, settled = txn.cast("date"), settled.cast("date")
    swapped = F.try_to_timestamp(F.date_format(txn, "ddMMyyyy"), F.lit("MMddyyyy")).cast("date")
    return F.when((settled < txn) & (swapped < settled), swapped).otherwise(txn)


def play_key(session: Column, ts: Column) -> Column:
    """md5 of session id and start second; milliseconds are dropped on purpose."""
    return F.md5(F.concat(session.cast("string"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))


def season(month: Column) -> Column:
    """Season name of a month number; null stays null."""
    return (
        F.when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .when(month.between(9, 11), "autumn")
        .when(month.isNotNull(), "winter")
    )


def daypart(hour: Column) -> Column:
    return (
        F.when(hour.between(7, 11), "morning")
        .when(hour.between(12, 18), "day")
        .when(hour.between(19, 23), "evening")
        .when(hour.between(0, 6), "night")
    )


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
