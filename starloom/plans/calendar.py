"""The generated calendar dimension: one row per day, both ends inclusive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, iso_week, leap_flag, week_day

# The calendar's default bounds, first and last day included.
CALENDAR_START = dt.date(2000, 1, 1)
CALENDAR_END = dt.date(2030, 1, 1)

CALENDAR_COLUMNS = ["dateid", "year", "quarter", "month", "week", "date", "week_day", "leap"]

# Days per generated partition; a century is under 40,000 days.
_DAYS_PER_PARTITION = 4096


def calendar_days(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> DataFrame:
    """Column ``date`` for every day from ``start`` to ``end`` inclusive.

    ``spark.range`` generates the day offsets in parallel partitions; no
    single row is exploded into the whole series.
    """
    n_days = (end - start).days + 1
    if n_days <= 0:
        raise ValueError(f"calendar end {end} precedes start {start}")
    parts = max(1, -(-n_days // _DAYS_PER_PARTITION))
    return (spark.range(0, n_days, numPartitions=parts)
            .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date")))


def calendar_dim(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> DataFrame:
    """``dateid, year, quarter, month, week, date, week_day, leap`` per day."""
    d = F.col("date")
    return calendar_days(spark, start, end).select(
        date_key(d).alias("dateid"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        iso_week(d).alias("week"),
        d.alias("date"),
        week_day(d).alias("week_day"),
        leap_flag(d).alias("leap"),
    )


def covering_bounds(dates: DataFrame, start: dt.date = CALENDAR_START,
                    end: dt.date = CALENDAR_END) -> tuple[dt.date, dt.date]:
    """Widen ``[start, end]`` to every date in the columns of ``dates``.

    One global aggregate (partial min/max per task); only two dates reach the
    driver.
    """
    lows = [F.min(c) for c in dates.columns]
    highs = [F.max(c) for c in dates.columns]
    row = dates.agg(
        (F.least(*lows) if len(lows) > 1 else lows[0]).alias("lo"),
        (F.greatest(*highs) if len(highs) > 1 else highs[0]).alias("hi"),
    ).first()
    lo = min(start, row["lo"]) if row["lo"] is not None else start
    hi = max(end, row["hi"]) if row["hi"] is not None else end
    return lo, hi
