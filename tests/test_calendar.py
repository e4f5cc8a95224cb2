"""Calendar dimension: row count, date parts and the calendar's `leap` rule."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.plans.calendar import calendar_dim

EDGES = {
    # date: (dateid, year, quarter, month, iso week, week_day, leap)
    dt.date(2000, 1, 1): (20000101, 2000, 1, 1, 52, "sat", "true"),
    dt.date(2000, 1, 30): (20000130, 2000, 1, 1, 4, "sun", "true"),
    dt.date(2001, 7, 31): (20010731, 2001, 3, 7, 31, "tue", "true"),
    dt.date(2001, 12, 30): (20011230, 2001, 4, 12, 52, "sun", "false"),
    dt.date(2005, 1, 1): (20050101, 2005, 1, 1, 53, "sat", "false"),
    dt.date(2008, 12, 29): (20081229, 2008, 4, 12, 1, "mon", "false"),
    dt.date(2030, 1, 1): (20300101, 2030, 1, 1, 1, "tue", "false"),
}


def test_default_bounds_inclusive(spark):
    cal = calendar_dim(spark)
    agg = cal.agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"),
                  F.count(F.when(F.col("leap") == "true", 1)).alias("leap"),
                  F.countDistinct("dateid").alias("keys")).first()
    assert (agg.n, agg.lo, agg.hi, agg.keys) == (10959, dt.date(2000, 1, 1), dt.date(2030, 1, 1), 10959)
    assert agg.leap == 338


def test_edge_days(spark):
    rows = {r.date: (r.dateid, r.year, r.quarter, r.month, r.week, r.week_day, r.leap)
            for r in calendar_dim(spark).filter(F.col("date").isin(list(EDGES))).collect()}
    assert rows == EDGES


def test_leap_rule_against_python(spark):
    def rule(d: dt.date) -> str:
        y, m = d.year + (d.month + 1) // 12, (d.month + 1) % 12 + 1
        last = (dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
        shifted = dt.date(y, m, min(d.day, last)) - dt.timedelta(days=1)
        return "true" if shifted.day == 29 else "false"
    for r in calendar_dim(spark, dt.date(2003, 12, 1), dt.date(2004, 12, 31)).collect():
        assert r.leap == rule(r.date), r.date


def test_inverted_bounds_rejected(spark):
    import pytest
    with pytest.raises(ValueError):
        calendar_dim(spark, dt.date(2001, 1, 2), dt.date(2001, 1, 1))


def test_covering_bounds(spark):
    from starloom.plans.calendar import CALENDAR_END, CALENDAR_START, covering_bounds
    empty = spark.createDataFrame([], "a date, b date")
    assert covering_bounds(empty) == (CALENDAR_START, CALENDAR_END)
    some = spark.createDataFrame([(dt.date(1995, 3, 1), dt.date(2031, 1, 1))], "a date, b date")
    assert covering_bounds(some) == (dt.date(1995, 3, 1), dt.date(2031, 1, 1))
    single_day = calendar_dim(spark, dt.date(2004, 2, 29), dt.date(2004, 2, 29)).collect()
    assert [(r.dateid, r.week_day) for r in single_day] == [(20040229, "sun")]
