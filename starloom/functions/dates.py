"""Date expressions of the warehouse, all built-in (JVM, codegen) functions.

Every function takes and returns a :class:`~pyspark.sql.Column` of ``DateType``
input, so results never depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """``yyyymmdd`` as an integer, e.g. 2016-11-08 -> 20161108.

    Arithmetic on the date parts instead of ``date_format(d, 'yyyyMMdd')``:
    same value, no string round trip, and no chance of the lowercase ``mm``
    (minutes) pattern slip.
    """
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def week_day(d: Column) -> Column:
    """Lowercase three-letter weekday name: 'mon' ... 'sun'."""
    return F.lower(F.date_format(d, "E"))


def iso_week(d: Column) -> Column:
    """ISO-8601 week number (1..53); paired with the calendar year, as the
    calendar table does (2005-01-01 is week 53 of year 2005)."""
    return F.weekofyear(d)


def leap_flag(d: Column) -> Column:
    """'true' when the day of month of ``d + 2 months - 1 day`` is 29.

    This is the calendar's ``leap`` column exactly as defined: months are
    added first (clamping to the month end), then one day is taken off.  It is
    true on 1 January of leap years and on other days whose shifted date
    lands on a 29th; it is *not* an is-leap-year flag (see :func:`is_leap_year`).
    """
    shifted = F.date_sub(F.add_months(d, 2), 1)
    return (F.dayofmonth(shifted) == 29).cast("string")


def is_leap_year(d: Column) -> Column:
    """True when the year of ``d`` is a leap year (Gregorian rule)."""
    y = F.year(d)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
