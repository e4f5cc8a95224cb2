"""Scalar column expressions used by the warehouse plans."""

from starloom.functions.dates import date_key, is_leap_year, iso_week, leap_flag, week_day

__all__ = ["date_key", "is_leap_year", "iso_week", "leap_flag", "week_day"]
