"""Date expressions of the calendar dimension and of trailing windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(when: Column) -> Column:
    return F.date_format(when, "yyyyMMdd").cast("int")


def month_of_key(key: Column) -> Column:
    return F.floor(key / 100).cast("int")


def day_of_week(day: Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(day) - 1


def _name(day: Column, fmt: str, padded: bool) -> Column:
    name = F.date_format(day, fmt)
    return F.rpad(name, 9, " ") if padded else name


def day_name(day: Column, padded: bool = False) -> Column:
    return _name(day, "EEEE", padded)


def month_name(day: Column, padded: bool = False) -> Column:
    return _name(day, "MMMM", padded)


def active_since(last_activity: Column, as_of: Column, months: int = 12) -> Column:
    return last_activity >= F.add_months(as_of, -months)


def within(ts: Column, as_of: Column, interval: str = "1 day") -> Column:
    return ts >= as_of - F.expr(f"INTERVAL {interval}")
