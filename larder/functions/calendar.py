"""Calendar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(date: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(date)


def wday(date: Column) -> Column:
    """1 = Saturday ... 7 = Friday (calendar-table convention)."""
    return (F.dayofweek(date) % 7) + 1


def week_key(date: Column) -> Column:
    """``year * 100 + ISO week``; not chronological around New Year."""
    return F.year(date) * 100 + F.weekofyear(date)


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")
