"""Null-safe arithmetic and small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` with NULL for a zero or NULL divisor (ANSI mode raises)."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def clip_non_negative(c: Column) -> Column:
    return F.greatest(c, F.lit(0.0))


def lead_time(day: Column, store: Column, item: Column, lt_min: int, lt_max: int, seed: int = 0) -> Column:
    """Deterministic lead time in ``[lt_min, lt_max]`` of one order: the first
    eight hexadecimal digits of the MD5 of ``day|store|item|seed``, which any
    SQL engine computes alike."""
    key = F.concat_ws("|", day.cast("string"), store, item, F.lit(str(seed)))
    drawn = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    return (F.lit(lt_min) + F.pmod(drawn, F.lit(lt_max - lt_min + 1))).cast("int")
