"""Shared window specifications.

Every per-series window uses the same partitioning and order, so Catalyst
plans all of them (lags, rolling frames, forward fill, group counts) on one
Exchange + Sort. A series holds at most one row per calendar day, so a
partition of this window is bounded by the calendar length, not by volume.
"""

from __future__ import annotations

from pyspark.sql import Window, WindowSpec

SERIES_KEYS = ("store_id", "item_id")


def series(order_by: str = "date") -> WindowSpec:
    return Window.partitionBy(*SERIES_KEYS).orderBy(order_by)


def series_unordered() -> WindowSpec:
    return Window.partitionBy(*SERIES_KEYS)
