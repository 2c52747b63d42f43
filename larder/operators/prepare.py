"""Reshape, joins and price fill that turn raw sales into the long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.windows import series

ID_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")


def melt_sales(wide: DataFrame, day_prefix: str = "d_") -> DataFrame:
    """Wide -> long: id columns x ``d_*`` columns -> (``d``, ``sales``).

    Id columns missing from the input are skipped. The reshape is one SQL
    ``stack`` generator: a single narrow Generate node (no shuffle), cheap to
    analyse even with thousands of day columns, and filters on id columns are
    pushed below it to the scan."""
    day_cols = [c for c in wide.columns if c.startswith(day_prefix)]
    ids = [c for c in ID_COLUMNS if c in wide.columns]
    pairs = ", ".join("'{}', CAST(`{}` AS DOUBLE)".format(c.replace("'", "\\'"), c.replace("`", "``"))
                      for c in day_cols)
    return wide.selectExpr(*[f"`{c}`" for c in ids], f"stack({len(day_cols)}, {pairs}) AS (d, sales)")


def join_calendar(long: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on ``d``. The calendar has one row per day of the span, a size
    bounded by the time range and not by the data volume, so it is broadcast."""
    return long.join(F.broadcast(calendar), "d", "left")


def join_prices(long: DataFrame, prices: DataFrame, co_partition: bool = True) -> DataFrame:
    """Left join of weekly prices on (store_id, item_id, wm_yr_wk).

    Prices grow with stores x items x weeks, so this stays a shuffle join
    unless AQE measures the price side under the broadcast threshold. With
    ``co_partition``, and where the session lets a join use a partitioning by
    some of its keys (``build_session`` does), both sides are hash-partitioned
    by series first, which the later series windows use again."""
    keys = ["store_id", "item_id", "wm_yr_wk"]
    partly = long.sparkSession.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true") == "false"
    if co_partition and partly:
        long, prices = long.repartition("store_id", "item_id"), prices.repartition("store_id", "item_id")
    return long.join(prices, keys, "left")


def ffill_prices(df: DataFrame, limit: int = 7, column: str = "sell_price") -> DataFrame:
    """Forward-fill ``column`` within each series by date, bridging at most
    ``limit`` consecutive missing rows (a bounded ROWS frame)."""
    w = series().rowsBetween(-limit, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(w))


def filter_stores_items(df: DataFrame, stores: Sequence[str] | None = None,
                        items: Sequence[str] | None = None) -> DataFrame:
    """IN-list filters; a None or empty list means no filter. Catalyst pushes
    them below the series windows (same partition keys) and into the scan."""
    if stores:
        df = df.filter(F.col("store_id").isin(list(stores)))
    if items:
        df = df.filter(F.col("item_id").isin(list(items)))
    return df


def normalise_types(df: DataFrame) -> DataFrame:
    """Ids to string, ``date`` to DATE, ``sales``/``sell_price`` to DOUBLE,
    calendar ints and SNAP flags to INT. Categories need no type in Spark:
    Parquet dictionary-encodes low-cardinality strings."""
    casts = {}
    for c in ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "weekday",
              "event_name_1", "event_type_1", "event_name_2", "event_type_2"):
        casts[c] = "string"
    casts.update({"date": "date", "sales": "double", "sell_price": "double",
                  "wm_yr_wk": "int", "wday": "int", "month": "int", "year": "int"})
    for c in df.columns:
        if c.startswith("snap_"):
            casts[c] = "int"
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c)
                       for c in df.columns])


def prepare_long(long: DataFrame, calendar: DataFrame, prices: DataFrame,
                 ffill_limit: int = 7, stores: Sequence[str] | None = None,
                 items: Sequence[str] | None = None) -> DataFrame:
    """Long sales -> calendar join -> price join + fill -> filters -> types."""
    df = join_prices(join_calendar(long, calendar), prices)
    df = ffill_prices(df, ffill_limit)
    df = filter_stores_items(df, stores, items)
    return normalise_types(df)
