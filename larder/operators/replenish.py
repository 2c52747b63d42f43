"""Replenishment decisions for one day, as table operators: stock position,
initial stock, order scheduling, arrivals, and the naive, min-max and
allocation policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.numeric import lead_time
from larder.operators.allocate import allocate

KEYS = ["store_id", "item_id"]


def in_transit_totals(in_transit: DataFrame) -> DataFrame:
    """Open order quantity per (store, item); partial aggregation per task."""
    return in_transit.groupBy(*KEYS).agg(F.sum(F.col("qty").cast("double")).alias("in_transit"))


def stock_position(forecast: DataFrame, stock: DataFrame, in_transit: DataFrame) -> DataFrame:
    """Forecast rows with their on-hand stock and open orders (missing = 0):
    ``store_id, item_id, forecasted_demand, stock, in_transit, position``."""
    on_hand = stock.groupBy(*KEYS).agg(F.sum(F.col("qty").cast("double")).alias("stock"))
    j = (forecast.join(on_hand, KEYS, "left").join(in_transit_totals(in_transit), KEYS, "left")
         .withColumn("stock", F.coalesce("stock", F.lit(0.0)))
         .withColumn("in_transit", F.coalesce("in_transit", F.lit(0.0))))
    return j.withColumn("position", F.col("stock") + F.col("in_transit"))


def initial_stock(stats: DataFrame, multiplier: float = 14.0) -> DataFrame:
    """``ceil(max(0, avg_demand) * multiplier)`` per (store, item)."""
    avg = F.greatest(F.lit(0.0), F.coalesce(F.col("avg_demand").cast("double"), F.lit(0.0)))
    return stats.select(*KEYS, F.ceil(avg * F.lit(multiplier)).cast("double").alias("qty"))


def schedule_orders(orders: DataFrame, lt_min: int = 2, lt_max: int = 5, seed: int = 0) -> DataFrame:
    """Keep positive orders, attach a lead time in [lt_min, lt_max] and the
    arrival day ``day + lead_time``."""
    lt = lead_time(F.col("day"), F.col("store_id"), F.col("item_id"), lt_min, lt_max, seed)
    return (orders.filter(F.col("qty") > 0).withColumn("lead_time", lt)
                  .withColumn("arrival_day", F.col("day") + F.col("lead_time")))


def split_arrivals(in_transit: DataFrame, day) -> DataFrame:
    """Flag orders due on ``day`` (arrival_day <= day, so lead time 0 is due
    the same day); the rest stay pending. ``day`` is an int or a Column."""
    d = day if not isinstance(day, int) else F.lit(day)
    return in_transit.withColumn("due", F.col("arrival_day") <= d)


def post_arrivals(inventory: DataFrame, due: DataFrame) -> DataFrame:
    """Add due quantities to stock; a (store, item) seen only in arrivals is
    created with that quantity (full outer join of two per-pair aggregates)."""
    a = due.groupBy(*KEYS).agg(F.sum(F.col("qty").cast("double")).alias("_arr"))
    inv = inventory.groupBy(*KEYS).agg(F.sum(F.col("qty").cast("double")).alias("_inv"))
    j = inv.join(a, KEYS, "full")
    return j.select(*KEYS, (F.coalesce("_inv", F.lit(0.0)) + F.coalesce("_arr", F.lit(0.0))).alias("qty"))


def naive_orders(position: DataFrame, lt_min: int = 2, lt_max: int = 5, buffer_days: float = 1.0) -> DataFrame:
    """Order up to forecast x (mean lead time + buffer) less stock and open orders."""
    mean_lt = (lt_min + lt_max) / 2.0
    target = F.col("forecasted_demand") * F.lit(mean_lt + buffer_days)
    qty = target - F.col("stock") - F.col("in_transit")
    return position.select(*KEYS, qty.alias("qty")).filter(F.col("qty") > 0)


def minmax_orders(position: DataFrame, min_days: float = 3.0, max_days: float = 7.0) -> DataFrame:
    """If position < forecast x min_days (strict), order up to forecast x max_days."""
    f = F.col("forecasted_demand")
    qty = f * F.lit(max_days) - F.col("position")
    return (position.filter(F.col("position") < f * F.lit(min_days))
                    .select(*KEYS, qty.alias("qty")).filter(F.col("qty") > 0))


def allocation_orders(position: DataFrame, warehouse: DataFrame, lt_min: int = 2, lt_max: int = 5,
                      stockout_penalty: float = 100.0, holding_cost: float = 1.0,
                      transport_cost: float = 2.0, mode: str = "ordered") -> DataFrame:
    """Allocate warehouse stock against forecast x mean lead time, with the
    stock position (on hand + open orders) as inventory; keep qty > 0."""
    mean_lt = (lt_min + lt_max) / 2.0
    demand = position.select(*KEYS, (F.col("forecasted_demand") * F.lit(mean_lt)).alias("demand"))
    inventory = position.select(*KEYS, F.col("position").alias("qty"))
    alloc = allocate(demand, inventory, warehouse, mode, stockout_penalty, holding_cost, transport_cost)
    return alloc.select(*KEYS, F.col("allocated_qty").alias("qty")).filter(F.col("qty") > 0)
