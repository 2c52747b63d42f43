"""Warehouse-to-store allocation at the cost optimum of the reference's LP.

LP per item: minimise transport*x + penalty*s + holding*h subject to
sum_stores x <= warehouse, h - s = inventory + x - demand, x, s, h >= 0.
Costs do not depend on the store and no constraint links items, so with
need = max(0, demand - inventory) a unit up to ``need`` changes the cost by
transport - penalty and a unit beyond it by transport + holding >= 0. The
optimum allocates min(warehouse, total need) per item when penalty exceeds
transport (in any split; two splits are offered), and nothing otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.numeric import safe_div

KEYS = ["store_id", "item_id"]
EPS = 1e-6


def demand_column(df: DataFrame):
    """``demand`` if present, else ``forecasted_demand``, else 0."""
    for c in ("demand", "forecasted_demand"):
        if c in df.columns:
            return F.col(c)
    return F.lit(0.0)


def allocation_need(demand: DataFrame, inventory: DataFrame | None) -> DataFrame:
    """Demand summed per pair (duplicate rows add up), inventory looked up
    (missing = 0), need = max(0, demand - inventory).

    ``inventory=None`` means ``demand`` already carries an ``inventory``
    column for its pair (a pre-joined table); no join is planned then."""
    dcol = demand_column(demand).cast("double")
    if inventory is None:
        j = demand.groupBy(*KEYS).agg(F.sum(dcol).alias("demand"),
                                      F.max(F.col("inventory").cast("double")).alias("inventory"))
    else:
        d = demand.groupBy(*KEYS).agg(F.sum(dcol).alias("demand"))
        inv = inventory.groupBy(*KEYS).agg(F.sum(F.col("qty").cast("double")).alias("inventory"))
        j = d.join(inv, KEYS, "left")
    j = j.withColumn("inventory", F.coalesce("inventory", F.lit(0.0)))
    return j.withColumn("need", F.greatest(F.lit(0.0), F.col("demand") - F.col("inventory")))


def join_warehouse(df: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Per item warehouse stock, missing = 0, negative clamped to 0."""
    wh = warehouse.groupBy("item_id").agg(F.sum(F.col("qty").cast("double")).alias("warehouse"))
    return (df.join(wh, "item_id", "left")
              .withColumn("warehouse", F.greatest(F.lit(0.0), F.coalesce("warehouse", F.lit(0.0)))))


def allocate(demand: DataFrame, inventory: DataFrame | None, warehouse: DataFrame, mode: str = "ordered",
             stockout_penalty: float = 100.0, holding_cost: float = 1.0, transport_cost: float = 2.0,
             keep_inputs: bool = False) -> DataFrame:
    """-> (store_id, item_id, allocated_qty). ``mode='ordered'`` fills stores
    in store order, ``'proportional'`` scales every need by the same factor.

    The per-item windows hold one row per store carrying the item, a size
    bounded by the number of stores."""
    base = join_warehouse(allocation_need(demand, inventory), warehouse)
    if stockout_penalty <= transport_cost:
        qty = F.lit(0.0)
    elif mode == "ordered":
        w = Window.partitionBy("item_id").orderBy("store_id").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("need").over(w), F.lit(0.0))
        qty = F.least(F.col("need"), F.greatest(F.lit(0.0), F.col("warehouse") - before))
    elif mode == "proportional":
        total = F.sum("need").over(Window.partitionBy("item_id"))
        share = F.least(F.lit(1.0), F.coalesce(safe_div(F.col("warehouse"), total), F.lit(0.0)))
        qty = F.col("need") * share
    else:
        raise ValueError(f"unknown allocation mode {mode!r}")
    out = base.withColumn("allocated_qty", qty)
    out = out.withColumn("allocated_qty",
                         F.when(F.col("allocated_qty") > EPS, F.col("allocated_qty")).otherwise(F.lit(0.0)))
    if keep_inputs:
        return out
    return out.select(*KEYS, "allocated_qty")


def allocation_cost(allocated: DataFrame, stockout_penalty: float = 100.0, holding_cost: float = 1.0,
                    transport_cost: float = 2.0) -> DataFrame:
    """Objective value of an allocation made with ``keep_inputs=True``."""
    x, d, inv = F.col("allocated_qty"), F.col("demand"), F.col("inventory")
    short = F.greatest(F.lit(0.0), d - inv - x)
    held = F.greatest(F.lit(0.0), inv + x - d)
    cost = F.lit(transport_cost) * x + F.lit(stockout_penalty) * short + F.lit(holding_cost) * held
    return allocated.agg(F.sum(cost).alias("total_cost"), F.sum(x).alias("total_allocated"),
                         F.sum(short).alias("total_short"), F.sum(held).alias("total_held"))
