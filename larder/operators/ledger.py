"""Stock ledgers over time: one-day fulfilment, open-loop replay with window
functions, warehouse drawdown, KPIs and the comparison of ordering policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.numeric import safe_div
from larder.operators.windows import SERIES_KEYS

KEYS = list(SERIES_KEYS)


def _demand_col(df: DataFrame):
    return F.col("demand") if "demand" in df.columns else F.col("sales")


def day_slice(df: DataFrame, day) -> DataFrame:
    """Rows of one ``day`` (an int or a Column such as a scalar subquery).
    Most operators keep ``day`` as a key instead of slicing."""
    d = F.lit(day) if isinstance(day, int) else day
    return df.filter(F.col("day") == d)


def fulfil_day(demand: DataFrame, stock: DataFrame, holding_cost: float = 1.0,
               stockout_penalty: float = 100.0) -> DataFrame:
    """Serve demand from stock: sales = min(demand, stock), stockout = the rest,
    end stock, holding cost on end stock, penalty on stockout. Demand rows of a
    pair on one day are summed first; a ``day`` column, if any, stays a key."""
    keys = (["day"] if "day" in demand.columns else []) + KEYS
    d = demand.groupBy(*keys).agg(F.sum(_demand_col(demand).cast("double")).alias("demand"))
    s = stock.groupBy(*KEYS).agg(F.sum(F.col("qty").cast("double")).alias("start_stock"))
    j = d.join(s, KEYS, "left").withColumn("start_stock", F.coalesce("start_stock", F.lit(0.0)))
    sales = F.least(F.col("demand"), F.col("start_stock"))
    j = j.withColumn("sales", sales).withColumn("stockout", F.col("demand") - F.col("sales"))
    j = j.withColumn("end_stock", F.col("start_stock") - F.col("sales"))
    return j.withColumns({"holding_cost": F.col("end_stock") * F.lit(holding_cost),
                          "stockout_penalty": F.col("stockout") * F.lit(stockout_penalty)})


def day_spine(df: DataFrame, day_col: str = "day", horizon: int | None = None) -> DataFrame:
    """Days 0 .. last day (or horizon - 1): a day without any demand row still
    gets a KPI row. Bounded by the horizon length."""
    if horizon is not None:
        return df.sparkSession.range(horizon).select(F.col("id").cast("int").alias(day_col))
    hi = df.agg(F.max(day_col).alias("hi"))
    return hi.select(F.explode(F.sequence(F.lit(0), F.col("hi").cast("int"))).alias(day_col))


def daily_kpis(rows: DataFrame, horizon: int | None = None, extra_keys: tuple = ()) -> DataFrame:
    """Per day (and ``extra_keys``): fulfillment_rate = sales / demand (1.0 with
    no demand), stockouts, stockout_penalty, holding_cost, total_cost
    (holding + penalty; transport is not part of it)."""
    keys = list(extra_keys) + ["day"]
    agg = rows.groupBy(*keys).agg(F.sum("demand").alias("_d"), F.sum("sales").alias("_s"),
                                  F.sum("stockout").alias("stockouts"),
                                  F.sum("stockout_penalty").alias("stockout_penalty"),
                                  F.sum("holding_cost").alias("holding_cost"))
    spine = (_spine_per_key(rows, list(extra_keys), horizon) if extra_keys
             else day_spine(rows, "day", horizon))
    j = spine.join(agg, keys, "left")
    z = F.lit(0.0)
    return j.select(
        *keys,
        F.when(F.coalesce("_d", z) > 0, safe_div(F.col("_s"), F.col("_d"))).otherwise(F.lit(1.0))
        .alias("fulfillment_rate"),
        F.coalesce("stockouts", z).alias("stockouts"),
        F.coalesce("stockout_penalty", z).alias("stockout_penalty"),
        F.coalesce("holding_cost", z).alias("holding_cost"),
        (F.coalesce("holding_cost", z) + F.coalesce("stockout_penalty", z)).alias("total_cost"))


def _spine_per_key(rows: DataFrame, keys: list, horizon: int | None) -> DataFrame:
    """Day spine per value of ``keys`` (e.g. per policy): one sequence per key
    value, exploded - bounded by (#key values x horizon)."""
    per = rows.groupBy(*keys).agg(F.max("day").alias("_hi"))
    hi = F.lit(horizon - 1) if horizon is not None else F.col("_hi").cast("int")
    return per.select(*keys, F.explode(F.sequence(F.lit(0), hi)).alias("day"))


def _exact_sum(col: str):
    """Sum as DECIMAL(38, 6) (exact, so independent of the summation order
    across tasks), returned as a double."""
    return F.sum(F.col(col).cast("decimal(38,6)")).cast("double")


def summary_kpis(daily: DataFrame, by: tuple = ()) -> DataFrame:
    """Mean of the daily rates and totals of the rest; no days -> no row.
    Totals are exact decimal sums of the daily values."""
    g = daily.groupBy(*by) if by else daily.groupBy()
    out = g.agg(F.avg("fulfillment_rate").alias("avg_fulfillment_rate"),
                _exact_sum("stockouts").alias("total_stockouts"),
                _exact_sum("stockout_penalty").alias("total_stockout_penalty"),
                _exact_sum("holding_cost").alias("total_holding_cost"),
                _exact_sum("total_cost").alias("total_cost"),
                F.count(F.lit(1)).alias("n_days"))
    return out.filter(F.col("n_days") > 0)


def _with_stock(e: DataFrame, keys: list) -> DataFrame:
    """``e (keys, day, demand, arrivals, inv0)``, one row per key and day, with
    ``start_stock`` (before the day's arrivals), ``end_stock`` and ``stockout``.

    Closed form of inv_t = max(0, inv_{t-1} + a_t - d_t): with
    S_t = inv_0 + sum_{k<=t}(a_k - d_k) and M_t = min(0, min_{k<=t} S_k),
    inv_t = S_t - M_t and stockout_t = M_{t-1} - M_t. Running windows on one
    sort per series (bounded by the series' days), no loop."""
    w = Window.partitionBy(*keys).orderBy("day")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("_s", F.col("inv0") + F.sum(F.col("arrivals") - F.col("demand")).over(run))
    e = e.withColumn("_m", F.least(F.lit(0.0), F.min("_s").over(run)))
    e = e.withColumn("_m_prev", F.coalesce(F.lag("_m", 1).over(w), F.lit(0.0)))
    e = e.withColumn("end_stock", F.col("_s") - F.col("_m"))
    e = e.withColumn("start_stock", F.coalesce(F.lag("end_stock", 1).over(w), F.col("inv0")))
    return e.withColumn("stockout", F.col("_m_prev") - F.col("_m")).drop("_s", "_m", "_m_prev")


def _first_stock(e: DataFrame, initial: DataFrame) -> DataFrame:
    """``e`` with the series' initial stock ``inv0``, 0 where there is none."""
    inv0 = initial.groupBy(*KEYS).agg(F.sum(F.col("qty").cast("double")).alias("inv0"))
    return e.join(inv0, KEYS, "left").withColumn("inv0", F.coalesce("inv0", F.lit(0.0)))


def replay_ledger(events: DataFrame, initial: DataFrame, holding_cost: float = 1.0,
                  stockout_penalty: float = 100.0, extra_keys: tuple = ()) -> DataFrame:
    """Open-loop stock ledger: arrivals are added before demand each day and
    stock never goes below 0 (``_with_stock``). ``events``: store_id, item_id,
    day, demand, arrivals (rows of a pair and day are summed); ``initial``:
    store_id, item_id, qty (>= 0). ``extra_keys`` keep ledgers apart that start
    from the same stock, one per policy for instance. Holding cost is charged
    on rows with demand."""
    keys = [*extra_keys, *KEYS]
    e = (events.groupBy(*keys, "day")
               .agg(F.sum(F.coalesce(F.col("demand").cast("double"), F.lit(0.0))).alias("demand"),
                    F.sum(F.coalesce(F.col("arrivals").cast("double"), F.lit(0.0))).alias("arrivals"),
                    F.max(F.col("demand").isNotNull().cast("int")).alias("has_demand")))
    e = _with_stock(_first_stock(e, initial), keys)
    e = e.withColumn("sales", F.col("demand") - F.col("stockout"))
    return e.select(*keys, "day", "demand", "arrivals", "sales", "stockout", "end_stock",
                    (F.col("end_stock") * F.lit(holding_cost) * F.col("has_demand")).alias("holding_cost"),
                    (F.col("stockout") * F.lit(stockout_penalty)).alias("stockout_penalty"))


def open_positions(orders: DataFrame, demand: DataFrame, initial: DataFrame, horizon: int) -> DataFrame:
    """What an ordering policy sees on the morning of every day 0 .. horizon - 1,
    for every series: ``store_id, item_id, day, in_transit, stock, position``.

    An order is in transit on the mornings after its day up to that of its
    arrival day (it is added to the stock later that day; with lead time 0 it
    never is). A sweep line: plus its quantity on the first such morning, minus
    it after the last one, and a running sum over the series' days; no order is
    repeated per day it is open. ``stock`` is what the ledger of ``demand`` and
    the orders' arrivals leaves of ``initial`` the evening before.

    ``orders``: store_id, item_id, day, qty, arrival_day; quantities that are
    null or not positive are no orders. Orders from before day 0 count; arrivals
    from before it are taken to be in ``initial``. A series is in the result if
    any of the three tables names it. Everything is one aggregation per series
    and day and windows on its partitioning."""
    o = orders.select(*KEYS, F.col("day").cast("int").alias("day"), F.col("qty").cast("double").alias("qty"),
                      F.col("arrival_day").cast("int").alias("arrival_day")).filter("qty > 0")
    none = F.lit(0.0)
    changes = o.select(*KEYS, F.explode(F.array(
        F.struct(F.greatest(F.col("day") + 1, F.lit(0)).alias("day"), F.col("qty").alias("opened"), none.alias("arrivals")),
        F.struct(F.greatest(F.col("arrival_day") + 1, F.lit(0)).alias("day"), (-F.col("qty")).alias("opened"), none.alias("arrivals")),
        F.struct(F.col("arrival_day").alias("day"), none.alias("opened"), F.col("qty").alias("arrivals")))).alias("x"))
    changes = changes.select(*KEYS, "x.day", "x.opened", "x.arrivals", none.alias("demand"))
    asked = demand.select(*KEYS, F.col("day").cast("int").alias("day"), none.alias("opened"), none.alias("arrivals"),
                          F.coalesce(_demand_col(demand).cast("double"), none).alias("demand"))
    series = orders.select(*KEYS).union(demand.select(*KEYS)).union(initial.select(*KEYS)).distinct()
    days = F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))) if horizon > 0 else F.explode(F.array().cast("array<int>"))
    spine = series.select(*KEYS, days.alias("day"), none.alias("opened"), none.alias("arrivals"), none.alias("demand"))
    rows = spine.unionByName(changes).unionByName(asked).filter((F.col("day") >= 0) & (F.col("day") < horizon))
    e = rows.groupBy(*KEYS, "day").agg(*[F.sum(c).alias(c) for c in ("opened", "arrivals", "demand")])
    e = _with_stock(_first_stock(e, initial), KEYS)
    run = Window.partitionBy(*KEYS).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("in_transit", F.sum("opened").over(run))
    return e.select(*KEYS, "day", "in_transit", F.col("start_stock").alias("stock"),
                    (F.col("start_stock") + F.col("in_transit")).alias("position"))


def policy_kpis(orders: DataFrame, demand: DataFrame, initial: DataFrame, policies: Sequence[str], horizon: int,
                holding_cost: float = 1.0, stockout_penalty: float = 100.0) -> DataFrame:
    """Policies by what their recorded orders would have led to: ``policy,
    avg_fulfillment_rate, total_stockouts, total_stockout_penalty,
    total_holding_cost, total_cost, n_days`` over days 0 .. horizon - 1.

    ``orders``: policy, store_id, item_id, arrival_day, qty, as each policy
    placed them. All policies face the same ``demand (store_id, item_id, day,
    demand)`` and start from the same ``initial`` stock; one windowed ledger
    keyed by policy and series serves all of them. Policies without orders have
    a row too; orders of policies that are not named are left out."""
    names = F.array(*[F.lit(p) for p in policies]).cast("array<string>")
    asked = demand.select(F.explode(names).alias("policy"), *KEYS, "day", _demand_col(demand).cast("double").alias("demand"),
                          F.lit(None).cast("double").alias("arrivals"))
    came = orders.filter(F.col("policy").isin(list(policies)) & (F.col("qty") > 0)).select(
        "policy", *KEYS, F.col("arrival_day").alias("day"), F.lit(None).cast("double").alias("demand"),
        F.col("qty").cast("double").alias("arrivals"))
    events = asked.unionByName(came).filter((F.col("day") >= 0) & (F.col("day") < horizon))
    rows = replay_ledger(events, initial, holding_cost, stockout_penalty, ("policy",))
    return summary_kpis(daily_kpis(rows, horizon, ("policy",)), ("policy",))


def warehouse_drawdown(orders: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Warehouse stock per item after each day's orders, floored at 0; items
    without warehouse stock are ignored. Also reports the cumulative shortfall.
    Per-item window rows: one per day with orders."""
    per_day = orders.groupBy("item_id", "day").agg(F.sum(F.col("qty").cast("double")).alias("ordered"))
    wh = warehouse.groupBy("item_id").agg(F.sum(F.col("qty").cast("double")).alias("start_qty"))
    j = per_day.join(wh, "item_id", "inner")
    w = Window.partitionBy("item_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    cum = F.sum("ordered").over(w)
    return j.select("item_id", "day", "ordered",
                    F.greatest(F.lit(0.0), F.col("start_qty") - cum).alias("remaining"),
                    F.greatest(F.lit(0.0), cum - F.col("start_qty")).alias("shortfall"))


def compare_policies(orders: dict, position: DataFrame, mean_lead_time: float, transport_cost: float = 2.0,
                     stockout_penalty: float = 100.0) -> DataFrame:
    """One row per policy for the same stock positions: ``policy, n_orders,
    units, transport_cost, short_units, shortage_cost``. Short units are what the
    forecast over the mean lead time needs beyond position and order. ``orders``
    maps a policy's name to its orders ``(store_id, item_id, qty)``."""
    each = None
    for name, placed in orders.items():
        rows = placed.select(*KEYS, "qty").withColumn("policy", F.lit(name))
        each = rows if each is None else each.unionByName(rows)
    names = F.explode(F.array(*[F.lit(n) for n in orders]))
    need = position.select(names.alias("policy"), *KEYS, (
        F.col("forecasted_demand") * F.lit(mean_lead_time) - F.col("position")).alias("_need"))
    j = need.join(each, ["policy", *KEYS], "left").withColumn("qty", F.coalesce("qty", F.lit(0.0)))
    short = F.greatest(F.lit(0.0), F.col("_need") - F.col("qty"))
    out = j.groupBy("policy").agg(F.sum((F.col("qty") > 0).cast("long")).alias("n_orders"), F.sum("qty").alias("units"),
                                  F.sum(short).alias("short_units"))
    return out.select("policy", "n_orders", "units", (F.col("units") * transport_cost).alias("transport_cost"),
                      "short_units", (F.col("short_units") * stockout_penalty).alias("shortage_cost"))
