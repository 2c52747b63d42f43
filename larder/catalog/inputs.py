"""Inputs shared by the registered queries, all derived lazily from the
driver's tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import prepare
from larder.sources import driver_tables as dt

# Fixed values for the registered queries (the reference's defaults unless
# noted): feature parameters, cost weights, simulation parameters.
FFILL_LIMIT = 7
LAGS = (7, 14, 28)
WINDOWS = (7, 28)
MIN_GROUP_ROWS = 30
FILTER_STORES = ("NATION_3", "NATION_7", "NATION_11", "NATION_19")
CV_SPLITS = 3
FORECAST_HORIZON = 14
STOCKOUT_PENALTY = 100.0
HOLDING_COST = 1.0
TRANSPORT_COST = 2.0
LEAD_TIME_MIN = 2
LEAD_TIME_MAX = 5
INITIAL_MULTIPLIER = 14.0
NAIVE_BUFFER_DAYS = 1.0
MIN_DAYS_SUPPLY = 3.0
MAX_DAYS_SUPPLY = 7.0
# The ledger starts from a short stock cover so that stockouts occur.
LEDGER_MULTIPLIER = 3.0
# The one-day policy snapshot is taken this many days before the last day;
# arrivals after it are the in-transit orders.
SNAPSHOT_DAYS_BEFORE_END = 7


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long sales joined to calendar and prices, prices forward-filled."""
    return prepare.prepare_long(dt.sales_daily(spark, sf_dir), dt.calendar(spark, sf_dir),
                                dt.prices(spark, sf_dir), FFILL_LIMIT)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Final projection for comparison: doubles rounded to ``places``."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


# -- derived inputs of the planning operators ---------------------------------

def series_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (store, item): mean and total daily sales."""
    return (dt.sales_daily(spark, sf_dir).groupBy("store_id", "item_id")
            .agg(F.avg("sales").alias("avg_demand"), F.sum("sales").alias("total_demand")))


def allocation_inputs(spark: SparkSession, sf_dir: str):
    """Per series: demand = total sales, inventory = initial stock (mean x 14),
    in one table (the inventory rides along, so ``allocate`` plans no join);
    warehouse per item = half the total need for even brand numbers and twice
    it for odd ones, so both the scarce and the ample branch run. Both outputs
    come from the same per-series aggregate."""
    stats = series_stats(spark, sf_dir)
    avg = F.greatest(F.lit(0.0), F.coalesce(F.col("avg_demand"), F.lit(0.0)))
    pairs = stats.select("store_id", "item_id", F.col("total_demand").alias("demand"),
                         F.ceil(avg * F.lit(INITIAL_MULTIPLIER)).cast("double").alias("inventory"))
    factor = F.when(F.substring("item_id", 7, 4).cast("int") % 2 == 0, F.lit(0.5)).otherwise(F.lit(2.0))
    warehouse = (pairs.groupBy("item_id")
                 .agg(F.sum(F.greatest(F.lit(0.0), F.col("demand") - F.col("inventory"))).alias("need"))
                 .select("item_id", (F.col("need") * factor).alias("qty")))
    return pairs, warehouse


def as_of_day(spark: SparkSession, sf_dir: str) -> int:
    """The snapshot day: last demand day - 7 (0-based day number)."""
    lo, _, last_demand = dt.span(spark, sf_dir)
    return (last_demand - lo).days - SNAPSHOT_DAYS_BEFORE_END


def policy_snapshot(spark: SparkSession, sf_dir: str):
    """State as of the snapshot day: forecast = mean daily demand up to it,
    on-hand stock = demand of the last day up to it, open orders = returns
    arriving after it."""
    t = as_of_day(spark, sf_dir)
    hist = dt.demand_daily(spark, sf_dir).filter(F.col("day") <= t)
    forecast = hist.groupBy("store_id", "item_id").agg(F.avg("demand").alias("forecasted_demand"))
    stock = hist.groupBy("store_id", "item_id").agg(F.max_by("demand", "day").alias("qty"))
    in_transit = (dt.returns_daily(spark, sf_dir).filter(F.col("day") > t)
                  .select("store_id", "item_id", "qty", F.col("day").alias("arrival_day")))
    return forecast, stock, in_transit


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand and arrivals per (store, item, day); either may be NULL."""
    return dt.ledger_events(spark, sf_dir)


def ledger_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larder.operators.replenish import initial_stock
    stats = dt.demand_daily(spark, sf_dir).groupBy("store_id", "item_id") \
        .agg(F.avg("demand").alias("avg_demand"))
    return initial_stock(stats, LEDGER_MULTIPLIER)


# How the recorded policies order. Each orders a share of what was
# sold over a number of days, on the last of these days.
RECORDED_POLICIES = {"daily": (1, 1.0), "weekly": (7, 1.0), "lean": (1, 0.5)}


def demand_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders for each day's demand, with lead times: ``store_id, item_id, day,
    qty, lead_time, arrival_day``."""
    from larder.operators.replenish import schedule_orders
    orders = dt.demand_daily(spark, sf_dir).withColumnRenamed("demand", "qty")
    return schedule_orders(orders, LEAD_TIME_MIN, LEAD_TIME_MAX)


def recorded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ``RECORDED_POLICIES`` place them, with lead times: ``policy,
    store_id, item_id, day, qty, lead_time, arrival_day``."""
    from larder.operators.replenish import schedule_orders
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("policy"), F.lit(days).alias("days"), F.lit(share).alias("share"))
                                for name, (days, share) in RECORDED_POLICIES.items()])).alias("r")
    each = dt.demand_daily(spark, sf_dir).select("store_id", "item_id", "day", "demand", rules).select("store_id", "item_id", "day", "demand", "r.*")
    placed = each.groupBy("policy", "store_id", "item_id", F.expr("CAST((day div days) * days + days - 1 AS INT)").alias("day")).agg(
        F.floor(F.sum(F.col("demand") * F.col("share"))).cast("double").alias("qty"))
    return schedule_orders(placed, LEAD_TIME_MIN, LEAD_TIME_MAX)
