"""Per-series demand features: calendar, events, SNAP, lags, rolling stats,
price features, sparse-group removal and diagnostics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from larder.functions.calendar import day_of_week
from larder.functions.numeric import safe_div
from larder.operators.windows import series, series_unordered

# Ordinal code of the primary event type (anything else or
# missing is 0).
EVENT_TYPE_CODES = {"Cultural": 1, "National": 2, "Religious": 3, "Sporting": 4}

DEFAULT_LAGS = (7, 14, 28)
DEFAULT_WINDOWS = (7, 28)


def calendar_features(df: DataFrame) -> DataFrame:
    """day_of_week (0=Mon), month, week_of_year (ISO), day_of_month,
    is_weekend (dow >= 5), quarter, year - all INT. A NULL date (unmatched
    calendar row) gives NULL parts."""
    d = F.col("date")
    dow = day_of_week(d)
    return df.withColumns({
        "day_of_week": dow,
        "month": F.month(d),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "is_weekend": (dow >= 5).cast("int"),
        "quarter": F.quarter(d),
        "year": F.year(d),
    })


def event_features(df: DataFrame) -> DataFrame:
    """has_event (either event name present); event_type_encoded from
    ``event_type_1`` when that column exists."""
    present = F.lit(False)
    for c in ("event_name_1", "event_name_2"):
        if c in df.columns:
            present = present | F.col(c).isNotNull()
    out = df.withColumn("has_event", present.cast("int"))
    if "event_type_1" in df.columns:
        code = None
        for name, value in EVENT_TYPE_CODES.items():
            cond = F.col("event_type_1") == name
            code = F.when(cond, value) if code is None else code.when(cond, value)
        out = out.withColumn("event_type_encoded", code.otherwise(0))
    return out


def snap_features(df: DataFrame, state_columns: Mapping[str, str] | None = None) -> DataFrame:
    """snap_active: the SNAP flag of the row's state. ``state_columns`` maps a
    state id to its flag column; by default every ``snap_<STATE>`` column.
    Other states, missing flag columns or no state column give 0."""
    if "state_id" not in df.columns:
        return df.withColumn("snap_active", F.lit(0))
    if state_columns is None:
        state_columns = {c[len("snap_"):]: c for c in df.columns if c.startswith("snap_")}
    expr = None
    for state, col in state_columns.items():
        if col not in df.columns:
            continue
        cond = F.col("state_id") == state
        value = F.col(col).cast("int")
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    active = F.lit(0) if expr is None else F.coalesce(expr.otherwise(0), F.lit(0))
    return df.withColumn("snap_active", active)


def lag_features(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, column: str = "sales") -> DataFrame:
    """``lag_n`` = value n rows earlier in the same series (row offset)."""
    w = series()
    return df.withColumns({f"lag_{n}": F.lag(column, n).over(w) for n in lags})


def rolling_mean(df: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS, column: str = "sales") -> DataFrame:
    """Mean of the N rows before today (today excluded), at least one value."""
    w = series()
    return df.withColumns({f"rolling_mean_{n}": F.avg(column).over(w.rowsBetween(-n, -1))
                           for n in windows})


def rolling_std(df: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS, column: str = "sales") -> DataFrame:
    """Sample standard deviation over the same frame; fewer than 2 values -> NULL."""
    w = series()
    return df.withColumns({f"rolling_std_{n}": F.stddev_samp(column).over(w.rowsBetween(-n, -1))
                           for n in windows})


def price_rel_mean(df: DataFrame, as_of: bool = False) -> DataFrame:
    """sell_price / mean price of the item over all stores and dates (a zero
    mean gives NULL).

    The mean is a grouped sum and count per item, combined in each task before
    the shuffle, and joined back; a hot item is never gathered in one task.

    ``as_of=True`` uses only earlier days: running sums per item and day."""
    if "sell_price" not in df.columns:
        return df
    if not as_of:
        mean = df.groupBy("item_id").agg(F.avg("sell_price").alias("_item_mean"))
        out = df.join(mean, "item_id", "left")
        return out.withColumn("price_rel_mean", safe_div(F.col("sell_price"), F.col("_item_mean"))).drop("_item_mean")
    per_day = (df.groupBy("item_id", "date")
               .agg(F.sum("sell_price").alias("_s"), F.count("sell_price").alias("_n")))
    w = Window.partitionBy("item_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.select("item_id", "date",
                             safe_div(F.sum("_s").over(w), F.sum("_n").over(w)).alias("_item_mean"))
    out = df.join(per_day, ["item_id", "date"], "left")
    return (out.withColumn("price_rel_mean", safe_div(F.col("sell_price"), F.col("_item_mean")))
               .drop("_item_mean"))


def price_change_pct(df: DataFrame, periods: int = 7, pad: bool = False) -> DataFrame:
    """p / p[-periods rows] - 1 within the series; zero or NULL base -> NULL.
    ``pad=True`` forward-fills the price first (older pandas behaviour)."""
    if "sell_price" not in df.columns:
        return df
    w = series()
    p = F.col("sell_price")
    if pad:
        p = F.last("sell_price", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        df = df.withColumn("_p", p)
        p = F.col("_p")
    out = df.withColumn("price_change_pct", safe_div(p, F.lag(p, periods).over(w)) - 1)
    return out.drop("_p") if pad else out


def log_price(df: DataFrame) -> DataFrame:
    if "sell_price" not in df.columns:
        return df
    return df.withColumn("log_price", F.log1p("sell_price"))


def drop_sparse_groups(df: DataFrame, min_rows: int = 30, column: str = "sales",
                       observation: Observation | None = None) -> DataFrame:
    """Keep series with at least ``min_rows`` non-NULL ``column`` values. The
    count is a window on the series partitioning, shared with the other
    series windows (no extra shuffle).

    An ``observation`` gets ``rows_in`` and ``rows_dropped`` from the job that
    runs the plan. It looks at the rows after the count, in the stage that
    writes them, where a task that runs again is counted once."""
    df = df.withColumn("_n", F.count(column).over(series_unordered()))
    sparse = F.col("_n") < min_rows
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows_in"),
                        F.coalesce(F.sum(sparse.cast("long")), F.lit(0)).alias("rows_dropped"))
    return df.filter(~sparse).drop("_n")


def add_all_features(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, windows: Sequence[int] = DEFAULT_WINDOWS,
                     min_rows: int = 30, observation: Observation | None = None) -> DataFrame:
    """The full feature step in the reference order: calendar, events, SNAP,
    lags, rolling, price, then sparse-group removal (and its ``observation``)."""
    df = calendar_features(df)
    df = event_features(df)
    df = snap_features(df)
    df = lag_features(df, lags)
    df = rolling_mean(df, windows)
    df = rolling_std(df, windows)
    df = price_rel_mean(df)
    df = price_change_pct(df)
    df = log_price(df)
    return drop_sparse_groups(df, min_rows, observation=observation)


def _null_counts(df: DataFrame, columns: Sequence[str] | None) -> list:
    if columns is None:
        columns = [c for c in df.columns if c.startswith(("lag_", "rolling_", "price_", "log_price"))]
    return [F.count(F.lit(1)).alias("n_rows"),
            *[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"null_{c}") for c in columns]]


def feature_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: total rows and NULL count per feature column, by a pass of its
    own (``observe_null_counts`` takes them from the job's)."""
    return df.agg(*_null_counts(df, columns))


def observe_null_counts(df: DataFrame, observation: Observation, columns: Sequence[str] | None = None) -> DataFrame:
    """``df``, whose ``feature_null_counts`` the ``observation`` gets from the job that runs it."""
    return df.observe(observation, *_null_counts(df, columns))


def quality_checks(df: DataFrame, keys: Sequence[str] = ("store_id", "item_id", "date"),
                   flags: Sequence[str] = ("is_weekend", "has_event", "snap_active")) -> DataFrame:
    """One row of data checks: row count, duplicated keys, price NULL rate,
    negative sales rows and rows whose 0/1 flags hold another value. The input
    is read once: sums per key, then over the keys."""
    bad_flag = F.lit(False)
    for f in flags:
        if f in df.columns:
            bad_flag = bad_flag | ~F.col(f).isin(0, 1)
    no_price = F.col("sell_price").isNull() if "sell_price" in df.columns else F.lit(None).cast("boolean")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(no_price.cast("long")).alias("_no_price"),
                                    F.sum((F.col("sales") < 0).cast("long")).alias("_negative"),
                                    F.sum(bad_flag.cast("long")).alias("_bad"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        safe_div(F.sum("_no_price").cast("double"), F.sum("_n").cast("double")).alias("price_null_rate"),
        F.sum("_negative").alias("negative_sales"), F.sum("_bad").alias("bad_flags"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_keys"))
