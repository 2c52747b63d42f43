"""Registered Spark queries: one per operator (or tight group of operators).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole of the driver's tables. Column names and types match the SQL oracle of
the same name in ``larder.catalog.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalog import inputs as P
from larder.catalog.inputs import prepared, round_doubles
from larder.operators import features as fe
from larder.operators import prepare as pr
from larder.sources import driver_tables as dt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KEYS = ["store_id", "item_id", "date"]


def register(name: str):
    """Register ``fn`` under ``name``. Every call starts a fresh scope, so a
    query builds (and pays for) its own daily fact table."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            dt.new_query_scope()
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# -- preparation --------------------------------------------------------------

@register("melt_sales")
def q_melt_sales(spark, sf_dir):
    return round_doubles(pr.melt_sales(dt.sales_wide(spark, sf_dir)))


@register("join_calendar")
def q_join_calendar(spark, sf_dir):
    return round_doubles(pr.join_calendar(dt.sales_daily(spark, sf_dir), dt.calendar(spark, sf_dir)))


@register("join_prices")
def q_join_prices(spark, sf_dir):
    df = pr.join_prices(pr.join_calendar(dt.sales_daily(spark, sf_dir), dt.calendar(spark, sf_dir)),
                        dt.prices(spark, sf_dir))
    return round_doubles(df.select(*KEYS, "wm_yr_wk", "sell_price"))


@register("ffill_prices")
def q_ffill_prices(spark, sf_dir):
    return round_doubles(prepared(spark, sf_dir).select(*KEYS, "sell_price"))


@register("filter_stores_items")
def q_filter_stores_items(spark, sf_dir):
    df = pr.filter_stores_items(prepared(spark, sf_dir), stores=P.FILTER_STORES, items=None)
    return round_doubles(df.select(*KEYS, "sales", "sell_price"))


@register("normalise_types")
def q_normalise_types(spark, sf_dir):
    return round_doubles(prepared(spark, sf_dir))


# -- features -----------------------------------------------------------------

@register("calendar_features")
def q_calendar_features(spark, sf_dir):
    df = fe.calendar_features(prepared(spark, sf_dir))
    return df.select(*KEYS, "day_of_week", "month", "week_of_year", "day_of_month", "is_weekend",
                     "quarter", "year")


@register("event_features")
def q_event_features(spark, sf_dir):
    return fe.event_features(prepared(spark, sf_dir)).select(*KEYS, "has_event", "event_type_encoded")


@register("snap_features")
def q_snap_features(spark, sf_dir):
    return fe.snap_features(prepared(spark, sf_dir)).select(*KEYS, "state_id", "snap_active")


@register("lag_features")
def q_lag_features(spark, sf_dir):
    df = fe.lag_features(prepared(spark, sf_dir), P.LAGS)
    return round_doubles(df.select(*KEYS, "sales", *[f"lag_{n}" for n in P.LAGS]))


@register("rolling_mean")
def q_rolling_mean(spark, sf_dir):
    df = fe.rolling_mean(prepared(spark, sf_dir), P.WINDOWS)
    return round_doubles(df.select(*KEYS, *[f"rolling_mean_{n}" for n in P.WINDOWS]))


@register("rolling_std")
def q_rolling_std(spark, sf_dir):
    df = fe.rolling_std(prepared(spark, sf_dir), P.WINDOWS)
    return round_doubles(df.select(*KEYS, *[f"rolling_std_{n}" for n in P.WINDOWS]))


@register("price_rel_mean")
def q_price_rel_mean(spark, sf_dir):
    df = fe.price_rel_mean(prepared(spark, sf_dir))
    return round_doubles(df.select(*KEYS, "sell_price", "price_rel_mean"))


@register("price_rel_mean_as_of")
def q_price_rel_mean_as_of(spark, sf_dir):
    """Price against the item's mean price on earlier days only."""
    df = fe.price_rel_mean(prepared(spark, sf_dir), as_of=True)
    return round_doubles(df.select(*KEYS, "sell_price", "price_rel_mean"))


@register("price_change_pct_padded")
def q_price_change_pct_padded(spark, sf_dir):
    """Prices padded forward without limit before the change is taken."""
    df = fe.price_change_pct(prepared(spark, sf_dir), pad=True)
    return round_doubles(df.select(*KEYS, "sell_price", "price_change_pct"))


@register("price_change_pct")
def q_price_change_pct(spark, sf_dir):
    df = fe.price_change_pct(prepared(spark, sf_dir))
    return round_doubles(df.select(*KEYS, "sell_price", "price_change_pct"))


@register("log_price")
def q_log_price(spark, sf_dir):
    df = fe.log_price(prepared(spark, sf_dir))
    return round_doubles(df.select(*KEYS, "sell_price", "log_price"))


@register("drop_sparse_groups")
def q_drop_sparse_groups(spark, sf_dir):
    df = fe.drop_sparse_groups(prepared(spark, sf_dir), P.MIN_GROUP_ROWS)
    return round_doubles(df.select(*KEYS, "sales"))


def feature_matrix(spark, sf_dir) -> DataFrame:
    return fe.add_all_features(prepared(spark, sf_dir), P.LAGS, P.WINDOWS, P.MIN_GROUP_ROWS)


@register("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    return round_doubles(feature_matrix(spark, sf_dir))


@register("feature_job_wide")
def q_feature_job_wide(spark, sf_dir):
    """The reference's feature build from the wide layout: melt over the
    whole calendar (days without sales are 0), calendar, prices + fill,
    features, sparse-group removal - the ``plans.jobs.build_features`` plan."""
    from larder.plans.jobs import build_features
    params = Params(lag_days=P.LAGS, rolling_windows=P.WINDOWS, min_group_rows=P.MIN_GROUP_ROWS,
                    price_ffill_limit=P.FFILL_LIMIT)
    feats = build_features(dt.sales_wide(spark, sf_dir), dt.calendar(spark, sf_dir), dt.prices(spark, sf_dir),
                           params)
    return round_doubles(feats.select(*KEYS, "sales", "sell_price", "lag_7", "lag_28", "rolling_mean_7",
                                      "rolling_std_28", "price_rel_mean", "price_change_pct", "snap_active",
                                      "event_type_encoded"))


@register("feature_null_counts")
def q_feature_null_counts(spark, sf_dir):
    return fe.feature_null_counts(feature_matrix(spark, sf_dir))


@register("feature_job_report")
def q_feature_job_report(spark, sf_dir):
    """Rows in, dropped and out and NULLs per feature, as the feature write
    itself counts them."""
    from larder.plans.jobs import write_observed
    from larder.sources.files import scratch_path, write_features
    path = scratch_path(spark, "features")
    done = write_observed(lambda seen: fe.add_all_features(prepared(spark, sf_dir), P.LAGS, P.WINDOWS, P.MIN_GROUP_ROWS, seen),
                          lambda feats: write_features(feats, path))
    return spark.createDataFrame([tuple(done.values())], ", ".join(f"{k} long" for k in done))


@register("quality_checks")
def q_quality_checks(spark, sf_dir):
    return round_doubles(fe.quality_checks(feature_matrix(spark, sf_dir)))


@register("features_roundtrip")
def q_features_roundtrip(spark, sf_dir):
    """Write the feature matrix as Parquet partitioned by store, read it back
    (the training job's input). The folder is under the shared checkpoint dir."""
    from larder.sources.files import read_features, scratch_path, write_features
    path = scratch_path(spark, "features")
    write_features(feature_matrix(spark, sf_dir), path)
    back = read_features(spark, path, columns=KEYS + ["sales", "lag_7", "rolling_mean_28", "sell_price"])
    return round_doubles(back)


# -- forecasting --------------------------------------------------------------

from larder.operators import forecast as fc  # noqa: E402


@register("distinct_dates")
def q_distinct_dates(spark, sf_dir):
    return fc.distinct_dates(feature_matrix(spark, sf_dir))


def _folds(spark, sf_dir, fm=None):
    fm = fm if fm is not None else feature_matrix(spark, sf_dir)
    return fc.cv_folds(fc.distinct_dates(fm), P.CV_SPLITS, P.FORECAST_HORIZON)


@register("cv_folds")
def q_cv_folds(spark, sf_dir):
    return _folds(spark, sf_dir)


@register("moving_average_forecast")
def q_moving_average_forecast(spark, sf_dir):
    df = fc.moving_average_forecast(feature_matrix(spark, sf_dir), 28)
    return round_doubles(df.select(*KEYS, "sales", "forecast"))


@register("cv_metrics")
def q_cv_metrics(spark, sf_dir):
    fm = feature_matrix(spark, sf_dir)
    scored = fc.moving_average_forecast(fm, 28)
    return round_doubles(fc.cv_average(fc.fold_metrics(scored, _folds(spark, sf_dir, fm))))


from larder.plans.jobs import Params  # noqa: E402

_JOB = Params()
GBT_NUMERIC, GBT_CATEGORICAL = list(_JOB.numeric_features), list(_JOB.categorical_features)
GBT = dict(max_iter=_JOB.n_estimators, step_size=_JOB.learning_rate, seed=_JOB.seed)


def _assembled(spark, sf_dir) -> DataFrame:
    """The feature matrix with its numeric features as one vector, written once
    to the checkpoint folder; folds, training and scoring read it from there."""
    from larder.plans.lineage import cut_lineage
    fm = feature_matrix(spark, sf_dir).select(*KEYS, "sales", "rolling_mean_28", *GBT_CATEGORICAL, *[
        c for c in GBT_NUMERIC if c != "rolling_mean_28"])
    return cut_lineage(fc.assemble_numeric(fm, GBT_NUMERIC).select(*KEYS, "sales", "rolling_mean_28", *GBT_CATEGORICAL, fc.NUMERIC_VECTOR))


def _last_fold(spark, sf_dir, fm) -> tuple:
    folds = _folds(spark, sf_dir, fm).filter(F.col("fold") == P.CV_SPLITS)
    return tuple(fc.date_semi_join(fm, folds.filter(F.col("role") == role)) for role in ("train", "test"))


@register("gbt_forecast")
def q_gbt_forecast(spark, sf_dir):
    """Fit on the train dates of the last fold, score its test dates."""
    train, test = _last_fold(spark, sf_dir, _assembled(spark, sf_dir))
    model = fc.train_model(train, GBT_NUMERIC, GBT_CATEGORICAL, **GBT)
    return round_doubles(fc.predict(model, test, GBT_NUMERIC).select(*KEYS, "sales", "prediction"))


# Trees of the queries that check saving, loading and jobs, not the forecast.
FEW_TREES = 12


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Save and load a model in the shared folder: test rows scored by both."""
    from larder.plans.jobs import reload_check
    from larder.sources.files import scratch_path
    train, test = _last_fold(spark, sf_dir, _assembled(spark, sf_dir))
    model = fc.train_model(train, GBT_NUMERIC, GBT_CATEGORICAL, **{**GBT, "max_iter": FEW_TREES})
    return reload_check(spark, model, scratch_path(spark, "model"), test, GBT_NUMERIC)


@register("training_job")
def q_training_job(spark, sf_dir):
    """The training job from written features: folds evaluated, model saved,
    every row scored by the loaded model."""
    from larder.plans.jobs import training_job
    from larder.sources.files import load_model, read_features, scratch_path, write_features
    path = scratch_path(spark, "features")
    write_features(feature_matrix(spark, sf_dir), path)
    done = training_job(spark, path, scratch_path(spark, "model"), Params(n_estimators=FEW_TREES))
    scored = fc.predict(load_model(done["model_path"]), read_features(spark, path), GBT_NUMERIC)
    measured = F.lit(done["rmse"]).isNotNull() & (F.lit(done["wmape"]) > 0)
    return scored.agg(F.lit(done["n_folds"]).alias("n_folds"), F.count(F.lit(1)).alias("n_scored"),
                      F.sum((F.col("prediction") >= 0).cast("long")).alias("n_predicted"), F.max(measured).alias("measured"))


@register("gbt_training_check")
def q_gbt_training_check(spark, sf_dir):
    """The trees against the moving average over the same folds, all trees of
    the production setting: WMAPE of both, whether the trees are better, and
    whether the loss on the training rows falls with every tree of the last
    fold's model, as fitted for the comparison."""
    fm = _assembled(spark, sf_dir)
    folds = _folds(spark, sf_dir, fm)
    models: dict = {}
    trees = fc.cross_validate(fm, folds, GBT_NUMERIC, GBT_CATEGORICAL, tasks=fc.fit_tasks(fm, P.CV_SPLITS), models=models, **GBT).first()
    average = fc.cv_average(fc.fold_metrics(fc.moving_average_forecast(fm, 28), folds))
    train, _ = _last_fold(spark, sf_dir, fm)
    losses = fc.training_losses(models[P.CV_SPLITS], train, GBT_NUMERIC)
    falls = all(b < a for a, b in zip(losses, losses[1:], strict=False))
    return average.select("n_folds", F.round("wmape", 6).alias("wmape_average"), (F.lit(trees["wmape"]) < F.col("wmape")).alias("trees_better"),
                          F.lit(falls).alias("loss_falls"))


@register("feature_target_split")
def q_feature_target_split(spark, sf_dir):
    """Target, category codes and missing numeric features per row. The codes are
    fitted on the rows of four stores, so values of the others are unseen."""
    fm = feature_matrix(spark, sf_dir)
    fm = fm.select(*KEYS, "sales", *GBT_NUMERIC, *GBT_CATEGORICAL)
    numeric, categorical = fc.feature_target_split(fm)
    known = fm.filter(F.col("store_id").isin(list(P.FILTER_STORES)))
    coded = fc.category_index(categorical).fit(known.select(*categorical)).transform(fm)
    missing = sum((F.col(c).isNull().cast("int") for c in numeric), F.lit(0))
    return round_doubles(coded.select(*KEYS, F.col("sales").alias("target"), missing.alias("n_missing"),
                                      *[F.col(f"{c}__idx").cast("int").alias(f"{c}_code") for c in categorical]))


@register("date_semi_join")
def q_date_semi_join(spark, sf_dir):
    """Feature rows on the test dates of the last fold."""
    fm = feature_matrix(spark, sf_dir)
    test = _folds(spark, sf_dir, fm).filter((F.col("fold") == P.CV_SPLITS) & (F.col("role") == "test"))
    return round_doubles(fc.date_semi_join(fm, test).select(*KEYS, "sales", "lag_7"))


@register("gbt_cv_metrics")
def q_gbt_cv_metrics(spark, sf_dir):
    """Expanding-window CV of the tree model: one distributed fit per fold, side
    by side, on vectors written once."""
    fm = _assembled(spark, sf_dir)
    return round_doubles(fc.cross_validate(fm, _folds(spark, sf_dir, fm), GBT_NUMERIC, GBT_CATEGORICAL, **GBT))


# -- allocation ---------------------------------------------------------------

from larder.operators import allocate as al  # noqa: E402
from larder.operators import ledger as lg  # noqa: E402
from larder.operators import replenish as rp  # noqa: E402

COSTS = dict(stockout_penalty=P.STOCKOUT_PENALTY, holding_cost=P.HOLDING_COST,
             transport_cost=P.TRANSPORT_COST)


@register("allocate_ordered")
def q_allocate_ordered(spark, sf_dir):
    pairs, warehouse = P.allocation_inputs(spark, sf_dir)
    return round_doubles(al.allocate(pairs, None, warehouse, "ordered", **COSTS))


@register("allocate_proportional")
def q_allocate_proportional(spark, sf_dir):
    pairs, warehouse = P.allocation_inputs(spark, sf_dir)
    return round_doubles(al.allocate(pairs, None, warehouse, "proportional", **COSTS))


@register("allocation_cost")
def q_allocation_cost(spark, sf_dir):
    pairs, warehouse = P.allocation_inputs(spark, sf_dir)
    alloc = al.allocate(pairs, None, warehouse, "ordered", keep_inputs=True, **COSTS)
    return round_doubles(al.allocation_cost(alloc, **COSTS))


# -- replenishment (one day) --------------------------------------------------

@register("in_transit_totals")
def q_in_transit_totals(spark, sf_dir):
    _, _, in_transit = P.policy_snapshot(spark, sf_dir)
    return round_doubles(rp.in_transit_totals(in_transit))


def _position(spark, sf_dir):
    forecast, stock, in_transit = P.policy_snapshot(spark, sf_dir)
    return rp.stock_position(forecast, stock, in_transit)


@register("stock_position")
def q_stock_position(spark, sf_dir):
    return round_doubles(_position(spark, sf_dir))


@register("initial_stock")
def q_initial_stock(spark, sf_dir):
    return rp.initial_stock(P.series_stats(spark, sf_dir), P.INITIAL_MULTIPLIER)


@register("schedule_orders")
def q_schedule_orders(spark, sf_dir):
    orders = dt.demand_daily(spark, sf_dir).withColumnRenamed("demand", "qty")
    return rp.schedule_orders(orders, P.LEAD_TIME_MIN, P.LEAD_TIME_MAX)


@register("split_arrivals")
def q_split_arrivals(spark, sf_dir):
    arrivals = dt.returns_daily(spark, sf_dir).withColumnRenamed("day", "arrival_day")
    return rp.split_arrivals(arrivals, P.as_of_day(spark, sf_dir))


@register("post_arrivals")
def q_post_arrivals(spark, sf_dir):
    _, stock, _ = P.policy_snapshot(spark, sf_dir)
    arrivals = dt.returns_daily(spark, sf_dir).withColumnRenamed("day", "arrival_day")
    due = rp.split_arrivals(arrivals, P.as_of_day(spark, sf_dir)).filter("due")
    return rp.post_arrivals(stock, due)


@register("naive_orders")
def q_naive_orders(spark, sf_dir):
    return round_doubles(rp.naive_orders(_position(spark, sf_dir), P.LEAD_TIME_MIN, P.LEAD_TIME_MAX,
                                         P.NAIVE_BUFFER_DAYS))


@register("minmax_orders")
def q_minmax_orders(spark, sf_dir):
    return round_doubles(rp.minmax_orders(_position(spark, sf_dir), P.MIN_DAYS_SUPPLY, P.MAX_DAYS_SUPPLY))


@register("allocation_orders")
def q_allocation_orders(spark, sf_dir):
    _, warehouse = P.allocation_inputs(spark, sf_dir)
    return round_doubles(rp.allocation_orders(_position(spark, sf_dir), warehouse, P.LEAD_TIME_MIN,
                                              P.LEAD_TIME_MAX, **COSTS))


# -- ledgers over time --------------------------------------------------------

@register("day_slice")
def q_day_slice(spark, sf_dir):
    """Demand rows of the snapshot day."""
    return lg.day_slice(dt.demand_daily(spark, sf_dir), P.as_of_day(spark, sf_dir))


@register("fulfil_day")
def q_fulfil_day(spark, sf_dir):
    stock = rp.initial_stock(P.series_stats(spark, sf_dir), P.INITIAL_MULTIPLIER)
    return round_doubles(lg.fulfil_day(dt.demand_daily(spark, sf_dir), stock, P.HOLDING_COST,
                                       P.STOCKOUT_PENALTY))


def _replay(spark, sf_dir):
    return lg.replay_ledger(P.ledger_events(spark, sf_dir), P.ledger_initial(spark, sf_dir),
                            P.HOLDING_COST, P.STOCKOUT_PENALTY)


@register("replay_ledger")
def q_replay_ledger(spark, sf_dir):
    return round_doubles(_replay(spark, sf_dir))


@register("daily_kpis")
def q_daily_kpis(spark, sf_dir):
    return round_doubles(lg.daily_kpis(_replay(spark, sf_dir), dt.n_calendar_days(spark, sf_dir)))


@register("summary_kpis")
def q_summary_kpis(spark, sf_dir):
    return round_doubles(lg.summary_kpis(lg.daily_kpis(_replay(spark, sf_dir), dt.n_calendar_days(spark, sf_dir))))


@register("open_positions")
def q_open_positions(spark, sf_dir):
    """Open orders, stock and position of every series on every day."""
    return round_doubles(lg.open_positions(P.demand_orders(spark, sf_dir), dt.demand_daily(spark, sf_dir),
                                           P.ledger_initial(spark, sf_dir), dt.n_calendar_days(spark, sf_dir)))


@register("policy_kpis")
def q_policy_kpis(spark, sf_dir):
    """Recorded policies by fulfilment, stockouts and costs over the whole span."""
    return round_doubles(lg.policy_kpis(P.recorded_orders(spark, sf_dir), dt.demand_daily(spark, sf_dir), P.ledger_initial(spark, sf_dir),
                                        list(P.RECORDED_POLICIES), dt.n_calendar_days(spark, sf_dir), P.HOLDING_COST, P.STOCKOUT_PENALTY))


@register("warehouse_drawdown")
def q_warehouse_drawdown(spark, sf_dir):
    _, warehouse = P.allocation_inputs(spark, sf_dir)
    orders = dt.demand_daily(spark, sf_dir).withColumnRenamed("demand", "qty")
    return round_doubles(lg.warehouse_drawdown(orders, warehouse))


@register("compare_policies")
def q_compare_policies(spark, sf_dir):
    """Naive, min-max and allocation orders for the snapshot position, side by
    side. The position, one row a series, is written once for the four uses."""
    from larder.plans.lineage import cut_lineage
    _, warehouse = P.allocation_inputs(spark, sf_dir)
    position = cut_lineage(_position(spark, sf_dir))
    orders = {"naive": rp.naive_orders(position, P.LEAD_TIME_MIN, P.LEAD_TIME_MAX, P.NAIVE_BUFFER_DAYS),
              "minmax": rp.minmax_orders(position, P.MIN_DAYS_SUPPLY, P.MAX_DAYS_SUPPLY),
              "allocation": rp.allocation_orders(position, warehouse, P.LEAD_TIME_MIN, P.LEAD_TIME_MAX, **COSTS)}
    return round_doubles(lg.compare_policies(orders, position, (P.LEAD_TIME_MIN + P.LEAD_TIME_MAX) / 2.0,
                                             P.TRANSPORT_COST, P.STOCKOUT_PENALTY), 4)


# -- files --------------------------------------------------------------------

from larder.sources import files as fs  # noqa: E402


def _as_csv(spark, df: DataFrame, name: str) -> str:
    """``df`` written as CSV under the shared folder, columns in reverse order
    and with one column more than the reader knows."""
    path = fs.scratch_path(spark, name)
    df.select(*reversed(df.columns), F.lit("x").alias("note")).write.csv(path, header=True)
    return path


@register("read_calendar")
def q_read_calendar(spark, sf_dir):
    cal = dt.calendar(spark, sf_dir)
    cal = cal.withColumnRenamed("snap_AF", "snap_CA").withColumnRenamed("snap_AM", "snap_TX").withColumnRenamed("snap_AS", "snap_WI")
    return fs.read_calendar(spark, _as_csv(spark, cal, "csv-calendar"))


@register("read_prices")
def q_read_prices(spark, sf_dir):
    return fs.read_prices(spark, _as_csv(spark, dt.prices(spark, sf_dir), "csv-prices"))


@register("read_sales_wide")
def q_read_sales_wide(spark, sf_dir):
    wide = dt.sales_wide(spark, sf_dir)
    whole = wide.select(*[F.col(c).cast("int").alias(c) if c.startswith("d_") else F.col(c) for c in wide.columns])
    return round_doubles(pr.melt_sales(fs.read_sales_wide(spark, _as_csv(spark, whole, "csv-sales"))))


def _price_folder(spark, sf_dir) -> str:
    """Weekly prices as a folder of CSV files in three column orders, one of
    them with a column more; stores are dealt to the orders by their name."""
    prices = dt.prices(spark, sf_dir).withColumn("note", F.lit('x, "y"'))
    path = fs.scratch_path(spark, "csv-folder")
    orders = (("store_id", "item_id", "wm_yr_wk", "sell_price"), ("note", "sell_price", "wm_yr_wk", "item_id", "store_id"),
              ("item_id", "wm_yr_wk", "store_id", "sell_price"))
    for k, columns in enumerate(orders):
        prices.filter(F.length("store_id") % len(orders) == k).select(*columns).write.mode("append").csv(path, header=True)
    return path


@register("read_prices_folder")
def q_read_prices_folder(spark, sf_dir):
    return fs.read_prices(spark, _price_folder(spark, sf_dir))


@register("csv_rejects")
def q_csv_rejects(spark, sf_dir):
    """Good and rejected rows per store of price files in which some weeks and
    some prices are no numbers."""
    path = fs.scratch_path(spark, "csv-bad")
    cents = F.round(F.col("sell_price") * 100).cast("long")
    week = F.when(cents % 5 == 0, F.concat(F.lit("w"), F.col("wm_yr_wk"))).otherwise(F.col("wm_yr_wk").cast("string"))
    price = F.when(cents % 7 == 0, F.lit("n/a")).otherwise(F.col("sell_price").cast("string"))
    dt.prices(spark, sf_dir).select("store_id", "item_id", week.alias("wm_yr_wk"), price.alias("sell_price")).write.csv(path, header=True)
    good = fs.read_prices(spark, path, bad_rows="drop").groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.round(F.col("sell_price") * 100).cast("long")).alias("cents"))
    bad = fs.csv_rejects(spark, path, {f.name: f.dataType for f in fs.PRICES_SCHEMA.fields})
    bad = bad.groupBy(F.split("record", ",")[0].alias("store_id")).agg(F.count(F.lit(1)).alias("n_rejected"))
    return good.join(bad, "store_id", "full").select("store_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "cents", "n_rejected")])


@register("feature_job_files")
def q_feature_job_files(spark, sf_dir):
    """The feature job from CSV files to Parquet files, then once more for one
    store without price fill: only that store's partition changes."""
    from larder.plans.jobs import feature_job
    wide = dt.sales_wide(spark, sf_dir)
    whole = wide.select(*[F.col(c).cast("int").alias(c) if c.startswith("d_") else F.col(c) for c in wide.columns])
    paths = (_as_csv(spark, whole, "csv-sales"), _as_csv(spark, dt.calendar(spark, sf_dir), "csv-calendar"),
             _as_csv(spark, dt.prices(spark, sf_dir), "csv-prices"), fs.scratch_path(spark, "features"))
    params = Params(lag_days=P.LAGS, rolling_windows=P.WINDOWS, min_group_rows=P.MIN_GROUP_ROWS, price_ffill_limit=P.FFILL_LIMIT)
    feature_job(spark, *paths, params)
    feats = feature_job(spark, *paths, replace(params, price_ffill_limit=0, stores_filter=list(P.FILTER_STORES[:1])))
    return round_doubles(feats.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("total_sales"), F.sum("lag_28").alias("total_lag_28"),
        F.sum(F.col("sell_price").isNull().cast("long")).alias("null_prices")))
