"""End-to-end jobs: the feature build and the model training job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators import features as fe
from larder.operators import forecast as fc
from larder.operators import prepare as pr
from larder.plans.lineage import cut_lineage
from larder.sources import files


@dataclass
class Params:
    """Job parameters (defaults are the reference's configuration)."""
    lag_days: Sequence[int] = (7, 14, 28)
    rolling_windows: Sequence[int] = (7, 28)
    min_group_rows: int = 30
    price_ffill_limit: int = 7
    stores_filter: Sequence[str] | None = None
    items_filter: Sequence[str] | None = None
    cv_splits: int = 3
    forecast_horizon: int = 14
    n_estimators: int = 150
    learning_rate: float = 0.05
    seed: int = 42
    numeric_features: Sequence[str] = field(default_factory=lambda: [
        "lag_7", "lag_14", "lag_28", "rolling_mean_7", "rolling_mean_28", "rolling_std_7", "rolling_std_28",
        "day_of_week", "month", "week_of_year", "day_of_month", "is_weekend", "quarter", "year",
        "has_event", "event_type_encoded", "snap_active", "sell_price", "price_rel_mean",
        "price_change_pct", "log_price"])
    categorical_features: Sequence[str] = ("dept_id", "cat_id", "state_id")


def build_features(wide: DataFrame, calendar: DataFrame, prices: DataFrame, params: Params,
                   observation: Observation | None = None) -> DataFrame:
    """Wide sales -> long -> calendar -> prices + fill -> filters -> types ->
    features -> sparse-group removal. Store / item filters are applied right
    after the melt: they are on the series keys, so the result is the same and
    Catalyst prunes rows at the scan.

    The long table is checkpointed right after the melt: the wide plan holds
    one expression per day column (about 2,000 in M5) and AQE re-optimises
    the remaining plan after every stage, so cutting it here keeps planning
    cheap; it is also the natural recovery point of the job."""
    long = cut_lineage(pr.filter_stores_items(pr.melt_sales(wide), params.stores_filter,
                                              params.items_filter))
    df = pr.prepare_long(long, calendar, prices, params.price_ffill_limit)
    return fe.add_all_features(df, params.lag_days, params.rolling_windows, params.min_group_rows, observation)


def write_observed(build, write) -> dict:
    """Run a feature build and its write as one job and return the job's own
    figures: ``rows_in``, ``rows_dropped``, ``n_rows`` and ``null_<feature>``.
    ``build(observation)`` makes the frame, ``write(frame)`` stores it. No second
    pass over the rows."""
    dropped, nulls = Observation(), Observation()
    write(fe.observe_null_counts(build(dropped), nulls))
    return {**dropped.get, **nulls.get}


def feature_job(spark: SparkSession, sales_path: str, calendar_path: str, prices_path: str,
                output_path: str, params: Params | None = None, report: dict | None = None) -> DataFrame:
    """Read the three CSV sets, build features, write Parquet partitioned by
    store. The inputs' files are looked up before any job runs.

    Without filters the output is replaced. With a store filter only the stores
    of this run are replaced, whole partitions at a time; with an item filter
    their other items' rows are carried over. ``report`` receives the job's own
    figures (``write_observed``)."""
    params = params or Params()
    wide, calendar = files.read_sales_wide(spark, sales_path), files.read_calendar(spark, calendar_path)
    prices = files.read_prices(spark, prices_path)
    some = bool(params.stores_filter or params.items_filter)
    others = _other_items(spark, output_path, params) if params.items_filter else None

    schema = []

    def write(feats: DataFrame) -> None:
        rows = feats if others is None else feats.unionByName(others, allowMissingColumns=True)
        schema.append(rows.schema)
        files.write_features(rows, output_path, replace="partitions" if some else "all")

    figures = write_observed(lambda seen: build_features(wide, calendar, prices, params, seen), write)
    if report is not None:
        report.update(figures)
    return files.read_features(spark, output_path, schema=schema[0])


def _other_items(spark: SparkSession, path: str, params: Params) -> DataFrame | None:
    """What ``path`` holds of items outside the run's filter in the run's
    stores, written elsewhere so that its partitions can be replaced."""
    if not files.path_exists(spark, path):
        return None
    kept = pr.filter_stores_items(files.read_features(spark, path), params.stores_filter)
    return cut_lineage(kept.filter(~F.col("item_id").isin(list(params.items_filter))))


def training_job(spark: SparkSession, features_path: str, model_path: str, params: Params | None = None,
                 skip_cv: bool = False) -> dict:
    """Read features -> optional expanding-window CV -> fit on all -> save."""
    params = params or Params()
    feats = files.read_features(spark, features_path)
    num = [c for c in params.numeric_features if c in feats.columns]
    cat = [c for c in params.categorical_features if c in feats.columns]
    data = fc.assemble_numeric(feats.select("date", "store_id", "item_id", "sales", *num, *cat), num)
    data = cut_lineage(data.drop(*num))
    kw = dict(max_iter=params.n_estimators, step_size=params.learning_rate, seed=params.seed)
    result = {}
    if not skip_cv:
        folds = fc.cv_folds(fc.distinct_dates(data), params.cv_splits, params.forecast_horizon)
        row = fc.cross_validate(data, folds, num, cat, **kw).first()
        result = {"rmse": row["rmse"], "wmape": row["wmape"], "n_folds": row["n_folds"]}
    model = fc.train_model(data, num, cat, **kw)
    files.save_model(model, model_path)
    result["model_path"] = model_path
    return result


def reload_check(spark: SparkSession, model, model_path: str, rows: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Save ``model``, load it again and score ``rows`` with both: ``n_scored,
    n_diff, n_null`` (rows that differ, rows without a prediction)."""
    files.save_model(model, model_path)
    rows = fc.assemble_numeric(rows, numeric)
    first = fc.predict(model, rows.withColumn("_vector", F.col(fc.NUMERIC_VECTOR)), numeric)
    first = first.withColumnRenamed("prediction", "_first").withColumnRenamed("_vector", fc.NUMERIC_VECTOR)
    both = fc.predict(files.load_model(model_path), first, numeric)
    differ = ~F.col("prediction").eqNullSafe(F.col("_first"))
    return both.agg(F.count(F.lit(1)).alias("n_scored"), F.coalesce(F.sum(differ.cast("long")), F.lit(0)).alias("n_diff"),
                    F.coalesce(F.sum(F.col("prediction").isNull().cast("long")), F.lit(0)).alias("n_null"))
