"""Back-testing: date ranks, expanding-window folds, moving-average and
gradient-boosted-tree forecasts, RMSE / WMAPE per fold and their average."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.numeric import clip_non_negative, safe_div
from larder.plans.lineage import cut_lineage
from larder.sources.files import scratch_path


def distinct_dates(df: DataFrame, date_col: str = "date") -> DataFrame:
    """(date, date_rank 1..n, n_dates). The global ordering runs in a single
    partition, but over distinct dates only: at most one row per calendar day."""
    d = df.select(date_col).distinct()
    return d.select(date_col,
                    F.row_number().over(Window.orderBy(date_col)).alias("date_rank"),
                    F.count(F.lit(1)).over(Window.partitionBy()).alias("n_dates"))


def cv_folds(dates: DataFrame, n_splits: int = 3, horizon: int = 14) -> DataFrame:
    """Expanding-window folds over ranked dates -> (fold, date, role).

    Fold f (1 = oldest) tests the ``horizon`` dates starting at index
    ``n_dates - (n_splits - f + 1) * horizon`` and trains on every earlier
    date; a fold whose test start is not after the first date is skipped.
    A date belongs to several folds; fold numbers come from a
    ``sequence(1, n_splits)`` explode (no cross join)."""
    f = dates.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold"))
    start = F.col("n_dates") - (F.lit(n_splits) - F.col("fold") + 1) * horizon
    role = (F.when(F.col("date_rank") <= start, F.lit("train"))
            .when(F.col("date_rank") <= start + horizon, F.lit("test")))
    return (f.withColumn("role", role).filter((start > 0) & F.col("role").isNotNull())
             .select(F.col("fold").cast("int").alias("fold"), "date", "role"))


def moving_average_forecast(features: DataFrame, window: int = 28) -> DataFrame:
    """The moving-average model: forecast = mean of the previous ``window`` rows
    (the ``rolling_mean_<window>`` feature), 0 when there is no history."""
    return features.withColumn("forecast", F.coalesce(F.col(f"rolling_mean_{window}"), F.lit(0.0)))


def fold_metrics(scored: DataFrame, folds: DataFrame, y: str = "sales", p: str = "forecast") -> DataFrame:
    """Per fold: rmse and wmape on the fold's test rows, predictions clipped
    at 0. The test-role fold table has at most n_splits x horizon rows (both
    are parameters), so broadcasting it is bounded."""
    test = folds.filter(F.col("role") == "test").select("fold", "date")
    return scored_metrics(scored.join(F.broadcast(test), "date"), y, p)


def cv_average(per_fold: DataFrame) -> DataFrame:
    """Unweighted mean over folds; NULL metrics when there is no fold."""
    return per_fold.agg(F.avg("rmse").alias("rmse"), F.avg("wmape").alias("wmape"),
                        F.count(F.lit(1)).alias("n_folds"))


def date_semi_join(df: DataFrame, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows whose date is in ``dates`` (a train or test date list). A list of
    distinct DATEs has at most one row per day of the span, so it is broadcast;
    a key of another type has no such bound and stays a plain join."""
    listed = dates.select(date_col).distinct()
    bounded = isinstance(listed.schema[date_col].dataType, T.DateType)
    return df.join(F.broadcast(listed) if bounded else listed, date_col, "left_semi")


def wmape(df: DataFrame, y: str, p: str) -> DataFrame:
    """sum|y - max(p, 0)| / sum y; 0 when sum y <= 0."""
    err = F.abs(F.col(y) - clip_non_negative(F.col(p)))
    return df.agg(F.when(F.sum(y) > 0, safe_div(F.sum(err), F.sum(y))).otherwise(F.lit(0.0)).alias("wmape"))


def rmse(df: DataFrame, y: str, p: str) -> DataFrame:
    err = F.col(y) - F.col(p)
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


# -- gradient-boosted trees (Spark ML) ---------------------------------------

# Columns that are neither features nor categories.
DROP_COLUMNS = ("date", "store_id", "item_id")
NUMERIC_VECTOR = "numeric__vector"
VARYING_VECTOR = "numeric__varying"
# Rows that one task of a fit holds at most, where the caller leaves the number
# of tasks to ``fit_tasks``: about 60 MB of binned points.
FIT_TASK_ROWS = 250_000


def feature_target_split(df: DataFrame, label: str = "sales", drop: Sequence[str] = DROP_COLUMNS) -> tuple:
    """(numeric features, categorical features) of a feature table: every column
    but the label and the keys, strings as categories. A column of a type that
    trees cannot use (a date, an array) is an error."""
    if label not in df.columns:
        raise ValueError(f"no column {label}")
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name == label or f.name in drop:
            continue
        if isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(f.name)
        else:
            raise ValueError(f"{f.name} is neither a number nor a category")
    return numeric, categorical


def category_index(categorical: Sequence[str]):
    """Estimator of category codes ``<name>__idx``: 0 for the most frequent value
    of the rows it is fitted on (ties by name); a value that these do not have,
    or null, gets the one code after the last."""
    from pyspark.ml.feature import StringIndexer
    return StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__idx" for c in categorical], handleInvalid="keep",
                         stringOrderType="frequencyDesc")


def assemble_numeric(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """``df`` with its numeric features as one vector. Trees in Spark ML reject
    NaN/NULL in vectors: a NULL feature becomes -1 plus a 0/1 indicator (no
    imputation of values). A frame that has the vector stays as it is."""
    from pyspark.ml.feature import VectorAssembler
    if NUMERIC_VECTOR in df.columns:
        return df
    cols = {}
    for c in numeric:
        cols[f"{c}__v"] = F.coalesce(F.col(c).cast("double"), F.lit(-1.0))
        cols[f"{c}__missing"] = F.col(c).isNull().cast("double")
    inputs = [f"{c}__v" for c in numeric] + [f"{c}__missing" for c in numeric]
    return VectorAssembler(inputCols=inputs, outputCol=NUMERIC_VECTOR).transform(df.withColumns(cols)).drop(*inputs)


def varying_slots(df: DataFrame) -> list:
    """Slots of the numeric vector that have more than one value in ``df``; none
    if all are constant or there are no rows. Trees cannot split on the others:
    mostly the 0/1 indicators of features that are never null there."""
    from pyspark.ml.stat import Summarizer
    seen = df.agg(Summarizer.metrics("min", "max").summary(F.col(NUMERIC_VECTOR)).alias("s")).select("s.min", "s.max").first()
    return [i for i, (low, high) in enumerate(zip(seen["min"], seen["max"], strict=True)) if low < high]


def gbt_pipeline(categorical: Sequence[str], max_iter: int = 150, step_size: float = 0.05, seed: int = 42,
                 max_depth: int = 5, label: str = "sales", slots: Sequence[int] | None = None):
    """Category codes, one feature vector, boosted trees. The errors so far are
    checkpointed every few trees, so that lineage stays short. A row's place in
    the growing tree is looked up in it: at a few levels this is cheaper than
    an RDD of places that every level writes anew, and gives the same trees.
    With ``slots`` the trees get only these of the numeric vector."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler, VectorSlicer
    from pyspark.ml.regression import GBTRegressor
    index = [category_index(categorical)] if categorical else []
    numbers = NUMERIC_VECTOR
    if slots:
        numbers = VARYING_VECTOR
        index.append(VectorSlicer(inputCol=NUMERIC_VECTOR, outputCol=VARYING_VECTOR, indices=list(slots)))
    vector = VectorAssembler(inputCols=[numbers, *[f"{c}__idx" for c in categorical]], outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, stepSize=step_size, seed=seed,
                         maxDepth=max_depth, maxBins=64, cacheNodeIds=False, checkpointInterval=10)
    return Pipeline(stages=[*index, vector, trees])


def train_model(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], **kw):
    """Fit category codes + vector + GBT on ``train``; returns a PipelineModel.
    Slots that are constant on ``train`` cost every level of every tree their
    share and are never split on, so the trees do not get them."""
    rows = assemble_numeric(train, numeric)
    return gbt_pipeline(categorical, slots=varying_slots(rows), **kw).fit(rows)


def predict(model, df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Score rows; predictions clipped at 0; helper columns dropped."""
    if model is None:
        raise ValueError("model is not fitted")
    scored = model.transform(assemble_numeric(df, numeric))
    helper = [c for c in scored.columns if c.endswith("__idx") or c in ("features", NUMERIC_VECTOR, VARYING_VECTOR)]
    return scored.withColumn("prediction", clip_non_negative(F.col("prediction"))).drop(*helper)


def training_losses(model, df: DataFrame, numeric: Sequence[str]) -> list:
    """Mean squared error on ``df`` after each tree; on the training rows it falls."""
    from pyspark.ml import PipelineModel
    trees = model.stages[-1]
    rows = PipelineModel(model.stages[:-1]).transform(assemble_numeric(df, numeric))
    return list(trees.evaluateEachIteration(rows.select("features", trees.getLabelCol()), "squared"))


def fit_tasks(df: DataFrame, fits: int) -> int:
    """Tasks for each of ``fits`` fits side by side on ``df``: together one for
    each core, more where a task would hold over ``FIT_TASK_ROWS`` rows. Each
    level of each tree is a job, so tasks beyond that cost more than they share."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, ceil(cores / max(1, fits)), ceil(df.count() / FIT_TASK_ROWS))


def score_folds(df: DataFrame, folds: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                parallel: int = 4, keep: Sequence[str] = ("store_id", "item_id", "date", "sales"),
                tasks: int | None = None, models: dict | None = None, **kw) -> DataFrame | None:
    """One fit per fold on its train dates, its test rows scored: ``fold``, the
    columns ``keep``, ``prediction``. None without folds.

    The numeric vectors are written once and read by every fold. The folds are
    independent, so up to ``parallel`` of them are fitted side by side, each
    from a thread of the driver in a scheduler pool of its own (pools share the
    cluster evenly where ``spark.scheduler.mode`` is FAIR); a fit is distributed
    and uses few tasks at a time, which leaves room for the others: as many as
    the vectors have partitions, at most ``tasks`` where given. Partitions are
    merged without a shuffle: the order of its rows, and so the trees, would
    differ from run to run. Every fold writes its scored rows to the shared
    folder; ``models`` receives the models by fold."""
    spark = df.sparkSession
    ids = sorted(r["fold"] for r in folds.select("fold").distinct().collect())
    if not ids:
        return None
    wanted = list(dict.fromkeys([*keep, "date", "sales", *categorical]))
    data = assemble_numeric(df, numeric).select(*wanted, NUMERIC_VECTOR)
    data = cut_lineage(data.coalesce(tasks) if tasks else data)
    folds = cut_lineage(folds)
    path = scratch_path(spark, "folds")

    def one(fold: int) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{fold}")
        dates = folds.filter(F.col("fold") == fold)
        train = date_semi_join(data, dates.filter(F.col("role") == "train"))
        test = date_semi_join(data, dates.filter(F.col("role") == "test"))
        model = train_model(train, numeric, categorical, **kw)
        if models is not None:
            models[fold] = model
        scored = predict(model, test, numeric)
        scored.select(*keep, "prediction").write.parquet(f"{path}/fold={fold}")

    with ThreadPoolExecutor(max(1, min(parallel, len(ids)))) as pool:
        for done in [pool.submit(one, f) for f in ids]:
            done.result()
    return spark.read.parquet(path).select(F.col("fold").cast("int").alias("fold"), *keep, "prediction")


def cross_validate(df: DataFrame, folds: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                   parallel: int = 4, tasks: int | None = None, models: dict | None = None, **kw) -> DataFrame:
    """Folds fitted side by side (``score_folds``), metrics by one aggregate over
    all scored rows -> (rmse, wmape, n_folds), null without folds."""
    scored = score_folds(df, folds, numeric, categorical, parallel, ("date", "sales"), tasks, models, **kw)
    if scored is None:
        none = F.avg(F.lit(None).cast("double"))
        return df.limit(0).agg(none.alias("rmse"), none.alias("wmape"), F.count(F.lit(1)).alias("n_folds"))
    return cv_average(scored_metrics(scored))


def scored_metrics(scored: DataFrame, y: str = "sales", p: str = "prediction") -> DataFrame:
    """Per fold of scored rows: rmse, wmape, n_test; predictions clipped at 0."""
    err = F.col(y) - clip_non_negative(F.col(p))
    return scored.groupBy("fold").agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.when(F.sum(y) > 0, safe_div(F.sum(F.abs(err)), F.sum(y))).otherwise(F.lit(0.0)).alias("wmape"),
        F.count(F.lit(1)).alias("n_test"))
