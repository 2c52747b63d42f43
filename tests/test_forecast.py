"""Forecast metrics, folds, GBT fit / predict / persistence, CV."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import forecast as fc
from larder.sources import files


@pytest.fixture(scope="module")
def feats(spark):
    rng = np.random.default_rng(0)
    rows = []
    for item in ("A", "B"):
        for i in range(30):
            rows.append((dt.date(2016, 1, 1) + dt.timedelta(days=i), "S", item, float(rng.integers(10, 50)),
                         float(rng.integers(10, 50)) if i >= 7 else None, float(rng.uniform(10, 50)),
                         int(i % 7 >= 5), "X" if i % 2 else "Y"))
    return spark.createDataFrame(rows, "date date, store_id string, item_id string, sales double, lag_7 double, "
                                       "rolling_mean_7 double, is_weekend int, event_type_encoded string")


def test_rmse(spark):
    df = spark.createDataFrame([(10.0, 10.0), (10.0, 12.0), (10.0, 10.0)], "y double, p double")
    assert fc.rmse(df, "y", "p").first()[0] == pytest.approx(1.1547, abs=1e-4)


def test_folds(feats):
    folds = fc.cv_folds(fc.distinct_dates(feats), n_splits=2, horizon=5)
    test = folds.filter("role = 'test'").groupBy("fold").agg(F.min("date"), F.count("*")).orderBy("fold").collect()
    assert [r[2] for r in test] == [5, 5]
    assert test[0][1] == dt.date(2016, 1, 21) and test[1][1] == dt.date(2016, 1, 26)
    train1 = folds.filter("fold = 1 AND role = 'train'").count()
    assert train1 == 20


def test_folds_skip_when_too_short(feats):
    assert fc.cv_folds(fc.distinct_dates(feats), n_splits=3, horizon=14).select("fold").distinct().count() == 2


def test_fit_predict_save_load(spark, feats, tmp_root):
    num, cat = ["lag_7", "rolling_mean_7", "is_weekend"], ["event_type_encoded"]
    model = fc.train_model(feats, num, cat, max_iter=5)
    pred = fc.predict(model, feats, num)
    rows = pred.select("prediction").collect()
    assert len(rows) == feats.count() and min(r[0] for r in rows) >= 0
    path = tmp_root + "/model"
    files.save_model(model, path)
    again = fc.predict(files.load_model(path), feats, num).select("prediction").collect()
    assert [r[0] for r in again] == [r[0] for r in rows]


def test_save_unfitted_raises():
    with pytest.raises(ValueError):
        files.save_model(None, "/nonexistent")


def test_cross_validate(feats):
    folds = fc.cv_folds(fc.distinct_dates(feats), n_splits=2, horizon=5)
    row = fc.cross_validate(feats, folds, ["lag_7", "rolling_mean_7"], ["event_type_encoded"], max_iter=3).first()
    assert row.n_folds == 2 and row.rmse is not None and row.wmape is not None


def test_moving_average_metrics(feats):
    folds = fc.cv_folds(fc.distinct_dates(feats), n_splits=2, horizon=5)
    scored = fc.moving_average_forecast(feats, 7)
    row = fc.cv_average(fc.fold_metrics(scored, folds)).first()
    assert row.n_folds == 2 and row.rmse > 0


def test_date_semi_join_and_wmape(spark, feats):
    dates = spark.createDataFrame([(dt.date(2016, 1, 2),), (dt.date(2016, 1, 2),), (dt.date(2016, 1, 5),)],
                                  "date date")
    got = fc.date_semi_join(feats, dates)
    assert got.count() == 4 and got.columns == feats.columns
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 14.0), (0.0, -3.0)], "y double, p double")
    assert fc.wmape(df, "y", "p").first()[0] == pytest.approx((2 + 4 + 0) / 20)
    zero = spark.createDataFrame([(0.0, 1.0)], "y double, p double")
    assert fc.wmape(zero, "y", "p").first()[0] == 0.0


def test_predict_without_a_model(spark):
    import pytest
    from larder.operators import forecast
    with pytest.raises(ValueError):
        forecast.predict(None, spark.range(1), [])
