"""Feature job end to end from CSV files, and the training job."""

import os

from pyspark.sql import functions as F

from larder.plans import jobs
from tests import fixtures as fx


def test_feature_and_training_jobs(spark, tmp_root):
    paths = fx.write_csvs(os.path.join(tmp_root, "job-csv"))
    out = os.path.join(tmp_root, "features")
    params = jobs.Params(min_group_rows=1)
    feats = jobs.feature_job(spark, paths["sales"], paths["calendar"], paths["prices"], out, params)
    assert feats.count() == len(fx.STORES) * len(fx.ITEMS) * fx.N_DAYS
    for c in ("lag_7", "rolling_mean_28", "rolling_std_7", "price_rel_mean", "snap_active", "event_type_encoded"):
        assert c in feats.columns
    # lag_7 is the same series' sales 7 rows back
    row = feats.filter((F.col("store_id") == "CA_7") & (F.col("item_id") == fx.ITEMS[0])) \
        .orderBy("date").collect()
    assert row[10].lag_7 == row[3].sales
    params = jobs.Params(min_group_rows=1, n_estimators=3, cv_splits=2, forecast_horizon=5)
    res = jobs.training_job(spark, out, os.path.join(tmp_root, "model"), params)
    assert res["n_folds"] == 2 and res["rmse"] is not None


def test_store_filter_in_job(spark, tmp_root):
    paths = fx.write_csvs(os.path.join(tmp_root, "job-csv2"))
    out = os.path.join(tmp_root, "features-ca")
    params = jobs.Params(min_group_rows=1, stores_filter=["CA_7"])
    feats = jobs.feature_job(spark, paths["sales"], paths["calendar"], paths["prices"], out, params)
    assert [r[0] for r in feats.select("store_id").distinct().collect()] == ["CA_7"]
