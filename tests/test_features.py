"""Feature operators against pandas reference computations."""

import numpy as np
import pandas as pd
import pytest

from larder.operators import features as fe


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(3)
    rows = []
    for store, state in (("CA_1", "CA"), ("TX_1", "TX"), ("WI_1", "WI")):
        for item in ("A", "B"):
            for i, d in enumerate(pd.date_range("2016-01-01", periods=45)):
                rows.append((store, state, item, d.date(), float(rng.integers(0, 30)),
                             None if i % 5 == 3 else float(round(rng.uniform(1, 5), 2)),
                             "Sporting" if i == 10 else ("Other" if i == 11 else None),
                             "Ev" if i in (10, 11) else None, None, int(i % 3 == 0), int(i % 4 == 0), 0))
    pdf = pd.DataFrame(rows, columns=["store_id", "state_id", "item_id", "date", "sales", "sell_price",
                                      "event_type_1", "event_name_1", "event_name_2", "snap_CA", "snap_TX",
                                      "snap_WI"])
    schema = ("store_id string, state_id string, item_id string, date date, sales double, sell_price double, "
              "event_type_1 string, event_name_1 string, event_name_2 string, snap_CA int, snap_TX int, snap_WI int")
    return pdf, spark.createDataFrame(rows, schema)  # tuples keep None as NULL


def _sorted(df):
    return df.orderBy("store_id", "item_id", "date").toPandas()


def test_lag_is_same_series_rows_back(series):
    pdf, df = series
    got = _sorted(fe.lag_features(df, [7, 14, 28]))
    want = pdf.sort_values(["store_id", "item_id", "date"]).groupby(["store_id", "item_id"])["sales"].shift(7)
    assert np.allclose(got["lag_7"].astype(float), want.to_numpy(dtype=float), equal_nan=True)


def test_rolling_excludes_today(series):
    pdf, df = series
    got = _sorted(fe.rolling_std(fe.rolling_mean(df, [7, 28]), [7, 28]))
    p = pdf.sort_values(["store_id", "item_id", "date"])
    shifted = p.groupby(["store_id", "item_id"])["sales"].shift(1)
    key = p["store_id"] + "|" + p["item_id"]
    for n in (7, 28):
        m = shifted.groupby(key).transform(lambda s: s.rolling(n, min_periods=1).mean())
        sd = shifted.groupby(key).transform(lambda s: s.rolling(n, min_periods=1).std())
        assert np.allclose(got[f"rolling_mean_{n}"].astype(float), m.to_numpy(float), equal_nan=True)
        assert np.allclose(got[f"rolling_std_{n}"].astype(float), sd.to_numpy(float), equal_nan=True)


def test_calendar_and_weekend(series):
    _, df = series
    got = _sorted(fe.calendar_features(df))
    dates = pd.to_datetime(got["date"])
    assert (got["day_of_week"] == dates.dt.dayofweek).all()
    assert (got["is_weekend"] == (dates.dt.dayofweek >= 5).astype(int)).all()
    assert (got["week_of_year"] == dates.dt.isocalendar().week.astype(int)).all()
    assert got.loc[dates == "2016-01-01", "week_of_year"].iloc[0] == 53


def test_event_and_snap(series):
    _, df = series
    got = _sorted(fe.snap_features(fe.event_features(df)))
    assert set(got["has_event"]) <= {0, 1} and set(got["snap_active"]) <= {0, 1}
    assert (got.loc[got["event_type_1"] == "Sporting", "event_type_encoded"] == 4).all()
    assert (got.loc[got["event_type_1"] == "Other", "event_type_encoded"] == 0).all()
    assert (got.loc[got["event_name_1"].isna(), "has_event"] == 0).all()
    ca = got[got["state_id"] == "CA"]
    assert (ca["snap_active"] == ca["snap_CA"]).all()
    assert (got[got["state_id"] == "WI"]["snap_active"] == 0).all()


def test_snap_without_state(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert fe.snap_features(df).first()["snap_active"] == 0


def test_price_features(series):
    pdf, df = series
    got = _sorted(fe.log_price(fe.price_change_pct(fe.price_rel_mean(df))))
    p = pdf.sort_values(["store_id", "item_id", "date"]).reset_index(drop=True)
    rel = p["sell_price"] / p.groupby("item_id")["sell_price"].transform("mean")
    assert np.allclose(got["price_rel_mean"].astype(float), rel.to_numpy(float), equal_nan=True)
    prev = p.groupby(["store_id", "item_id"])["sell_price"].shift(7)
    pct = p["sell_price"] / prev - 1
    assert np.allclose(got["price_change_pct"].astype(float), pct.to_numpy(float), equal_nan=True)
    assert np.allclose(got["log_price"].astype(float), np.log1p(p["sell_price"].to_numpy(float)), equal_nan=True)


def test_price_features_skipped_without_price(spark):
    df = spark.createDataFrame([("S", "I", 1.0)], "store_id string, item_id string, sales double")
    assert fe.log_price(fe.price_rel_mean(df)).columns == df.columns


def test_drop_sparse_groups(spark):
    rows = [("S", "A", i, 1.0) for i in range(5)] + [("S", "B", i, None if i else 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date int, sales double")
    assert fe.drop_sparse_groups(df, 1).count() == 10
    kept = fe.drop_sparse_groups(df, 3).select("item_id").distinct().collect()
    assert [r.item_id for r in kept] == ["A"]


def test_series_windows_share_one_shuffle(series):
    """Lags, rolling frames and the group count plan on one Exchange."""
    _, df = series
    out = fe.drop_sparse_groups(fe.rolling_std(fe.rolling_mean(fe.lag_features(df))), 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(store_id") == 1


def test_quality_checks(series):
    _, df = series
    row = fe.quality_checks(fe.snap_features(fe.event_features(fe.calendar_features(df)))).first()
    assert row.duplicate_keys == 0 and row.negative_sales == 0 and row.bad_flags == 0
    assert 0 < row.price_null_rate < 0.5
