"""Loading and preparation: wide CSV -> long, joins, price fill, filters."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from larder.operators import prepare as pr
from larder.sources import files
from tests import fixtures as fx


@pytest.fixture(scope="module")
def paths(tmp_root):
    return fx.write_csvs(tmp_root + "/csv")


@pytest.fixture(scope="module")
def long(spark, paths):
    wide = files.read_sales_wide(spark, paths["sales"])
    cal = files.read_calendar(spark, paths["calendar"])
    prices = files.read_prices(spark, paths["prices"])
    return pr.prepare_long(pr.melt_sales(wide), cal, prices, ffill_limit=7).cache()


def test_wide_schema_from_header(spark, paths):
    wide = files.read_sales_wide(spark, paths["sales"])
    types = dict(wide.dtypes)
    assert types["d_1"] == "int" and types["d_60"] == "int" and types["store_id"] == "string"


def test_rows_are_stores_x_items_x_days(long):
    assert long.count() == len(fx.STORES) * len(fx.ITEMS) * fx.N_DAYS


def test_key_unique(long):
    assert long.groupBy("store_id", "item_id", "date").count().filter("count > 1").count() == 0


def test_price_null_rate_below_half(long):
    rate = long.agg(F.avg(F.col("sell_price").isNull().cast("double"))).first()[0]
    assert rate < 0.5


def test_all_empty_event_column_is_typed(spark, paths):
    cal = files.read_calendar(spark, paths["calendar"])
    assert dict(cal.dtypes)["event_name_2"] == "string"
    assert cal.filter(F.col("event_name_2").isNotNull()).count() == 0


def test_store_filter(spark, long):
    only = pr.filter_stores_items(long, stores=["CA_7"])
    assert only.select("store_id").distinct().collect()[0][0] == "CA_7"
    assert only.count() == len(fx.ITEMS) * fx.N_DAYS
    assert pr.filter_stores_items(long, stores=[], items=None).count() == long.count()


def test_melt_skips_missing_ids(spark):
    wide = spark.createDataFrame([("A", "S", 1, 2)], "item_id string, store_id string, d_1 int, d_2 int")
    out = pr.melt_sales(wide).orderBy("d").collect()
    assert [(r.item_id, r.store_id, r.d, r.sales) for r in out] == [("A", "S", "d_1", 1.0), ("A", "S", "d_2", 2.0)]


def test_ffill_matches_pandas_limit(spark):
    vals = [1.0, None, None, None, 5.0, None, None, None, None, None, None, None, None, None, 9.0]
    pdf = pd.DataFrame({"store_id": "S", "item_id": "I",
                        "date": pd.date_range("2016-01-01", periods=len(vals)).date, "sell_price": vals})
    rows = [("S", "I", d, v) for d, v in zip(pdf["date"], vals)]  # tuples keep None as NULL
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, sell_price double")
    got = [r.sell_price for r in pr.ffill_prices(df, limit=7).orderBy("date").collect()]
    want = pdf["sell_price"].ffill(limit=7).tolist()
    assert [None if pd.isna(w) else w for w in want] == got


def test_filter_reaches_scan(spark, tmp_root):
    """A store filter written after the windows is pushed into the Parquet scan."""
    path = tmp_root + "/pushdown"
    spark.createDataFrame([("S1", "I", "2016-01-01", 1.0), ("S2", "I", "2016-01-01", 2.0)],
                          "store_id string, item_id string, date string, sell_price double") \
        .withColumn("date", F.to_date("date")).write.mode("overwrite").parquet(path)
    df = pr.filter_stores_items(pr.ffill_prices(spark.read.parquet(path)), stores=["S1"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: ["):].split("]", 1)[0]
    assert "EqualTo(store_id,S1)" in pushed or "In(store_id, [S1]" in pushed


def test_csv_columns_by_name(spark, tmp_root):
    """Reordered and extra columns change nothing; a missing one is an error."""
    import pytest

    def write(name, text):
        path = f"{tmp_root}/{name}.csv"
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        return path

    from larder.sources import files
    p = files.read_prices(spark, write("p", 'sell_price,"item_id",extra,store_id,wm_yr_wk\n1.5,A,x,S,202101\n')).first()
    assert (p.store_id, p.item_id, p.wm_yr_wk, p.sell_price) == ("S", "A", 202101, 1.5)
    c = files.read_calendar(spark, write("c", "d,note,date,wm_yr_wk,event_name_1\nd_1,x,2021-03-03,202109,\n"))
    assert c.columns == ["date", "wm_yr_wk", "d", "event_name_1"] and str(c.first().date) == "2021-03-03"
    w = files.read_sales_wide(spark, write("w", "d_2,store_id,item_id,d_1,note\n5,S,A,3,x\n"))
    assert w.columns == ["item_id", "store_id", "d_1", "d_2"] and (w.first().d_1, w.first().d_2) == (3, 5)
    with pytest.raises(ValueError):
        files.read_prices(spark, write("m", "store_id,item_id\nS,A\n"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_prices(spark, f"{tmp_root}/absent.csv")
