"""CSV folders: files with their own column order, malformed rows, missing files."""

import gzip
import os

import pytest
from pyspark.sql import types as T

from larder.plans import jobs
from larder.sources import files as fs
from tests import fixtures as fx


def _folder(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / name.replace("__", ".")).write_text(text)
    return str(tmp_path)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_files_with_other_column_orders(spark, tmp_path):
    path = _folder(tmp_path, a__csv="store_id,item_id,wm_yr_wk,sell_price\nS1,I1,202101,2.5\n",
                   b__csv="item_id,note,store_id,sell_price,wm_yr_wk\nI2,\"x, y\",S2,3,202102\n",
                   c__csv="store_id,item_id,wm_yr_wk,sell_price\nS3,I3,202103,\n", empty__csv="", _SUCCESS="no data")
    with gzip.open(tmp_path / "d e[1].csv.gz", "wt") as f:
        f.write("﻿wm_yr_wk,sell_price,store_id,item_id\n202104,4.5,S4,I4\n")
    got = fs.read_prices(spark, path)
    assert got.dtypes == [("store_id", "string"), ("item_id", "string"), ("wm_yr_wk", "int"), ("sell_price", "double")]
    want = [("S1", "I1", 202101, 2.5), ("S2", "I2", 202102, 3.0), ("S3", "I3", 202103, None), ("S4", "I4", 202104, 4.5)]
    assert _rows(got) == want
    assert _rows(fs.read_prices(spark, [f"{path}/a.csv", f"{path}/b.csv"])) == want[:2]
    assert len(fs.csv_groups(spark, path)) == 3  # headers, not files


BAD = "store_id,item_id,wm_yr_wk,sell_price\nS1,I1,202101,2.5\nS1,I2,20x6,1\nS2,I1,202102\nS2,I2,202102,1,9\nS3,I3,,\nS4,I4,202103,abc\n"


def test_bad_rows_end_the_job_or_are_told(spark, tmp_path):
    path = _folder(tmp_path, a__csv=BAD)
    kept = fs.read_prices(spark, path, bad_rows="drop")
    assert _rows(kept) == [("S1", "I1", 202101, 2.5), ("S3", "I3", None, None)]
    assert kept.select("store_id").count() == 2  # whatever is selected
    rejects = fs.csv_rejects(spark, path, {f.name: f.dataType for f in fs.PRICES_SCHEMA.fields}).collect()
    assert sorted(r.record for r in rejects) == ["S1,I2,20x6,1", "S2,I1,202102", "S2,I2,202102,1,9", "S4,I4,202103,abc"]
    assert all(r.file.endswith("a.csv") for r in rejects)
    for pruned in (fs.read_prices(spark, path), fs.read_prices(spark, path).select("store_id")):
        with pytest.raises(Exception, match="malformed row in .*a.csv"):
            pruned.collect()
    with pytest.raises(ValueError, match="bad_rows"):
        fs.read_prices(spark, path, bad_rows="keep")


def test_headers_that_do_not_do(spark, tmp_path):
    _folder(tmp_path, a__csv="store_id,item_id,wm_yr_wk\nS,I,1\n", b__csv="d,D\n1,2\n", c__csv="")
    with pytest.raises(ValueError, match="no column sell_price"):
        fs.read_prices(spark, str(tmp_path / "a.csv"))
    with pytest.raises(ValueError, match="twice"):
        fs.read_calendar(spark, str(tmp_path / "b.csv"))
    with pytest.raises(ValueError, match="no CSV file"):
        fs.read_prices(spark, str(tmp_path / "c.csv"))


def test_sales_files_of_different_spans(spark, tmp_path):
    path = _folder(tmp_path, a__csv="item_id,store_id,d_2,d_1\nI1,S1,2,1\n", b__csv="store_id,item_id,d_1,d_10\nS2,I2,7,8\n")
    got = fs.read_sales_wide(spark, path)
    assert got.columns == ["item_id", "store_id", "d_1", "d_2", "d_10"] and dict(got.dtypes)["d_10"] == "int"
    assert _rows(got.fillna(-1)) == [("I1", "S1", 1, 2, -1), ("I2", "S2", 7, -1, 8)]


def test_calendar_dates_are_dates(spark, tmp_path):
    path = _folder(tmp_path, a__csv="d,date,wm_yr_wk,extra\nd_1,2021-03-03,202109,q\nd_2,03/04/2021,202109,q\n")
    kept = fs.read_calendar(spark, path, bad_rows="drop")
    assert kept.schema["date"].dataType == T.DateType() and [r.d for r in kept.collect()] == ["d_1"]


def test_missing_files_are_told_before_any_job(spark, tmp_path):
    paths = fx.write_csvs(os.path.join(tmp_path, "csv"))
    sc = spark.sparkContext
    for name in ("sales", "calendar", "prices"):
        given = {**paths, name: paths[name] + ".none"}
        sc.setJobGroup(f"missing-{name}", "no job may run")
        try:
            with pytest.raises(Exception, match="PATH_NOT_FOUND"):
                jobs.feature_job(spark, given["sales"], given["calendar"], given["prices"], str(tmp_path / "out"))
            assert list(sc.statusTracker().getJobIdsForGroup(f"missing-{name}")) == []
        finally:
            sc.setJobGroup(None, None)
    assert not (tmp_path / "out").exists()
