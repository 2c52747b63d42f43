"""Access to the driver's parquet tables (one file per table under ``sf_dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``; when ``columns`` are given the scan is
    pruned to them right away (the ReadSchema then lists only those)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
