"""File sources and sinks: M5-shaped CSVs, the feature Parquet and model
persistence. Paths may be local or any Hadoop file system URI."""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.plans.session import ensure_checkpoint_dir

SALES_ID_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]

CALENDAR_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("weekday", T.StringType()),
    T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("d", T.StringType()),
    T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()),
    T.StructField("event_name_2", T.StringType()),
    T.StructField("event_type_2", T.StringType()),
    T.StructField("snap_CA", T.IntegerType()),
    T.StructField("snap_TX", T.IntegerType()),
    T.StructField("snap_WI", T.IntegerType()),
])

PRICES_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("sell_price", T.DoubleType()),
])


def _first_line(spark: SparkSession, uri: str) -> str | None:
    """The first line of a text file that is not blank; None for an empty file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = file.getFileSystem(conf).open(file)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip("\ufeff \t\r"):
            line = reader.readLine()
        return line
    finally:
        stream.close()


def _names(header: str, uri: str) -> tuple:
    names = tuple(n.strip().lstrip("\ufeff") for n in next(csv.reader([header])))
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"{uri} has a column name twice")
    return names


def _as_path(uri: str) -> str:
    """A listed file's URI as a path for a reader, which takes it for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def csv_groups(spark: SparkSession, path: str | Sequence[str], threads: int = 32) -> list:
    """``(column names, files)`` of the CSV files of a path (a file, a folder or
    several of these), one entry per distinct header. Spark lists the files, and
    a path that does not exist is its error, before any job runs. The driver reads
    one line a file, some at a time, and keeps the distinct ones; files without
    a line are left out."""
    uris = spark.read.text([path] if isinstance(path, str) else list(path)).inputFiles()
    groups: dict = {}
    with ThreadPoolExecutor(max(1, min(threads, len(uris)))) as pool:
        for uri, line in zip(uris, pool.map(lambda u: _first_line(spark, u), uris), strict=True):
            if line is not None:
                groups.setdefault(_names(line, uri), []).append(_as_path(uri))
    if not groups:
        raise ValueError(f"{path} holds no CSV file with a header")
    return list(groups.items())


def _read_group(spark: SparkSession, names: Sequence[str], files: Sequence[str], types: Mapping[str, T.DataType]) -> tuple:
    """The files of one header with typed columns, ``_line`` (a row's line, where
    it is bad) and ``_file``; and a condition that is true for every row and
    names every column. Spark's parser judges the columns that a query needs,
    so only with that condition a row is judged alike whatever is selected.
    Every task checks its file's header."""
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names] + [T.StructField("_line", T.StringType())])
    rows = spark.read.csv(list(files), header=True, schema=schema, dateFormat="yyyy-MM-dd", mode="PERMISSIVE",
                          enforceSchema=False, columnNameOfCorruptRecord="_line")
    whole = F.length(F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))) >= 0
    return rows.select("*", F.col("_metadata.file_path").alias("_file")), whole


def read_named(spark: SparkSession, path: str | Sequence[str], types: Mapping[str, T.DataType], needed: Sequence[str] = (),
               bad_rows: str = "error") -> DataFrame:
    """CSV files as one table, every column found by its name in its own file's
    header: files may order their columns differently, and a column that a file
    lacks is null there. ``types`` are the columns to read (those that no file
    has are left out); each file must have the ``needed`` ones.

    A row is bad when it has more or fewer cells than its file's header, or a
    cell that is neither empty nor of its column's type. ``bad_rows="error"``
    ends the job at the first one, ``"drop"`` leaves them out (``csv_rejects``
    returns these)."""
    if bad_rows not in ("error", "drop"):
        raise ValueError("bad_rows is 'error' or 'drop'")
    out = None
    for names, files in csv_groups(spark, path):
        missing = [c for c in needed if c not in names]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        rows, whole = _read_group(spark, names, files, types)
        told = F.raise_error(F.concat(F.lit("malformed row in "), F.col("_file"), F.lit(": "), F.col("_line"))).cast("boolean")
        rows = rows.filter(F.when(F.col("_line").isNull(), True).otherwise(~whole if bad_rows == "drop" else F.when(whole, told)))
        rows = rows.select(*[F.col(f"`{n}`") for n in types if n in names])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select(*[F.col(f"`{n}`") for n in types if n in out.columns])


def csv_rejects(spark: SparkSession, path: str | Sequence[str], types: Mapping[str, T.DataType]) -> DataFrame:
    """``file, record`` of the rows that ``read_named`` calls bad, as they stand in the file."""
    out = None
    for names, files in csv_groups(spark, path):
        rows, whole = _read_group(spark, names, files, types)
        bad = rows.filter(F.when(F.col("_line").isNotNull(), whole).otherwise(False))
        bad = bad.select(F.col("_file").alias("file"), F.col("_line").alias("record"))
        out = bad if out is None else out.union(bad)
    return out


def _by_name(schema: T.StructType) -> dict:
    return {f.name: f.dataType for f in schema.fields}


def sales_types(spark: SparkSession, path: str | Sequence[str]) -> dict:
    """Types of the wide sales columns that any of the files has: id columns as
    text, then every ``d_*`` column as an integer, by day."""
    names = {n for group, _ in csv_groups(spark, path) for n in group}
    days = sorted((c for c in names if c.startswith("d_")), key=lambda c: (len(c), c))
    return {**{c: T.StringType() for c in SALES_ID_COLUMNS if c in names}, **{c: T.IntegerType() for c in days}}


def read_sales_wide(spark: SparkSession, path: str | Sequence[str], bad_rows: str = "error") -> DataFrame:
    """Wide sales CSV files: the id columns as strings and every ``d_*`` column
    as an integer, by name and in any order; other columns are left out."""
    return read_named(spark, path, sales_types(spark, path), bad_rows=bad_rows)


def read_calendar(spark: SparkSession, path: str | Sequence[str], bad_rows: str = "error") -> DataFrame:
    """Calendar CSV files by column name; columns that the calendar does not
    know are ignored, absent optional ones are left out."""
    return read_named(spark, path, _by_name(CALENDAR_SCHEMA), ("date", "wm_yr_wk", "d"), bad_rows)


def read_prices(spark: SparkSession, path: str | Sequence[str], bad_rows: str = "error") -> DataFrame:
    """Weekly prices CSV files by column name; other columns are ignored."""
    return read_named(spark, path, _by_name(PRICES_SCHEMA), [f.name for f in PRICES_SCHEMA.fields], bad_rows)


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] = ("store_id",), replace: str = "all") -> None:
    """Feature matrix to Parquet, partitioned by store (partition pruning for
    store filters on the read side). ``replace="all"`` puts ``df`` in place of
    what is there; ``"partitions"`` replaces the stores that ``df`` has and
    leaves every other store's files alone. Both commit when the job has ended."""
    if replace not in ("all", "partitions"):
        raise ValueError("replace is 'all' or 'partitions'")
    kind = "static" if replace == "all" else "dynamic"
    df.write.mode("overwrite").option("partitionOverwriteMode", kind).partitionBy(*partition_by).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def read_features(spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Written features; with the ``schema`` they were written with, a folder
    without any row can be read too, and store names that look like numbers stay text."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.select(*columns) if columns else df


def save_model(model, path: str) -> None:
    """Persist a fitted PipelineModel (Spark ML format, any file system)."""
    if model is None:
        raise ValueError("model is not fitted")
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
