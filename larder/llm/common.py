"""Helpers shared by the operators: picking columns, scratch tables, joins that
spread hot keys and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.files import scratch_path

WORD_REGEX = r"[^\x20\x09-\x0D]+"
SPACE_REGEX = r"[\x20\x09-\x0D]+"


def positional(df: DataFrame):
    """``df`` with its columns renamed by position (``c0, c1, ...``), a function
    from a column's name to its new name, and one that undoes the renaming.
    Extra columns, also such that differ only in case, cannot clash this way."""
    names = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])

    def at(name: str) -> str:
        i = names.index(name) if name in names else [n.lower() for n in names].index(name.lower())
        return f"c{i}"

    def restore(d: DataFrame) -> DataFrame:
        return d.select(*[F.col(f"c{i}") for i in range(len(names))]).toDF(*names)

    return flat, at, restore


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Select ``alias=column`` by exact name (see ``positional``)."""
    flat, at, _ = positional(df)
    return flat.select(*[F.col(at(src)).alias(alias) for alias, src in wanted.items()])


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage ends here, the files outlive executors, and readers prune
    columns."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` (any number per key, on the left) with ``table`` (one row
    per key). A plain equi-join on purpose: adaptive execution broadcasts
    ``table`` after measuring it small, and otherwise splits the rows of a hot
    key over tasks, each of which reads the key's one row. Nothing that needs a
    key's rows together may follow without another shuffle."""
    return rows.join(table, key, how)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges (a, b)`` of long ids,
    already written: ``(node, comp)`` with ``comp`` the smallest id reachable.

    Every round a node takes the smallest of its own label, its neighbours'
    labels and its label's label (pointer jumping). Labels are written to the
    shared folder each round; hubs are aggregated per task before a shuffle and
    looked up by joins that adaptive execution splits."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).filter("node <> other")
    labels = materialise(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("comp"))
                         .withColumn("moved", F.lit(True)), "labels")
    for _ in range(max_rounds):
        named = labels.select("node", "comp")
        near = spread_join(both, named.select(F.col("node").alias("other"), "comp"), "other")
        up = spread_join(named, named.select(F.col("node").alias("comp"), F.col("comp").alias("up")), "comp")
        best = near.select("node", "comp").union(up.select("node", F.col("up").alias("comp")))
        best = best.groupBy("node").agg(F.min("comp").alias("best"))
        labels = materialise(named.join(best, "node").select(
            "node", F.least("comp", "best").alias("comp"), (F.col("best") < F.col("comp")).alias("moved")), "labels")
        if not labels.filter("moved").limit(1).count():
            return labels.select("node", "comp")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
