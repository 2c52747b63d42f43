"""Registered query of the embedding whitening."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.llm.whitening import whiten
from larder.sources.tables import read_table


def op13_whitening(spark, sf_dir):
    return whiten(read_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {"op13_whitening": op13_whitening}
ORACLES: dict = {}
