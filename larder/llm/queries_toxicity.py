"""Registered query of the toxicity chain."""

from __future__ import annotations

from larder.llm.toxicity import toxicity
from larder.sources.tables import read_table


def op8_toxicity(spark, sf_dir):
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLES: dict = {}
