"""Registered query of soft-membership mixing."""

from __future__ import annotations

from larder.llm.mixing import mixing_rates
from larder.sources.tables import read_table


def op3_mixing(spark, sf_dir):
    return mixing_rates(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {"op3_mixing": op3_mixing}
ORACLES: dict = {}
