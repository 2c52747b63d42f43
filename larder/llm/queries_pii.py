"""Registered query of the personal-data finder."""

from __future__ import annotations

from larder.llm.pii import find_pii
from larder.sources.tables import read_table


def op4_pii(spark, sf_dir):
    return find_pii(read_table(spark, sf_dir, "documents"))


QUERIES = {"op4_pii": op4_pii}
ORACLES: dict = {}
