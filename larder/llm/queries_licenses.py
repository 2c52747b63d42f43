"""Registered query of the licence scan."""

from __future__ import annotations

from larder.llm.licenses import scan_licenses
from larder.sources.tables import read_table


def op9_licenses(spark, sf_dir):
    return scan_licenses(read_table(spark, sf_dir, "documents"))


QUERIES = {"op9_licenses": op9_licenses}
ORACLES: dict = {}
