"""Registered query of the compression-band rules."""

from __future__ import annotations

from larder.llm.quality import compression_bands
from larder.sources.tables import read_table


def op1_compression_bands(spark, sf_dir):
    return compression_bands(read_table(spark, sf_dir, "documents"))


QUERIES = {"op1_compression_bands": op1_compression_bands}
ORACLES: dict = {}
