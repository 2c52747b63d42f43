"""Registered query of the alignment of two tokenizers."""

from __future__ import annotations

from larder.llm.alignment import alignment
from larder.sources.tables import read_table


def op12_alignment(spark, sf_dir):
    return alignment(read_table(spark, sf_dir, "documents"))


QUERIES = {"op12_alignment": op12_alignment}
ORACLES: dict = {}
