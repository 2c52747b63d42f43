"""Registered query of the BPE encoder and decoder."""

from __future__ import annotations

from larder.llm.bpe import digests
from larder.sources.tables import read_table


def op5_bpe(spark, sf_dir):
    return digests(read_table(spark, sf_dir, "documents"))


QUERIES = {"op5_bpe": op5_bpe}
ORACLES: dict = {}
