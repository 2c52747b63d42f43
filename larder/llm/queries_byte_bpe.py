"""Registered query of the byte-level BPE encoder and decoder."""

from __future__ import annotations

from larder.llm.byte_bpe import digests
from larder.sources.tables import read_table


def op11_byte_bpe(spark, sf_dir):
    return digests(read_table(spark, sf_dir, "documents"))


QUERIES = {"op11_byte_bpe": op11_byte_bpe}
ORACLES: dict = {}
