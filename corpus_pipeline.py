"""A corpus pipeline: rules, near-duplicates, personal data, mixing, encoding.

Every stage reads what the one before wrote. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from larder.llm.bpe import default_params, digests
from larder.llm.common import materialise
from larder.llm.minhash import MinMaxParams, keep_one
from larder.llm.mixing import MixParams, mix
from larder.llm.pii import redact
from larder.llm.quality import keep_good
from larder.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and base rules keep."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five words, similarity 0.8."""
    return keep_one(docs, MinMaxParams(shingle=5, percent=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by placeholders."""
    return redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the domains' tokens meet smoothed targets;
    every document stays at least once."""
    return mix(docs, read_table(spark, sf_dir, "labels"), MixParams(min_rate=1.0))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts. Blocks are
    smaller than by default: the workers have run other stages before."""
    return digests(docs, replace(default_params(), block_bytes=4 << 20))


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_dedup), ("personal data", personal_data),
          ("source mixing", source_mixing), ("BPE encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# Compression ratios, a fitted model and the tokenizer have no SQL form.
ORACLE_SQL = None
