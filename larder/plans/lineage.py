"""Cutting lineage in a way that survives executor loss.

A reliable ``checkpoint()`` writes to the shared folder named by
``spark.checkpoint.dir``; ``localCheckpoint`` keeps blocks on executors and is
never used here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from larder.plans.session import ensure_checkpoint_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the checkpoint folder and return the re-read frame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
