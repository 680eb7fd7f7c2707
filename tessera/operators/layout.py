"""Physical layout: persistence around shared inputs, repartitioning."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def persisted(*dfs: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist DataFrames that feed several outputs for the duration of a
    block, then release them.  MEMORY_AND_DISK spills instead of
    recomputing when executors run short of memory."""
    for df in dfs:
        df.persist(level)
    try:
        yield dfs
    finally:
        for df in dfs:
            df.unpersist()
