"""The driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one driver table (filters and projections are
    pushed into the scan by Catalyst)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPREAD = "spark.tessera.spread"


def fan_out(df: DataFrame) -> DataFrame:
    """Deal rows round robin to ``spark.tessera.spread`` partitions; unset or
    0, the default, changes nothing.

    A table of one file with one row group is read by one task.  Set this
    only for such tables (the bench does): tables of many splits need no
    shuffle before per-row work."""
    partitions = int(df.sparkSession.conf.get(SPREAD, "0"))
    return df.repartition(partitions) if partitions > 0 else df
