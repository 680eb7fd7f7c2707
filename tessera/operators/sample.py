"""Sampling and splitting.

``sample`` / ``randomSplit`` depend on the partitioning and on the seed, so
a recomputed partition can change membership.  The hash variants decide
membership from the row's key alone: stable on retries, at any partitioning,
and reproducible in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import draw, threshold


def sample_by_hash(df: DataFrame, key: str, fraction: float, salt: int = 0) -> DataFrame:
    """Rows whose key hashes below ``fraction`` (Bernoulli-like, exact rule);
    rows with a null key are in no sample below 1."""
    if fraction >= 1:
        return df
    return df.where(draw(key, salt) < threshold(fraction))


def split_by_hash(df: DataFrame, key: str, weights: Sequence[float], salt: int = 0,
                  column: str | None = None):
    """Split by key hash into parts with the given weights.

    Returns a list of DataFrames, or one DataFrame with a ``column`` holding
    the part index when ``column`` is given.  Rows with a null key are in
    the last part.
    """
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        acc += w / total
        bounds.append(threshold(acc))
    b = draw(key, salt)
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        part = F.when(b < bounds[i], F.lit(i)).otherwise(part)
    if column:
        return df.withColumn(column, part)
    return [df.where(part == i) for i in range(len(weights))]


def sample_random(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Spark's Bernoulli sample (membership depends on partitioning)."""
    return df.sample(fraction=fraction, seed=seed)
