"""Profiling: ``describe`` as typed doubles from one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATS = ("count", "mean", "stddev", "min", "max")


def describe(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column.

    One pass (a single global aggregate with partial aggregation), then the
    one result row is unpivoted to one row per statistic with a double
    column per input column (``DataFrame.describe`` returns strings).
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"count__{c}"),
                 F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"stddev__{c}"),
                 F.min(x).alias(f"min__{c}"),
                 F.max(x).alias(f"max__{c}")]
    one = df.agg(*aggs)
    if digits is not None:
        one = one.select(*[F.round(F.col(n), digits).alias(n) for n in one.columns])
    rows = F.explode(F.array(*[
        F.struct(F.lit(s).alias("summary"),
                 *[F.col(f"{s}__{c}").alias(c) for c in columns])
        for s in STATS]))
    return one.select(rows.alias("r")).select("r.*")
