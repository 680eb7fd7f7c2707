"""Aggregation helpers: dict-form aggregates, pivots, sorted lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FUNCS = {
    "avg": F.avg, "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max,
    "count": F.count, "stddev": F.stddev_samp, "first": F.first, "last": F.last,
}


def agg_dict(df: DataFrame, group: Sequence[str], spec: Mapping[str, str],
             rename: Mapping[str, str] | None = None) -> DataFrame:
    """``groupBy(group).agg({col: fn})`` with stable output names
    ``fn(col)`` (as Spark names them) or the names in ``rename``."""
    rename = rename or {}
    exprs = []
    for column, fn in spec.items():
        name = f"{fn}({column})"
        exprs.append(_FUNCS[fn](F.col(column)).alias(rename.get(name, name)))
    return df.groupBy(*group).agg(*exprs)


def pivot_count(df: DataFrame, group: Sequence[str] | str, pivot_col: str,
                values: Sequence | None = None) -> DataFrame:
    """Rows per (group, pivot value) as columns.  With ``values`` absent
    combinations are null; without them Spark runs an extra job to find the
    distinct values.  ``count(lit(1))`` because ``count("*")`` is rejected
    inside a pivot on Spark 4."""
    group = [group] if isinstance(group, str) else list(group)
    g = df.groupBy(*group)
    p = g.pivot(pivot_col, list(values)) if values is not None else g.pivot(pivot_col)
    return p.agg(F.count(F.lit(1)))


def sorted_list(df: DataFrame, group: Sequence[str] | str, value: str,
                alias: str | None = None) -> DataFrame:
    """``array_sort(collect_list(value))`` per group, built from counts.

    Values are first counted per (group, value) with map-side partial
    aggregation; the per-group buffer then holds one (value, count) pair per
    distinct value instead of one entry per row, and the list is expanded
    only in the output.  Nulls are skipped, as by ``collect_list``.
    """
    group = [group] if isinstance(group, str) else list(group)
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n")))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_n").alias("n"))))
    expanded = F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["v"], p["n"].cast("int"))))
    return counts.groupBy(*group).agg(expanded.alias(alias or value))
