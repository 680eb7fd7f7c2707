"""Cleaning: defined-survivor dedup and one-pass quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_digest(df: DataFrame) -> Column:
    """64-bit hash of a whole row; a null differs from every value and from a
    null in another column."""
    flags = [F.col(f.name).isNull() for f in df.schema.fields if f.nullable]
    return F.xxhash64(*[F.col(c) for c in df.columns], *flags)


def dedup_by_key(df: DataFrame, keys: Sequence[str],
                 order: Sequence[str] | None = None, ties: str = "columns") -> DataFrame:
    """Keep one row per key: the smallest by ``order`` (ascending, nulls
    first), then by ``ties``, so the survivor is defined:

    * ``"columns"``: every remaining column, so all of them are sorted and
      shuffled whatever the caller goes on to use;
    * ``"digest"``: a 64-bit hash of the whole row, taken before the shuffle.
      Only the key, ``order``, the digest and the columns that are used later
      travel.  Rows of a key that still tie are equal (different ones do with
      a chance of 2^-64);
    * ``"none"``: ``order`` is unique within a key, as the caller knows.

    Built as ``row_number() = 1``: Spark keeps the first row of every key in
    each task before the shuffle (``WindowGroupLimit``), so a key that holds a
    third of all rows reaches its task as one row per map task.  Measured
    against ``min(struct(...))`` (a sort aggregate on both sides of the
    shuffle): 1.6-2.1 s to 2.4-3.4 s for 600,000 order lines, local[8].
    """
    if ties not in ("columns", "digest", "none"):
        raise ValueError("ties must be columns, digest or none")
    keys = list(keys)
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order + rest:
        return df.dropDuplicates(keys)
    if ties == "none":
        rest = []
        if not order:
            raise ValueError("ties='none' needs an order")
    used = df.columns if ties == "digest" else order + rest
    maps = [c for c in used if isinstance(df.schema[c].dataType, T.MapType)]
    if maps:
        raise ValueError(f"columns without an order cannot pick the survivor: {maps}")
    rows = df
    if ties == "digest":
        rows, rest = df.withColumn("_digest", row_digest(df)), ["_digest"]
    first = Window.partitionBy(*keys).orderBy(*[F.asc(c) for c in order + rest])
    return rows.withColumn("_place", F.row_number().over(first)).where("_place = 1").select(*df.columns)


def quality_report(entity: str, df: DataFrame, keep: Column, key: str) -> DataFrame:
    """Rows before, after ``filter(keep)`` + dedup on ``key``, and removed,
    from one aggregate over the input (no separate ``count()`` jobs)."""
    kept_key = F.when(keep, F.col(key))
    # Null keys form one group in the dedup, so they add one survivor.
    null_group = F.coalesce(F.max(F.when(keep & F.col(key).isNull(), 1).otherwise(0)), F.lit(0))
    return df.agg(
        F.lit(entity).alias("entity"),
        F.count(F.lit(1)).alias("initial_count"),
        F.count_if(keep).alias("after_filter"),
        (F.count_distinct(kept_key) + null_group).alias("final_count"),
    ).withColumn("removed", F.col("initial_count") - F.col("final_count"))
