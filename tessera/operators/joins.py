"""Joins with an explicit broadcast policy.

Spark broadcasts a join side by itself only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime with the
real shuffle sizes and falls back to sort-merge otherwise).  A broadcast
*hint* skips that check, so it is only given for sides whose size is bounded
by definition (for example the 25 nations).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
                how: str = "left", columns: Sequence[str] | None = None,
                bounded_rows: int | None = None) -> DataFrame:
    """Fact-to-dimension lookup keeping every fact row (``how='left'``);
    unmatched facts get null attributes.

    ``columns`` prunes the dimension before the join.  With ``bounded_rows``
    the dimension is broadcast by hint if it really has no more rows (at most
    ``bounded_rows`` + 1 rows are counted).  Otherwise AQE decides from
    runtime sizes and splits skewed keys of a sort-merge join.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if columns is not None:
        dim = dim.select(*keys, *[c for c in columns if c not in keys])
    if bounded_rows is not None and dim.limit(bounded_rows + 1).count() <= bounded_rows:
        dim = F.broadcast(dim)
    return fact.join(dim, keys, how)


def serial(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of each partition in the order of their hash: equal rows
    get different numbers, and a task that is run again gives the same set of
    (row, number) whatever order its input comes in."""
    by_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.sortWithinPartitions(by_hash).withColumn(name, F.monotonically_increasing_id())


DEFAULT_HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000
SALTS_PER_HOT = 2      # salts for every hot_rows rows of a hot key


def _hot_keys(df: DataFrame, key: str, hot_rows: int, salts: str) -> DataFrame:
    """(_hot_key, salts) of the keys with more than ``hot_rows`` rows, and more
    than one MAX_HOT_KEYS-th of all rows: fewer than MAX_HOT_KEYS."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = df.select((F.count(F.lit(1)) / F.lit(float(MAX_HOT_KEYS))).alias("s")).scalar()
    return (counts.where((F.col("_n") > hot_rows) & (F.col("_n") > share))
            .select(F.col(key).alias("_hot_key"),
                    F.ceil(F.col("_n") * SALTS_PER_HOT / F.lit(hot_rows)).cast("long").alias(salts)))


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", *,
              hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Equi-join on ``key`` (one output key column, like ``join(on=key)``)
    that splits hot keys of both sides, for every join type including ``full``
    (AQE's skew splitting covers inner / semi / anti / one-sided outer joins
    only, and one side of those).

    A key is hot on a side that holds more than ``hot_rows`` rows of it, and
    more than one MAX_HOT_KEYS-th of its rows, so the list of hot keys has
    fewer than 2 MAX_HOT_KEYS rows and is broadcast with that bound.  The
    result is the union of

    * the plain join of the keys that are hot on neither side (not sorted,
      numbered or salted);
    * the salted join of the hot keys: a key with a salts on the left and b on
      the right is a grid of a x b cells; a left row is dealt to one of the a
      rows and copied to its b cells, a right row to one of the b columns and
      its a cells, so that every pair meets in one cell.  Equal rows are dealt
      by a serial number.  A row that found no partner in a cell, though the
      other side is hot and so has rows of the key, is a copy's miss and goes;
    * for outer joins the rows with a null key, which match nothing: they are
      neither shuffled nor joined, however many there are.

    Without hot keys the second part is empty at run time.  Each side is read
    for the counts (key only), the two joins, and (outer) the null keys.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be inner, left, right or full")
    clash = [c for c in left.columns if c != key and c in right.columns]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    marks = F.broadcast(_hot_keys(left, key, hot_rows, "_salts_l")
                        .join(_hot_keys(right, key, hot_rows, "_salts_r"), "_hot_key", "full"))
    is_hot = F.col(key) == F.col("_hot_key")
    columns = [key, *[c for c in left.columns if c != key], *[c for c in right.columns if c != key]]

    cold_left, cold_right = (df.where(F.col(key).isNotNull()).join(marks, is_hot, "left_anti")
                             for df in (left, right))
    out = cold_left.join(cold_right, key, how).select(columns)

    one = F.lit(1).cast("long")
    rows, cols = F.coalesce("_salts_l", one), F.coalesce("_salts_r", one)

    def dealt(df: DataFrame, own: Column, copies: Column, own_name: str, copy_name: str, side: str) -> DataFrame:
        return (serial(df.join(marks, is_hot), "_serial")
                .withColumn(own_name, F.pmod("_serial", own))
                .withColumn(copy_name, F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
                .withColumn(f"_is_{side}", F.lit(True)))

    hot_left = (dealt(left, rows, cols, "_row", "_col", "l").withColumn("_hot_r", F.col("_salts_r").isNotNull())
                .drop("_serial", "_hot_key", "_salts_l", "_salts_r"))
    hot_right = (dealt(right, cols, rows, "_col", "_row", "r").withColumn("_hot_l", F.col("_salts_l").isNotNull())
                 .drop("_serial", "_hot_key", "_salts_l", "_salts_r"))
    cells = hot_left.join(hot_right, [key, "_row", "_col"], how)
    missed = ((F.col("_is_r").isNull() & F.col("_hot_r")) | (F.col("_is_l").isNull() & F.col("_hot_l")))
    out = out.unionByName(cells.where(~F.coalesce(missed, F.lit(False))).select(columns))

    for df, other, types in ((left, right, ("left", "full")), (right, left, ("right", "full"))):
        if how in types:
            missing = {f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name != key}
            out = out.unionByName(df.where(F.col(key).isNull()).withColumns(missing).select(columns))
    return out
