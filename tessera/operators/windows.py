"""Ranking within groups that may be huge.

``rank().over(Window.partitionBy(g).orderBy(v))`` sends every row of a group
to one task.  When one group holds a third of the table that task does a
third of the work.  ``rank_within`` splits groups instead.

``rank`` and ``dense_rank`` of numbers, dates and timestamps (lazy, one
shuffle of the table, no checkpoint):

1. groups of more than ``hot_rows`` rows (and of more than one
   MAX_HOT_GROUPS-th of all rows) get chunk bounds from a mergeable quantile
   sketch of their values; the bounds are a small broadcast table;
2. a bound cuts a hot group into the rows below it, the rows equal to it and
   the rows above it.  Rows equal to a bound, and nulls, are ties: their rank
   is that of the chunk, so they are not shuffled, however many there are;
3. the other rows are ranked per (group, chunk) and offset by the rows (or
   distinct values) of the group in the chunks before, which one aggregate of
   the table counts.  Every row of a chunk checks that count against its
   window, so bounds that were not the same in both uses raise an error.

Everything else (``row_number``, strings):

1. range-partition on (group, value, tiebreak, row hash): hot groups -- and
   even one hot (group, value) pair -- are cut into several contiguous
   chunks; small groups share a chunk;
2. checkpoint (to the shared ``spark.checkpoint.dir``) so every use below
   sees the same chunk assignment, also after a lost executor;
3. rank locally per (group, chunk), then add offsets from a per-chunk table
   (one row per chunk and group in it): the rows, or distinct values for
   ``dense_rank``, of the group in earlier chunks -- minus the rows / values
   that earlier chunks share with this chunk's first value, because the row
   hash may cut a run of equal values across chunks.  Equal values form one
   run of consecutive chunks, found with window functions over the chunk
   table (no pairs of chunks are formed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import serial
from tessera.session import scratch_root

_METHODS = {"rank": F.rank, "row_number": F.row_number, "dense_rank": F.dense_rank}
DEFAULT_HOT_ROWS = 1_000_000
DEFAULT_CHUNKS = 1024          # pieces of a hot group
MAX_HOT_GROUPS = 1000          # bounds the broadcast tables, with the chunks
NULLS = -1                     # chunk of the null values


def rank_within(df: DataFrame, group: str, value: str, *, descending: bool = True,
                method: str = "rank", name: str = "rank", tiebreak: str | None = None,
                chunks: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """Add ``name`` = rank / row_number / dense_rank of ``value`` within
    ``group``, equal to the window function of the same name, without any
    group landing whole in one task.  Nulls are placed as by the window
    (last when descending, first when ascending) and tie with each other;
    ``row_number`` orders ties by ``tiebreak`` (then by a row hash).  A null group
    is a group of its own; the result is a long.

    ``chunks`` is the number of pieces of a hot group; with it and without
    ``hot_rows`` every group is cut."""
    if method not in _METHODS:
        raise ValueError(f"method must be one of {sorted(_METHODS)}")
    kind = df.schema[value].dataType
    if method != "row_number" and isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        if hot_rows is None:
            hot_rows = 0 if chunks else DEFAULT_HOT_ROWS
        return _rank_by_bounds(df, group, value, descending, method, name, chunks or DEFAULT_CHUNKS, hot_rows)
    return _rank_by_range(df, group, value, descending, method, name, tiebreak, chunks)


def _bounds(df: DataFrame, group: str, value: str, chunks: int, hot_rows: int) -> DataFrame:
    """(_group, _bounds) of the hot groups: fewer than MAX_HOT_GROUPS rows of at
    most ``chunks`` - 1 different values each, ascending."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    share = df.select((F.count(F.lit(1)) / F.lit(float(MAX_HOT_GROUPS))).alias("s")).scalar()
    hot = F.broadcast(counts.where((F.col("_n") > hot_rows) & (F.col("_n") > share))
                      .select(F.col(group).alias("_group")))
    rows = df.select(group, value).join(hot, F.col(group).eqNullSafe(F.col("_group")))
    shares = F.array(*[F.lit(i / chunks) for i in range(1, chunks)])
    sketch = F.percentile_approx(F.when(~_is_nan(df, value), F.col(value)), shares, 20 * chunks)
    none = F.array().cast(T.ArrayType(df.schema[value].dataType))
    return rows.groupBy("_group").agg(F.coalesce(F.array_sort(F.array_distinct(sketch)), none).alias("_bounds"))


def _is_nan(df: DataFrame, value: str) -> Column:
    real = isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType))
    return F.isnan(value) if real else F.lit(False)


def _chunk(value: Column, bounds: Column, nan: Column, chunks: int) -> Column:
    """2 k for a value between bounds k and k + 1, 2 k + 1 for one equal to
    bound k + 1 (binary search); NULLS for null; 2 ``chunks`` + 1 for NaN,
    which is above all; 0 without bounds."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, chunks.bit_length())))])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < value, at + step)
                        .otherwise(at))
    equal = F.coalesce(F.get(bounds, below) == value, F.lit(False))
    return (F.when(bounds.isNull(), 0).when(value.isNull(), NULLS).when(nan, 2 * chunks + 1)
            .otherwise(below * 2 + F.when(equal, 1).otherwise(0)))


def _rank_by_bounds(df: DataFrame, group: str, value: str, descending: bool, method: str, name: str,
                    chunks: int, hot_rows: int) -> DataFrame:
    val, chunks = F.col(value), max(2, chunks)
    bounds = F.broadcast(_bounds(df, group, value, chunks, hot_rows))

    def cut(rows: DataFrame) -> DataFrame:
        marked = rows.join(bounds, F.col(group).eqNullSafe(F.col("_group")), "left")
        return marked.withColumn("_chunk", _chunk(val, F.col("_bounds"), _is_nan(df, value), chunks))

    counted = cut(df.select(group, value)).where(F.col("_bounds").isNotNull()).groupBy("_group", "_chunk")
    size = F.count(F.lit(1))
    # Rows equal to a bound, nulls and NaNs are one value each.
    values = F.count_distinct(F.when(F.col("_chunk") % 2 == 0, val)) if method == "dense_rank" else F.lit(0).cast("long")
    sizes = counted.agg(size.alias("_n"), values.alias("_d")).withColumn(
        "_d", F.when(F.col("_chunk") % 2 == 0, F.col("_d")).otherwise(1))
    order = F.col("_chunk").desc() if descending else F.col("_chunk").asc()
    # At most 2 chunks + 1 rows a group.
    earlier = Window.partitionBy("_group").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select(
        F.col("_group").alias("_of"), F.col("_chunk").alias("_at"), "_n",
        F.coalesce(F.sum("_d" if method == "dense_rank" else "_n").over(earlier), F.lit(0)).alias("_before")))
    here = F.col(group).eqNullSafe(F.col("_of")) & (F.col("_chunk") == F.col("_at"))

    rows = cut(df)
    ties = rows.where(F.col("_bounds").isNotNull() & (F.col("_chunk") % 2 != 0)).join(offsets, here)
    tied = ties.select(*df.columns, (F.col("_before") + 1).cast("long").alias(name))

    part = Window.partitionBy(group, "_chunk").orderBy(val.desc() if descending else val.asc())
    whole = part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    others = rows.where(F.col("_bounds").isNull() | (F.col("_chunk") % 2 == 0)).drop("_bounds", "_group")
    local = (others.withColumn("_local", _METHODS[method]().over(part)).withColumn("_rows", F.count(F.lit(1)).over(whole))
             .join(offsets, here, "left"))
    checked = F.when(F.col("_n").isNull() | (F.col("_n") == F.col("_rows")), F.col("_local")).otherwise(
        F.raise_error(F.lit("chunk bounds differ between the count and the ranks")).cast("int"))
    ranked = local.select(*df.columns, (checked + F.coalesce("_before", F.lit(0))).cast("long").alias(name))
    return ranked.unionByName(tied)


def _rank_by_range(df: DataFrame, group: str, value: str, descending: bool, method: str, name: str,
                   tiebreak: str | None, chunks: int | None) -> DataFrame:
    scratch_root(df.sparkSession)  # make sure a checkpoint folder is set
    unb = Window.unboundedPreceding
    val = F.col(value)
    v = val.desc() if descending else val.asc()
    ties = [F.col(tiebreak).asc()] if tiebreak else []
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    # The serial number cuts runs of equal rows, too.
    keyed = serial(df, "_serial").withColumn("_spread", spread)
    keys = [F.col(group), v, *ties, F.col("_spread"), F.col("_serial")]
    ranged = keyed.repartitionByRange(chunks, *keys) if chunks else keyed.repartitionByRange(*keys)
    chunked = ranged.withColumn("_chunk", F.spark_partition_id()).checkpoint(eager=True)

    # Local ranks per (group, chunk); the chunk's first and last values in
    # window order (nulls placed as by the window: last when descending,
    # first when ascending) and the rows equal to its last value.
    local_order = [v] if method != "row_number" else [v, *ties, F.col("_spread"), F.col("_serial")]
    part = Window.partitionBy(group, "_chunk")
    ordered = part.orderBy(*local_order)
    whole = ordered.rowsBetween(unb, Window.unboundedFollowing)
    local = (chunked
             .withColumn("_local", _METHODS[method]().over(ordered))
             .withColumn("_first_v", F.first(val).over(whole))
             .withColumn("_last_v", F.last(val).over(whole)))
    local = local.withColumn("_is_last", val.eqNullSafe(F.col("_last_v")).cast("int"))

    stats = local.groupBy(group, "_chunk").agg(
        F.count(F.lit(1)).alias("_n"),
        (F.count_distinct(value) + F.max(val.isNull().cast("int"))).alias("_d"),
        F.max("_first_v").alias("_first"),
        F.max("_last_v").alias("_last"),
        F.sum("_is_last").alias("_n_last"))

    by_chunk = Window.partitionBy(group).orderBy("_chunk")
    before = by_chunk.rowsBetween(unb, -1)
    has_prev = F.lag("_chunk").over(by_chunk).isNotNull()
    stats = (stats
             .withColumn("_has_prev", has_prev)
             .withColumn("_prev_last", F.lag("_last").over(by_chunk))
             # 1 when this chunk starts with the value the previous one ends on
             .withColumn("_cont", F.when(F.col("_has_prev")
                                         & F.col("_prev_last").eqNullSafe(F.col("_first")), 1)
                         .otherwise(0))
             # runs of consecutive chunks ending on the same value
             .withColumn("_new_run", F.when(~F.col("_has_prev")
                                            | ~F.col("_prev_last").eqNullSafe(F.col("_last")), 1)
                         .otherwise(0))
             .withColumn("_run", F.sum("_new_run").over(by_chunk.rowsBetween(unb, 0))))
    stats = stats.withColumn("_tail_rows", F.sum("_n_last").over(
        Window.partitionBy(group, "_run").orderBy("_chunk").rowsBetween(unb, 0)))
    offsets = stats.select(
        group, "_chunk", "_first", "_cont",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum(F.col("_d") - F.col("_cont")).over(before), F.lit(0))
        .alias("_distinct_before"),
        F.when(F.col("_cont") == 1, F.lag("_tail_rows").over(by_chunk)).otherwise(F.lit(0))
        .alias("_ties_before"))

    offsets = offsets.withColumnsRenamed({group: "_group", "_chunk": "_chunk_of"})
    out = local.join(offsets, F.col(group).eqNullSafe(F.col("_group"))
                     & (F.col("_chunk") == F.col("_chunk_of")))
    if method == "rank":
        rank = (F.col("_local") + F.col("_rows_before")
                - F.when(val.eqNullSafe(F.col("_first")), F.col("_ties_before"))
                .otherwise(F.lit(0)))
    elif method == "row_number":
        rank = F.col("_local") + F.col("_rows_before")
    else:
        rank = F.col("_local") + F.col("_distinct_before") - F.col("_cont")
    return out.withColumn(name, rank.cast("long")).select(*df.columns, name)
