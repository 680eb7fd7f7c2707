"""File sinks.

Writes run on the executors, one file per task.  Two layout controls:

* ``num_files``: coalesce to that many writers (``coalesce(1)`` gives a single
  file but serialises the write, so it is off by default);
* ``partition_by``: Hive-style directories.  Rows are numbered in their task
  (in the order of a row hash, so a task that runs again numbers them alike)
  and range-partitioned on the partition columns plus that number.  Each task
  then holds a contiguous slice of partition values: small values share a task
  (one file per value, not tasks x values small files) and a hot value -- say
  one day holding a third of all rows, equal rows or not -- is cut into several
  slices written by several tasks in parallel.  ``rows_per_task`` sets the size
  of the slices (one count of the input), ``max_records_per_file`` caps files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tessera.operators.joins import serial


def _layout(df: DataFrame, num_files: int | None, partition_by: Sequence[str] | None,
            rows_per_task: int | None = None) -> DataFrame:
    if partition_by:
        keys = [*partition_by, "_serial"]
        rows = serial(df, "_serial")
        if rows_per_task:
            num_files = max(1, -(-df.count() // rows_per_task))
        cut = rows.repartitionByRange(num_files, *keys) if num_files else rows.repartitionByRange(*keys)
        return cut.drop("_serial")
    if num_files:
        return df.coalesce(num_files)
    return df


def write_csv(df: DataFrame, path: str, *, header: bool = True, sep: str = ",",
              quote: str = '"', mode: str = "overwrite", num_files: int | None = None,
              partition_by: Sequence[str] | None = None,
              max_records_per_file: int | None = None, rows_per_task: int | None = None) -> None:
    w = (_layout(df, num_files, partition_by, rows_per_task).write.mode(mode)
         .option("header", header).option("sep", sep).option("quote", quote))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.csv(path)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite",
               compression: str | None = None, num_files: int | None = None) -> None:
    w = _layout(df, num_files, None).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  compression: str = "snappy", partition_by: Sequence[str] | None = None,
                  dynamic: bool = False, num_files: int | None = None,
                  max_records_per_file: int | None = None, rows_per_task: int | None = None) -> None:
    """Parquet write.  With ``dynamic`` (and ``partition_by``) an overwrite
    replaces only the partitions present in ``df``."""
    w = (_layout(df, num_files, partition_by, rows_per_task).write.mode(mode)
         .option("compression", compression))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_text(df: DataFrame, path: str, *, mode: str = "overwrite",
               partition_by: Sequence[str] | None = None) -> None:
    """One string column per row as a line; with ``partition_by`` one file
    per partition value."""
    w = _layout(df, None, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)
