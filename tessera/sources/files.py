"""File scans.  Every reader takes an explicit schema; inference is opt-in
because it costs an extra pass over the data and guesses differently for
different files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, paths: str | Sequence[str],
             schema: T.StructType | str | None = None, *, header: bool = True,
             sep: str = ",", quote: str = '"', infer: bool = False,
             **options) -> DataFrame:
    """CSV scan over a path, a glob (``dir/*.csv``, ``sales_2024_*.csv``) or
    a list of paths, all in one distributed scan."""
    reader = spark.read.option("header", header).option("sep", sep).option("quote", quote)
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_json(spark: SparkSession, paths: str | Sequence[str],
              schema: T.StructType | str | None = None, *,
              multiline: bool = False, infer: bool = False, **options) -> DataFrame:
    """JSON-lines scan, or one document / array per file with ``multiline``.
    Without a schema ``infer`` must ask for the extra pass that finds one."""
    if schema is None and not infer:
        raise ValueError("give a schema or infer=True")
    reader = spark.read.option("multiLine", multiline)
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(list(paths) if not isinstance(paths, str) else paths)


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Vectorised parquet scan (schema comes from the files' footers)."""
    if isinstance(paths, str):
        return spark.read.parquet(paths)
    return spark.read.parquet(*paths)


class EntityReadError(RuntimeError):
    """A required input could not be read or lacks required columns."""


def read_entity(spark: SparkSession, path: str, entity: str,
                required: T.StructType | Sequence[str] | None = None,
                observation: Observation | None = None) -> DataFrame:
    """Fail-fast parquet read of a named entity.

    Raises :class:`EntityReadError` naming the entity when the path cannot be
    resolved or its footers not be read, when required columns are missing or,
    with a StructType, when their types differ.  With ``observation`` (a
    ``pyspark.sql.Observation``) the row count is observed by the job that
    reads the table, as ``rows``; no extra job runs here.
    """
    try:
        df = spark.read.parquet(path)
    except Exception as exc:
        raise EntityReadError(f"cannot read {entity} from {path}: {exc}") from exc
    if required is not None:
        names = required.fieldNames() if isinstance(required, T.StructType) else list(required)
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise EntityReadError(f"{entity} at {path} lacks columns {missing}")
        if isinstance(required, T.StructType):
            wrong = {f.name: df.schema[f.name].dataType.simpleString() for f in required.fields
                     if df.schema[f.name].dataType != f.dataType}
            if wrong:
                raise EntityReadError(f"{entity} at {path} has columns of other types: {wrong}")
        df = df.select(*names)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    return df
