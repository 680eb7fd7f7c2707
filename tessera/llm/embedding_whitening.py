"""Embedding whitening on distributed block matrices (Spark MLlib).

1. Valid vectors become integers x = floor(1024 c) + 100000 and are written
   with their place in the task that read them; the places and the rows of the
   tasks before give a contiguous row index.  Row count n and sums S per
   dimension are exact.
2. The centred rows x - S/n, indexed, are an ``IndexedRowMatrix`` and then a
   ``BlockMatrix`` A of blocks of ``rows_per_block`` rows.  A^T A, multiplied
   with the rows' blocks dealt over as many splits as there are partitions, is
   the scatter: one dimension x dimension block, the only matrix that comes to
   the driver.
3. ``eigh`` on the driver gives the components; the whitening matrix (unit
   eigenvector over sqrt(eigenvalue)) is a one-block ``BlockMatrix`` W, and the
   blocks of A W hold the projected rows.
4. The covariance of the projected rows, aggregated from them, is compared
   with the identity.

The blocks are persisted while the products read them (in memory, then on
disk).  Memory: a block is ``rows_per_block`` x dimension doubles; the driver holds a
few dimension x dimension matrices and MLlib's list of blocks (one index pair a
block; ``rows_per_block`` grows so that there are at most ``MAX_BLOCKS``).

Defined results: rows whose vector is null, or holds null, NaN or infinite
entries, or an entry too large for a long x, are dropped.  Vectors of another
length than most have (ties: the longest), and empty ones, are dropped, too.
Repeated rows and ids count and are returned as often as they occur; a null
vec_id stays null.  A component without variance (eigenvalue not above
``FLAT`` times the trace) has a null ``whitened`` and does not enter
``identity_error`` (0.0 where no component is left); ``explained`` is null
where the trace is 0.  A ``deviation`` beyond a long is null.  An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

COMPONENTS = 8
SCALE = 1024           # x = floor(SCALE c) + SHIFT
SHIFT = 100_000
FLAT = 1e-11           # share of the trace below which a component has no variance
ROWS_PER_BLOCK = 4096
MAX_BLOCKS = 1 << 20
LARGEST = 2.0 ** 52    # |SCALE c| up to which x is an exact long

SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")
PLACES = (1 << 33) - 1  # the place in its task, in monotonically_increasing_id


def integer_rows(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, x): the valid vectors as integers with contiguous row
    numbers from 0.  Writes them, without a shuffle."""
    # NaN is larger than any number; the comparison is null for a null entry.
    fits = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) * SCALE < LARGEST, F.lit(False)))
    valid = embeddings.where((F.size("embedding") > 0) & fits).select("vec_id", "embedding")
    usual = (valid.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), F.desc("d")).first())
    same = valid.where(F.size("embedding") == (usual["d"] if usual else 0))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    rows = stored(same.select("vec_id", x.alias("x")).withColumn("_id", F.monotonically_increasing_id()),
                  "integer_vectors")
    task, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit(PLACES))
    # One row a task of the write.
    sizes = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(offsets), task == F.col("_task"))
            .select((place + F.col("_before")).alias("row"), "vec_id", "x"))


def column_sums(rows: DataFrame) -> tuple[int, list[int], int]:
    """Row count, exact sum of every dimension, and a bound on the numbers that
    the deviation of any row goes through."""
    # Sums of the upper and lower bits stay within a long whatever x is.
    each = rows.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("v", 26)).alias("high"),
        F.sum(F.col("v").bitwiseAND(F.lit((1 << 26) - 1))).alias("low"),
        F.min("v").alias("least"), F.max("v").alias("most")).orderBy("d").collect()
    if not each:
        return 0, [], 0
    n = each[0]["n"]
    sums = [(r["high"] << 26) + r["low"] for r in each]
    bound = sum(max(abs(n * r["least"] - s), abs(n * r["most"] - s)) ** 2 for r, s in zip(each, sums))
    return n, sums, max(bound, *(n * abs(r[end]) for r in each for end in ("least", "most")))


def deviation(n: int, sums: list[int], bound: int) -> Column:
    """Sum over the dimensions of (n x - S)^2, exact; null beyond a long."""
    if bound < 1 << 63:
        gaps = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in sums]), lambda x, s: x * F.lit(n) - s)
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap * gap)
    wide = "decimal(38,0)"
    gaps = F.zip_with("x", F.array(*[F.lit(str(s)).cast(wide) for s in sums]),
                      lambda x, s: F.try_subtract(F.try_multiply(x.cast(wide), F.lit(n).cast("decimal(19,0)")), s))
    return F.aggregate(gaps, F.lit(0).cast(wide),
                       lambda total, gap: F.try_add(total, F.try_multiply(gap, gap)).cast(wide)).try_cast("long")


def centred_matrix(rows: DataFrame, n: int, sums: list[int]) -> BlockMatrix:
    """The rows x - S/n as a distributed matrix in blocks of rows."""
    means = F.array(*[F.lit(s / n) for s in sums])
    centred = rows.select(F.col("row").alias("index"), array_to_vector(
        F.zip_with("x", means, lambda x, mean: x.cast("double") - mean)).alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(centred, "vector"), n, len(sums))
    return indexed.toBlockMatrix(max(ROWS_PER_BLOCK, -(-n // MAX_BLOCKS)), len(sums))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """A^T A.  The rows' blocks are dealt over the partitions and their products
    summed there; MLlib's one-argument product would bring every block to the
    one partition of the result."""
    splits = max(1, min(matrix.numRowBlocks, matrix.blocks.getNumPartitions()))
    product = matrix.transpose()._java_matrix_wrapper.call(
        "multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest eigenvalues, their unit eigenvectors (columns) and the trace."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1][:k]
    return values[order], vectors[:, order], float(np.trace(covariance))


def projected(spark: SparkSession, matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """(row, w): rows of A W, from the product's blocks."""
    d, k = whitening.shape
    right = BlockMatrix(spark.sparkContext.parallelize(
        [((0, 0), DenseMatrix(d, k, whitening.T.reshape(-1).tolist()))], 1), d, k, d, k)
    per_block = matrix.rowsPerBlock

    def rows_of(block: tuple) -> Iterator[tuple[int, list[float]]]:
        (at, _), values = block
        for i, row in enumerate(values.toArray().tolist()):
            yield at * per_block + i, row

    return matrix.multiply(right).blocks.flatMap(rows_of).toDF("row long, w array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity."""
    w = [F.col("w")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = white.agg(*[F.avg(c) for c in w], *[F.avg(w[i] * w[j]) for i, j in pairs]).first()
    return max((abs(row[k + at] - row[i] * row[j] - (i == j)) for at, (i, j) in enumerate(pairs)), default=0.0)


def whiten(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per valid vector and component (numbered from 1 by falling
    eigenvalue): vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Runs jobs while the plan is built (writes integers and projected rows)."""
    spark = embeddings.sparkSession
    rows = integer_rows(embeddings)
    n, sums, bound = column_sums(rows)
    if n == 0:
        return spark.createDataFrame([], SCHEMA)
    k = min(k, len(sums))
    # The products read the blocks four times; a lost one is built again.
    matrix = centred_matrix(rows, n, sums).persist(StorageLevel.MEMORY_AND_DISK)
    values, vectors, trace = components(scatter(matrix) / n, k)
    live = int((values > FLAT * trace).sum()) if trace > 0 else 0
    own = rows.select("row", "vec_id", deviation(n, sums, bound).alias("deviation"))
    if live:
        white = stored(projected(spark, matrix, vectors[:, :live] / np.sqrt(values[:live])), "whitened")
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
    if live:
        error = identity_error(white, live)
        own = own.join(white, "row")
    else:
        error = 0.0
        own = own.withColumn("w", F.array().cast("array<double>"))
    explained = F.array(*[F.lit(float(v / trace) if trace > 0 else None).cast("double") for v in values])
    flat = F.array_repeat(F.lit(None).cast("double"), k - live)
    return (own.select("vec_id", "deviation", F.posexplode(F.concat("w", flat)).alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error")))
