"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

SHINGLE = 5            # words per shingle
SIMILARITY = 0.8       # Jaccard similarity of near duplicates
SLICE_ROWS = 256       # rows handled at once inside a task ...
SLICE_BYTES = 1 << 20  # ... and about as many bytes of text


def stored(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later reads
    do not depend on the executors that computed it.  ``rows_per_file`` bounds
    what a task holds of wide rows when it writes or reads them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send at most ``rows`` rows at once to a Python task,
    which bounds what the task and its JVM hold of long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, min(rows, int(old)) if int(old) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keep_rows(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` semi- or anti-joined with ``keys`` (doc_id, text_hash), null
    ids matching each other; a semi join keeps one of repeated rows.  Columns
    are unchanged, whatever their names."""
    taken = {c.lower() for c in docs.columns}
    names = []
    for name in ("_text_hash", "_key_id", "_key_hash"):
        while name in taken:
            name += "_"
        taken.add(name)
        names.append(name)
    own, kid, khash = names
    keys = keys.select(F.col("doc_id").alias(kid), F.col("text_hash").alias(khash))
    rows = docs.withColumn(own, text_hash())
    out = rows.join(keys, F.col("doc_id").eqNullSafe(F.col(kid)) & (F.col(own) == F.col(khash)), how)
    return (out.dropDuplicates(["doc_id", own]) if how == "left_semi" else out).drop(own)


def bounded_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most ``n`` rows of ``df``, chosen by a hash of ``keys``.  The hash
    leaves about 2 n rows before they are put in order, so that the last step
    stays small however many tasks there are."""
    share = min(1.0, 2.0 * n / max(1, df.count()))
    draw = F.pmod(F.xxhash64(*keys, F.lit(17)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return df.filter(draw < share).orderBy(draw, *keys).limit(n)


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = SLICE_ROWS,
           size_limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds a bounded amount of text (a
    single longer text is a slice of its own)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(size):
            if i > start and (held + n > size_limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
        del batch
        pa.default_memory_pool().release_unused()


def split_words(texts: pa.Array, split=pc.utf8_split_whitespace) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """White-space separated words of every text: (distinct words, code of each
    word, offsets of the texts).  Null is the empty text."""
    texts = pc.fill_null(texts, "")
    if texts.type == pa.string():
        texts = texts.cast(pa.large_string())
    lists = split(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.values.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = encoded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    keep = codes != empty
    if not keep.all():
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    else:
        offsets = offsets - offsets[0]
    return words, codes, offsets


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hash of each distinct word, the same in every process."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()),
                       dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (wraps modulo 2^64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that start at each position (one array over
    many texts; the caller leaves out windows that cross a text's end)."""
    n = len(hashed) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashed[k:k + n]
    return mix(out)


def shingles(hashed: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and their offsets.  A text of fewer than
    ``size`` words has one shingle, the whole text; one without words none."""
    lengths = np.diff(offsets)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(out_offsets[-1], np.uint64)
    every = gram_hashes(hashed, size)
    whole = np.flatnonzero(lengths >= size)
    if len(whole):
        at = np.repeat(offsets[whole] - out_offsets[whole], counts[whole])
        to = np.concatenate([np.arange(out_offsets[i], out_offsets[i + 1]) for i in whole])
        out[to] = every[to + at]
    for i in np.flatnonzero((lengths > 0) & (lengths < size)):
        own = hashed[offsets[i]:offsets[i + 1]]
        out[out_offsets[i]] = gram_hashes(own, len(own))[0] ^ np.uint64(len(own))
    return out, out_offsets
