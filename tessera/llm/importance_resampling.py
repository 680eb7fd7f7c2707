"""Target-distribution importance resampling.

Documents are drawn with a chance that grows with how much their hashed word
runs look like a target corpus.  A text is lower-cased in A-Z only and
pre-tokenised by an untrained ``Regex`` split of the tokenizers library, which
gives its words with byte offsets.  Features are the runs of one to three
consecutive words, joined by one space; a run is a window over the offset
pairs, and its CRC-32 follows from the CRCs and lengths of its words (CRC is
linear, so no joined string is built).  A feature counts in bucket
CRC mod ``BUCKETS``.

1. One pass over the texts writes the bucket codes of every document (two
   bytes a feature) to the shared scratch folder.
2. Counting them gives the corpus histogram (at most ``BUCKETS`` rows a task
   are shuffled); the target's histogram comes from its own texts.  The gains,
   one number a bucket, go through the driver.
3. A document's weight is the sum of its features' gains, its score adds a
   Gumbel draw from its id, and the highest scores are drawn.  Rows are put in
   order by range partitions, numbered in each and offset by the rows of the
   partitions before; equal rows are dealt by a serial number.

Defined results: a null text has no words (weight 0); a null doc_id draws as
the empty id and is placed after the others in ties; repeated rows are rows of
their own and ties between them fall by text hash; empty tables give no rows,
an empty target gains that only follow the corpus; columns besides doc_id and
text are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_rows, slices, stored, text_hash

BUCKETS = 10_000
MAX_RUN = 3            # words of the longest feature
MIN_WORDS = 20         # shorter documents are never drawn
DRAW_PERCENT = 5
SEED = 42
PIECE_CHARS = 1 << 18  # longer texts are pre-tokenised in pieces, cut between words

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

# ---- CRC-32 of joined strings ------------------------------------------------

_SHORT = 64            # bytes up to which one table advances a CRC at once


def _byte_step(crc: np.ndarray) -> np.ndarray:
    """The CRC register after one zero byte (reflected polynomial 0xEDB88320)."""
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (crc & np.uint32(1)))
    return crc


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """``crc`` advanced by a table [byte of the register, value]."""
    return (table[0, crc & 255] ^ table[1, (crc >> 8) & 255]
            ^ table[2, (crc >> 16) & 255] ^ table[3, crc >> 24])


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Registers after 0 to ``_SHORT`` zero bytes, and after 2^k zero bytes."""
    step = [np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]]
    for _ in range(_SHORT):
        step.append(_byte_step(step[-1]))
    double = [step[1]]
    for _ in range(40):
        double.append(_through(double[-1], double[-1]))
    return np.stack(step), np.stack(double)


_STEPS, _DOUBLES = _tables()


def advance(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC-32 of a followed by n zero bytes, less the part of those bytes:
    crc(a + b) = advance(crc(a), len(b)) ^ crc(b)."""
    short = np.minimum(n, _SHORT)
    out = (_STEPS[short, 0, crc & 255] ^ _STEPS[short, 1, (crc >> 8) & 255]
           ^ _STEPS[short, 2, (crc >> 16) & 255] ^ _STEPS[short, 3, crc >> 24])
    for at in np.flatnonzero(n > _SHORT):
        left, value = int(n[at]), crc[at:at + 1]
        for k in range(left.bit_length()):
            if left >> k & 1:
                value = _through(_DOUBLES[k], value)
        out[at] = value[0]
    return out


_SPACE = np.uint32(zlib.crc32(b" "))


def run_crcs(crc: np.ndarray, length: np.ndarray, size: int = MAX_RUN) -> list[np.ndarray]:
    """CRCs of the runs of 1 to ``size`` words that start at each word."""
    spaced = advance(np.full(len(crc), _SPACE), length) ^ crc
    runs = [crc]
    for k in range(1, size):
        runs.append(advance(runs[-1][:-1], length[k:] + 1) ^ spaced[k:] if len(crc) > k else crc[:0])
    return runs


# ---- words -------------------------------------------------------------------

class _WordCrcs(dict):
    """CRC of each word met by this worker; full at 2^18 words of 32 characters."""

    def __missing__(self, word: str) -> int:
        crc = zlib.crc32(word.encode())
        if len(word) <= 32 and len(self) < 1 << 18:
            self[word] = crc
        return crc


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PIECE_CHARS:
        gap = _GAP.search(text, start + PIECE_CHARS)
        if gap is None:
            break
        yield text[start:gap.start()]
        start = gap.start()
    yield text[start:]


def _lower(text: str) -> str:
    return text.encode().lower().decode()  # bytes.lower() changes A-Z only


class Words:
    """Words of texts as (CRC, bytes) arrays."""

    def __init__(self) -> None:
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.crcs = _WordCrcs()

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        from tokenizers import PreTokenizedString

        crcs, sizes = [], []
        for piece in _pieces(_lower(text)):
            state = PreTokenizedString(piece)
            self.split.pre_tokenize(state)
            found = state.get_splits(offset_referential="normalized", offset_type="byte")
            known = self.crcs
            crcs.append(np.fromiter((known[word] for word, _, _ in found), np.uint32, len(found)))
            sizes.append(np.fromiter((end - start for _, (start, end), _ in found), np.int64, len(found)))
        return np.concatenate(crcs), np.concatenate(sizes)


def _codes_of(texts: list[str | None], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket codes of all texts in order, the number of words and of features of each."""
    found = [words.of(text or "") for text in texts]
    n_words = np.array([len(crc) for crc, _ in found], np.int64)
    crc = np.concatenate([c for c, _ in found])
    length = np.concatenate([s for _, s in found])
    ends = np.repeat(np.cumsum(n_words), n_words)
    codes = np.zeros((len(crc), MAX_RUN), np.uint16)
    inside = np.zeros((len(crc), MAX_RUN), bool)
    place = np.arange(len(crc))
    for k, run in enumerate(run_crcs(crc, length)):
        codes[:len(run), k] = run % np.uint32(BUCKETS)
        inside[:len(run), k] = place[:len(run)] + k < ends[:len(run)]
    n_features = sum(np.maximum(n_words - k, 0) for k in range(MAX_RUN))
    return codes[inside], n_words, n_features


def feature_codes(docs: DataFrame, *keys: Column) -> DataFrame:
    """``keys`` and, of every text, its number of words, its number of features
    and the features' bucket codes (16-bit little endian)."""
    rows = docs.select(*keys, F.col("text").alias("_text"))
    n_keys = len(keys)
    schema = T.StructType([*rows.schema.fields[:n_keys], T.StructField("n_words", T.LongType()),
                           T.StructField("n_features", T.LongType()), T.StructField("codes", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        names = [f.name for f in schema.fields]
        for part in slices(batches, "_text"):
            codes, n_words, n_features = _codes_of(part.column(n_keys).to_pylist(), words)
            # 32-bit offsets of the Arrow column: a slice is about 1 MB of text
            # or one longer text.
            ends = np.cumsum(n_features) * 2
            offsets = np.concatenate([[0], ends])
            big = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)),
                                               pa.py_buffer(np.ascontiguousarray(codes, "<u2"))])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n_keys], pa.array(n_words), pa.array(n_features), big.cast(pa.binary())], names)

    return rows.mapInArrow(encode, schema)


# ---- histograms, gains, weights ----------------------------------------------

def bucket_counts(coded: DataFrame) -> DataFrame:
    """(bucket, n) over all codes; each task sends its non-empty buckets."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u2"), minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return (coded.select("codes").mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket: floor(1000 ln of the smoothed ratio of target to
    source shares).  What reaches the driver is one row a bucket."""
    zero = F.lit(0).cast("long")
    both = (source.select("bucket", F.col("n").alias("s"), zero.alias("t"))
            .unionByName(target.select("bucket", zero.alias("s"), F.col("n").alias("t"))))
    counts = np.zeros((2, BUCKETS), np.int64)
    for row in both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        counts[:, row["bucket"]] = row["s"], row["t"]
    (ss, tt), gain = counts.sum(axis=1).tolist(), np.zeros(BUCKETS, np.int64)
    for bucket, (s, t) in enumerate(counts.T.tolist()):
        ratio = (t + 1.0) * (ss + float(BUCKETS)) / ((s + 1.0) * (tt + float(BUCKETS)))
        gain[bucket] = math.floor(1000.0 * math.log(ratio))
    return gain


def weights(coded: DataFrame, gain: np.ndarray) -> DataFrame:
    """``coded`` with ``weight`` in place of the codes."""
    names = [f.name for f in coded.schema.fields if f.name != "codes"] + ["weight"]
    schema = T.StructType([f for f in coded.schema.fields if f.name != "codes"] + [T.StructField("weight", T.LongType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("codes")
            total = [int(gain[np.frombuffer(value.as_buffer(), "<u2")].sum()) for value in codes]
            rest = [batch.column(name) for name in names[:-1]]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(total, pa.int64())], names)

    return coded.mapInArrow(weigh, schema)


# ---- draw --------------------------------------------------------------------

def gumbel(doc_id: str = "doc_id") -> Column:
    """Thousandths of a Gumbel draw that follows from seed and id."""
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place (1, 2, ...) in ``order``: range partitions,
    written once, a number in each partition and the rows before it."""
    parts = stored(rows.withColumn("_serial", F.monotonically_increasing_id())
                   .repartitionByRange(*order, F.col("_serial"))
                   .withColumn("_part", F.spark_partition_id()), "ordered")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row a partition of the exchange.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order, F.col("_serial")))
    return (parts.withColumn("_own", own).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_own") + F.col("_before")).drop("_part", "_serial", "_own", "_before"))


def resample(docs: DataFrame, target: DataFrame, *, percent: int = DRAW_PERCENT,
             min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if
    not drawn), n_words, text_hash, drawn.

    Runs jobs while the plan is built (codes, histograms, count, order)."""
    coded = stored(feature_codes(docs, F.col("doc_id"), text_hash().alias("text_hash")), "feature_codes")
    gain = gains(bucket_counts(coded), bucket_counts(feature_codes(target)))
    scored = weights(coded, gain).withColumn("score", F.col("weight") + gumbel())
    wanted = coded.where(F.col("n_words") >= min_words).count() * percent // 100
    fit = F.col("n_words") >= min_words
    order = [fit.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc()]
    placed = numbered(scored, order, "_place")
    drawn = F.col("_place") <= wanted
    return placed.select("doc_id", "n_features", "weight", "score",
                         F.when(drawn, F.col("_place").cast("long")).alias("rank"),
                         "n_words", "text_hash", drawn.alias("drawn"))


def drawn_documents(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are drawn (one of repeated rows)."""
    return keep_rows(docs, resample(docs, target).where("drawn"), "left_semi")


# The same in SQL.  The CRC goes over the four-bit halves of every byte.
_NIBBLES = []
for _value in range(16):
    for _ in range(4):
        _value = (_value >> 1) ^ (0xEDB88320 * (_value & 1))
    _NIBBLES.append(_value)

SQL = f"""
WITH texts AS (
  SELECT 0 AS side, row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
words AS (
  SELECT side, row_id, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
runs AS (
  SELECT side, row_id, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM words),
counted AS (SELECT side, row_id, f, count(*) AS n FROM runs GROUP BY ALL),
halves AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h)),
      lambda i: ('0x' || substr(h, (i + 1 - 2 * (i % 2) + 1)::BIGINT, 1))::BIGINT)),
    lambda c, b: xor(c >> 4, list_extract({_NIBBLES}, xor(c & 15, b) + 1)::BIGINT)), 4294967295::BIGINT) % {BUCKETS} AS bucket
  FROM halves),
hist AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
  FROM counted JOIN buckets USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t::DOUBLE + 1) * (sum(s) OVER ()::DOUBLE + {BUCKETS})
    / ((s::DOUBLE + 1) * (sum(t) OVER ()::DOUBLE + {BUCKETS}))))::BIGINT AS gain FROM hist),
weight AS (
  SELECT row_id, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN buckets USING (f) JOIN gain USING (bucket) WHERE side = 0 GROUP BY row_id),
scored AS (
  SELECT doc_id, row_id, len(w) AS n_words,
    (len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0))::BIGINT AS n_features,
    coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE
      / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weight USING (row_id) WHERE side = 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id ASC NULLS LAST) AS place,
    count(*) OVER (PARTITION BY n_words >= {MIN_WORDS}) AS fit
  FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= {MIN_WORDS} AND place <= {DRAW_PERCENT} * fit // 100 THEN place END AS rank
FROM placed
"""
