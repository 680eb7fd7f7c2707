"""Exact dedup against a history held in a minimal perfect hash.

The distinct digests of history and batch are cut into shards of bounded size
by their leading bits; each shard is a minimal perfect hash (levels of bit
arrays: a key that is alone at its place in a level is settled there, the
others go to the next level) plus one slot per key that holds the full
32-byte digest, the winner's locator (its doc_id) and the number of copies.
A lookup computes the slot and compares all 32 bytes, so a digest outside the
history never matches by accident; such nonmembers group among themselves.

Copies are counted per digest before any shuffle, so a digest that a third of
all rows share is one row per task.

Defined results: a null text counts as empty; repeated rows (same doc_id and
text) all appear in the result, exactly one of them kept; null doc_ids lose
against any other; an empty history or batch gives an empty index or result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_rows, mix, stored, text_hash

SHARD_KEYS = 50_000   # expected digests of the larger input in a shard
GAMMA = 1.5           # bits per key in a level
MAX_LEVELS = 200

INDEX = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("slots", T.LongType()),
    T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType()),
    T.StructField("digests", T.BinaryType()), T.StructField("winners", T.ArrayType(T.LongType())),
    T.StructField("copies", T.ArrayType(T.LongType()))])


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(keys[:, 1] ^ mix(keys[:, 2] + seed)) % np.uint64(size)).astype(np.int64)


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u8").reshape(-1, 4).astype(np.uint64)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and all levels' bits for distinct 4 x 64-bit keys."""
    sizes, levels, left = [], [], np.arange(len(keys))
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("digests are not distinct")
        size = max(64, math.ceil(GAMMA * len(left)))
        at = _places(keys[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool)


def slots_of(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 where no level claims it (surely no member)."""
    rank = np.cumsum(bits) - 1
    slot = np.full(len(keys), -1, np.int64)
    left, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        if not len(left):
            break
        at = _places(keys[left], level, size) + base
        hit = bits[at]
        slot[left[hit]] = rank[at[hit]]
        left = left[~hit]
        base += size
    return slot


def _index_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    digests = pdf["digest"].tolist()
    keys = _words(digests)
    sizes, bits = build_hash(keys)
    order = np.argsort(slots_of(keys, sizes, bits))
    return pd.DataFrame([{
        "shard": int(pdf["shard"].iloc[0]), "slots": len(pdf), "sizes": sizes,
        "bits": np.packbits(bits).tobytes(), "digests": b"".join(digests[i] for i in order),
        "winners": pdf["winner"].to_numpy()[order], "copies": pdf["copies"].to_numpy()[order]}])


def _lookup_shard(key, batch: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = batch[["digest", "winner", "copies"]].copy()
    out["old_winner"] = pd.array([None] * len(out), dtype="Int64")
    out["old_copies"] = np.zeros(len(out), np.int64)
    if len(index) and len(batch):
        row = index.iloc[0]
        sizes = [int(x) for x in row["sizes"]]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
        keys = _words(batch["digest"].tolist())
        slot = slots_of(keys, sizes, bits)
        held = np.frombuffer(row["digests"], ">u8").reshape(-1, 4).astype(np.uint64)
        member = slot >= 0
        member[member] = (held[slot[member]] == keys[member]).all(axis=1)
        found = np.flatnonzero(member)
        out.iloc[found, 3] = np.asarray(row["winners"])[slot[found]]
        out.iloc[found, 4] = np.asarray(row["copies"])[slot[found]]
    return out


def digests(df: DataFrame, text: str = "text") -> DataFrame:
    """``df``'s doc_id and the SHA-256 of the unchanged text."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"))


def per_digest(hashed: DataFrame) -> DataFrame:
    """One row per digest: its largest doc_id (-2^63 when all are null) and
    its number of rows."""
    return hashed.groupBy("digest").agg(
        F.coalesce(F.max("doc_id"), F.lit(-2**63)).alias("winner"), F.count("*").alias("copies"))


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    head = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return groups.withColumn("shard", F.pmod(head, F.lit(shards)).cast("int"))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """Minimal perfect hash over the distinct digests of ``history``
    (digest, winner, copies), one row per shard."""
    return _sharded(history, shards).groupBy("shard").applyInPandas(_index_shard, INDEX)


def lookup(batch: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``batch`` (one row per digest) with the winner and number of copies
    that the index holds for the same digest (null and 0: not a member)."""
    schema = "digest binary, winner long, copies long, old_winner long, old_copies long"
    return (_sharded(batch, shards).groupBy("shard").cogroup(index.groupBy("shard"))
            .applyInPandas(_lookup_shard, schema))


def shard_count(*inputs: DataFrame) -> int:
    """So many shards that each holds about SHARD_KEYS digests of the largest
    input, and no more of any other."""
    return max(1, math.ceil(max(groups.count() for groups in inputs) / SHARD_KEYS))


def winners(history: DataFrame, batch: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) of every distinct text of both inputs.

    ``history`` and ``batch`` come from :func:`digests`.  Members of the batch
    join the history's group; nonmembers group among themselves."""
    old = stored(per_digest(history), "dedup-history")
    new = stored(per_digest(batch), "dedup-batch")
    shards = shard_count(old, new)
    index = stored(build_index(old, shards), "dedup-index")
    found = lookup(new, index, shards)
    merged = found.select("digest", F.greatest("winner", "old_winner").alias("keep_id"),
                          (F.col("copies") + F.col("old_copies")).alias("group_size"),
                          F.col("old_winner").isNotNull().alias("member"))
    merged = stored(merged, "dedup-found")
    members = merged.filter("member").select("digest")
    alone = old.join(members, "digest", "left_anti").select("digest", F.col("winner").alias("keep_id"),
                                                            F.col("copies").alias("group_size"))
    return merged.drop("member").unionByName(alone)


def arrivals(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut the rows into what arrived first (the history) and the rest (the
    batch) at the middle of the doc_id range; null ids belong to the batch."""
    ends = df.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    cut = 0 if ends["a"] is None else (int(ends["a"]) + int(ends["b"])) // 2
    early = F.coalesce(F.col("doc_id") <= cut, F.lit(False))
    return df.filter(early), df.filter(~early)


def exact_dedup(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept,
    text_sha256.  Of equal texts the row with the largest doc_id stays."""
    hashed = stored(digests(df, text), "dedup-digests")
    groups = winners(*arrivals(hashed))
    # repeated rows (same id, same text) are counted once and unfolded again
    rows = hashed.groupBy("digest", "doc_id").agg(F.count("*").alias("_n"))
    joined = rows.join(groups, "digest")
    first = F.coalesce("doc_id", F.lit(-2**63)) == F.col("keep_id")
    unfolded = joined.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i"))
    return unfolded.select(
        "doc_id", F.when(F.col("keep_id") != -2**63, F.col("keep_id")).alias("keep_id"), "group_size",
        (first & (F.col("_i") == 1)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the largest
    doc_id; columns unchanged."""
    hashed = docs.select("doc_id", "text", text_hash().alias("text_hash"))
    kept = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("_id"), "text_sha256")
    own = hashed.select("doc_id", "text_hash", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"))
    stay = own.join(kept, own["doc_id"].eqNullSafe(kept["_id"]) & (own["sha"] == kept["text_sha256"]), "left_semi")
    return keep_rows(docs, stored(stay.select("doc_id", "text_hash").distinct(), "dedup-kept"), "left_semi")


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
