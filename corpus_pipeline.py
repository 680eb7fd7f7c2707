"""Corpus cleaning: documents -> accepted languages -> one of each text -> one
of each near-duplicate group -> without benchmark passages -> piece ids.

Each stage works on all rows that its predecessor kept, is written as Parquet
to the shared scratch folder and read again.  All stages but the last return
the columns of ``documents``; the last one returns doc_id, ids, n_ids and
round_trip of every document that stayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, exact_dedup, jaccard_join, language_id, sentencepiece_fst
from tessera.llm.common import documents, small_batches, stored

BATCH_ROWS = 1000


def accept_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted_documents(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, documents(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode_documents(docs)


STAGES = [
    ("language_id", accept_languages),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", to_pieces),
]

# The classifier, the near-duplicate classes, the tiles and the pieces are not
# expressible in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    # Long texts: a task and its JVM hold few rows of them at a time.
    with small_batches(spark, BATCH_ROWS):
        for name, stage in STAGES[:-1]:
            docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
