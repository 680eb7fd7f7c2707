"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat_rotation, decontamination, embedding_whitening, exact_dedup, host_reputation, html_extraction,
               importance_resampling, jaccard_join, katz_lm, language_id, secret_scan, sentencepiece_fst, token_counts)
from .common import documents


def op1_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_rotation.rotate(documents(spark, sf_dir, "conversations"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(documents(spark, sf_dir))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode_documents(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op6_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_lm.score_documents(documents(spark, sf_dir))


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judge_pages(documents(spark, sf_dir, "pages"), documents(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(documents(spark, sf_dir))


def op9_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_pages(documents(spark, sf_dir, "pages"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(documents(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(documents(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_rotation": op1_chat_rotation,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_secret_scan": op5_secret_scan,
    "op6_katz_lm": op6_katz_lm,
    "op7_host_reputation": op7_host_reputation,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op9_language_id_pages": op9_language_id_pages,
    "op10_html_extraction": op10_html_extraction,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_counts": op13_token_counts,
}

ORACLE: dict[str, str] = {"op2_exact_dedup": exact_dedup.SQL, "op7_host_reputation": host_reputation.SQL,
                          "op11_importance_resampling": importance_resampling.SQL}
