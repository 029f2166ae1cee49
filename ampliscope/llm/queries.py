"""The training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ampliscope.llm import cover_tree, langid, mixing, packing, quality, quartile_digest, simhash, token_coder, toxicity, url_filter
from ampliscope.llm.common import read


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_coder.round_trip(read(spark, sf_dir, "documents"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(read(spark, sf_dir, "embeddings"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.fingerprints(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_url_filters": op2_url_filters,
        "op3_toxicity": op3_toxicity,
        "op4_token_ids": op4_token_ids,
        "op5_exact_top_k": op5_exact_top_k,
        "op6_source_mixing": op6_source_mixing,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_document_fingerprints": op10_document_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filters": url_filter.SQL, "op5_exact_top_k": cover_tree.SQL, "op6_source_mixing": mixing.SQL}
