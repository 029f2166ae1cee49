"""The corpus pipeline: language ID, quality, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and
returns documents, the last one packed pieces. run() writes each stage as Parquet in
the shared scratch folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampliscope.llm import langid, mixing, near_copies, packing, quality
from ampliscope.llm.common import discard, materialize, read

#: Texts whose language is less likely than this are rejected, as are those without one.
LEAST_LANGUAGE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return langid.accept(docs, langid.fit(docs), LEAST_LANGUAGE)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the trusted ones is usual for their language."""
    found, _ = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.accept(docs, found)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_copies.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture by domain, language and source; a document of several epochs comes as often."""
    return mixing.mixture(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: A trained network and byte-pair encoding aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        done = materialize(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
