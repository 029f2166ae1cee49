"""Incremental forms of the collapse and dedup operators over a file source, and event-time extensions.

The batch operators have no notion of time; what uses a watermark or a window here is an extension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ampliscope.functions.dna import pair_key


def read_stream(spark: SparkSession, path: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of a folder, each exactly once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def running_unique(collapsed: DataFrame) -> DataFrame:
    """Totals of distinct pairs so far: for update or complete mode."""
    keyed = collapsed.withColumn("seq_hash", pair_key(F.col("r1"), F.col("r2")))
    return keyed.groupBy("seq_hash").agg(F.min("r1").alias("r1_sequence"), F.min("r2").alias("r2_sequence"), F.sum("count").alias("total_count"))


def running_outcomes(labelled: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Reads by sample and label so far."""
    return labelled.groupBy(sample, "outcome").agg(F.sum("count").alias("reads"))


def first_of_key(reads: DataFrame, keys: list[str], time: str | None = None, late: str = "1 hour") -> DataFrame:
    """The first read of each key as it comes; with a time column, state older than the watermark goes."""
    if time is None:
        return reads.dropDuplicates(keys)
    return reads.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed_outcomes(labelled: DataFrame, time: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Extension: reads by window and label, final once the watermark has passed."""
    return labelled.withWatermark(time, late).groupBy(F.window(time, width), "outcome").agg(F.sum("count").alias("reads")).select(F.col("window.start").alias("start"), "outcome", "reads")


def sessions(labelled: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Extension: the temporal sibling of clustering by gaps."""
    return labelled.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("events")).select(F.col("session_window.start").alias("start"), key, "events")


def upsert_into(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a table of distinct pairs up to date: each batch's totals go to a folder of their own, written once
    however often the batch is tried; current() adds them up."""

    def write(batch: DataFrame, number: int) -> None:
        running_unique(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    parts = spark.read.parquet(path)
    return parts.groupBy("seq_hash").agg(F.min("r1_sequence").alias("r1_sequence"), F.min("r2_sequence").alias("r2_sequence"), F.sum("total_count").alias("total_count"))
