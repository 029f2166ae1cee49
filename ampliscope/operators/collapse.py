"""Reads to distinct sequences: collapse, UMI counts, the global set, and the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.functions.dna import pair_key


def collapse(reads: DataFrame, keys: list[str], weight: Column | None = None) -> DataFrame:
    """Distinct keys with `count`, the number of reads or the sum of a weight."""
    return reads.groupBy(*keys).agg((F.count("*") if weight is None else F.sum(weight)).alias("count"))


def collapse_keep_best(reads: DataFrame, keys: list[str], kept: str, score: Column) -> DataFrame:
    """As collapse(), with the value of `kept` from the read with the best score, the smallest on a tie."""
    best = F.min_by(kept, F.struct((-score).alias("s"), F.col(kept).alias("v")))
    return reads.groupBy(*keys).agg(F.count("*").alias("count"), F.max(score).alias("best_score"), best.alias(kept))


def collapse_umi(reads: DataFrame, keys: list[str], umi: str = "umi") -> DataFrame:
    """`count`: distinct UMIs, or reads where they have none; `total_reads`; `has_umi`."""
    known = F.col(umi).isNotNull() & (F.col(umi) != "")
    grouped = reads.groupBy(*keys).agg(F.countDistinct(F.when(known, F.col(umi))).alias("_umis"), F.count("*").alias("total_reads"))
    return grouped.select(*keys, F.when(F.col("_umis") > 0, F.col("_umis")).otherwise(F.col("total_reads")).alias("count"), "total_reads", (F.col("_umis") > 0).alias("has_umi"))


def global_unique(collapsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (sample_id, r1, r2, guide, donor, count): the distinct pairs with their total, and the mappings."""
    keyed = collapsed.withColumn("seq_hash", pair_key(F.col("r1"), F.col("r2")))
    unique = keyed.groupBy("seq_hash").agg(F.min("r1").alias("r1_sequence"), F.min("r2").alias("r2_sequence"), F.sum("count").alias("total_count"))
    return unique, keyed.select("seq_hash", "sample_id", "guide", "donor", "count")


def upsert_unique(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored distinct pairs with new ones added: totals sum up."""
    return stored.unionByName(new).groupBy("seq_hash").agg(F.min("r1_sequence").alias("r1_sequence"), F.min("r2_sequence").alias("r2_sequence"), F.sum("total_count").alias("total_count"))


def upsert_latest(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new replace stored rows with the same key."""
    return stored.join(new.select(key), key, "left_anti").unionByName(new)


def store_statistics(mappings: DataFrame, unique: DataFrame) -> DataFrame:
    """One row: pairs, mappings, samples, reads by single and paired, and distinct (sequence, guide, donor)."""
    paired = F.coalesce(F.col("r2_sequence"), F.lit("")) != ""
    one = unique.agg(F.count("*").alias("unique_pairs"), F.sum(F.when(paired, F.col("total_count")).otherwise(0)).alias("paired_reads"), F.sum(F.when(paired, 0).otherwise(F.col("total_count"))).alias("single_reads"), F.sum("total_count").alias("total_reads"))
    two = mappings.agg(F.count("*").alias("mappings"), F.countDistinct("sample_id").alias("samples"), F.countDistinct("seq_hash", "guide", "donor").alias("combinations"))
    return one.crossJoin(two)  # a row each


def min_count(collapsed: DataFrame, least: int) -> DataFrame:
    return collapsed.where(F.col("count") >= least) if least > 1 else collapsed


def min_global_count(collapsed: DataFrame, key: str, least: int) -> DataFrame:
    """Rows whose key has at least `least` reads over all samples: totals first, as a key may be very common."""
    common = collapsed.groupBy(key).agg(F.sum("count").alias("_total")).where(F.col("_total") >= least).select(key)
    return collapsed.join(common, key, "left_semi")


def top_sequences(collapsed: DataFrame, sample: str, key: str, n: int) -> DataFrame:
    """The n most common sequences of each sample; equal counts by key."""
    order = Window.partitionBy(sample).orderBy(F.desc("count"), F.asc(key))
    return collapsed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def expand(mappings: DataFrame, labels: DataFrame, on: list[str], label: str = "outcome") -> DataFrame:
    """Every sample's sequences with the label that each distinct one got, else NOT_IN_CACHE."""
    return mappings.join(labels, on, "left").withColumn(label, F.coalesce(F.col(label), F.lit("NOT_IN_CACHE")))


def relevant(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return rows.join(wanted.select(key), key, "left_semi")


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")


def once_each(rows: DataFrame, keys: list[str], expensive, *columns: str) -> DataFrame:
    """rows with what an expensive DataFrame function gives for their keys, worked out once per distinct key."""
    return rows.join(expensive(rows.select(*keys).distinct()), keys, "left")


def combinations(mappings: DataFrame) -> DataFrame:
    """Distinct (guide, donor) with a 12-digit id."""
    return mappings.select("guide", "donor").distinct().withColumn("combo_id", F.substring(F.md5(F.concat("guide", F.lit("|"), "donor")), 1, 12))


def trim_umi(reads: DataFrame, umi5: int, trim5: int, umi3: int, trim3: int) -> DataFrame:
    """Reads (r1, r2) less their primers, upper-case, with the UMIs of both ends joined where both have one.
    Pairs with a mate that isn't longer than its trim go."""
    u5, u3 = F.substring("r1", 1, umi5), F.substring("r2", 1, umi3)
    umi = F.when((F.length(u5) > 0) & (F.length(u3) > 0), F.concat_ws("_", u5, u3)).when(F.length(u5) > 0, u5).otherwise(u3)
    long = (F.length("r1") > trim5) & (F.coalesce(F.length("r2"), F.lit(trim3 + 1)) > trim3)
    return reads.where(long).select("*", F.upper(umi).alias("umi")).withColumn("r1", F.upper(F.expr(f"substring(r1, {trim5 + 1})"))).withColumn("r2", F.upper(F.expr(f"substring(r2, {trim3 + 1})")))
