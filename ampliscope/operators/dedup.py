"""Keep one row of each key. Every operator states a total order, so that its choice doesn't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Aligners from the most trusted; any other comes after.
PRIORITY = {"bwa": 0, "bbmap": 1, "minimap2": 2}


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key with the smallest order: an aggregate, so that a key with very many rows is reduced
    before it is shuffled. Nulls are smallest; largest() turns a column round."""
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    first = F.min_by(row, F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order))))
    return rows.groupBy(*keys).agg(first.alias("_first")).select("_first.*")


def largest(c: Column | str) -> Column:
    """An order by which the largest number or true comes first, and null last."""
    c = F.col(c) if isinstance(c, str) else c
    return F.struct(c.isNull(), -c.cast("double"))


def aligner_priority(aligner: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in PRIORITY.items() for x in kv)), aligner), F.lit(99))


def best_by_penalty(alignments: DataFrame, key: str = "read_id", then: tuple[str, ...] = ()) -> DataFrame:
    """The alignment with the smallest penalty of each read; on a tie by aligner, then by further columns."""
    return keep_first(alignments, [key], [F.col("penalty"), aligner_priority(F.col("aligner")), F.col("aligner"), *map(F.col, then)])


def best_by_score(alignments: DataFrame, key: str = "read_id") -> DataFrame:
    """The mapped alignment with the best score, then the fewest edits, then the first."""
    score, edits = F.coalesce("score", F.lit(0)), F.coalesce("nm", F.lit(100))
    return keep_first(alignments, [key], [largest("is_mapped"), largest(score), edits, F.col("ordinal")])


def best_pair(r1: DataFrame, r2: DataFrame, key: str = "read_id") -> DataFrame:
    """The aligner with the smallest sum of both mates' penalties, of those that align both."""
    both = r1.select(key, "aligner", F.col("penalty").alias("p1")).join(r2.select(key, "aligner", F.col("penalty").alias("p2")), [key, "aligner"])
    both = both.withColumn("penalty", F.col("p1") + F.col("p2")).where(F.col("penalty") < float("inf"))
    return best_by_penalty(both, key)


def position_dedup(reads: DataFrame, order: str = "read_idx", sample: list[str] | None = None) -> DataFrame:
    """The first read of each (start, end, cigar). The sequence isn't part of the key."""
    return keep_first(reads, [*(sample or []), "start", "end", "cigar"], [F.col(order)])


def pair_dedup(pairs: DataFrame, order: str = "read_idx") -> DataFrame:
    """The first pair of each key of both mates' positions; pairs with an unaligned mate stay."""
    key = ["r1_start", "r1_end", "r2_start", "r2_end", "r1_cigar", "r2_cigar"]
    aligned = F.col("r1_start").isNotNull() & F.col("r2_start").isNotNull()
    return keep_first(pairs.where(aligned), key, [F.col(order)]).unionByName(pairs.where(~aligned))


def umi_dedup(reads: DataFrame, umi: str = "umi", quality: str = "mean_quality", order: str = "read_idx") -> DataFrame:
    """The read of best mean quality for each UMI, the first on a tie."""
    return keep_first(reads, [umi], [largest(quality), F.col(order)])


def best_of_pair(rows: DataFrame, fraction: str, key: str = "read_name", order: str = "read_idx") -> DataFrame:
    return keep_first(rows, [key], [largest(fraction), F.col(order)])


def fragment_key(start: Column, mate_start: Column, template: Column, end: Column, cigar: Column, paired: Column) -> Column:
    """The key of a molecule: both starts and the template length, or the read's own interval and CIGAR."""
    return F.when(paired, F.concat_ws(":", F.lit("P"), F.least(start, mate_start), F.greatest(start, mate_start), F.abs(template))).otherwise(F.concat_ws(":", F.lit("S"), start, end, cigar))


def cluster_by_gap(rows: DataFrame, keys: list[str], position: Column, most: float) -> DataFrame:
    """rows with `cluster`: a new one wherever a position is over `most` past the one before."""
    order = Window.partitionBy(*keys).orderBy("_p")
    gap = F.col("_p") - F.lag("_p").over(order)
    return rows.withColumn("_p", position).withColumn("_new", (gap > most).cast("int")).withColumn("cluster", F.sum(F.coalesce("_new", F.lit(0))).over(order)).drop("_p", "_new")
