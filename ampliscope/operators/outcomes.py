"""Labels to numbers: outcome counts, rates and roll-ups per sample, SNV integration, swaps, per-template rows.

Two roll-ups of the same labels exist and stay apart: summarize() (per read, all labels, HDR total of five)
and weighted_table() (weighted, with percentages, HDR total of two).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIG_LABELS = ["hdr_complete", "hdr_partial", "hdr_plus_nhej_indel", "hdr_plus_mmej_indel", "hdr_plus_other", "donor_capture", "nhej_indel", "mmej_indel", "wt", "non_donor_snv", "unclassified", "unmapped"]
HDR_5 = SIG_LABELS[:5]
#: Columns of the sample table: counts by label, then sums of them, then percentages.
TABLE_COUNTS = {
    "HDR_COMPLETE": ["HDR_COMPLETE"], "HDR_PARTIAL": ["HDR_PARTIAL"], "NHEJ_INDEL": ["NHEJ_INDEL"], "MMEJ_INDEL": ["MMEJ_INDEL"],
    "HDR_PLUS_NHEJ_INDEL": ["HDR_PLUS_NHEJ_INDEL"], "HDR_PLUS_MMEJ_INDEL": ["HDR_PLUS_MMEJ_INDEL"], "HDR_PLUS_OTHER": ["HDR_PLUS_OTHER"],
    "NON_NHEJ_INDEL": ["NON_DONOR_NON_NHEJ_INDEL"], "NON_DONOR_SNV": ["NON_DONOR_SNV"], "DONOR_CAPTURE": ["DONOR_CAPTURE"], "CHIMERIC": ["CHIMERIC"], "WT": ["WT"], "UNALIGNED": ["UNALIGNED", "UNMAPPED"],
}
TABLE_SUMS = {"HDR_total": ["HDR_COMPLETE", "HDR_PARTIAL"], "NHEJ_MMEJ_indel": ["NHEJ_INDEL", "MMEJ_INDEL"], "HDR_PLUS_NHEJ_MMEJ_indel": ["HDR_PLUS_NHEJ_INDEL", "HDR_PLUS_MMEJ_INDEL"]}
TABLE_PERCENT = {
    "HDR_pct": ["HDR_total"], "NHEJ_pct": ["NHEJ_INDEL"], "MMEJ_pct": ["MMEJ_INDEL"], "NHEJ_MMEJ_pct": ["NHEJ_MMEJ_indel"], "HDR_PLUS_NHEJ_pct": ["HDR_PLUS_NHEJ_INDEL"], "HDR_PLUS_MMEJ_pct": ["HDR_PLUS_MMEJ_INDEL"],
    "HDR_PLUS_NHEJ_MMEJ_pct": ["HDR_PLUS_NHEJ_MMEJ_indel"], "HDR_PLUS_OTHER_pct": ["HDR_PLUS_OTHER"], "WT_pct": ["WT"], "edited_pct": ["HDR_total", "NHEJ_MMEJ_indel", "HDR_PLUS_NHEJ_MMEJ_indel", "HDR_PLUS_OTHER"],
    "off_target_pct": ["NON_NHEJ_INDEL", "NON_DONOR_SNV"], "chimeric_pct": ["CHIMERIC"], "donor_capture_pct": ["DONOR_CAPTURE"],
}


def count_of(labels: list[str], outcome: str = "outcome", weight: str | None = None) -> Column:
    unit = F.lit(1) if weight is None else F.col(weight)
    return F.coalesce(F.sum(F.when(F.col(outcome).isin(labels), unit).otherwise(0)), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


def summarize(reads: DataFrame, keys: list[str], outcome: str = "outcome") -> DataFrame:
    """Counts of every label per key, rates of classifiable reads, and roll-ups."""
    named = [count_of([x], outcome).alias(x) for x in SIG_LABELS]
    out = reads.groupBy(*keys).agg(F.count("*").alias("total"), *named)
    total = lambda names: sum((F.col(n) for n in names[1:]), F.col(names[0]))
    out = out.withColumn("classifiable", F.col("total") - F.col("unmapped")).withColumn("hdr_total", total(HDR_5)).withColumn("nhej_mmej_total", total(["nhej_indel", "mmej_indel"]))
    out = out.withColumn("edited_total", F.col("hdr_total") + F.col("nhej_mmej_total") + F.col("donor_capture"))
    return out.select("*", *(F.coalesce(F.try_divide(F.col(n), F.col("classifiable")), F.lit(0.0)).alias(f"{n}_rate") for n in [*SIG_LABELS[:-1], "hdr_total", "nhej_mmej_total", "edited_total"]))


def weighted_table(rows: DataFrame, sample: str = "sample_id", outcome: str = "outcome", count: str | None = "count", samples: DataFrame | None = None) -> DataFrame:
    """Reads by label for each sample, weighted, with percentages of all its reads. Labels without a column of their
    own count in the total only. samples: those without a row get zeros."""
    unit = F.lit(1) if count is None else F.col(count)
    out = rows.groupBy(sample).agg(F.sum(unit).alias("total_reads"), *(count_of(v, outcome, count).alias(k) for k, v in TABLE_COUNTS.items()))
    if samples is not None:
        out = samples.select(sample).distinct().join(out, sample, "left").fillna(0)
    add = lambda names: sum((F.col(n) for n in names[1:]), F.col(names[0]))
    out = out.select("*", *(add(v).alias(k) for k, v in TABLE_SUMS.items()))
    return out.select("*", *(percent(add(v), F.col("total_reads")).alias(k) for k, v in TABLE_PERCENT.items()))


def reference_summary(rows: DataFrame, keys: list[str], expected: Column) -> DataFrame:
    """Weighted counts of reads by label of the several-reference classifier, and of those with the expected template."""
    n = F.col("count")
    some = lambda *x: F.coalesce(F.sum(F.when(F.col("outcome").isin(*x), n)), F.lit(0))
    out = rows.groupBy(*keys).agg(F.sum(n).alias("total"), some("WT").alias("wt"), some("PERFECT").alias("hdr_perfect"), some("IMPERFECT").alias("hdr_imperfect"), some("NHEJ").alias("nhej"), some("LARGE_DEL").alias("large_deletion"), F.coalesce(F.sum(F.when(F.col("outcome").isin("PERFECT", "IMPERFECT") & (F.col("template") == expected), n)), F.lit(0)).alias("expected_hdr"))
    return out.withColumn("hdr_rate", F.coalesce(F.try_divide(F.col("hdr_perfect") + F.col("hdr_imperfect"), F.col("total")), F.lit(0.0)))


def by_template(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted reads of each template and label."""
    return rows.where("template is not null").groupBy(*keys, "template", "outcome").agg(F.sum("count").alias("count"))


def kmer_rates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of k-mer labels; rates of what is WT or HDR."""
    names = ["WT", "HDR", "AMBIGUOUS", "CONTAMINATION", "UNKNOWN"]
    out = rows.groupBy(*keys).agg(F.count("*").alias("total"), *(count_of([x]).alias(x.lower()) for x in names))
    known = F.col("wt") + F.col("hdr")
    return out.withColumn("wt_rate", F.coalesce(F.try_divide(F.col("wt"), known), F.lit(0.0))).withColumn("hdr_rate", F.coalesce(F.try_divide(F.col("hdr"), known), F.lit(0.0)))


def snv_integration(rows: DataFrame, keys: list[str], signature: DataFrame, cut: int, weight: Column | None = None, labels: tuple = ("HDR_COMPLETE", "HDR_PARTIAL", "MIXED")) -> DataFrame:
    """How often each donor SNV (pos) was seen in HDR reads: count, frequency and distance from the cut."""
    n = F.lit(1) if weight is None else weight
    hdr = rows.where(F.col("outcome").isin(*labels)).withColumn("_n", n)
    total = hdr.groupBy(*keys).agg(F.sum("_n").alias("hdr_reads"))
    seen = hdr.select(*keys, "_n", F.explode("donor_snvs_detected").alias("pos")).groupBy(*keys, "pos").agg(F.sum("_n").alias("count"))
    every = total.join(F.broadcast(signature.select("pos").distinct()), how="cross") if not keys else total.crossJoin(F.broadcast(signature.select("pos").distinct()))
    out = every.join(seen, [*keys, "pos"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return out.withColumn("frequency", F.coalesce(F.try_divide(F.col("count"), F.col("hdr_reads")), F.lit(0.0))).withColumn("distance", F.col("pos") - cut)


def partial_breakdown(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.where("outcome = 'HDR_PARTIAL'").groupBy(*keys, F.size("donor_snvs_detected").alias("n_snvs")).agg(F.count("*").alias("reads"))


def cooccurrence(rows: DataFrame, keys: list[str], positions: str = "donor_snvs_detected") -> DataFrame:
    """(a, b, both, either, jaccard) of SNV pairs: pairs are made within each read's own short list."""
    own = F.array_sort(F.array_distinct(F.col(positions)))
    one = rows.select(*keys, F.explode(own).alias("p")).groupBy(*keys, "p").agg(F.count("*").alias("n"))
    each = rows.select(*keys, own.alias("s")).select(*keys, F.explode("s").alias("a"), "s").select(*keys, "a", F.explode("s").alias("b")).where("a < b")
    both = each.groupBy(*keys, "a", "b").agg(F.count("*").alias("both"))
    for end in ("a", "b"):
        both = both.join(one.select(*keys, F.col("p").alias(end), F.col("n").alias(f"n_{end}")), [*keys, end])
    out = both.withColumn("either", F.col("n_a") + F.col("n_b") - F.col("both"))
    return out.select(*keys, "a", "b", "both", "either", (F.col("both") / F.col("either")).alias("jaccard"))


def swap_summary(rows: DataFrame, sample: str = "sample_id", donor: str = "best_donor_id", expected: str = "expected_donor", count: str = "count") -> DataFrame:
    """Of each sample's HDR reads by donor: the commonest, and whether it is a swap: another than expected, with
    more reads than that, and over half of all."""
    per = rows.groupBy(sample, expected, donor).agg(F.sum(count).alias("n"))
    out = per.groupBy(sample, expected).agg(F.sum("n").alias("total_hdr_reads"), F.max_by(donor, F.struct("n", F.col(donor))).alias("detected_donor"), F.max(F.struct("n", F.col(donor)))["n"].alias("swap_reads"), F.coalesce(F.sum(F.when(F.col(donor) == F.col(expected), F.col("n"))), F.lit(0)).alias("expected_reads"))
    share = F.col("swap_reads") / F.col("total_hdr_reads")
    swap = (F.col("detected_donor") != F.col(expected)) & (F.col("swap_reads") > F.col("expected_reads")) & (share > 0.5)
    return out.withColumn("swap_fraction", share).withColumn("is_swap", swap).withColumn("confidence", share)


def capture_statistics(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.where("is_donor_capture").groupBy(*keys, "mmej_class").agg(F.count("*").alias("n"), F.avg("donor_capture_size").alias("mean_size"), F.avg("donor_capture_distance").alias("mean_distance"))


def histogram(rows: DataFrame, keys: list[str], column: str, count: str | None = None) -> DataFrame:
    return rows.groupBy(*keys, column).agg((F.count("*") if count is None else F.sum(count)).alias("reads"))


def granular(results: DataFrame, key: str, names: list[str]) -> DataFrame:
    """One row per sample and non-zero count column."""
    return results.unpivot([key], names, "category", "count").where(F.col("count") > 0)


def library_rates(reads: Column, unique: Column, duplicates: Column) -> list[Column]:
    """Duplicate rate, dedup rate and compression."""
    return [F.coalesce(F.try_divide(duplicates, reads), F.lit(0.0)).alias("duplicate_rate"), F.coalesce(F.try_divide(unique, reads), F.lit(0.0)).alias("dedup_rate"), F.coalesce(F.try_divide(reads, unique), F.lit(0.0)).alias("compression")]
