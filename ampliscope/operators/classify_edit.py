"""Outcome of an aligned read by its edits against a donor's signature (the flagship classifier).

Input: alignments (seq_hash, ref_start, cigar, read_seq, ref_seq, cut_site and a donor_id), one row per
distinct sequence, reference and donor; and a signature table (donor_id, kind, pos, ref, alt). The signature
becomes three small arrays per donor; all the rest is one projection of array expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.functions import cigar as C
from ampliscope.functions.dna import homopolymer
from ampliscope.functions.homology import fuzzy_insertion, indel_homology, near_cut

LABELS = [
    "HDR_COMPLETE", "HDR_PARTIAL", "HDR_PLUS_MMEJ_INDEL", "HDR_PLUS_NHEJ_INDEL", "HDR_PLUS_OTHER", "MMEJ_INDEL", "NHEJ_INDEL",
    "NON_DONOR_NON_NHEJ_INDEL", "NON_DONOR_SNV", "WT", "LOW_QUALITY", "CHIMERIC", "UNMAPPED",
]
EDITS = "array<struct<kind:string,position:int,ref:string,read:string,is_donor:boolean>>"
HDR_ANY = ["HDR_COMPLETE", "HDR_PARTIAL", "HDR_PLUS_MMEJ_INDEL", "HDR_PLUS_NHEJ_INDEL", "HDR_PLUS_OTHER"]


@dataclass(frozen=True)
class Settings:
    snv_distance: int = 50
    chimeric: bool = True
    chimeric_length: int = 30
    chimeric_n: int = 5
    homopolymer: int = 0
    window: int = 1
    least_quality: float = 0.90
    most_mismatches: float = 0.15
    insertion_band: int = 5
    mmej_over: int = 2


def donor_arrays(signature: DataFrame) -> DataFrame:
    """One row per donor with its SNVs, insertions and deletions as arrays."""
    of = lambda kind, *cols: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct(*cols))))
    return signature.groupBy("donor_id").agg(of("snv", "pos", "ref", "alt").alias("d_snvs"), of("insertion", "pos", "alt").alias("d_ins"), of("deletion", "pos", "ref").alias("d_dels"))


def _edit(kind: str, position: Column, ref: Column, read: Column, donor: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), position.cast("int").alias("position"), ref.alias("ref"), read.alias("read"), donor.alias("is_donor"))


def find_edits(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """rows with `edits`, `chimeric` and `mismatched`, the bases that edits of all kinds cover."""
    read, ref = F.upper("read_seq"), F.upper("ref_seq")
    rows = rows.withColumn("_read", read).withColumn("_ref", ref)
    whole = F.coalesce(F.col("cigar"), F.concat(F.length("_read").cast("string"), F.lit("M")))
    rows = rows.withColumn("_ops", C.operations(whole, F.col("ref_start")))
    ops, ins, dels = F.col("_ops"), C.insertions(F.col("_ops"), F.col("_read")), C.deletions(F.col("_ops"), F.col("_ref"))
    rows = rows.withColumn("_ins", ins).withColumn("_dels", dels).withColumn("_mm", C.mismatches(ops, F.col("_read"), F.col("_ref")))
    long_n = F.exists("_ins", lambda i: (i["n"] >= settings.chimeric_length) & (F.length(i["sequence"]) - F.length(F.replace(i["sequence"], F.lit("N"), F.lit(""))) >= settings.chimeric_n))
    counted = lambda a: F.filter(a, lambda x: ~((x["n"] == 1) & (homopolymer(F.col("_ref"), x["position"]) >= settings.homopolymer)))
    if settings.homopolymer > 0:
        rows = rows.withColumn("_ins", counted("_ins")).withColumn("_dels", counted("_dels"))
    snvs = F.transform("_mm", lambda p: _edit("snv", p["ref"], p["ref_base"], p["base"], F.exists("d_snvs", lambda d: (d["pos"] == p["ref"]) & (d["alt"] == p["base"]))))
    inss = F.transform("_ins", lambda i: _edit("insertion", i["position"], F.lit(""), i["sequence"], F.exists("d_ins", lambda d: (F.abs(d["pos"] - i["position"]) <= settings.insertion_band) & fuzzy_insertion(i["sequence"], d["alt"]))))
    delss = F.transform("_dels", lambda x: _edit("deletion", x["position"], x["sequence"], F.lit(""), F.exists("d_dels", lambda d: (d["pos"] == x["position"]) & (d["ref"] == x["sequence"]))))
    rows = rows.withColumn("edits", F.array_sort(F.concat(snvs, inss, delss), lambda a, b: (a["position"] - b["position"])))
    size = lambda e: F.when(e["kind"] == "snv", 1).otherwise(F.length(e["ref"]) + F.length(e["read"]))
    rows = rows.withColumn("mismatched", F.aggregate("edits", F.lit(0), lambda a, e: a + size(e)))
    return rows.withColumn("chimeric", F.coalesce(long_n, F.lit(False)) if settings.chimeric else F.lit(False)).drop("_ops", "_ins", "_dels", "_mm", "_read")


def label(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """rows of find_edits() with counters, the outcome and the donor SNVs seen and missing."""
    edits, cut = F.col("edits"), F.col("cut_site")
    indels = F.filter(edits, lambda e: (e["kind"] != "snv") & ~e["is_donor"])
    judged = F.transform(indels, lambda e: _judge(e, cut, settings))
    rows = rows.withColumn("_indels", judged).withColumn("n_edits", F.size("edits")).withColumn("_donor", F.size(F.filter(edits, lambda e: e["is_donor"])))
    near = F.size(F.filter(edits, lambda e: (e["kind"] == "snv") & ~e["is_donor"] & (F.abs(e["position"] - cut) <= settings.snv_distance)))
    rows = rows.withColumn("n_mmej", F.size(F.filter("_indels", lambda i: i["at_cut"] & i["mmej"]))).withColumn("n_nhej", F.size(F.filter("_indels", lambda i: i["at_cut"] & ~i["mmej"]))).withColumn("n_off_cut", F.size(F.filter("_indels", lambda i: ~i["at_cut"]))).withColumn("n_near_snv", near)
    rows = rows.withColumn("n_expected", F.size("d_snvs") + F.size("d_ins") + F.size("d_dels"))
    length = F.greatest(F.length("read_seq"), F.length("ref_seq"))
    rate = F.col("mismatched") / length
    bad = (length == 0) | ((length - F.col("mismatched")) / length < settings.least_quality) | (rate > settings.most_mismatches)
    donor, other = F.col("_donor"), F.col("n_edits") - F.col("_donor")
    outcome = (
        F.when(bad, "LOW_QUALITY")
        .when(F.col("chimeric"), "CHIMERIC")
        .when(F.col("n_edits") == 0, "WT")
        .when((donor == F.col("n_expected")) & (other == 0), "HDR_COMPLETE")
        .when((donor > 0) & (other == 0), "HDR_PARTIAL")
        .when((donor > 0) & (F.col("n_mmej") > 0), "HDR_PLUS_MMEJ_INDEL")
        .when((donor > 0) & (F.col("n_nhej") > 0), "HDR_PLUS_NHEJ_INDEL")
        .when((donor > 0) & ((F.col("n_off_cut") > 0) | (F.col("n_near_snv") > 0)), "HDR_PLUS_OTHER")
        .when((donor == 0) & (F.col("n_mmej") > 0), "MMEJ_INDEL")
        .when((donor == 0) & (F.col("n_nhej") > 0), "NHEJ_INDEL")
        .when((donor == 0) & (F.col("n_off_cut") > 0), "NON_DONOR_NON_NHEJ_INDEL")
        .when((donor == 0) & (F.col("n_near_snv") > 0), "NON_DONOR_SNV")
        .otherwise("WT")
    )
    rows = rows.withColumn("outcome", F.coalesce(outcome, F.lit("UNMAPPED")))
    void = F.col("outcome").isin("LOW_QUALITY", "CHIMERIC")
    seen = F.transform(F.filter(edits, lambda e: (e["kind"] == "snv") & e["is_donor"]), lambda e: e["position"])
    rows = rows.withColumn("n_donor", F.when(void, 0).otherwise(donor)).withColumn("n_non_donor", F.col("n_edits") - F.col("n_donor"))
    rows = rows.withColumn("donor_fraction", F.coalesce(F.try_divide(F.col("n_donor"), F.col("n_edits")), F.lit(0.0)))
    rows = rows.withColumn("donor_snvs_detected", F.when(void, F.array().cast("array<int>")).otherwise(seen))
    missing = F.filter(F.transform("d_snvs", lambda d: d["pos"]), lambda p: ~F.array_contains("donor_snvs_detected", p))
    return rows.withColumn("donor_snvs_missing", missing).drop("_indels", "_donor", "_ref")


def _judge(e: Column, cut: Column, settings: Settings) -> Column:
    sequence = F.concat(e["ref"], e["read"])
    h = indel_homology(e["kind"], e["position"], sequence, F.col("_ref"))
    at_cut = near_cut(e["kind"], e["position"], sequence, F.col("_ref"), cut, settings.window)
    return F.struct(at_cut.alias("at_cut"), (F.greatest(h["left"], h["right"]) > settings.mmej_over).alias("mmej"))


def classify(alignments: DataFrame, signature: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """alignments with their outcome. Donors without a signature have an empty one. The signature holds a few
    rows for each donor; adaptive execution broadcasts it while it is small."""
    empty = lambda c, t: F.coalesce(F.col(c), F.array().cast(t))
    rows = alignments.join(donor_arrays(signature), "donor_id", "left")
    rows = rows.withColumn("d_snvs", empty("d_snvs", "array<struct<pos:int,ref:string,alt:string>>")).withColumn("d_ins", empty("d_ins", "array<struct<pos:int,alt:string>>")).withColumn("d_dels", empty("d_dels", "array<struct<pos:int,ref:string>>"))
    return label(find_edits(rows, settings), settings).drop("d_snvs", "d_ins", "d_dels")


def classify_multi(alignments: DataFrame, signature: DataFrame, donors: DataFrame, least_gap: float = 5.0, settings: Settings = Settings()) -> DataFrame:
    """Each sequence (seq_hash, expected_donor) against every donor (donor_id, ordinal): the donor that fits
    best, by 10 for a donor edit, -5 for another and 20 for a complete set, over the edits expected."""
    every = alignments.drop("donor_id").join(F.broadcast(donors), how="cross") if donors.count() <= MOST_DONORS else alignments.drop("donor_id").crossJoin(donors)
    scored = classify(every, signature, settings)
    points = 10 * F.col("n_donor") - 5 * F.col("n_non_donor") + F.when(F.col("outcome") == "HDR_COMPLETE", 20).otherwise(0)
    scored = scored.withColumn("score", F.coalesce(F.try_divide(points.cast("double"), F.col("n_expected")), F.lit(0.0)))
    key = Window.partitionBy("seq_hash")
    expected = F.max(F.when(F.col("donor_id") == F.col("expected_donor"), F.col("score"))).over(key)
    first = F.row_number().over(key.orderBy(F.desc("score"), "ordinal"))
    best = scored.withColumn("expected_score", F.coalesce(expected, F.lit(0.0))).withColumn("_n", first).where("_n = 1").drop("_n")
    gap = F.col("score") - F.col("expected_score")
    swap = (F.col("donor_id") != F.col("expected_donor")) & (gap >= least_gap) & (F.col("score") > 0)
    best = best.withColumn("is_sample_swap", F.coalesce(swap, F.lit(False)))
    return best.withColumn("swap_confidence", F.when(F.col("is_sample_swap"), F.least(0.5 + (gap - least_gap) / (2 * least_gap), F.lit(1.0))).otherwise(0.0)).withColumnRenamed("donor_id", "best_donor_id")


#: Donors up to this many are broadcast.
MOST_DONORS = 10_000


def sequencing_mode(r1_mapped: Column, r2_mapped: Column, r1_length: Column, r2_length: Column, snv_span: Column) -> Column:
    """single_end, symmetric (both mates cover 1.2 times the SNVs' span, or 200 bases) or asymmetric."""
    long = ((r1_length >= 1.2 * snv_span) & (r2_length >= 1.2 * snv_span)) | ((r1_length >= 200) & (r2_length >= 200))
    return F.when(~r1_mapped | ~F.coalesce(r2_mapped, F.lit(False)), "single_end").when(long, "symmetric").otherwise("asymmetric")


def merge_pair(r1: Column, r2: Column, confirmed: Column, expected: Column) -> Column:
    """The label of a symmetric pair: equal labels stay, WT yields, of two HDR labels the SNVs that both mates
    confirm decide, else the first mate's."""
    hdr = r1.startswith("HDR") & r2.startswith("HDR")
    return F.when(r1 == r2, r1).when(r1 == "WT", r2).when(r2 == "WT", r1).when(hdr, F.when(F.size(confirmed) == expected, "HDR_COMPLETE").when(F.size(confirmed) > 0, "HDR_PARTIAL").otherwise(r1)).otherwise(r1)


def coverage(positions: Column, r1: tuple[Column, Column], r2: tuple[Column, Column]) -> Column:
    """(mode, uncovered): which mates cover all edit positions."""
    inside = lambda iv: F.filter(positions, lambda p: (p >= iv[0]) & (p < iv[1]))
    a, b = inside(r1), F.coalesce(inside(r2), F.array().cast("array<int>"))
    gone = F.array_except(positions, F.array_union(a, b))
    mode = F.when(F.size(positions) == 0, "no_edits").when(F.size(gone) > 0, "incomplete").when(F.size(a) == F.size(positions), F.when(F.size(b) == F.size(positions), "r1_and_r2").otherwise("r1_only")).when(F.size(b) == F.size(positions), "r2_only").otherwise("r1_and_r2")
    return F.struct(mode.alias("mode"), gone.alias("uncovered"))
