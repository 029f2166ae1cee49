"""The other read classifiers. Each has labels and thresholds of its own; they aren't versions of one."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.functions import cigar as C
from ampliscope.functions.dna import reverse_complement, upto
from ampliscope.functions.homology import deletion_mechanism, junction_overlap, overlap
from ampliscope.operators.dedup import best_by_penalty

# ---- by signature


def by_signature(reads: DataFrame, hdr_threshold: float = 0.8, cut_window: int = 5, window: int = 20, large: int = 50, capture_least: int = 30, capture_window: int = 100) -> DataFrame:
    """reads (is_mapped, ref_start, cigar, read_seq, ref_seq, donor_seq, cut_site, signature: array of (pos, alt),
    expected_insertions: array of (pos, alt)) with outcome, confidence and what led to them."""
    rows = reads.withColumn("_read", F.upper("read_seq")).withColumn("_ref", F.upper("ref_seq")).withColumn("_ops", C.operations(F.col("cigar"), F.col("ref_start")))
    cut, ops, sig = F.col("cut_site"), F.col("_ops"), F.col("signature")
    near = (cut - cut_window, cut + cut_window)
    rows = rows.withColumn("_dels", C.deletions(ops, F.col("_ref"), 1, near)).withColumn("_ins", C.insertions(ops, F.col("_read"), 1, near)).withColumn("_mm", C.mismatches(ops, F.col("_read"), F.col("_ref")))
    at = lambda p: C.query_offset(F.col("_ops"), p, extrapolate=False)
    hits = F.transform(F.filter(sig, lambda s: F.substring(F.col("_read"), at(s["pos"]) + 1, F.lit(1)) == s["alt"]), lambda s: s["pos"])
    rows = rows.withColumn("hdr_positions", F.coalesce(hits, F.array().cast("array<int>")))
    n, total = F.size("hdr_positions"), F.size("signature")
    frac = F.coalesce(F.try_divide(n, F.when(total > 0, total)), F.lit(0.0))
    largest = F.element_at(F.array_sort(F.col("_dels"), lambda a, b: F.when(a["n"] != b["n"], b["n"] - a["n"]).otherwise(a["position"] - b["position"])), 1)
    rows = rows.withColumn("hdr_fraction", frac).withColumn("_cut", (F.size("_dels") + F.size("_ins")) > 0).withColumn("_large", F.when(F.size("_dels") > 0, largest))
    mechanism = F.when(F.size("_dels") > 0, deletion_mechanism(F.col("_ref"), F.col("_large.position"), F.col("_large.position") + F.col("_large.n"))).when(F.size("_ins") > 0, "nhej")
    far = C.insertions(ops, F.col("_read"), capture_least, (cut - capture_window, cut + capture_window))
    rows = rows.withColumn("mechanism", mechanism).withColumn("_far", far).withColumn("_donor", F.upper(F.coalesce("donor_seq", F.lit(""))))
    expected = lambda i: F.exists("expected_insertions", lambda e: (F.abs(e["pos"] - i["position"]) <= 10) & (i["sequence"].contains(e["alt"]) | e["alt"].contains(i["sequence"]) | overlap(i["sequence"], e["alt"], 10)))
    captured = F.exists("_far", lambda i: ~expected(i) & (F.col("_donor").contains(i["sequence"]) | reverse_complement(F.col("_donor")).contains(i["sequence"])))
    other = F.exists("_mm", lambda p: (F.abs(p["ref"] - cut) <= window) & ~F.exists("signature", lambda s: s["pos"] == p["ref"]))
    span = F.exists(C.deletions(ops, F.col("_ref"), large, (cut - window - 50, cut + window + 50)), lambda d: (d["position"] <= cut) & (cut <= d["position"] + d["n"]))
    wide = (cut - window, cut + window)
    wild = (F.size(C.deletions(ops, F.col("_ref"), 1, wide)) + F.size(C.insertions(ops, F.col("_read"), 1, wide)) == 0) & ~F.exists("_mm", lambda p: F.abs(p["ref"] - cut) <= window)
    rows = rows.withColumn("_capture", (n > 0) & (F.length("_donor") > 0) & captured).withColumn("_other", other).withColumn("is_large_deletion", span).withColumn("_wild", wild)
    mmej, has_cut, hdr_all = F.col("mechanism") == "mmej", F.col("_cut"), F.col("hdr_fraction") >= hdr_threshold
    cases = [
        (~F.col("is_mapped"), "unmapped", F.lit(1.0)),
        (F.col("_capture"), "donor_capture", F.lit(0.85)),
        ((n > 0) & hdr_all & ~has_cut, "hdr_complete", F.col("hdr_fraction")),
        ((n > 0) & hdr_all & mmej, "hdr_plus_mmej_indel", F.col("hdr_fraction") * 0.9),
        ((n > 0) & hdr_all, "hdr_plus_nhej_indel", F.col("hdr_fraction") * 0.9),
        ((n > 0) & F.col("_other") & ~has_cut, "hdr_plus_other", F.col("hdr_fraction") * 0.8),
        (n > 0, "hdr_partial", F.col("hdr_fraction") * 0.9),
        (has_cut & mmej, "mmej_indel", F.lit(0.9)),
        (has_cut, "nhej_indel", F.lit(0.9)),
        (F.col("_other"), "non_donor_snv", F.lit(0.7)),
        (F.col("_wild"), "wt", F.lit(0.95)),
    ]
    outcome, confidence = F.when(cases[0][0], cases[0][1]), F.when(cases[0][0], cases[0][2])
    for test, name, sure in cases[1:]:
        outcome, confidence = outcome.when(test, name), confidence.when(test, sure)
    rows = rows.withColumn("outcome", outcome.otherwise("unclassified")).withColumn("confidence", confidence.otherwise(0.5))
    return rows.drop("_read", "_ref", "_ops", "_dels", "_ins", "_mm", "_cut", "_large", "_far", "_donor", "_capture", "_other", "_wild")


def captured_insertion(rows: DataFrame, least: int = 10, share: float = 0.8, most_distance: int = 50, flank: int = 15) -> DataFrame:
    """rows (insertions: array of (position, sequence), donor_seq, ref_seq, cut_site) with the first insertion near
    the cut of which the longest start agrees with some window of the donor in 80 % and more of at least `least`
    bases: size, distance, homology with both flanks and its class."""
    donor, ref, cut = F.upper("donor_seq"), F.upper("ref_seq"), F.col("cut_site")
    near = F.filter("insertions", lambda i: (F.length(i["sequence"]) >= least) & (F.abs(i["position"] - cut) <= most_distance))
    same = lambda s, o, n: F.size(F.filter(upto(n), lambda k: F.substring(s, k, F.lit(1)) == F.substring(F.col("_donor"), o + k, F.lit(1))))
    longest = lambda s: F.array_max(F.filter(upto(F.least(F.length(s), F.length("_donor")), least), lambda n: F.exists(upto(F.length("_donor") - n, 0), lambda o: same(s, o, n) >= share * n)))
    rows = rows.withColumn("_donor", donor).withColumn("_ref", ref).withColumn("_near", near)
    hit = F.transform("_near", lambda i: F.struct(i["position"].alias("position"), F.upper(i["sequence"]).alias("sequence"), longest(F.upper(i["sequence"])).alias("matched")))
    rows = rows.withColumn("_hit", F.try_element_at(F.filter(hit, lambda x: x["matched"].isNotNull()), F.lit(1)))
    left = F.right(F.substring(F.col("_ref"), F.lit(1), F.col("_hit.position")), F.lit(flank))
    right = F.substring(F.col("_ref"), F.col("_hit.position") + 1, F.lit(flank))
    junction = junction_overlap(F.col("_hit.sequence"), left, right, flank)
    rows = rows.withColumn("is_donor_capture", F.col("_hit").isNotNull()).withColumn("_j", F.when(F.col("_hit").isNotNull(), junction))
    rows = rows.withColumn("donor_capture_size", F.coalesce(F.length("_hit.sequence"), F.lit(0))).withColumn("donor_capture_distance", F.coalesce(F.abs(F.col("_hit.position") - cut), F.lit(0)))
    rows = rows.withColumn("junction_homology_left", F.coalesce("_j.left", F.lit(0))).withColumn("junction_homology_right", F.coalesce("_j.right", F.lit(0))).withColumn("mmej_class", F.coalesce("_j.class", F.lit("")))
    return rows.drop("_donor", "_ref", "_near", "_hit", "_j")


# ---- by several references


def by_references(alignments: DataFrame, window: int = 10, most_mismatches: int = 5, large: int = 50) -> DataFrame:
    """alignments (is_hdr, nm, ref_start, cigar, ref_seq, cut_site) with PERFECT, IMPERFECT, NHEJ, WT or LARGE_DEL."""
    rows = alignments.withColumn("_ops", C.operations(F.col("cigar"), F.col("ref_start")))
    cut = F.col("cut_site")
    indels = F.filter("_ops", lambda o: o["op"].isin("I", "D"))
    end = lambda o: o["ref"] + F.when(o["op"] == "D", o["n"]).otherwise(0)
    close = F.exists(indels, lambda o: (o["ref"] <= cut + window) & (end(o) >= cut - window))
    big = F.exists("_ops", lambda o: (o["op"] == "D") & (o["n"] >= large))
    few = F.coalesce("nm", F.lit(0)) <= most_mismatches
    hdr = F.when((F.size(indels) > 0) & few, "IMPERFECT").when(F.size(indels) > 0, "NHEJ").when(F.coalesce("nm", F.lit(0)) == 0, "PERFECT").when(few, "IMPERFECT").otherwise("NHEJ")
    wt = F.when(close, "NHEJ").when(few, "WT").otherwise("NHEJ")
    outcome = F.when(big, "LARGE_DEL").when(F.col("is_hdr"), hdr).otherwise(wt)
    return rows.withColumn("outcome", outcome).drop("_ops")


def by_three_aligners(alignments: DataFrame, window: int = 12, large: int = 50, anchor: int = 20, parity: bool = False) -> DataFrame:
    """The best alignment of each read (read_id, aligner, penalty, is_mapped, ref_start, cigar, cut_site), labelled.
    parity: a deletion near the cut overrides a large one, as it does where the first label doesn't end the search."""
    rows = best_by_penalty(alignments, then=("cigar", "ref_start", "is_mapped")).withColumn("_ops", C.operations(F.col("cigar"), F.col("ref_start")))
    cut = F.col("cut_site")
    close = lambda op: F.exists("_ops", lambda o: (o["op"] == op) & (o["ref"] <= cut + window) & (o["ref"] + F.when(o["op"] == "D", o["n"]).otherwise(0) >= cut - window))
    big = F.exists("_ops", lambda o: (o["op"] == "D") & (o["n"] >= large) & (o["ref"] <= cut) & (cut <= o["ref"] + o["n"]) & (C.anchors(F.col("_ops"), o["ref"], o["ref"] + o["n"])["left"] >= anchor) & (C.anchors(F.col("_ops"), o["ref"], o["ref"] + o["n"])["right"] >= anchor))
    label = F.when(~F.col("is_mapped"), "UNMAPPED").when(close("I"), "NHEJ_INSERTION")
    label = label.when(close("D"), "NHEJ_DELETION").when(big, "LARGE_DELETION") if parity else label.when(big, "LARGE_DELETION").when(close("D"), "NHEJ_DELETION")
    return rows.withColumn("outcome", label.when(F.col("penalty") == 0, "WILD_TYPE").otherwise("UNCLASSIFIED")).drop("_ops")


# ---- by k-mers


def kmer_flags(reads: DataFrame, sequence: str, sets: dict[str, list[str]]) -> DataFrame:
    """reads with has_<name> for each short list of k-mers (one locus has a few dozen). Longer lists: joins.kmer_hits."""
    u = F.upper(F.col(sequence))
    return reads.withColumns({f"has_{name}": F.coalesce(reduce(or_, (u.contains(x) for x in sorted(own)), F.lit(False)), F.lit(False)) for name, own in sets.items()})


def kmer_label(wt: Column, hdr: Column, contamination: Column) -> Column:
    return F.when(contamination & ~hdr, "CONTAMINATION").when(hdr & ~wt, "HDR").when(wt & ~hdr, "WT").when(wt & hdr, "AMBIGUOUS").otherwise("UNKNOWN")


def kmer_pair_label(a: Column, b: Column) -> Column:
    """The label of a pair: contamination unless the other mate is HDR, then HDR, WT, AMBIGUOUS if either is."""
    either = lambda x: (a == x) | (b == x)
    return F.when(either("CONTAMINATION") & ~either("HDR"), "CONTAMINATION").when(either("HDR"), "HDR").when(either("WT"), "WT").when(either("AMBIGUOUS"), "AMBIGUOUS").otherwise("UNKNOWN")


def best_template(hits: DataFrame, key: str) -> DataFrame:
    """(key, template, hits): the template with most k-mer hits (key, name, hits); AMBIGUOUS if several have as many."""
    top = F.rank().over(Window.partitionBy(key).orderBy(F.desc("hits")))
    best = hits.where("hits > 0").withColumn("_r", top).where("_r = 1")
    return best.groupBy(key).agg(F.when(F.count("*") == 1, F.min("name")).otherwise("AMBIGUOUS").alias("template"), F.max("hits").alias("hits"))


def hybrid(sequences: DataFrame, by_kmer, by_alignment, key: str = "seq_hash") -> DataFrame:
    """Labels (key, outcome, stage): by k-mers for all, by alignment for what they leave UNKNOWN."""
    first = by_kmer(sequences).select(key, "outcome")
    rest = sequences.join(first.where("outcome = 'UNKNOWN'"), key, "left_semi")
    second = by_alignment(rest).select(key, "outcome").withColumn("stage", F.lit("alignment"))
    return first.where("outcome != 'UNKNOWN'").withColumn("stage", F.lit("kmer")).unionByName(second)


# ---- by combinations of SNVs


def by_combination(reads: DataFrame) -> DataFrame:
    """reads (read_seq, ref_start, snvs: array of (pos, alt)) with the SNVs of the nearest of all 2^N variants: those
    whose base the read has, as the SNVs are independent of each other; a tie goes to the smaller set."""
    at = lambda s: F.substring(F.upper("read_seq"), s["pos"] - F.col("ref_start") + 1, F.lit(1))
    seen = F.transform(F.filter("snvs", lambda s: (s["pos"] >= F.col("ref_start")) & (at(s) == s["alt"])), lambda s: s["pos"])
    rows = reads.withColumn("detected", F.array_sort(seen))
    n, total = F.size("detected"), F.size("snvs")
    return rows.withColumn("outcome", F.when(n == 0, "WT").when(n == total, "HDR_COMPLETE").otherwise("HDR_PARTIAL"))
