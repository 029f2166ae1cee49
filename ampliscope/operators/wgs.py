"""Whole-genome reads: barcodes by constant flanks, donor windows, variants, structural reads, plasmids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.functions import cigar as C
from ampliscope.functions.dna import apply_variant, piece, reverse_complement
from ampliscope.functions.intervals import clipped_at, contains, duplicate, nested_gap, overlaps
from ampliscope.functions.stats import quantification_start
from ampliscope.operators.dedup import fragment_key
from ampliscope.operators.joins import bridge, interval_join, point_join

# ---- donor windows


def donor_reads(records: DataFrame, windows: DataFrame, blacklist: DataFrame, flex: int = 6, mode: str = "standard") -> DataFrame:
    """Every record (sample, read, flag, rname, pos, cigar, rnext, pnext, tlen; 1-based) over a donor window (sample,
    chrom, donor_start, donor_end) with `action` (include, discard) and `kind` (plasmid, chimeric, genome, or null),
    and whether it covers the window's middle. blacklist: (chrom, start, end), open at both ends."""
    spans = records.withColumn("span", C.span_md(F.col("cigar"))).withColumn("read_end", F.col("pos") + F.col("span")).withColumnRenamed("rname", "chrom")
    rows = interval_join(spans, windows, ["sample", "chrom"], ("pos", "read_end"), ("donor_start", "donor_end"))
    same = F.col("rnext") == "="
    rows = rows.withColumn("_mate", F.when(same, F.col("chrom")).otherwise(F.col("rnext"))).withColumn("_row", F.struct("read", "flag", "pos", "pnext", "cigar"))
    hits = point_join(rows.select(F.col("_mate").alias("chrom"), "pnext").distinct(), blacklist, ["chrom"], "pnext", ("start", "end"), "()").select(F.col("chrom").alias("_mate"), "pnext").distinct()
    rows = rows.join(hits.withColumn("_cassette", F.lit(True)), ["_mate", "pnext"], "left")
    low, high = F.col("donor_start") - flex, F.col("donor_end") + flex
    fragment = F.least("pos", "pnext")
    inside = contains(fragment, fragment + F.abs("tlen") - 1, low, high)
    near, distal = same & (F.abs("tlen") < 1000), F.col("rnext") != "*"
    junction = clipped_at(F.col("donor_start"), F.col("donor_end"), F.col("pos"), F.col("cigar"), flex)
    read_in = contains(F.col("pos"), F.col("read_end") - 1, low, high)
    cassette = F.coalesce("_cassette", F.lit(False))
    action = F.when(near, F.when(inside, "discard").otherwise("include")).when(distal, F.when(cassette & read_in, "discard").otherwise("include")).otherwise("discard")
    kind = F.when(near, F.when(inside, "plasmid").when(junction, "chimeric").otherwise("genome")).when(distal, F.when(cassette, F.when(read_in, "plasmid").otherwise("chimeric")).otherwise("genome"))
    middle = (F.col("donor_start") + F.col("donor_end")) / 2.0
    counts = (near & ~inside) | (~near & distal & ~cassette)
    covers = counts & (F.col("pos") < middle) & (middle < F.col("read_end"))
    return rows.select("sample", "chrom", "donor_start", "donor_end", "read", "flag", "pos", "cigar", action.alias("action"), kind.alias("kind"), duplicate(F.col("flag"), mode).alias("is_dup"), covers.alias("covers"))


def donor_read_counts(classified: DataFrame) -> DataFrame:
    """Reads over the middle, and fragments that aren't duplicates by kind, for each window."""
    own = lambda kind: F.countDistinct(F.when((F.col("kind") == kind) & ~F.col("is_dup"), F.col("read")))
    return classified.groupBy("sample", "chrom", "donor_start", "donor_end").agg(F.sum((F.col("covers") & ~F.col("is_dup")).cast("int")).alias("variant_cov"), own("genome").alias("frags_genome"), own("plasmid").alias("frags_plasmid"), own("chimeric").alias("frags_chimeric"))


def cleaned(records: DataFrame, classified: DataFrame) -> DataFrame:
    """Records of reads that overlap no window, or that are included and never discarded."""
    state = classified.groupBy("sample", "read").agg(F.max((F.col("action") == "discard").cast("int")).alias("_gone"), F.max((F.col("action") == "include").cast("int")).alias("_in"))
    return records.join(state, ["sample", "read"], "left").where(F.col("_gone").isNull() | ((F.col("_gone") == 0) & (F.col("_in") == 1))).drop("_gone", "_in")


def large_deletions(pairs: DataFrame, least: int = 1000) -> DataFrame:
    """Pairs (r1_start, r1_end, r2_start, r2_end) of which one mate lies inside the other's gap."""
    return pairs.where(nested_gap(F.col("r1_start"), F.col("r1_end"), F.col("r2_start"), F.col("r2_end"), least))


def plasmid_integration(reads: DataFrame, junction: int = 1129, window: int = 200, prefix: str = "integrated_plasmid_") -> DataFrame:
    """Reads (sample, rname, start, end, contig_length) across either junction of integrated contigs, per sample."""
    near = reads.where(F.col("rname").startswith(prefix))
    up, down = F.lit(junction), F.col("contig_length") - junction
    over = lambda j: (F.col("start") <= j) & (j < F.col("end"))
    out = near.groupBy("sample").agg(F.sum(over(up).cast("int")).alias("upstream"), F.sum(over(down).cast("int")).alias("downstream"))
    return out.withColumn("total", F.col("upstream") + F.col("downstream")).orderBy(F.desc("total"), "sample")


# ---- variants of donor windows


def bucket(variant: Column, wild: Column, design: Column, synthesised: Column) -> Column:
    """(bucket, before, after): a variant that brings the wild type nearer to the design, or else to what was
    synthesised, or neither."""
    e1, e2 = F.levenshtein(variant, design), F.levenshtein(wild, design)
    e3, e4 = F.levenshtein(variant, synthesised), F.levenshtein(wild, synthesised)
    name = F.when(e1 < e2, "designed").when(e3 < e4, "synthetic_error").otherwise("spontaneous")
    return F.struct(name.alias("bucket"), e2.alias("before"), e1.alias("after"))


def orient(windows: DataFrame, genome: DataFrame) -> DataFrame:
    """windows turned to the genome's strand where their wild type reads the other way (genome: chrom, sequence)."""
    own = windows.join(genome, "chrom", "left")
    there = piece(F.upper("sequence"), F.col("donor_start") - 1, F.col("donor_end"))
    turn = (F.upper("donor_wt") != there) & (reverse_complement(F.upper("donor_wt")) == there)
    for c in ("donor_wt", "donor_design", "donor_step2"):
        own = own.withColumn(c, F.when(turn, reverse_complement(F.upper(c))).otherwise(F.upper(c)))
    return own.drop("sequence")


def _splice(wild: Column, variants: Column) -> Column:
    """wild with (pos0, ref, alt) put in from the right, so that positions stay; all are within it."""
    order = F.array_sort(variants, lambda a, b: b["pos0"] - a["pos0"])
    return F.aggregate(order, wild, lambda s, v: apply_variant(s, v["pos0"], v["ref"], v["alt"]))


def precall(windows: DataFrame, vcf: DataFrame, gvcf: DataFrame, least_depth: int = 1, width: int = 10, share: float = 1.0) -> DataFrame:
    """The editing outcome of each window (sample, chrom, donor_start, donor_end, donor_wt, donor_design, donor_step2)
    from its variants (sample, chrom, pos, ref, alt) and reference blocks (the same with depth; alt: the first)."""
    w = windows.withColumn("_last", F.col("donor_start") + F.length("donor_wt") - 1)
    local = lambda v: point_join(v, w, ["sample", "chrom"], "pos", ("donor_start", "_last"), "[]").withColumn("pos0", F.col("pos") - F.col("donor_start"))
    judged = bucket(apply_variant(F.col("donor_wt"), F.col("pos0"), F.col("ref"), F.col("alt")), F.col("donor_wt"), F.col("donor_design"), F.col("donor_step2"))
    name = F.concat_ws("_", "chrom", F.col("pos").cast("string"), "ref", F.lit("to"), "alt")
    called = local(vcf).where(F.col("pos0") + F.length("ref") < F.length("donor_wt")).withColumn("b", judged).withColumn("name", name).withColumn("sure", F.lit(True))
    taken = called.select("sample", "chrom", "donor_start", F.explode(F.sequence("pos0", F.col("pos0") + F.length("ref") - 1)).alias("p")).distinct()
    blocks = local(gvcf)
    start = quantification_start(F.col("donor_start"), F.col("donor_end"), width)
    covered = blocks.where((F.col("depth") >= least_depth) & (F.col("pos") >= start) & (F.col("pos") <= start + width - 1)).groupBy("sample", "chrom", "donor_start").agg(F.count("*").alias("covered"))
    weak = blocks.where((F.col("alt") != "<NON_REF>") & (F.col("pos0") < F.length("donor_wt") - F.length("ref"))).withColumn("b", judged).withColumn("name", F.concat(F.lit("(LC)"), name)).withColumn("sure", F.lit(False))
    touched = weak.select("sample", "chrom", "donor_start", "name", F.explode(F.sequence("pos0", F.col("pos0") + F.length("ref") - 1)).alias("p")).join(taken, ["sample", "chrom", "donor_start", "p"], "left_semi").select("sample", "chrom", "donor_start", "name").distinct()
    weak = weak.join(touched, ["sample", "chrom", "donor_start", "name"], "left_anti").where("b.bucket != 'spontaneous'")
    columns = ["sample", "chrom", "donor_start", "pos0", "ref", "alt", "b", "name", "sure"]
    key = ["sample", "chrom", "donor_start"]
    both = called.select(*columns).unionByName(weak.select(*columns))
    named = lambda kind: F.array_sort(F.collect_set(F.when(F.col("b.bucket") == kind, F.col("name"))))
    parts = lambda kinds: F.collect_set(F.when(F.col("b.bucket").isin(kinds), F.struct("pos0", "ref", "alt")))
    found = both.groupBy(*key).agg(named("designed").alias("designed"), named("synthetic_error").alias("synthetic"), named("spontaneous").alias("spontaneous"), parts(["designed"]).alias("_d"), parts(["designed", "spontaneous"]).alias("_a"))
    rows = windows.join(found, key, "left").join(covered, key, "left")
    for c, t in (("designed", "string"), ("synthetic", "string"), ("spontaneous", "string"), ("_d", "struct<pos0:int,ref:string,alt:string>"), ("_a", "struct<pos0:int,ref:string,alt:string>")):
        rows = rows.withColumn(c, F.coalesce(F.col(c), F.array().cast(f"array<{t}>")))
    far = lambda s: F.levenshtein(s, F.col("donor_design"))
    one, two = _splice(F.col("donor_wt"), F.col("_d")), _splice(F.col("donor_wt"), F.col("_a"))
    rows = rows.withColumn("_one", far(one)).withColumn("_two", far(two))
    flag = F.when((F.col("_one") == 0) | (F.col("_two") == 0), "designed_variant_installed").when(F.col("_one") < far(F.col("donor_wt")), "designed_variant_partially_installed").when(F.coalesce("covered", F.lit(0)) >= width * share, "designed_variant_unedited").otherwise("unknown")
    promote = (F.col("_one") != 0) & (F.col("_two") == 0)
    rows = rows.withColumn("designed", F.when(promote, F.array_sort(F.array_union("designed", "spontaneous"))).otherwise(F.col("designed"))).withColumn("spontaneous", F.when(promote, F.array().cast("array<string>")).otherwise(F.col("spontaneous")))
    outcome = F.concat(flag, F.when(F.size("synthetic") > 0, ";synthetic_error_installed").otherwise(""), F.when(F.size("spontaneous") > 0, ";spontaneous_mutations").otherwise(""))
    return rows.select(*key, "donor_end", outcome.alias("editing_outcome"), "designed", "synthetic", "spontaneous")


# ---- barcodes


def extract_barcodes(reads: DataFrame, tracks: DataFrame, amplicon_filter: bool = True) -> DataFrame:
    """The barcode of every read that spans a track.

    reads: sample, qname, flag, rname, start (0-based), cigar, seq, rnext, mate_start, tlen, ref_seq, with ref_seq the
    track's contig; tracks: track, rname, bc_start, bc_end (0-based, half-open), turned, and the amplicon's windows
    left_lo, left_hi, right_lo, right_hi (1-based, closed, or null). A read whose mate lies on another contig, and
    one that begins or ends in an amplicon window with a defect there, is a contaminant.
    """
    rows = reads.join(F.broadcast(tracks), "rname").withColumn("_ops", C.operations(F.col("cigar"), F.col("start")))
    rows = rows.withColumn("_len", F.length("seq")).withColumn("end", F.col("start") + C.reference_length(F.col("cigar")))
    low, high = F.col("start") - C.clip_5(F.col("cigar")), F.col("end") + C.clip_3(F.col("cigar"))
    rows = rows.where((low <= F.col("bc_start")) & (high >= F.col("bc_end")))
    hop = (F.col("flag").bitwiseAND(F.lit(8)) != 0) | ((F.col("rnext") != "=") & (F.col("rnext") != F.col("rname")))
    rows = rows.withColumn("_mm", C.mismatches(F.col("_ops"), F.col("seq"), F.col("ref_seq")))
    at_left = ((F.col("start") + 1) >= F.col("left_lo")) & ((F.col("start") + 1) <= F.col("left_hi")) & C.boundary_defect(F.col("_ops"), F.col("_mm"), 5, False, F.col("_len"))
    at_right = (F.col("end") >= F.col("right_lo")) & (F.col("end") <= F.col("right_hi")) & C.boundary_defect(F.col("_ops"), F.col("_mm"), 7, True, F.col("_len"))
    amplicon = F.coalesce(at_left, F.lit(False)) | F.coalesce(at_right, F.lit(False)) if amplicon_filter else F.lit(False)
    n = F.col("bc_end") - F.col("bc_start")
    by_left = F.col("start") < F.col("bc_start")
    left_at = C.query_offset(F.col("_ops"), F.col("bc_start") - 1) + 1
    right_at = C.query_offset(F.col("_ops"), F.col("bc_end")) - n
    at = F.when(by_left, left_at).otherwise(right_at)
    found = F.when((at >= 0) & (at + n <= F.col("_len")), F.substring(F.col("seq"), at + 1, n))
    flank = F.size(F.filter("_mm", lambda p: F.when(by_left, p["ref"] < F.col("bc_start")).otherwise(p["ref"] >= F.col("bc_end"))))
    paired = F.col("mate_start").isNotNull() & (F.col("tlen") != 0)
    key = fragment_key(F.col("start"), F.col("mate_start"), F.col("tlen"), F.col("end"), F.col("cigar"), paired)
    out = rows.withColumn("is_hop", F.coalesce(hop, F.lit(False))).withColumn("is_amplicon", amplicon).withColumn("_bc", F.upper(found))
    bc = F.when(F.col("turned"), reverse_complement(F.col("_bc"))).otherwise(F.col("_bc"))
    return out.select("sample", "track", "qname", "is_hop", "is_amplicon", bc.alias("barcode"), F.when(by_left, "left").otherwise("right").alias("anchor"), flank.alias("flank_mismatches"), key.alias("molecule"))


def top_barcodes(extracted: DataFrame) -> DataFrame:
    """The winner of each sample and track: most molecules, then cleanest flank, then by name; with what speaks for it."""
    clean = extracted.where("not is_hop and not is_amplicon and barcode is not null")
    per = clean.groupBy("sample", "track", "barcode").agg(F.countDistinct("molecule").alias("support"), F.min("flank_mismatches").alias("min_flank_mm"), (F.countDistinct("anchor") == 2).alias("both_anchors"))
    order = Window.partitionBy("sample", "track").orderBy(F.desc("support"), "min_flank_mm", "barcode")
    top = per.withColumn("_n", F.row_number().over(order)).withColumn("n_distinct", F.count("*").over(Window.partitionBy("sample", "track"))).where("_n = 1").drop("_n")
    seen = extracted.groupBy("sample", "track").agg(F.count("*").alias("n_reads_seen"), F.sum(F.col("is_hop").cast("int")).alias("n_contaminant"), F.sum((F.col("is_amplicon") & ~F.col("is_hop")).cast("int")).alias("n_amplicon"))
    return top.join(seen, ["sample", "track"]).withColumn("caller_confidence", F.when(F.col("both_anchors") | (F.col("support") >= 2), "high").otherwise("low"))


def combine_confidence(caller: Column, tier: Column) -> Column:
    return F.when(tier.isin("NONE", "AMBIGUOUS"), "low").when((caller == "high") & (tier == "EXACT"), "high").otherwise("medium")


def call_barcodes(extracted: DataFrame, index: DataFrame, samples: DataFrame) -> DataFrame:
    """One call per sample: the genome track's winner, else the plasmid track's if of high confidence, with its donor."""
    top = top_barcodes(extracted).where("track = 'genome' or caller_confidence = 'high'")
    first = Window.partitionBy("sample").orderBy(F.when(F.col("track") == "genome", 0).otherwise(1))
    best = top.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    known = bridge(best.select("barcode"), index).select("barcode", F.col("tier").alias("bridge_tier"), "oligo", F.col("support").alias("bridge_support"))
    rows = samples.select("sample").distinct().join(best, "sample", "left").join(known, "barcode", "left")
    none = F.col("track").isNull()
    tier = F.coalesce("bridge_tier", F.lit("NONE"))
    return rows.withColumn("bridge_tier", tier).withColumn("confidence", F.when(none, "none").otherwise(combine_confidence(F.col("caller_confidence"), F.col("bridge_tier")))).withColumn("track", F.coalesce("track", F.lit("none"))).withColumn("caller_confidence", F.coalesce("caller_confidence", F.lit("none"))).fillna({"barcode": "", "support": 0, "n_distinct": 0, "n_reads_seen": 0, "n_contaminant": 0, "n_amplicon": 0, "bridge_support": 0, "min_flank_mm": -1, "both_anchors": False})


def overlapping(l1: Column, r1: Column, l2: Column, r2: Column) -> Column:
    return overlaps(l1, r1, l2, r2)
