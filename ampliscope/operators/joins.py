"""Joins beyond equality: intervals, bands, one-off barcodes, k-mers. Range joins go through bins, so that
they are equi-joins whatever the size of either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.functions.dna import kmers, neighbours, reverse_complement
from ampliscope.functions.intervals import bins

BIN = 1000


def interval_join(left: DataFrame, right: DataFrame, on: list[str], l_iv: tuple[str, str], r_iv: tuple[str, str], width: int = BIN) -> DataFrame:
    """Pairs of rows whose closed intervals meet, within equal `on` columns. A pair meets once: in the bin
    where the later of the two begins."""
    a = left.withColumn("_bin", F.explode(bins(F.col(l_iv[0]), F.col(l_iv[1]), width)))
    b = right.withColumn("_bin", F.explode(bins(F.col(r_iv[0]), F.col(r_iv[1]), width)))
    met = a.join(b, [*on, "_bin"])
    later = F.greatest(F.col(l_iv[0]), F.col(r_iv[0]))
    meets = (F.col(l_iv[0]) <= F.col(r_iv[1])) & (F.col(r_iv[0]) <= F.col(l_iv[1]))
    return met.where(meets & (F.floor(later / width) == F.col("_bin"))).drop("_bin")


def point_join(points: DataFrame, spans: DataFrame, on: list[str], point: str, span: tuple[str, str], bounds: str = "[)", width: int = BIN) -> DataFrame:
    """Points within intervals; bounds: `[)`, `[]` or `()`."""
    a = points.withColumn("_bin", F.floor(F.col(point) / width).cast("long"))
    b = spans.withColumn("_bin", F.explode(bins(F.col(span[0]), F.col(span[1]), width)))
    p, s, e = F.col(point), F.col(span[0]), F.col(span[1])
    low = p >= s if bounds[0] == "[" else p > s
    high = p <= e if bounds[1] == "]" else p < e
    return a.join(b, [*on, "_bin"]).where(low & high).drop("_bin")


def in_any(points: DataFrame, spans: DataFrame, on: list[str], point: str, span: tuple[str, str], bounds: str = "()", width: int = BIN) -> DataFrame:
    """points with `inside`: whether any interval holds them. Each distinct point is looked up once."""
    at = [*on, point]
    hit = point_join(points.select(*at).distinct(), spans, on, point, span, bounds, width).select(*at).distinct().withColumn("inside", F.lit(True))
    return points.join(hit, at, "left").withColumn("inside", F.coalesce("inside", F.lit(False)))


def band_join(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str, most: int) -> DataFrame:
    """Pairs of rows with |a - b| <= most."""
    spans = right.withColumn("_low", F.col(b) - most).withColumn("_high", F.col(b) + most)
    return point_join(left, spans, on, a, ("_low", "_high"), "[]", max(1, 2 * most)).drop("_low", "_high")


def not_covering(rows: DataFrame, others: DataFrame, on: list[str], span: tuple[str, str], point: str, key: str) -> DataFrame:
    """Rows whose interval [start, end) holds no point of others."""
    hit = point_join(others.select(*on, point), rows.select(key, *on, *span), on, point, span, "[)").select(key).distinct()
    return rows.join(hit, key, "left_anti")


def expected_barcode(samples: DataFrame, manifest: DataFrame, column: str = "expected_barcode") -> DataFrame:
    return samples.join(manifest.select("sample_id", column), "sample_id", "left")


def build_bridge(records: DataFrame, least: int = 0, turned: bool = False) -> DataFrame:
    """(bc1, oligo, support) from (bc1, oligo_name, count): counts that aren't digits are 0, those under `least` go."""
    count = F.when(F.col("count").rlike(r"^\d+$"), F.col("count").cast("long")).otherwise(F.lit(0))
    key = F.upper(reverse_complement(F.col("bc1")) if turned else F.col("bc1"))
    return records.select(key.alias("bc1"), F.col("oligo_name").alias("oligo"), count.alias("n")).where(F.col("n") >= least).groupBy("bc1", "oligo").agg(F.sum("n").alias("support"))


def bridge(barcodes: DataFrame, index: DataFrame, one_off: bool = True) -> DataFrame:
    """(barcode, tier, oligo, support, matched, one_off_neighbour) for distinct barcodes.

    EXACT: the barcode is in the index with one oligo; AMBIGUOUS: with several. Else HD1 if exactly one
    barcode of the index differs in one base, and AMBIGUOUS if several do; else NONE. The oligo is that
    with the most support, the first by name on a tie.
    """
    order = Window.partitionBy("bc1").orderBy(F.desc("support"), "oligo")
    n = F.count("*").over(Window.partitionBy("bc1"))
    best = index.withColumn("_r", F.row_number().over(order)).withColumn("oligos", n).where("_r = 1").drop("_r")
    asked = barcodes.select(F.upper("barcode").alias("barcode")).where("barcode is not null").distinct()
    exact = asked.join(best.withColumnRenamed("bc1", "barcode"), "barcode", "left")
    near = asked.select("barcode", F.explode(neighbours(F.col("barcode"))).alias("bc1")).join(best, "bc1")
    near = near.groupBy("barcode").agg(F.count("*").alias("near"), F.min("bc1").alias("near_bc"), F.min_by("oligo", "bc1").alias("near_oligo"), F.min_by("support", "bc1").alias("near_support"), F.min_by("oligos", "bc1").alias("near_oligos"))
    both = exact.join(near, "barcode", "left")
    hit, single = F.col("oligo").isNotNull(), F.col("near") == 1
    hd1 = ~hit & single & F.lit(one_off)
    tier = F.when(hit & (F.col("oligos") == 1), "EXACT").when(hit, "AMBIGUOUS").when(hd1 & (F.col("near_oligos") == 1), "HD1").when(hd1, "AMBIGUOUS").when(F.lit(one_off) & (F.col("near") > 1), "AMBIGUOUS").otherwise("NONE")
    return both.select(
        "barcode", tier.alias("tier"),
        F.when(hit, F.col("oligo")).when(hd1, F.col("near_oligo")).alias("oligo"),
        F.when(hit, F.col("support")).when(hd1, F.col("near_support")).otherwise(F.lit(0)).cast("long").alias("support"),
        F.when(hit, F.col("barcode")).when(hd1, F.col("near_bc")).alias("matched"),
        F.coalesce(hit & (F.col("near") > 0), F.lit(False)).alias("one_off_neighbour"),
    )


def kmer_hits(reads: DataFrame, key: str, sequence: str, wanted: DataFrame, k: int) -> DataFrame:
    """(key, name, hits): how often k-mers of `wanted` (name, kmer) occur in each read."""
    found = reads.select(key, F.explode(kmers(F.col(sequence), k)).alias("kmer"))
    return found.join(wanted, "kmer").groupBy(key, "name").agg(F.count("*").alias("hits"))


def without_kmers(pairs: DataFrame, key: str, r1: str, r2: str, unwanted: DataFrame, k: int) -> DataFrame:
    """Read pairs of which neither mate holds a k-mer of `unwanted` (kmer)."""
    both = F.concat(kmers(F.col(r1), k), F.coalesce(kmers(F.col(r2), k), F.array().cast("array<string>")))
    hit = pairs.select(key, F.explode(F.array_distinct(both)).alias("kmer")).join(unwanted.select("kmer").distinct(), "kmer", "left_semi").select(key).distinct()
    return pairs.join(hit, key, "left_anti")


def unique_kmers(sequences: DataFrame, others: DataFrame, k: int) -> DataFrame:
    """Distinct k-mers of `sequences` (sequence) that neither `others` nor their reverse complements have."""
    own = sequences.select(F.explode(kmers(F.upper("sequence"), k)).alias("kmer")).distinct()
    out = others.select(F.explode(kmers(F.upper("sequence"), k)).alias("kmer")).distinct()
    return own.join(out.union(out.select(reverse_complement(F.col("kmer")))).distinct(), "kmer", "left_anti")


def method_outer(own: DataFrame, other: DataFrame, key: str = "sample_id") -> DataFrame:
    return own.join(other, key, "full")


def first_known(rows: DataFrame, key: str, columns: list[str], order: Column) -> DataFrame:
    """The first non-null value of each column for each key, in the given order."""
    return rows.groupBy(key).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns))


MANIFEST = ["sample_id", "r1_path", "r2_path", "expected_barcode", "sample_number", "gDNA_plate_num", "Well ID", "sample_ID", "date", "locus", "sequencing_date", "outer_primers", "replicate"]


def manifest(samples: DataFrame, plates: DataFrame, raw_dir: str, locus: str | None = None, replicate: str | None = None) -> DataFrame:
    """A row for each sample and sequencing run of its plate, with its id and FASTQ paths; columns that exist only.
    sample_ID, where samples have it, differs from sample_id by case: select it by position or rename it first."""
    joined = samples.join(plates, "gDNA_plate_num")
    if locus is not None:
        joined = joined.where(F.col("locus") == locus)
    if replicate is not None:
        joined = joined.where(F.col("replicate") == replicate)
    run = F.concat_ws("_", F.col("sequencing_date").cast("string"), "outer_primers", F.col("sample_number").cast("string"))
    path = lambda mate: F.concat(F.lit(f"{raw_dir.rstrip('/')}/fastq/"), run, F.lit(f"_R{mate}.fastq.gz"))
    made = {"sample_id": run, "r1_path": path(1), "r2_path": path(2)}
    if "barcode" in joined.columns:
        made["expected_barcode"] = F.col("barcode")
    return joined.select(*((made[c] if c in made else F.col(f"`{c}`")).alias(c) for c in MANIFEST if c in made or c in joined.columns))


def primer_pair(sample_id: Column, pairs: list[str]) -> Column:
    """The first primer pair whose name a sample id holds, else the first of all."""
    found = F.lit(pairs[0])
    for p in reversed(pairs):
        found = F.when(sample_id.contains(p), p).otherwise(found)
    return found


def by_reference(samples: DataFrame, references: DataFrame) -> DataFrame:
    """samples with the reference of each (sample_id, reference_id), `default` where there is none."""
    return samples.join(references.select("sample_id", "reference_id"), "sample_id", "left").withColumn("reference_id", F.coalesce("reference_id", F.lit("default")))


def flatten_mates(alignments: DataFrame) -> DataFrame:
    """One row per sequence (seq_hash) from alignments (flag, start, end, cigar, seq, mapq, ordinal): the last primary
    record of each mate; reads that aren't paired are first mates."""
    rows = alignments.where(F.col("flag").bitwiseAND(F.lit(0x900)) == 0).withColumn("_mate", F.when(F.col("flag").bitwiseAND(F.lit(0x80)) != 0, 2).otherwise(1))
    last = lambda m, c: F.max_by(c, F.when(F.col("_mate") == m, F.col("ordinal")))
    out = []
    for m in (1, 2):
        there = F.max(F.when(F.col("_mate") == m, F.lit(1))).isNotNull()
        out += [F.when(there, last(m, c)).alias(f"r{m}_{c}") for c in ("start", "end", "cigar", "seq", "mapq", "flag")]
    flat = rows.groupBy("seq_hash").agg(*out, F.max_by((F.col("flag").bitwiseAND(F.lit(2)) != 0), "ordinal").alias("is_proper_pair"))
    for m in (1, 2):
        flag = F.coalesce(F.col(f"r{m}_flag"), F.lit(4))
        flat = flat.withColumn(f"r{m}_is_mapped", flag.bitwiseAND(F.lit(4)) == 0).withColumn(f"r{m}_is_reverse", flag.bitwiseAND(F.lit(16)) != 0).drop(f"r{m}_flag")
    return flat
