"""End to end: a sample key and a locus to the table of outcomes.

reads -> distinct per sample -> distinct over all -> aligned once -> classified once -> back to samples by count.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliscope.operators import classify_edit, classify_more, collapse, kmers, outcomes
from ampliscope.operators.align_reads import align_distinct
from ampliscope.sources import text
from ampliscope.sources.config import Locus


#: A local file's scheme is written with one slash or three.
LOCAL = "^file:/+"


def whole_path(spark: SparkSession, path: str) -> str:
    """A path as Spark names a file, with its folder, so that equal names in two folders stay apart."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub(LOCAL, "/", where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri().toString())


def read_samples(spark: SparkSession, samples: DataFrame, most: int | None = None) -> DataFrame:
    """(sample_id, sequence, count): the distinct first reads of every sample, all files in one scan."""
    rows = samples.select("r1_path", "sample_id").distinct().collect()  # a row per file and sample
    reads = text.fastq(spark, sorted({r["r1_path"] for r in rows}), most)
    own = spark.createDataFrame([(whole_path(spark, r["r1_path"]), r["sample_id"]) for r in rows], "file string, sample_id string")
    named = reads.withColumn("file", F.regexp_replace("file", LOCAL, "/")).join(own, "file")
    return collapse.collapse(named.where("valid").select("sample_id", F.upper("seq").alias("sequence"), "count"), ["sample_id", "sequence"], F.col("count"))


def classify_samples(collapsed: DataFrame, locus: Locus, least_global: int = 1, settings: classify_edit.Settings = classify_edit.Settings()) -> DataFrame:
    """(sample_id, seq_hash, count, outcome, ...): every sequence aligned and judged once, joined back."""
    spark = collapsed.sparkSession
    keyed = collapse.min_global_count(collapsed, "sequence", least_global).withColumn("seq_hash", F.md5("sequence"))
    distinct = keyed.select("seq_hash", "sequence").distinct().withColumn("ref_seq", F.lit(locus.reference))
    donor = next(iter(locus.signatures))
    aligned = align_distinct(distinct).withColumns({"ref_seq": F.lit(locus.reference), "cut_site": F.lit(locus.cleavage), "donor_id": F.lit(donor)})
    judged = classify_edit.classify(aligned.where("is_mapped"), locus.table(spark), settings)
    labels = judged.select("seq_hash", "outcome", "n_donor", "n_non_donor", "donor_fraction", "donor_snvs_detected")
    lost = aligned.where("not is_mapped").select("seq_hash", F.lit("UNMAPPED").alias("outcome"), F.lit(0).alias("n_donor"), F.lit(0).alias("n_non_donor"), F.lit(0.0).alias("donor_fraction"), F.array().cast("array<int>").alias("donor_snvs_detected"))
    return collapse.expand(keyed.drop("sequence"), labels.unionByName(lost), ["seq_hash"])


def run(spark: SparkSession, samples: DataFrame, locus: Locus, least_global: int = 1) -> DataFrame:
    """The outcome table of all samples."""
    return outcomes.weighted_table(classify_samples(read_samples(spark, samples), locus, least_global), samples=samples)


def run_templates(collapsed: DataFrame, locus: Locus) -> DataFrame:
    """(sample_id, template, reads) by k-mers that only one template has."""
    k, sets = kmers.template_sets(locus.reference, locus.templates, locus.positions(), 12)
    wanted = collapsed.sparkSession.createDataFrame([(name, x) for name, own in sets.items() for x in sorted(own)], "name string, kmer string")
    from ampliscope.operators.joins import kmer_hits

    keyed = collapsed.withColumn("seq_hash", F.md5("sequence"))
    hits = kmer_hits(keyed.select("seq_hash", "sequence").distinct(), "seq_hash", "sequence", wanted, k)
    best = classify_more.best_template(hits, "seq_hash")
    return keyed.join(best, "seq_hash", "left").groupBy("sample_id", F.coalesce("template", F.lit("NONE")).alias("template")).agg(F.sum("count").alias("reads"))
