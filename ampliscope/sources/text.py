"""Readers of FASTQ, FASTA, SAM, VCF and gVCF text. Records keep the order of their lines.

A file's lines are numbered with a range-partitioned pass over (file, block) where files are split; a gzip file
is one block. Numbers come from Spark's own line order within a file (`_metadata.file_block_start` and the line's
place in its block), never from monotonically_increasing_id after a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, idx, line): idx counts from 0 in each file.

    Within a partition, increasing ids follow line order; blocks of a file are brought in order by what precedes
    each, from one row per block. Empty lines count.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    blocks = raw.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return raw.join(blocks, ["file", "block"]).select("file", (F.col("id") - F.col("first") + F.col("before")).alias("idx"), "line")


def fastq(spark: SparkSession, path: str | list[str], most: int | None = None) -> DataFrame:
    """(file, read_idx, header, seq, plus, qual, count): `;count=N` or `;size=N` of a header, else 1; `valid` where the
    record begins with @ and +. most: reads up to that many by count."""
    four = lines(spark, path).groupBy("file", F.expr("idx div 4").alias("read_idx")).agg(*(F.max(F.when(F.col("idx") % 4 == i, F.col("line"))).alias(n) for i, n in enumerate(("header", "seq", "plus", "qual"))))
    n = F.regexp_extract("header", r";(?:count|size)=(\d+)", 1)
    out = four.withColumn("count", F.coalesce(n.try_cast("long"), F.lit(1))).withColumn("valid", F.coalesce(F.col("header").startswith("@") & F.col("plus").startswith("+"), F.lit(False)))
    if most is None:
        return out
    before = F.sum("count").over(Window.partitionBy("file").orderBy("read_idx").rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < most).drop("_before")


def fastq_pairs(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """R1 and R2 by ordinal; a read without its mate is an error when it is read."""
    a = r1.select("read_idx", F.col("header").alias("header1"), F.col("seq").alias("r1"), F.col("qual").alias("q1"))
    b = r2.select("read_idx", F.col("seq").alias("r2"), F.col("qual").alias("q2"))
    whole = a.join(b, "read_idx", "full")
    return whole.where(F.coalesce(F.assert_true(F.col("r1").isNotNull() & F.col("r2").isNotNull(), F.lit("R1 and R2 differ in length")).isNull(), F.lit(True)))


def count_reads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.expr("count(*) div 4").alias("reads"))


def fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, ordinal, name, sequence): every record, upper-case, named by its first word."""
    rows = lines(spark, path).withColumn("line", F.trim("line")).where("line != ''")
    order = Window.partitionBy("file").orderBy("idx")
    rows = rows.withColumn("ordinal", F.sum(F.col("line").startswith(">").cast("int")).over(order)).where("ordinal > 0")
    name = F.max(F.when(F.col("line").startswith(">"), F.regexp_extract("line", r"^>\s*(\S*)", 1)))
    parts = F.array_sort(F.collect_list(F.when(~F.col("line").startswith(">"), F.struct("idx", "line"))))
    return rows.groupBy("file", "ordinal").agg(name.alias("name"), F.upper(F.array_join(F.transform(parts, lambda x: x["line"]), "")).alias("sequence"))


def first_sequence(spark: SparkSession, path: str) -> str:
    return fasta(spark, path).orderBy("ordinal").first()["sequence"]


def sequence_or_file(spark: SparkSession, value: str) -> str:
    """A DNA string as it is, else the first sequence of the file that it names."""
    import re

    return value.upper() if re.fullmatch("[ACGTacgtNn]+", value) and len(value) < 1000 else first_sequence(spark, value)


SAM = [("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "int"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "int"), ("tlen", "int"), ("seq", "string"), ("qual", "string")]


def _tag(tags: Column, name: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(tags, F.lit(rf"(?:^|\t){name}:[A-Za-z]:([^\t]*)"), F.lit(1)), F.lit(1))


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignment lines of SAM text with the tags NM, MD and AS. Positions stay 1-based, as in the file."""
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.length("value") > 0))
    cols = F.split("value", "\t")
    out = rows.select(F.col("_metadata.file_path").alias("file"), *(F.get(cols, F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(SAM)), F.concat_ws("\t", F.slice(cols, 12, 1000)).alias("_tags"))
    return out.withColumn("nm", _tag(F.col("_tags"), "NM").try_cast("int")).withColumn("md", _tag(F.col("_tags"), "MD")).withColumn("score", _tag(F.col("_tags"), "AS").try_cast("int")).drop("_tags")


def window_of(alignments: DataFrame, rname: str, start: int, end: int) -> DataFrame:
    """Alignments over [start, end) (0-based columns start and end); pushed down to Parquet."""
    return alignments.where((F.col("rname") == rname) & (F.col("start") < end) & (F.col("end") > start))


def vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chrom, pos, ref, alt) of all records, whatever their FILTER."""
    cols = F.split("value", "\t")
    return spark.read.text(path).where(~F.col("value").startswith("#") & (F.length("value") > 0)).select(F.col("_metadata.file_path").alias("file"), cols[0].alias("chrom"), cols[1].cast("int").alias("pos"), cols[3].alias("ref"), cols[4].alias("alt"))


def gvcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As vcf(), with the first ALT and the reference depth: the first value of the sample's second field."""
    cols = F.split("value", "\t")
    depth = F.split(F.get(F.split(F.get(cols, F.lit(9)), ":"), F.lit(1)), ",")[0].try_cast("int")
    return spark.read.text(path).where(~F.col("value").startswith("#") & (F.length("value") > 0)).select(F.col("_metadata.file_path").alias("file"), cols[0].alias("chrom"), cols[1].cast("int").alias("pos"), cols[3].alias("ref"), F.split(cols[4], ",")[0].alias("alt"), F.coalesce(depth, F.lit(0)).alias("depth"))


# ---- writers


def fasta_lines(rows: DataFrame, name: str, sequence: str, width: int = 80) -> DataFrame:
    """FASTA text (value), sorted by name, the sequence wrapped."""
    wrapped = F.regexp_replace(F.col(sequence), f"(.{{{width}}})(?=.)", "$1\n")
    return rows.orderBy(name).select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), wrapped).alias("value"))


def fastq_lines(rows: DataFrame, name: str, sequence: str) -> DataFrame:
    """FASTQ text (value) with the quality I throughout."""
    return rows.select(F.concat(F.lit("@"), F.col(name), F.lit("\n"), F.col(sequence), F.lit("\n+\n"), F.repeat(F.lit("I"), F.length(sequence))).alias("value"))
