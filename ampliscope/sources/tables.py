"""Tables that come and go as tab-separated text: sample keys, sample sheets, intervals, barcodes, results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliscope.functions.dna import null_if_missing, valid_barcode

SAMPLE_FIXED = ["sample_id", "r1_path", "r2_path", "reference", "hdr_template", "guide"]
SHEET = "sample string, chrom string, donor_start_coord int, donor_end_coord int, wt_seq string, design_donor string, synthetic_donor string"


def tsv(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """All columns as text unless a schema is given: ids that look like numbers stay as they are."""
    reader = spark.read.option("sep", "\t").option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def sample_key(spark: SparkSession, path: str) -> DataFrame:
    """Samples with their fixed columns; every other column goes into the map `metadata`. Missing values are null."""
    rows = tsv(spark, path)
    gone = [c for c in SAMPLE_FIXED[:2] if c not in rows.columns]
    if gone:
        raise ValueError(f"a sample key needs the columns {gone}")
    fixed = [(null_if_missing(F.col(c)) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in SAMPLE_FIXED]
    open_ = [c for c in rows.columns if c not in SAMPLE_FIXED]
    pairs = F.array(*(F.struct(F.lit(c).alias("k"), null_if_missing(F.col(f"`{c}`")).alias("v")) for c in open_)) if open_ else None
    meta = F.map_from_entries(F.filter(pairs, lambda x: x["v"].isNotNull())) if open_ else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return rows.select(*fixed, meta.alias("metadata"))


def sample_problems(samples: DataFrame) -> DataFrame:
    """(sample_id, problem): missing paths, repeated ids, and a locus that is given only in part."""
    some = F.coalesce(F.col("reference"), F.col("hdr_template"), F.col("guide")).isNotNull()
    every = F.col("reference").isNotNull() & F.col("hdr_template").isNotNull() & F.col("guide").isNotNull()
    found = samples.select("sample_id", F.explode(F.filter(F.array(F.when(F.col("sample_id").isNull(), "no sample_id"), F.when(F.col("r1_path").isNull(), "no r1_path"), F.when(some & ~every, "partial locus")), lambda x: x.isNotNull())).alias("problem"))
    twice = samples.groupBy("sample_id").count().where("count > 1").select("sample_id", F.lit("repeated sample_id").alias("problem"))
    return found.unionByName(twice)


def custom_locus(samples: DataFrame) -> DataFrame:
    return samples.where("reference is not null and hdr_template is not null and guide is not null")


def sample_key_template(locus: bool = False) -> str:
    """The text of an empty sample key."""
    columns = ["sample_id", "r1_path", "r2_path", *(SAMPLE_FIXED[3:] if locus else []), "condition", "replicate"]
    row = ["sample_1", "/path/to/sample_1_R1.fastq.gz", "/path/to/sample_1_R2.fastq.gz", *(["", "", ""] if locus else []), "control", "1"]
    return "\t".join(columns) + "\n" + "\t".join(row) + "\n"


def samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """Donor windows (sample, chrom, donor_start, donor_end, donor_wt, donor_design, donor_step2), 1-based and closed."""
    r = tsv(spark, path)
    return r.select("sample", "chrom", F.col("donor_start_coord").cast("int").alias("donor_start"), F.col("donor_end_coord").cast("int").alias("donor_end"), F.upper("wt_seq").alias("donor_wt"), F.upper("design_donor").alias("donor_design"), F.upper("synthetic_donor").alias("donor_step2"))


def blacklist(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end); a bound that is no number is 0, which makes an open interval hold nothing."""
    cols = F.split("value", "\t")
    whole = lambda i: F.coalesce(F.get(cols, F.lit(i)).try_cast("int"), F.lit(0))
    return spark.read.text(path).where(F.trim("value") != "").select(cols[0].alias("chrom"), whole(1).alias("start"), whole(2).alias("end"))


def barcodes(rows: DataFrame, column: str = "barcode", id_column: str | None = None) -> DataFrame:
    """(id, barcode): valid barcodes, upper-case, each id once; without an id column the sequence is its own."""
    own = rows.where(valid_barcode(F.col(column))).select(F.upper(F.trim(column)).alias("barcode"), *([F.col(id_column).alias("id")] if id_column else []))
    own = own if id_column else own.withColumn("id", F.col("barcode"))
    return own.groupBy("id").agg(F.min("barcode").alias("barcode"))


def quantification(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Another tool's quantification table by sample (the folder `<tool>_on_<sample>`): rates of all reads aligned."""
    rows = tsv(spark, path).withColumn("sample_id", F.regexp_extract(F.input_file_name(), r"_on_([^/]+)/[^/]*$", 1))
    number = lambda c: F.col(f"`{c}`").try_cast("double")
    return rows.select("sample_id", F.col("Amplicon").alias("amplicon"), number("Modified%").alias("modified_pct"), number("Unmodified%").alias("unmodified_pct"), number("Reads_aligned").alias("reads_aligned"), number("Reads_aligned_all_amplicons").alias("reads_aligned_all"), number("Modified").alias("modified"), number("Unmodified").alias("unmodified"))


def json_rate(text: Column, path: str) -> Column:
    """A percentage of a JSON document as a rate."""
    return F.get_json_object(text, path).try_cast("double") / 100


def locus_config(text: str) -> dict[str, str]:
    """`key: 'value'` lines; no other YAML."""
    found = (re.match(r"\s*([A-Za-z_]\w*)\s*:\s*(.*?)\s*(?:#.*)?$", line) for line in text.splitlines())
    return {m[1]: m[2].strip().strip("'\"") for m in found if m}


def locus(value: str) -> tuple[str, int, int]:
    """`chrom:start-end`, 1-based and closed."""
    chrom, _, span = value.rpartition(":")
    start, end = (int(x.replace(",", "")) for x in span.split("-"))
    return chrom, start, end


# ---- sinks

#: Columns of the sample results and their number of decimals.
RESULT_FORMATS = {"pct": 2, "large_del_pct": 3, "rate": 4}


def formatted(rows: DataFrame, decimals: dict[str, int]) -> DataFrame:
    """Numeric columns as text with fixed decimals; others as they are."""
    return rows.select(*(F.format_string(f"%.{decimals[c]}f", F.col(c).cast("double")).alias(c) if c in decimals else F.col(c) for c in rows.columns))


def write_tsv(rows: DataFrame, path: str, gzip: bool = False, mode: str = "overwrite") -> None:
    """A folder of tab-separated parts with a header each; the committer makes it whole or leaves nothing."""
    flat = rows.select(*(F.array_join(F.col(c).cast("array<string>"), ",").alias(c) if t.startswith("array") else F.to_json(c).alias(c) if t.startswith(("map", "struct")) else F.col(c) for c, t in rows.dtypes))
    flat.write.mode(mode).option("sep", "\t").option("header", True).option("compression", "gzip" if gzip else "none").csv(path)


def write_store(rows: DataFrame, path: str, mode: str = "overwrite", partition: str | None = None) -> None:
    writer = rows.write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def export_sqlite(rows: DataFrame, table: str) -> DataFrame:
    """(value): INSERT statements of a table, for stores that take SQL text."""
    quoted = F.concat_ws(", ", *(F.coalesce(F.concat(F.lit("'"), F.replace(F.col(c).cast("string"), F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL")) for c in rows.columns))
    return rows.select(F.concat(F.lit(f"INSERT INTO {table} VALUES ("), quoted, F.lit(");")).alias("value"))


def page(rows: DataFrame, order: list[str], size: int, number: int) -> DataFrame:
    """The number-th page of rows in a total order."""
    return rows.orderBy(*order).offset(size * number).limit(size)


def report(rows: DataFrame, sample: str, reads: str, hdr: str, top: int = 10) -> str:
    """A Markdown report: totals, mean, least and most HDR, and the samples with the most."""
    t = rows.agg(F.count("*").alias("n"), F.sum(reads).alias("reads"), F.avg(hdr).alias("mean"), F.max(hdr).alias("most"), F.min(hdr).alias("least")).first()
    text = ["# Editing summary", "", f"- Samples: {t['n']}", f"- Reads: {t['reads'] or 0}"]
    if t["n"]:
        text += [f"- HDR mean {t['mean']:.2f} %, from {t['least']:.2f} % to {t['most']:.2f} %", "", "| Sample | HDR % | Reads |", "|---|---|---|"]
        text += [f"| {r[sample]} | {r[hdr]:.2f} | {r[reads]} |" for r in rows.orderBy(F.desc(hdr), sample).limit(top).collect()]
    return "\n".join(text) + "\n"
