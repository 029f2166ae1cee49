"""The test tables as the engine's tables, and the registry that queries enter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


#: Documents as reads: the letters A, C, G and T of a text; a source is a sample.
DNA = "SELECT doc_id, source AS sample_id, lang, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS dna FROM documents"


def dna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("sample_id"), "lang", F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("dna"))


#: Events as labelled reads: a user is a sample, the value's whole part the read count.
LABEL = {"click": "HDR_COMPLETE", "view": "WT", "purchase": "NHEJ_INDEL", "signup": "HDR_PLUS_MMEJ_INDEL", "error": "LOW_QUALITY"}
EVENTS = "SELECT event_id, user_id AS sample_id, ts, value, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABEL.items()) + " ELSE 'UNMAPPED' END AS outcome, (floor(abs(value)) + 1)::BIGINT AS count FROM events"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(*(F.lit(x) for kv in LABEL.items() for x in kv))
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("sample_id"), "ts", "value", F.coalesce(F.element_at(names, F.col("event_type")), F.lit("UNMAPPED")).alias("outcome"), (F.floor(F.abs("value")) + 1).cast("long").alias("count"))


#: Line items as alignments: an order is a read, a line an aligner's result.
LINES = """SELECT l_orderkey AS read_id, l_linenumber AS ordinal, l_suppkey, l_partkey, l_quantity, l_extendedprice, l_discount, l_returnflag,
  CASE l_linenumber % 4 WHEN 0 THEN 'minimap2' WHEN 1 THEN 'bwa' WHEN 2 THEN 'bbmap' ELSE 'other' END AS aligner, floor(l_quantity / 5)::DOUBLE AS penalty,
  l_quantity::BIGINT || 'M' || l_linenumber || CASE l_returnflag WHEN 'A' THEN 'I' WHEN 'N' THEN 'D' ELSE 'S' END || (l_partkey % 30 + 1) || 'M' AS cigar,
  l_partkey AS start, l_linenumber % 3 > 0 AS is_mapped, (l_quantity::BIGINT % 7)::BIGINT AS nm, (l_partkey % 11)::BIGINT AS score FROM lineitem"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    n, op = F.col("l_linenumber"), F.when(F.col("l_returnflag") == "A", "I").when(F.col("l_returnflag") == "N", "D").otherwise("S")
    aligner = F.when(n % 4 == 0, "minimap2").when(n % 4 == 1, "bwa").when(n % 4 == 2, "bbmap").otherwise("other")
    quantity = whole(F.rint("l_quantity"))  # as SQL casts: halves to the even number
    cigar = F.concat(quantity, F.lit("M"), n, op, F.col("l_partkey") % 30 + 1, F.lit("M"))
    return t.select(
        F.col("l_orderkey").alias("read_id"), n.alias("ordinal"), "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", aligner.alias("aligner"), F.floor(F.col("l_quantity") / 5).cast("double").alias("penalty"),
        cigar.alias("cigar"), F.col("l_partkey").alias("start"), (n % 3 > 0).alias("is_mapped"), (quantity % 7).alias("nm"), (F.col("l_partkey") % 11).cast("long").alias("score"),
    )
