"""What kind of library reads come from: start positions, adapters, UMIs, overlap, and the protocol that follows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.functions.dna import kmers, reverse_complement, upto

#: The adapters' sequences.
TN5, TRUSEQ = "CTGTCTCTTATACACATCT", "AGATCGGAAGAGC"


def start_positions(reads: DataFrame, reference: str, k: int = 15, offsets: int = 60) -> DataFrame:
    """reads (read_idx, seq) that share a k-mer with the reference, on either strand, with where they begin: from
    the first of their first `offsets` k-mers that it has."""
    spark = reads.sparkSession
    own = spark.createDataFrame([(reference.upper(),)], "ref string")
    table = own.select(F.posexplode(kmers(F.col("ref"), k)).alias("pos", "kmer")).groupBy("kmer").agg(F.min("pos").alias("pos"))
    seq = F.upper("seq")
    at = lambda s, strand: F.transform(F.slice(kmers(s, k), 1, offsets), lambda x, i: F.struct(i.alias("offset"), F.lit(strand).alias("strand"), x.alias("kmer")))
    seeds = reads.select("read_idx", F.explode(F.concat(at(seq, "+"), at(reverse_complement(seq), "-"))).alias("s")).select("read_idx", "s.*")
    return seeds.join(F.broadcast(table), "kmer").groupBy("read_idx").agg(F.min_by(F.col("pos") - F.col("offset"), F.struct("offset", "strand")).alias("start"))


def clustering(starts: DataFrame, keys: list[str], near: int = 5) -> DataFrame:
    """Of read starts: the commonest, the share within `near` of it, and how many there are."""
    per = starts.groupBy(*keys, "start").agg(F.count("*").alias("n"))
    top = per.groupBy(*keys).agg(F.max_by("start", F.struct("n", -F.col("start"))).alias("dominant"), F.sum("n").alias("reads"), F.count("*").alias("n_positions"))
    both = per.join(top, keys) if keys else per.crossJoin(top)  # one row on the right
    close = F.sum(F.when(F.abs(F.col("start") - F.col("dominant")) <= near, F.col("n")).otherwise(0))
    return both.groupBy(*keys, "dominant", "reads", "n_positions").agg((close / F.first("reads")).alias("clustering"))


def adapter_shares(reads: DataFrame, keys: list[str]) -> DataFrame:
    has = lambda a: F.avg(F.upper("seq").contains(a).cast("double"))
    return reads.groupBy(*keys).agg(F.count("*").alias("reads"), has(TN5).alias("tn5"), has(TRUSEQ).alias("truseq"))


def library_type(clustered: Column, positions: Column, placed: Column, tn5: Column, truseq: Column) -> Column:
    """(type, confidence): by start positions where over 100 reads have one, else by adapters at twice the other's share."""
    made = lambda t, c: F.struct(F.lit(t).alias("type"), (F.lit(c) if isinstance(c, str) else c).alias("confidence"))
    enough = placed > 100
    sure = lambda test: F.when(test, "high").otherwise("medium")
    return (
        F.when(enough & (clustered >= 0.7), made("TruSeq", sure(clustered >= 0.85)))
        .when(enough & (positions >= 20) & (clustered < 0.5), made("Tn5", sure(clustered < 0.3)))
        .when((tn5 > 2 * truseq) & (tn5 > 0), made("Tn5", sure(tn5 > 0.3)))
        .when((truseq > 2 * tn5) & (truseq > 0), made("TruSeq", sure(truseq > 0.3)))
        .otherwise(made("TruSeq", "low"))
    )


def library_type_by_adapter(clustered: Column, positions: Column, tn5: Column, truseq: Column) -> Column:
    """The workflow's order: adapters over a tenth of the reads first."""
    return F.when((tn5 > 0.1) & (tn5 > truseq), "Tn5").when(truseq > 0.1, "TruSeq").when(clustered >= 0.7, "TruSeq").when((positions >= 20) & (clustered < 0.5), "Tn5").otherwise("TruSeq")


def offset_diversity(reads: DataFrame, keys: list[str], k: int = 6, most: int = 15) -> DataFrame:
    """For each offset: the share of reads with the commonest k-mer there, and of distinct ones."""
    u = F.upper("seq")
    at = F.transform(F.filter(upto(most, 0), lambda i: i + k <= F.length(u)), lambda i: F.struct(i.alias("offset"), F.substring(u, i + 1, F.lit(k)).alias("kmer")))
    per = reads.select(*keys, F.explode(at).alias("x")).groupBy(*keys, "x.offset", "x.kmer").agg(F.count("*").alias("n"))
    out = per.groupBy(*keys, "offset").agg(F.sum("n").alias("reads"), F.count("*").alias("distinct_kmers"), F.max("n").alias("top"), F.max_by("kmer", F.struct("n", "kmer")).alias("top_kmer"))
    return out.withColumn("top_share", F.col("top") / F.col("reads")).withColumn("unique_share", F.col("distinct_kmers") / F.col("reads"))


def umi_length(diversity: DataFrame, keys: list[str], default: int = 6) -> DataFrame:
    """Where a fixed primer begins: the first offset over 0 with a k-mer in over half of the reads, else over 3 with
    one in 0.3, else of 4 to 8 where the share rises by 0.10 to over 0.15, else the default."""
    jump = F.col("top_share") - F.lag("top_share").over(Window.partitionBy(*(keys or [F.lit(1)])).orderBy("offset"))
    rows = diversity.withColumn("_jump", jump)
    first = lambda test: F.min(F.when(test, F.col("offset")))
    share = F.col("top_share")
    out = rows.groupBy(*keys).agg(first((share > 0.5) & (F.col("offset") > 0)).alias("_1"), first((share > 0.3) & (F.col("offset") > 3)).alias("_2"), first((share > 0.15) & (F.col("_jump") > 0.10) & F.col("offset").between(4, 8)).alias("_3"))
    found_by = F.when(F.col("_1").isNotNull(), 1).when(F.col("_2").isNotNull(), 2).when(F.col("_3").isNotNull(), 3).otherwise(0)
    return out.select(*keys, F.coalesce("_1", "_2", "_3", F.lit(default)).alias("umi_length"), found_by.alias("found_by"))


def base_diversity(reads: DataFrame, keys: list[str], most: int = 12, least_share: float = 0.05) -> DataFrame:
    """How many bases have 5 % and more of the reads at each of the first positions."""
    u = F.upper("seq")
    each = F.transform(upto(F.least(F.lit(most), F.length(u))), lambda i: F.struct((i - 1).alias("position"), F.substring(u, i, F.lit(1)).alias("base")))
    per = reads.select(*keys, F.explode(each).alias("x")).groupBy(*keys, "x.position", "x.base").agg(F.count("*").alias("n"))
    total = per.groupBy(*keys, "position").agg(F.sum("n").alias("t"))
    return per.join(total, [*keys, "position"]).groupBy(*keys, "position").agg(F.sum((F.col("n") >= least_share * F.col("t")).cast("int")).alias("bases"))


def prefix_uniqueness(reads: DataFrame, keys: list[str], lengths: tuple[int, ...] = (6, 8, 10)) -> DataFrame:
    """Distinct prefixes per read for each length."""
    u = F.upper("seq")
    return reads.groupBy(*keys).agg(F.count("*").alias("reads"), *((F.countDistinct(F.substring(u, 1, n)) / F.count("*")).alias(f"unique_{n}") for n in lengths))


def upper_median(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The value in the middle of the sorted list, the upper of two."""
    rank, n = F.row_number().over(Window.partitionBy(*keys).orderBy(column)), F.count("*").over(Window.partitionBy(*keys))
    return rows.where(F.col(column).isNotNull()).withColumn("_r", rank).withColumn("_n", n).where("_r = _n div 2 + 1").select(*keys, F.col(column).alias("median"))


def merge_need(reads: DataFrame, keys: list[str], amplicon: int, least: int = 15) -> DataFrame:
    """The overlap that mates of mean length have in an amplicon, and whether it is enough to merge them."""
    out = reads.groupBy(*keys).agg(F.avg(F.length("seq")).alias("mean_length"))
    return out.withColumn("overlap", (F.col("mean_length") * 2 - amplicon).cast("int")).withColumn("should_merge", F.col("overlap") >= least)


@dataclass(frozen=True)
class Protocol:
    dedup: bool
    trim: bool
    merge: bool
    collapse: bool
    output: str


def protocol(library: str, has_umi: bool, should_merge: bool, paired: bool = True) -> Protocol:
    """TruSeq reads lose duplicates by UMI and collapse once merged; Tn5 reads by position, after alignment."""
    merge = should_merge and paired
    output = "merged" if merge else "paired" if paired else "single"
    if library.lower() == "truseq":
        return Protocol(has_umi, True, merge, merge, output)
    return Protocol(False, True, merge, False, output)


def comparison_mode(paired: bool, should_merge: bool) -> str:
    return "single" if not paired else "merged" if should_merge else "paired"


def trim_grid(reads: DataFrame, most: int = 30, step: int = 2) -> DataFrame:
    """(trim1, trim2, shared): for two primer pairs' reads (pair: 1 or 2, seq), how many trimmed sequences both have,
    over a grid of trims; counted by joining on trim and sequence, not by comparing sets."""
    grid = F.array(*(F.lit(x) for x in range(0, most + 1, step)))
    own = reads.select("pair", F.upper("seq").alias("seq"), F.explode(grid).alias("trim")).where("length(seq) > trim").select("pair", "trim", F.expr("substring(seq, trim + 1)").alias("s")).distinct()
    a, b = own.where("pair = 1").select(F.col("trim").alias("trim1"), "s"), own.where("pair = 2").select(F.col("trim").alias("trim2"), "s")
    return a.join(b, "s").groupBy("trim1", "trim2").agg(F.count("*").alias("shared"))
