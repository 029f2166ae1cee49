"""Replicates, conditions, statistics; library detection."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ampliscope.functions import stats as S
from ampliscope.operators import detect, pool
from ampliscope.plans.base import DNA, dna, query, table, whole

#: Orders as replicates of a customer: reads are the whole part of the price.
_ORDERS = "SELECT o_custkey AS bio, o_orderkey AS replicate, floor(o_totalprice)::BIGINT AS total_reads, round(o_totalprice % 100, 2) AS hdr_pct, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE round(o_totalprice % 37, 2) END AS nhej_pct, o_orderpriority, o_orderstatus FROM orders"


def _orders(spark, sf_dir):
    p = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("bio"), F.col("o_orderkey").alias("replicate"), F.floor(p).cast("long").alias("total_reads"), F.round(p % 100, 2).alias("hdr_pct"), F.when(F.col("o_orderstatus") != "F", F.round(p % 37, 2)).alias("nhej_pct"), "o_orderpriority", "o_orderstatus")


def _rounded(df, digits: int = 6):
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


_LOW = 100_000


@query(f"""WITH o AS ({_ORDERS}), f AS (SELECT bio, count(*) AS n, count(*) FILTER (total_reads < {_LOW}) AS low, arg_min(o_orderpriority, replicate) AS o_orderpriority FROM o GROUP BY bio),
u AS (SELECT o.*, CASE WHEN low = 0 THEN 'good' WHEN low = n THEN 'all_low_reads' ELSE 'one_low_read_removed' END AS flag FROM o JOIN f USING (bio) WHERE NOT (low > 0 AND low < n AND total_reads < {_LOW}))
SELECT bio, max(flag) AS quality_flag, max(f.n) AS n_replicates, count(*) AS n_replicates_used, sum(total_reads)::BIGINT AS total_reads_total, round(avg(hdr_pct), 6) AS hdr_pct_mean, round(CASE WHEN count(hdr_pct) > 1 THEN stddev_samp(hdr_pct) / sqrt(count(hdr_pct)) WHEN count(hdr_pct) = 1 THEN 0.0 END, 6) AS hdr_pct_sem,
  round(avg(nhej_pct), 6) AS nhej_pct_mean, round(CASE WHEN count(nhej_pct) > 1 THEN stddev_samp(nhej_pct) / sqrt(count(nhej_pct)) WHEN count(nhej_pct) = 1 THEN 0.0 END, 6) AS nhej_pct_sem, any_value(f.o_orderpriority) AS o_orderpriority FROM u JOIN f USING (bio) GROUP BY bio""")
def replicate_pool_qc(spark, sf_dir):
    return _rounded(pool.pool(_orders(spark, sf_dir), "bio", "total_reads", ["total_reads"], ["hdr_pct", "nhej_pct"], ["o_orderpriority"], "replicate", _LOW))


@query(f"SELECT bio, sum(total_reads)::BIGINT AS total_reads, round(sum(hdr_pct * total_reads) / sum(total_reads), 4) AS hdr_pct, round(CASE WHEN count(hdr_pct) > 1 THEN stddev_samp(hdr_pct) / sqrt(count(hdr_pct)) ELSE 0.0 END, 4) AS hdr_pct_sem, sum(replicate)::BIGINT AS replicate FROM ({_ORDERS}) GROUP BY bio")
def pooled_weighted_mean(spark, sf_dir):
    return pool.pooled_means(_orders(spark, sf_dir), "bio", ["hdr_pct"], ["replicate"])


@query(f"SELECT o_orderpriority, round(coalesce(avg(nhej_pct), 0.0), 6) AS mean, round(coalesce(stddev_samp(nhej_pct), 0.0), 6) AS std, round(CASE WHEN count(nhej_pct) > 1 THEN stddev_samp(nhej_pct) / sqrt(count(nhej_pct)) ELSE 0.0 END, 6) AS sem, count(nhej_pct) AS n FROM ({_ORDERS}) GROUP BY ALL")
def condition_stats(spark, sf_dir):
    return _rounded(pool.condition_statistics(_orders(spark, sf_dir), "o_orderpriority", "nhej_pct"))


@query(f"SELECT o_orderpriority, o_orderstatus, round(avg(nhej_pct), 6) AS nhej_pct_mean, round(stddev_samp(nhej_pct), 6) AS nhej_pct_std, round(CASE WHEN count(*) > 1 THEN stddev_samp(nhej_pct) / sqrt(count(*)) ELSE 0.0 END, 6) AS nhej_pct_sem, count(nhej_pct) AS nhej_pct_count FROM ({_ORDERS}) GROUP BY ALL")
def group_agg(spark, sf_dir):
    return _rounded(pool.group_aggregate(_orders(spark, sf_dir), ["o_orderpriority", "o_orderstatus"], ["nhej_pct"]))


@query(f"SELECT o_orderstatus, count(*) AS n, round(avg(nhej_pct), 6) AS nhej_pct_mean, round(CASE WHEN count(nhej_pct) > 1 THEN stddev_samp(nhej_pct) END, 6) AS nhej_pct_std, round(CASE WHEN count(nhej_pct) > 1 THEN stddev_samp(nhej_pct) / sqrt(count(nhej_pct)) END, 6) AS nhej_pct_sem FROM ({_ORDERS}) GROUP BY ALL")
def condition_summary(spark, sf_dir):
    return _rounded(pool.condition_summary(_orders(spark, sf_dir), "o_orderstatus", ["nhej_pct"]))


_STATS = f"SELECT o_orderpriority, avg(hdr_pct) AS mean, stddev_samp(hdr_pct) AS std, count(hdr_pct) AS n FROM ({_ORDERS}) GROUP BY ALL"


@query(f"""WITH s AS ({_STATS}), b AS (SELECT * FROM s ORDER BY o_orderpriority LIMIT 1)
SELECT s.o_orderpriority, b.o_orderpriority AS base_condition, round(s.mean - b.mean, 6) AS difference, round(s.mean / b.mean, 6) AS fold_change, round((s.mean - b.mean) / sqrt(s.std * s.std / s.n + b.std * b.std / b.n), 6) AS t,
  round(pow(s.std * s.std / s.n + b.std * b.std / b.n, 2) / (pow(s.std * s.std / s.n, 2) / (s.n - 1) + pow(b.std * b.std / b.n, 2) / (b.n - 1)), 4) AS df FROM s, b WHERE s.o_orderpriority != b.o_orderpriority""")
def welch_t(spark, sf_dir):
    rows = pool.compare(pool.condition_statistics(_orders(spark, sf_dir), "o_orderpriority", "hdr_pct"), "o_orderpriority", p_values=False)
    return rows.select("o_orderpriority", "base_condition", *(F.round(c, 6).alias(c) for c in ("difference", "fold_change", "t")), F.round("df", 4).alias("df"))


@query(None)
def compare_conditions(spark, sf_dir):
    """With p-values, for which SQL has no function."""
    rows = pool.compare(pool.condition_statistics(_orders(spark, sf_dir), "o_orderpriority", "hdr_pct"), "o_orderpriority")
    return rows.select("o_orderpriority", "base_condition", *(F.round(c, 9).alias(c) for c in ("t", "df", "p_value", "p_adjusted")), "significance")


@query("""WITH p AS (SELECT p_brand, p_partkey, ((p_partkey * 7919) % 10007) / 10007.0::DOUBLE AS p FROM part), r AS (SELECT *, p * count(*) OVER (PARTITION BY p_brand) / row_number() OVER (PARTITION BY p_brand ORDER BY p) AS raw FROM p)
SELECT p_brand, p_partkey, round(p, 9) AS p, round(least(min(raw) OVER (PARTITION BY p_brand ORDER BY p DESC ROWS UNBOUNDED PRECEDING), 1.0), 9) AS p_adjusted, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS significance FROM r""")
def bh_fdr(spark, sf_dir):
    t = table(spark, sf_dir, "part").select("p_brand", "p_partkey", (F.col("p_partkey") * 7919 % 10007 / 10007.0).alias("p"))
    return pool.benjamini_hochberg(t, "p", ["p_brand"]).select("p_brand", "p_partkey", F.round("p", 9).alias("p"), F.round("p_adjusted", 9).alias("p_adjusted"), S.stars(F.col("p")).alias("significance"))


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n FROM lineitem GROUP BY ALL")
def pearson(spark, sf_dir):
    return pool.correlation(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"]).select("l_returnflag", F.round("r", 6).alias("r"), "n")


@query(f"SELECT o_orderpriority, round(mean - 1.96 * std / sqrt(n), 6) AS low, round(mean + 1.96 * std / sqrt(n), 6) AS high FROM ({_STATS})")
def confidence_intervals(spark, sf_dir):
    low, high = S.confidence_interval(F.col("mean"), F.col("std"), F.col("n"))
    return pool.condition_statistics(_orders(spark, sf_dir), "o_orderpriority", "hdr_pct").select("o_orderpriority", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("""WITH c AS (SELECT l_suppkey, l_partkey % 60 AS start, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT l_suppkey, arg_max(start, (n, -start)) AS dominant, sum(n)::BIGINT AS reads, count(*) AS n_positions FROM c GROUP BY ALL)
SELECT t.*, (sum(CASE WHEN abs(start - dominant) <= 5 THEN n ELSE 0 END) / any_value(reads))::DOUBLE AS clustering FROM c JOIN t USING (l_suppkey) GROUP BY ALL""")
def start_clustering(spark, sf_dir):
    return detect.clustering(table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") % 60).alias("start")), ["l_suppkey"])


_SEQ = f"SELECT sample_id, dna AS seq FROM ({DNA})"


def _seq(spark, sf_dir):
    return dna(spark, sf_dir).select("sample_id", F.col("dna").alias("seq"))


_DIV = f"""SELECT sample_id, "offset", sum(n)::BIGINT AS reads, count(*) AS distinct_kmers, max(n) AS top, max(n) / sum(n) AS top_share, count(*) / sum(n) AS unique_share FROM (SELECT sample_id, o AS "offset", substr(seq, o + 1, 3) AS kmer, count(*) AS n FROM (SELECT sample_id, seq, unnest(range(0, 16)) AS o FROM ({_SEQ})) WHERE o + 3 <= length(seq) GROUP BY ALL) GROUP BY ALL"""


@query(f'SELECT sample_id, "offset"::INT AS "offset", reads, distinct_kmers, top, top_share::DOUBLE AS top_share, unique_share::DOUBLE AS unique_share FROM ({_DIV})')
def offset_diversity(spark, sf_dir):
    return detect.offset_diversity(_seq(spark, sf_dir), ["sample_id"], 3).drop("top_kmer")


@query(f"""SELECT sample_id, coalesce(a, b, c, 6)::INT AS umi_length, CASE WHEN a IS NOT NULL THEN 1 WHEN b IS NOT NULL THEN 2 WHEN c IS NOT NULL THEN 3 ELSE 0 END::INT AS found_by FROM (SELECT sample_id, min(CASE WHEN top_share > 0.5 AND "offset" > 0 THEN "offset" END) AS a, min(CASE WHEN top_share > 0.3 AND "offset" > 3 THEN "offset" END) AS b, min(CASE WHEN top_share > 0.15 AND jump > 0.10 AND "offset" BETWEEN 4 AND 8 THEN "offset" END) AS c
  FROM (SELECT *, top_share - lag(top_share) OVER (PARTITION BY sample_id ORDER BY "offset") AS jump FROM ({_DIV})) GROUP BY sample_id)""")
def umi_length(spark, sf_dir):
    return detect.umi_length(detect.offset_diversity(_seq(spark, sf_dir), ["sample_id"], 3), ["sample_id"])


@query(f"SELECT sample_id, position::INT AS position, count(*) FILTER (n >= 0.05 * t) AS bases FROM (SELECT *, sum(n) OVER (PARTITION BY sample_id, position) AS t FROM (SELECT sample_id, p AS position, substr(seq, p + 1, 1) AS base, count(*) AS n FROM (SELECT sample_id, seq, unnest(range(0, least(12, length(seq)))) AS p FROM ({_SEQ})) GROUP BY ALL)) GROUP BY ALL")
def base_diversity(spark, sf_dir):
    return detect.base_diversity(_seq(spark, sf_dir), ["sample_id"])


@query(f"SELECT sample_id, count(*) AS reads, count(DISTINCT substr(seq, 1, 6)) / count(*) AS unique_6, count(DISTINCT substr(seq, 1, 8)) / count(*) AS unique_8, count(DISTINCT substr(seq, 1, 10)) / count(*) AS unique_10 FROM ({_SEQ}) GROUP BY sample_id")
def prefix_uniqueness(spark, sf_dir):
    return detect.prefix_uniqueness(_seq(spark, sf_dir), ["sample_id"])


@query(f"SELECT sample_id, list_sort(list(length(seq)))[count(*) // 2 + 1]::BIGINT AS median FROM ({_SEQ}) GROUP BY sample_id")
def upper_median(spark, sf_dir):
    return detect.upper_median(_seq(spark, sf_dir).withColumn("n", whole(F.length("seq"))), ["sample_id"], "n")


@query(f"SELECT sample_id, avg(length(seq)) AS mean_length, trunc(2 * avg(length(seq)) - 700)::INT AS overlap, trunc(2 * avg(length(seq)) - 700) >= 15 AS should_merge FROM ({_SEQ}) GROUP BY sample_id")
def merge_need(spark, sf_dir):
    return detect.merge_need(_seq(spark, sf_dir), ["sample_id"], 700)


@query(f"""SELECT l_suppkey, CASE WHEN n > 100 AND c >= 0.7 THEN 'TruSeq' WHEN n > 100 AND p >= 20 AND c < 0.5 THEN 'Tn5' WHEN a > 2 * b AND a > 0 THEN 'Tn5' ELSE 'TruSeq' END AS type FROM (SELECT l_suppkey, count(*) AS n, avg(l_discount) * 10 AS c, count(DISTINCT l_partkey) AS p, avg(l_tax) AS a, avg(l_discount) AS b FROM lineitem GROUP BY l_suppkey)""")
def library_type(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_discount", "l_tax", F.struct("_metadata.file_path", "_metadata.row_index").alias("row"))
    made = lambda c, p, n, a, b: detect.library_type(c, p, n, a, b)["type"].alias("type")
    means = t.groupBy("l_suppkey").agg(F.count("*").alias("n"), (F.avg("l_discount") * 10).alias("c"), F.countDistinct("l_partkey").alias("p"), F.avg("l_tax").alias("a"), F.avg("l_discount").alias("b"))
    # at a limit the order of a sum decides: there it is the table's, however its rows are dealt to tasks
    near = lambda x, y: F.coalesce(F.abs(x - y) < 1e-6, F.lit(False))
    means = means.withColumn("at_limit", near(F.col("c"), F.lit(0.7)) | near(F.col("c"), F.lit(0.5)) | near(F.col("a"), 2 * F.col("b")) | near(F.col("a"), F.lit(0.0)))
    limit = means.where("at_limit").select(F.col("l_suppkey").alias("own"), "n", "p")
    so_far = Window.partitionBy("l_suppkey").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = t.join(limit, F.col("l_suppkey").eqNullSafe(F.col("own"))).select("l_suppkey", "n", "p", "row", F.avg("l_tax").over(so_far).alias("a"), F.avg("l_discount").over(so_far).alias("b"))
    last = rows.groupBy("l_suppkey").agg(F.max_by(F.struct("n", "p", "a", "b"), "row").alias("x")).select("l_suppkey", "x.*")
    found = means.where("not at_limit").select("l_suppkey", made(F.col("c"), F.col("p"), F.col("n"), F.col("a"), F.col("b")))
    return found.unionByName(last.select("l_suppkey", made(F.col("b") * 10, F.col("p"), F.col("n"), F.col("a"), F.col("b"))))


@query(f"SELECT a.t AS trim1, b.t AS trim2, count(*) AS shared FROM (SELECT DISTINCT t, substr(seq, t + 1) AS s FROM (SELECT seq, unnest(range(0, 7, 2)) AS t FROM ({_SEQ}) WHERE sample_id IN ('src0', 'src1')) WHERE length(seq) > t) a JOIN (SELECT DISTINCT t, substr(seq, t + 1) AS s FROM (SELECT seq, unnest(range(0, 7, 2)) AS t FROM ({_SEQ}) WHERE sample_id NOT IN ('src0', 'src1')) WHERE length(seq) > t) b USING (s) GROUP BY ALL")
def trim_grid(spark, sf_dir):
    reads = _seq(spark, sf_dir).select(F.when(F.col("sample_id").isin("src0", "src1"), 1).otherwise(2).alias("pair"), "seq")
    return detect.trim_grid(reads, 6).select(whole("trim1").alias("trim1"), whole("trim2").alias("trim2"), "shared")
