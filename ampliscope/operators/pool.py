"""Replicates and conditions: pooling with quality flags, condition statistics, comparisons.

Standard deviations of single values have three dialects in use: 0 (condition_statistics), null
(group_aggregate, condition_summary), and standard errors of 0 (pool, group_aggregate).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.functions.stats import stars, t_p_value, welch_t
from ampliscope.runtime import ship

LEAST_READS = 1000


def _known(x: str | Column) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.when(~F.isnan(x.cast("double")), x.cast("double"))


def pool(replicates: DataFrame, sample: str, reads: str, totals: list[str], rates: list[str], metadata: list[str] | None = None, order: str | None = None, least: int = LEAST_READS) -> DataFrame:
    """One row per sample: a flag, replicates and those used, sums, means with standard errors, first metadata.

    Replicates under `least` reads are left out unless all are. Totals come from a first aggregation joined
    back, not a window, as a sample may have very many rows.
    """
    low = F.col(reads) < least
    flags = replicates.groupBy(sample).agg(F.count("*").alias("n_replicates"), F.count(reads).alias("_n"), F.sum(low.cast("int")).alias("_low"))
    flag = F.when(F.col("_n") == 0, "no_data").when(F.col("_low") == 0, "good").when(F.col("_low") == F.col("_n"), "all_low_reads").otherwise("one_low_read_removed")
    flags = flags.withColumn("quality_flag", flag)
    used = replicates.join(flags, sample).where(~((F.col("quality_flag") == "one_low_read_removed") & low))
    out = [F.sum(c).alias(f"{c}_total") for c in totals]
    for c in rates:
        x = _known(c)
        out += [F.avg(x).alias(f"{c}_mean"), F.when(F.count(x) > 1, F.stddev_samp(x) / F.sqrt(F.count(x))).when(F.count(x) == 1, 0.0).alias(f"{c}_sem")]
    summed = used.groupBy(sample).agg(F.max("quality_flag").alias("quality_flag"), F.max("n_replicates").alias("n_replicates"), F.when(F.max("quality_flag") == "no_data", 0).otherwise(F.count("*")).alias("n_replicates_used"), *out)
    if not metadata:
        return summed
    by = F.col(order) if order else F.lit(0)
    first = replicates.groupBy(sample).agg(*(F.min_by(c, by).alias(c) for c in metadata))
    return summed.join(first, sample)


def pooled_means(replicates: DataFrame, sample: str, rates: list[str], sums: list[str], weight: str = "total_reads") -> DataFrame:
    """Means of percentages weighted by reads, with unweighted standard errors, to 4 places; other columns summed."""
    w = F.col(weight)
    out = [F.sum(w).alias(weight)]
    for c in rates:
        out += [F.round(F.try_divide(F.sum(F.col(c) * w), F.sum(w)), 4).alias(c), F.round(F.when(F.count(c) > 1, F.stddev_samp(c) / F.sqrt(F.count(c))).otherwise(0.0), 4).alias(f"{c}_sem")]
    return replicates.groupBy(sample).agg(*out, *(F.sum(c).alias(c) for c in sums))


def condition_statistics(rows: DataFrame, condition: str, metric: str, where: Column | None = None) -> DataFrame:
    """Mean, sample deviation, standard error, n and sorted values; 0 where there are too few values."""
    x = _known(metric)
    picked = rows if where is None else rows.where(where)
    n, sd = F.count(x), F.coalesce(F.stddev_samp(x), F.lit(0.0))
    return picked.where(F.col(condition).isNotNull()).groupBy(condition).agg(F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"), sd.alias("std"), F.when(n > 1, sd / F.sqrt(n)).otherwise(0.0).alias("sem"), n.alias("n"))


def group_aggregate(rows: DataFrame, keys: list[str], metrics: list[str], functions: tuple[str, ...] = ("mean", "std", "sem", "count")) -> DataFrame:
    """Named aggregates of metrics; the deviation of one value is null, and the standard error divides by the root
    of all rows, null ones too."""
    rows = rows.dropna(subset=keys)
    kinds = {
        "mean": lambda x: F.avg(x), "std": lambda x: F.stddev_samp(x), "count": lambda x: F.count(x), "sum": lambda x: F.sum(x), "min": lambda x: F.min(x), "max": lambda x: F.max(x), "median": lambda x: F.median(x),
        "sem": lambda x: F.when(F.count("*") > 1, F.stddev_samp(x) / F.sqrt(F.count("*"))).otherwise(0.0),
    }
    return rows.groupBy(*keys).agg(*(kinds[f](_known(m)).alias(f"{m}_{f}") for m in metrics for f in functions))


def condition_summary(rows: DataFrame, condition: str, metrics: list[str]) -> DataFrame:
    out = [F.count("*").alias("n")]
    for m in metrics:
        x = _known(m)
        out += [F.avg(x).alias(f"{m}_mean"), F.when(F.count(x) > 1, F.stddev_samp(x)).alias(f"{m}_std"), F.when(F.count(x) > 1, F.stddev_samp(x) / F.sqrt(F.count(x))).alias(f"{m}_sem")]
    return rows.where(F.col(condition).isNotNull()).groupBy(condition).agg(*out)


#: Ranges of p-values that a family is ranked by.
RANGES = 4096


def benjamini_hochberg(rows: DataFrame, p: str, keys: list[str] | None = None, total: Column | None = None) -> DataFrame:
    """rows with `p_adjusted`: p times the number of tests over its rank, made monotone from the largest down and
    capped at 1; null stays null. Distinct p-values are ranked within ranges of them, and the ranges (4,097 to a
    family at most) by their counts, so that a family of any size is many tasks."""
    keys, known = keys or [], F.col(p).isNotNull() & ~F.isnan(p)
    each = rows.where(known).groupBy(*keys, F.col(p).alias("_p")).agg(F.count("*").alias("_n"), *([] if total is None else [F.max(total).alias("_m")]))
    each = each.withColumn("_range", F.floor(F.least(F.greatest("_p", F.lit(0.0)), F.lit(1.0)) * RANGES))
    family = Window.partitionBy(*keys)
    sums = each.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in"))
    sums = sums.withColumn("_before", F.sum("_in").over(family.orderBy("_range")) - F.col("_in")).withColumn("_all", F.sum("_in").over(family))
    inside = Window.partitionBy(*keys, "_range")
    ranked = _same_keys(each, sums, [*keys, "_range"]).withColumn("_rank", F.col("_before") + F.sum("_n").over(inside.orderBy("_p")))
    raw = ranked.withColumn("_raw", F.col("_p") * (F.col("_all") if total is None else F.col("_m")) / F.col("_rank"))
    least = raw.groupBy(*keys, "_range").agg(F.min("_raw").alias("_own"))
    above = least.withColumn("_above", F.min("_own").over(family.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1))).drop("_own")
    own = F.min("_raw").over(inside.orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, 0))
    found = _same_keys(raw.withColumn("_least", own), above, [*keys, "_range"])
    found = found.select(*keys, F.col("_p").alias("_known"), F.least("_least", F.coalesce("_above", F.lit(1.0)), F.lit(1.0)).alias("p_adjusted"))
    return _same_keys(rows.withColumn("_known", F.when(known, F.col(p))), found, [*keys, "_known"]).drop("_known")


def _same_keys(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """A left join in which null keys are equal."""
    own = right.select(*(F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in right.columns))
    same = [left[c].eqNullSafe(own[f"_on_{c}"]) for c in on]
    return left.join(own, reduce(and_, same), "left").drop(*(f"_on_{c}" for c in on))


def compare(statistics: DataFrame, condition: str, base: str | None = None, least: int = 2, fdr: bool = True, p_values: bool = True) -> DataFrame:
    """Every condition against a base (the first by name): difference, fold change, Welch's t, p, stars."""
    enough = statistics.where(F.col("n") >= least)
    first = enough.agg(F.min(condition).alias("_base")) if base is None else enough.agg(F.first(F.lit(base)).alias("_base"))
    named = enough.join(F.broadcast(first), F.col(condition) == F.col("_base"))  # one row
    of = named.select(F.col(condition).alias("base_condition"), F.col("mean").alias("base_mean"), F.col("std").alias("base_std"), F.col("n").alias("base_n"))
    rows = enough.crossJoin(of).where(F.col(condition) != F.col("base_condition"))  # one row on the right
    t, df = welch_t(F.col("mean"), F.col("std"), F.col("n"), F.col("base_mean"), F.col("base_std"), F.col("base_n"))
    rows = rows.withColumn("difference", F.col("mean") - F.col("base_mean")).withColumn("fold_change", F.when(F.col("base_mean") > 0, F.col("mean") / F.col("base_mean"))).withColumn("t", t).withColumn("df", df)
    if not p_values:
        return rows
    ship(statistics.sparkSession)
    rows = rows.withColumn("p_value", t_p_value("t", "df"))
    rows = benjamini_hochberg(rows, "p_value") if fdr else rows.withColumn("p_adjusted", F.col("p_value"))
    return rows.withColumn("significance", stars(F.col("p_adjusted")))


def significant(comparisons: DataFrame) -> DataFrame:
    """Comparisons with a star; those without a p-value aren't."""
    return comparisons.where(F.col("significance").isin("*", "**", "***"))


def correlation(rows: DataFrame, x: str, y: str, keys: list[str] | None = None) -> DataFrame:
    """Pearson's r with n and its t (n > 2)."""
    both = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = both.groupBy(*(keys or [])).agg(F.corr(x, y).alias("r"), F.count("*").alias("n"))
    return out.withColumn("t", F.when(F.col("n") > 2, F.try_divide(F.col("r") * F.sqrt(F.col("n") - 2.0), F.sqrt(1 - F.col("r") * F.col("r")))))


def correlation_test(rows: DataFrame, x: str, y: str, keys: list[str] | None = None) -> DataFrame:
    """correlation() with the two-sided p of r."""
    ship(rows.sparkSession)
    return correlation(rows, x, y, keys).withColumn("p_value", t_p_value("t", F.when(F.col("n") > 2, F.col("n") - 2.0)))


def one_sample_t(rows: DataFrame, keys: list[str], metric: str, expected: float = 0.0, p_values: bool = True) -> DataFrame:
    """Student's t of each group's mean against an expected one, with n - 1 degrees of freedom; null under two values."""
    x = _known(metric)
    out = rows.groupBy(*keys).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    out = out.withColumn("df", F.when(F.col("n") > 1, F.col("n") - 1.0)).withColumn("t", F.when(F.col("n") > 1, F.try_divide(F.col("mean") - expected, F.col("std") / F.sqrt("n"))))
    if not p_values:
        return out
    ship(rows.sparkSession)
    return out.withColumn("p_value", t_p_value("t", "df"))
