"""Connected components of an edge table by alternating large-star and small-star steps.

Each step reads and writes tables in the shared scratch folder, so a lost executor
costs one step. Both sides of every join are plain scans: a hub with very many
edges is a skewed join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliscope.llm.common import discard, materialize


def _lowest(edges: DataFrame, self_too: bool) -> DataFrame:
    low = F.min("v")
    return materialize(edges.groupBy("u").agg((F.least(F.col("u"), low) if self_too else low).alias("m")), "lowest")


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Null ends and loops are no edges; an empty edge table gives an empty result.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = materialize(pairs.distinct(), "edges")
    sign = _sign(now)
    while sign[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both, True)
        large = materialize(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        below = _lowest(large, False)
        # u points to its lowest neighbour, as do its other neighbours
        joined = large.join(below, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        lone = below.select("u", F.col("m").alias("v"))
        new = materialize(joined.unionByName(lone).distinct(), "edges")
        was, sign = sign, _sign(new)
        for gone in (now, low, large, below):
            discard(gone)
        now = new
        if sign == was:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return materialize(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")
