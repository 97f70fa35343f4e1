"""Connected components as DataFrame joins (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import pin


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u > v): relink neighbours to the smallest one.

    Both steps are an aggregate with map-side combine plus an equi join, so a
    centre with many neighbours is summed before its shuffle and its join
    partition can be split.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("u", "m").alias("m"))
    near = both.join(least, both.u == least.c)
    if large:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node on an edge (u, v); component = smallest node.

    Nodes may be of any one orderable type. Rows with a null end and loops are
    ignored; repeated and reversed edges count once; no edges give no rows.
    Every round is checkpointed, so a lost executor costs one round at most.
    Ends when a round changes nothing; raises if ``rounds`` do not suffice
    (the number needed grows with the logarithm of the longest path).
    """
    now = pin(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        if mark is None and now.isEmpty():
            break
        now = pin(_star(_star(now, True), False))
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
