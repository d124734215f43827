"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import staged

MOST_ROUNDS = 64


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of a node move to the smallest node among it and its neighbours."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node of its component.

    Loops are ignored. Each round is written to the shared folder; for the alternating steps a number of
    rounds in the square of the logarithm of the nodes is known to suffice; long chains took few in tests. Only a count of changed edges comes to the driver.
    """
    edges = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(MOST_ROUNDS):
        if _is_settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = staged(_star(_star(edges, True), False), "edges")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _is_settled(edges: DataFrame) -> bool:
    """Every upper node has one edge, and no lower node is an upper node elsewhere."""
    counted = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))).groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where("up > 1 or (up > 0 and down > 0)").limit(1).count() == 0
