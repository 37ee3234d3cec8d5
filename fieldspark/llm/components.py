"""Connected components over an edge table, by alternating large-star and small-star rounds of joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import remove, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v), u > v, distinct. Nothing but each node's smallest neighbour is gathered per node."""
    near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = near.join(low, "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    edges: long columns (a, b); repeated edges and loops are harmless, nulls are dropped. An empty table gives an empty
    table. Each round is written to ``folder``, where the last one stays; the end is when a round changes nothing, which is
    when every edge joins a node to its component's smallest node.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, was, k = stored(e, f"{folder}/e0"), None, 0
    while not e.isEmpty():
        k += 1
        e = stored(_star(_star(e, True), False), f"{folder}/e{k}")
        remove(edges.sparkSession, f"{folder}/e{k - 1}")
        row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == was or not row[0]:
            break
        was = row
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
