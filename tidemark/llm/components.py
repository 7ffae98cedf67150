"""Connected components of a links table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on pairs (a, b). Every node is hung under the smallest node around it.

    The large star moves each node's larger neighbours, the small star the node
    itself and its smaller ones. Minima are aggregated before the exchange, and
    the join back can be split, so a node with very many links is no hot spot.
    """
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = around.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a"), F.least("least", "a").alias("least"))
    hung = around.join(smallest, "a")
    if large:
        moved = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            smallest.select("a", F.col("least").alias("b"))
        )
    return moved.where("a != b").distinct()


def connected(links: DataFrame, limit: int = 64) -> DataFrame:
    """(node, root): each linked node and the smallest node of its component.

    ``links`` has columns a and b of one orderable type; null and equal pairs
    are left out. Each round is written to the shared folder.
    """
    edges = staged(links.select("a", "b").where("a != b").distinct())
    before = None
    for _ in range(limit):
        edges = staged(_star(_star(edges, large=True), large=False))
        state = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("sum")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    tops = roots.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    return staged(roots.unionByName(tops))
