"""Connected components of a graph of any shape, by large-star and small-star rounds.

Every round is a few shuffles over the edges, ends in a table in the shared folder and leaves no
lineage behind. A hub's edges are aggregated before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import settled


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang each node's neighbours (the larger, or the smaller ones) on its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if larger else both.where("b < a")
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hung = near.join(least, "a")
    if larger:
        moved = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; a component is its least node.

    Loops and repeated edges do no harm; without edges there are no rows.
    """
    edges = settled(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    def mark(rows):
        return rows.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()

    before = mark(edges)
    while True:
        edges = settled(_star(_star(edges, larger=True), larger=False), "stars")
        now = mark(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
