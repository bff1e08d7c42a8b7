"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hitledger.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Neighbours of each node hung on its smallest one: the larger neighbours, or the smaller ones and the node."""
    if large:
        pairs = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    hung = pairs.join(least, "a")
    if large:
        hung = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return hung.filter("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for each node that has an edge.

    Large and small stars in turn, each round written to the shared folder, until every edge points to a root.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while True:
        edges = stored(_stars(_stars(edges, True), False), "edges")
        roots = edges.select(F.col("b").alias("a")).distinct()
        # done when no root hangs on another node and no node on two
        again = edges.join(roots, "a", "left_semi").limit(1).count() or (
            edges.groupBy("a").count().filter("count > 1").limit(1).count()
        )
        if not again:
            break
    hung = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return hung.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
