"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return (
        edges.join(least, "a")
        .select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b); the label is the component's smallest node.

    Labels are found by joins and minima that combine map-side, so a node with
    many neighbours is never gathered; each round is cut by a reliable
    checkpoint. Edges from a node to itself and repeated edges change nothing;
    without edges the result is empty.
    """
    current = durable(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    summary = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == summary or state[0] == 0:
            break
        summary = tuple(state)
        current = durable(_small_star(_large_star(current).distinct()))
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
