"""Connected components of a graph in a table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.storage import materialise_counted


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Every node's neighbours are tied to the least node around it.

    The large star ties the larger neighbours, the small star the smaller ones and the node itself. Edges
    point from the larger to the smaller node. The minimum is a map-side aggregate; a hub's edges meet it in a merge
    join, which AQE splits when they are many. Nothing is broadcast, so rounds leave nothing in the driver's memory.
    """
    if larger_only:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    ties = edges.join(least.hint("merge"), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return ties.union(least.select("a", F.col("m").alias("b"))).distinct()


def _stored(edges: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """``edges`` on shared storage, with their number and a 128-bit digest of their set, taken by the write."""
    return materialise_counted(
        edges, "edges", n=F.count("*"), x=F.bit_xor(F.xxhash64("a", "b")), y=F.bit_xor(F.xxhash64("b", "a"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node that it reaches.

    Self-loops and repeated edges do no harm; a null end is ignored. An empty table gives an empty result.
    Rounds grow with the logarithm of the longest path; each is one write to the shared folder. When a round
    leaves the set of edges as it was, all of them run from a node straight to its component's least node.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = _stored(edges)
    while True:
        edges, after = _stored(_stars(_stars(edges, True), False))
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
