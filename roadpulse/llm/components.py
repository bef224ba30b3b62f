"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b long); a component is named by one of its nodes.

    Each round every node joins its least neighbour, edges are renamed to the joined nodes, and
    those inside one node go; it ends when no edge is left.  Node numbers are hashes, so rounds
    grow with the logarithm of a component.  A node with very many edges is one row of each partial
    minimum, and joins on it are split at run time.  Each round is a written table.
    """
    edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = stage(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        joined = stage(both.groupBy(F.col("a").alias("old")).agg(F.min("b").alias("new")).withColumn("new", F.least("old", "new")), "joined")
        labels = stage(
            labels.join(joined, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component")), "labels"
        )
        moved = edges.join(joined, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
        moved = moved.join(joined, F.col("b") == F.col("old")).select("a", F.col("new").alias("b"))
        edges = stage(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return labels
