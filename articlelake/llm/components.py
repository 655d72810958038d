"""Connected components by repeated local contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.llm.common import written


def contract(edges: DataFrame) -> DataFrame:
    """Components of an edge list (a, b): one row per node, (node, label).

    In every round each node takes the smallest name among itself and its
    neighbours, edges move to the new names, and those within one name go. With
    names in random order, as digests are, a constant part of the nodes goes in
    each round. Only minima are aggregated, so a node with many neighbours
    costs one row per task; its edges are joined by a key that Spark may split.
    """
    edges = written(edges.filter("a <> b").distinct(), "edges")
    labels = None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        least = written(least, "least")
        if labels is None:
            labels = least.select("node", F.col("to").alias("label"))
        else:
            step = least.select(F.col("node").alias("label"), "to")
            labels = labels.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            labels = written(labels, "labels")
        edges = (
            edges.join(least.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(least.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        edges = written(edges, "edges")
        if edges.isEmpty():
            return labels
