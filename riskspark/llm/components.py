"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node it is connected with.

    In every round a node takes the smallest label among its neighbours and then its label's own label, which
    halves the way to the smallest node. A hub of any degree is an aggregate with partial sums, or a join side that AQE splits.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        own = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        step = own.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("label"))
        step = cut_lineage(step, "labels")
        labels = step.select("node", "label")
        if step.where("label < old").isEmpty():
            return labels
