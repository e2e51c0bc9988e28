"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayload.llm.workspace import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges ``a``, ``b``; the label is the smallest node reachable.

    Smallest labels spread over edges, and each round also follows labels of labels, so
    the rounds grow with the logarithm of a path's length. Nothing but a count comes to
    the driver; a node with very many edges is aggregated map-side.
    """
    both = stage(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges"
    )
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("_near"))
        spread = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new")
        )
        jump = spread.select(F.col("node").alias("_at"), F.col("_new").alias("_far"))
        # The label is a node itself, so its own label is one more step.
        nearer = stage(
            spread.join(jump, F.col("_new") == F.col("_at")).select("node", F.least("_new", "_far").alias("label"), "_old"), "labels"
        )
        labels = nearer.select("node", "label")
        if nearer.where("label <> _old").limit(1).count() == 0:
            return labels
