"""Connected components of a graph that Spark holds: minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.shared import stored


def extended(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels of `connected` after more edges: only the components that these meet are joined anew."""
    own = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
    met = edges.select("a", "b").join(own("a"), "a", "left").join(own("b"), "b", "left")
    return merged(labels, stored(met.select("a", "b", F.coalesce("label_a", "a").alias("label_a"), F.coalesce("label_b", "b").alias("label_b"))))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """As `extended`, of edges (a, b, label_a, label_b) that have the labels of their ends; a node without one is its own."""
    up = connected(edges.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    up = up.select(F.col("node").alias("label"), F.col("label").alias("least"))
    ends = labels
    for end in ("a", "b"):
        ends = ends.unionByName(edges.select(F.col(end).alias("node"), F.col(f"label_{end}").alias("label")))
    ends = ends.groupBy("node").agg(F.min("label").alias("label"))
    return stored(ends.join(up, "label", "left").select("node", F.coalesce("least", "label").alias("label")))


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of `edges` (a, b): the smallest node that it reaches.

    Each round gives every node the least label among itself and its neighbours and then the label of
    that label, so chains of length n need about log2(n) rounds. Least labels are partial aggregates:
    a node with very many neighbours sends one row from each task. Every round is written to the shared
    folder; the driver sees only the number of labels that changed.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        least = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        labels = stored(least.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("label")))
        if not labels.where("label <> old").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
