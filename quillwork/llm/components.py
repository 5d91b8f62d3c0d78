"""Connected components of a link table, by falling labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node reachable.

    A round gives each node the smallest label among its neighbours and then the
    label of that label, so rounds grow with the logarithm of a chain's length. Minima are
    combined before they are shuffled, so a node with very many links is no hot spot.
    Every round is a written table: a lost executor costs one task, not the loop.
    """
    both = materialise(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a != b"), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select(
        "node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lowered = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        moved = materialise(
            lowered.join(jump, "low").select("node", F.least("low", "far").alias("label"), F.col("label").alias("was")), "labels"
        )
        labels = moved.select("node", "label")
        if moved.where("label != was").limit(1).count() == 0:
            return labels
