"""Connected components of an edge list, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each end of the edges (a, b) reaches.

    A round takes the smallest label among a node and its neighbours (a partial
    aggregation, so a node with very many edges is no burden), and then the
    label's own label.  Every round is written to the shared folder; only the
    number of changed labels comes back to the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b")
    both = materialise(both.distinct())
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        lower = lower.join(jump, "root", "left").select("node", "was", F.coalesce("next", "root").alias("root"))
        lower = materialise(lower)
        labels = lower.select("node", "root")
        if lower.where("root != was").isEmpty():
            return labels
