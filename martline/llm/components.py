"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node of its component.

    Each round takes the least label among the neighbours, then the label's own label (path halving), so stars
    and chains collapse quickly; it ends when a round changes nothing. Every round is written as a table in the
    shared checkpoint folder, so neither the plan nor the loss of an executor makes earlier rounds run again.
    Hub nodes are the larger side of equi-joins, which AQE splits, and of aggregates with map-side combine.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = cut_lineage(both)
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = cut_lineage(step.join(up, "label").select("node", "old", F.least("label", "up").alias("label")))
        labels = step.select("node", "label")
        if not step.where("label <> old").limit(1).count():
            return labels
