"""Connected components by label propagation with pointer jumping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.session import checkpoint_dir


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for each node of ``links``; the label is the least node of its
    component.

    In a round each node takes the least label among its own and its neighbours', then
    the label of its label.  Both are aggregates or joins on small rows; a hub is
    summed map-side and its joins are split as skewed.  Rounds grow with the logarithm
    of the longest chain.  Each round is checkpointed; the driver sees one count.
    """
    checkpoint_dir(links.sparkSession)
    edges = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    edges = edges.union(edges.select("other", "node")).distinct().checkpoint()
    labels = (edges.groupBy("node").agg(F.min("other").alias("other"))
              .select("node", F.least("node", "other").alias("label")).checkpoint())
    while True:
        around = (edges.join(labels.select(F.col("node").alias("other"), "label"), "other")
                  .groupBy("node").agg(F.min("label").alias("near")))
        near = labels.join(around, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        moved = near.join(jump, "label").select(
            "node", "old", F.least("label", "beyond").alias("label")).checkpoint()
        done = moved.where("old != label").isEmpty()
        labels = moved.select("node", "label")
        if done:
            return labels
