"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.scratch import written


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``): the smallest node it reaches.

    Each round takes the smallest label among the neighbours, then the label of that label,
    so the rounds grow with the logarithm of a component's diameter. Each round is
    written; only a count of changed labels comes back.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    edges = written(both.select(F.col("a").alias("node"), F.col("b").alias("other")), "edges")
    labels = edges.groupBy("node").agg(F.min("other").alias("least"))
    labels = written(labels.select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other")
        near = near.groupBy("node").agg(F.min("near").alias("near"))
        hop = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = written(hop.join(jump, "via").select("node", "old", F.least("via", "far").alias("label")), "labels")
        if not after.filter(F.col("label") != F.col("old")).limit(1).count():
            return after.select("node", "label")
        labels = after.select("node", "label")
