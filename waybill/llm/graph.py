"""Connected components of a graph of numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import forget, written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node with an edge; the label is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then that label's own
    label, so paths halve. Rounds are written to the shared folder; a hot node's edges are
    combined before the shuffle.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both = written(both.filter("node <> other").distinct(), "edges")
    labels = last = written(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        lower = written(
            lower.join(jump, "next", "left").select("node", "label", F.least("next", F.coalesce("far", "next")).alias("new")),
            "labels",
        )
        changed = lower.filter("new <> label").limit(1).count()
        forget(last)
        labels, last = lower.select("node", F.col("new").alias("label")), lower
        if not changed:
            forget(both)
            return labels
