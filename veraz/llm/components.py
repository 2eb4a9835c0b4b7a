"""Connected components of a link table by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.llm.shared import checkpoint


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component): the smallest node reachable. Nodes without links are absent.

    Each round a node takes the smallest label of itself and its neighbours, then the label of
    that label. Labels only fall, and the rounds end when none has changed. Nothing is collected.
    """
    both = links.select("a", "b").where("a <> b").distinct()
    edges = checkpoint(both.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(both.select(F.col("b").alias("src"), F.col("a").alias("dst"))).distinct())
    labels = checkpoint(edges.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("label")).select(F.col("src").alias("node"), "label"))
    while True:
        near = edges.join(labels.select(F.col("node").alias("dst"), "label"), "dst").groupBy("src").agg(F.min("label").alias("near"))
        met = labels.join(near, labels.node == near.src).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        state = checkpoint(met.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")))
        labels = state.select("node", "label")
        if not state.where("was <> label").limit(1).count():
            return labels.withColumnRenamed("label", "component")
