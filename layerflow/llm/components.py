"""Connected components of a table of links, by label propagation with pointer jumping on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the smallest node reachable.

    Every round takes the least label among the neighbours and then the label of
    that label, so the number of rounds grows with the logarithm of the longest
    path. Least labels are combined on the map side, so a node with a third of all
    links is no hot group. Rounds are written to the shared folder.
    """
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(links.filter("a <> b").select(F.inline(ends)).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("least"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = labels.join(near.withColumnRenamed("a", "node"), "node").join(hop, "label").select(
            "node", F.least("next", "least").alias("new"), "label")
        new = written(moved.select("node", F.col("new").alias("label"), (F.col("new") < F.col("label")).alias("changed")), "labels")
        labels = new.select("node", "label")
        if new.filter("changed").isEmpty():
            return labels
