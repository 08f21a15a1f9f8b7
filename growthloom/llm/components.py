"""Connected components of an edge table, by minimum labels and pointer jumping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.session import discard, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of (a, b): label is the smallest node reachable.

    Each round takes the smallest label among the neighbours, then the label of that label. Rounds are written to the
    shared folder; the driver sees one count per round. Hubs are summed map-side and their joins are left to AQE to split.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("heard"))
        near = labels.join(heard, labels["node"] == heard["a"]).select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = stage(near.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")), "labels")
        discard(labels)
        labels = after.select("node", "label")
        labels._staged = after._staged
        if not after.where("label <> old").limit(1).count():
            discard(both)
            return labels
