"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import discard, stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the edges, for every node in them.

    Each round takes the smallest label among a node's neighbours (a grouped
    minimum, combined map-side, so a hub is no hot task) and then the label of
    that label, which halves the distances. Rounds end when no label changes;
    every round is a staged table, so no lineage grows.
    """
    both = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                 .unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).filter("u <> v").distinct(), "edges")
    labels = stage(both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("component")), "labels")
    while True:
        seen = (both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("m")))
        hooked = labels.join(seen, labels["node"] == seen["u"]).select("node", "component", F.least("component", "m").alias("next"))
        root = labels.select(F.col("node").alias("root"), F.col("component").alias("up"))
        jumped = hooked.join(root, hooked["next"] == root["root"]).select(
            "node", F.least("next", "up").alias("component"), (F.least("next", "up") < F.col("component")).alias("moved"))
        step = stage(jumped, "labels")
        done = step.filter("moved").isEmpty()
        discard(labels)
        labels = step.select("node", "component")
        if done:
            return labels
