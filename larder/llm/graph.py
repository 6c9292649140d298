"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node reaches; nodes without an edge are absent.

    Every round a node takes the smallest label among its neighbours and then the label of that label, so a chain of n
    nodes needs about log n rounds. The minimum is combined before the shuffle, which keeps a node with very many
    neighbours cheap. Labels are written to the shared folder each round. Loops, nulls and repeated edges are ignored.
    """
    both = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = materialise(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    labels = materialise(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("node")).alias("label")), "labels")
    while True:
        seen = both.join(labels, both["dst"] == labels["node"]).select(F.col("src").alias("node"), "label")
        nearest = labels.unionByName(seen).groupBy("node").agg(F.min("label").alias("label"))
        roots = nearest.select(F.col("node").alias("root"), F.col("label").alias("above"))
        jumped = nearest.join(roots, F.col("label") == F.col("root")).select("node", F.least("label", "above").alias("label"))
        before = labels.select("node", F.col("label").alias("old"))
        after = materialise(jumped.join(before, "node").select("node", "label", "old"), "labels")
        labels = after.select("node", "label")
        if after.where(F.col("label") != F.col("old")).isEmpty():
            return labels.select("node", F.col("label").alias("component"))
