"""Connected components of an edge table by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.session import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node reachable, for every node that has an edge.

    In each round a node takes the smallest label among its own and its neighbours', and the
    node that was its label takes it too; then labels are replaced by their labels.  Rounds go on
    until nothing changes; their number grows with the logarithm of the longest chain.
    Minima are aggregated before the shuffle, so a node with very many edges is no hot task.
    """
    both = scratch.put(f"{name}-edges", edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
                       .unionByName(edges.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct())
    labels = scratch.put(f"{name}-0", both.groupBy(F.col("x").alias("node")).agg(
        F.least(F.min("y"), F.first("x")).alias("label")))
    done = 0
    while True:
        around = (both.join(labels.toDF("y", "seen"), "y").groupBy(F.col("x").alias("node")).agg(F.min("seen").alias("seen")))
        near = labels.join(around, "node").select("node", "label", F.least("label", "seen").alias("low"))
        # The old label is a node as well; it learns the smallest label that its followers found.
        taught = near.groupBy(F.col("label").alias("node")).agg(F.min("low").alias("taught"))
        new = (near.join(taught, "node", "left")
               .select("node", F.col("label").alias("old"), F.least("low", F.coalesce("taught", "low")).alias("label")))
        step = scratch.put(f"{name}-step{done}", new)
        jumped = (step.join(step.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left")
                  .select("node", F.coalesce("next", "label").alias("label"), "old"))
        done += 1
        result = scratch.put(f"{name}-{done}", jumped)
        scratch.drop(f"{name}-step{done - 1}", f"{name}-{done - 1}")
        if result.where("label <> old").isEmpty():
            scratch.drop(f"{name}-edges")
            return result.select("node", "label")
        labels = result.select("node", "label")
