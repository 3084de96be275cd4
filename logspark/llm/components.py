"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logspark.session import cut_lineage

MAX_ROUNDS = 64


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, for every node that has an edge.

    ``edges`` has columns a, b in either direction. Each round takes the smallest label among the neighbours
    and then follows that label's own label, so long chains shrink fast. Labels are checkpointed each round;
    only the number of changed labels comes to the driver. Nulls and self-edges are ignored; no edges: no rows.
    """
    both = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = cut_lineage(both.select("a", "b").union(both.select("b", "a")).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")))
    for _ in range(MAX_ROUNDS):
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.least("root", "near").alias("root"), F.col("root").alias("was")
        )
        above = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        step = cut_lineage(
            lower.join(above, "root").select("node", F.least("root", "above").alias("root"), "was")
        )
        changed = step.where("root <> was").limit(1).count()
        labels = step.drop("was")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
