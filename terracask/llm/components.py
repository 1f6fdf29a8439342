"""Connected components by minimum labels with pointer jumping, on DataFrames.

Only edges and labels of nodes that have edges are held, as tables in the shared folder;
nothing is gathered at the driver but the count of changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, write_table

MOST_ROUNDS = 60


def components(spark: SparkSession, edges: DataFrame) -> tuple[DataFrame, str]:
    """(node, comp) for every node of ``edges`` (a, b), comp being its component's smallest
    node; and the path of that table."""
    both = edges.select(F.col("a"), F.col("b")).union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both, edge_path = write_table(spark, both.toDF("node", "other"), "edges")
    labels, path = write_table(spark, both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("comp")), "labels")
    for _ in range(MOST_ROUNDS):
        other = labels.select(F.col("node").alias("other"), F.col("comp").alias("other_comp"))
        near = both.join(other, "other").groupBy("node").agg(F.min("other_comp").alias("near"))
        # A node's label is a node of its component, so the smallest label that any node with
        # that label sees may replace it for all of them.
        seen = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("best"))
        hooks = seen.groupBy("comp").agg(F.min("best").alias("hook"))
        step = seen.join(hooks, "comp").select("node", F.col("comp").alias("old"), F.col("hook").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("comp").alias("jumped"))
        moved = step.join(jump, "mid", "left").select("node", "old", F.least("mid", F.coalesce("jumped", "mid")).alias("comp"))
        new, new_path = write_table(spark, moved, "labels")
        changed = new.where("old <> comp").limit(1).count()
        drop_path(spark, path)
        labels, path = new.select("node", "comp"), new_path
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    drop_path(spark, edge_path)
    return labels, path
