"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orestack.llm.common import saved


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node that has a link.

    Each round takes the smallest label among the neighbours and then the label of that label, so the
    number of rounds follows the logarithm of the longest path. Minima are taken before the shuffle,
    so a node with very many neighbours sends one row per task. Every round is written to the shared
    folder. No links give no rows; repeated, reversed and self links are harmless, null ends are ignored.
    """
    ends = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).dropna()
    edges = saved(ends.union(ends.select("dst", "src")).distinct(), "edges")
    labels = saved(edges.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low"))
                   .select("node", F.least("node", "low").alias("root")), "labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "dst"), "dst")
                .groupBy(F.col("src").alias("node")).agg(F.min("root").alias("low")))
        lower = saved(labels.join(near, "node").select("node", F.col("root").alias("was"),
                                                       F.least("root", "low").alias("root")), "labels")
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = saved(lower.join(jump, "root").select("node", "was", F.col("above").alias("root")), "labels")
        if jumped.filter(F.col("root") != F.col("was")).isEmpty():
            return jumped.select("node", "root")
        labels = jumped.select("node", "root")
