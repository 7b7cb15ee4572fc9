"""Connected components by label passing and pointer jumping on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpair.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links`` (a, b: long); component is the smallest node reachable.

    Rows with a null end, links of a node to itself and repeated links add nothing; no links give an empty table.

    A round takes each node's smallest label among its neighbours (partial aggregate, so a hub shrinks before the
    shuffle), then the label of that label. Every table of a round is written to the shared checkpoint folder, which cuts
    the lineage, lets a lost executor's work start from files, and leaves both sides of each join plain scans whose hot
    keys adaptive execution can split. Rounds end when no label changes; nothing is collected but that one flag.
    """
    ends = links.where("a is not null and b is not null and a <> b").select("a", "b")
    edges = stored(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")))
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        lower = stored(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label")))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stored(lower.join(jump, "label").select("node", F.col("next").alias("label"), (F.col("next") != F.col("old")).alias("moved")))
        moved = labels.agg(F.max("moved")).first()[0]
        labels = labels.select("node", "label")
        if not moved:
            return labels.withColumnRenamed("label", "component")
