"""Connected components of a link table, by label propagation with pointer
jumping.

Each round replaces a node's label by that label's label, then gives it the
least label among its neighbours' and its own: one grouping, which also tells
whether any link still joins different labels.  Rounds read and write tables in
the shared folder, so lineage stays short and a lost executor costs a task.  A
node with a third of all links is a pre-aggregated row per task in the grouping
and a split partition in the join; labels few enough are broadcast instead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmeter.llm.common import maybe_broadcast, written


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the least node
    of its component.  Self-links and repeated links are allowed."""
    links = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = written(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                     .select("node", F.least("node", "least").alias("root")), "labels")
    n = labels.count()
    while True:
        jump = maybe_broadcast(labels.select(F.col("node").alias("root"), F.col("root").alias("next")), n)
        labels = written(labels.join(jump, "root").select("node", F.col("next").alias("root")), "labels-jump")
        met = both.join(maybe_broadcast(labels.select(F.col("node").alias("b"), "root"), n), "b").select(F.col("a").alias("node"), "root")
        labels = written(met.union(labels).groupBy("node").agg(F.min("root").alias("root"), F.max("root").alias("high")), "labels")
        if labels.where("root != high").isEmpty():  # no link between different labels
            return labels.select("node", "root")
        labels = labels.select("node", "root")
