"""Connected components of a link table: smallest reachable node, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.session import stage


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b).

    Each round every node takes the smallest label among its own, its neighbours' and its
    label's own label, so labels travel along whole chains of labels at once. Rounds end
    when no label changes. Each round's labels are written to the shared folder, which cuts
    the lineage; minima are taken before and after the shuffle, so a node with very many
    links is no hot spot, and the join on it is a plain one that adaptive execution splits.
    """
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"),
                                                                 F.col("a").alias("b"))), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select("a", "component")
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        own = labels.join(jump, "component").select(F.col("node").alias("a"),
                                                    F.col("next").alias("component"))
        found = stage(near.unionByName(own).unionByName(
            labels.withColumnRenamed("node", "a")).groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("component")), "labels")
        changed = found.join(labels.withColumnRenamed("component", "old"), "node").where(
            "component != old")
        labels = found
        if changed.isEmpty():
            return labels
