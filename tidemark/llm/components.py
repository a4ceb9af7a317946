"""Connected components of a graph given as links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest id reachable, for every id in ``links`` (a, b).

    Every round takes the smallest label among the neighbours, then follows
    labels once more, so chains shorten by a power of two. Minima are combined
    before each shuffle, and the changed labels are counted while they are
    written. Ends when nothing changes; null ids have no links.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stored(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    )
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        reached = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(reached, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("label")
        )
        further = labels.select(F.col("node").alias("label"), F.col("component").alias("next"))
        changes = Observation()
        stepped = (
            nearer.join(further, "label", "left")
            .select("node", "before", F.least("label", F.coalesce("next", "label")).alias("component"))
            .observe(changes, F.count_if(F.col("component") != F.col("before")).alias("changed"))
        )
        labels = stored(stepped.select("node", "component"))
        if not changes.get["changed"]:
            return labels
