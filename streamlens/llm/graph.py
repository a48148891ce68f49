"""Connected groups of linked nodes, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.common import dropped, written


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (columns a, b): the least node that is
    reachable. Each round gives a node the least label around it and then its label's label, so
    chains shorten by doubling; a node with many links is reduced before each shuffle. Rounds end
    when no label changes; each is written in the shared folder, so a lost executor costs one round; the one before is deleted then."""
    both = edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    links = written(both, "links")
    labels = written(links.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component")), "labels")
    while True:
        near = links.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("low"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("component").alias("was"), F.least("component", "low").alias("low"))
        up = labels.select(F.col("node").alias("of"), F.col("component").alias("further"))
        now = low.join(up, F.col("low") == F.col("of"), "left").select("node", "was", F.least("low", F.coalesce("further", "low")).alias("component"))
        now = written(now, "labels")
        dropped(labels)
        labels = now.select("node", "component")
        if not now.where("was <> component").limit(1).count():
            dropped(links)
            return labels
