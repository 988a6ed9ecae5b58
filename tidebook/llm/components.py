"""Connected components of a graph given as a table of links, without holding the graph anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm import base


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from every linked node: node, component.

    `links` has columns a and b. Each round takes the least label of a node's neighbours and then that
    label's own label, so chains halve; rounds end when no label changes.
    """
    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = base.materialize(ends.filter("a <> b").distinct(), "links")
    labels = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = base.materialize(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = ends.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("best"))
        hooked = labels.join(near, F.col("node") == F.col("a")).select("a", F.col("label").alias("old"), F.least("label", "best").alias("via"))
        moved = hooked.join(labels, F.col("via") == F.col("node")).select(F.col("a").alias("node"), "old", F.least("via", "label").alias("label"))
        moved = base.materialize(moved, "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) after more links (a, b), which are followed from component to component only."""
    between = links.select("a", "b")
    for end in ("a", "b"):
        between = between.join(labels, F.col(end) == F.col("node"), "left").withColumn(end, F.coalesce("component", end)).drop("node", "component")
    tops = components(between).select(F.col("node").alias("of"), F.col("component").alias("top"))
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    fresh = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    return labels.union(fresh).join(tops, F.col("component") == F.col("of"), "left").select("node", F.coalesce("top", "component").alias("component"))
