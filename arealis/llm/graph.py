"""Connected components of links, with every step in tables of the shared folder.

Each round gives a node the smallest label among its neighbours' and its own,
and then follows labels to their labels, so that paths shrink by powers. Links
are read by both ends with splittable joins; minima are taken with partial
aggregation, so a node with very many links is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import spread_join
from arealis.scratch import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node and component (the smallest node reachable) for all ends of links."""
    edges = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    edges = stored(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = stored(edges.groupBy(F.col("x").alias("node")).agg(F.least("node", F.min("y")).alias("component")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("y"), "component"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("component", "near").alias("low"), F.col("component").alias("old"))
        follow = labels.select(F.col("node").alias("low"), F.col("component").alias("next"))
        jumped = lower.join(follow, "low").select("node", F.least("low", "next").alias("component"), "old")
        step = stored(jumped, "labels")
        labels = step.select("node", "component")
        if step.where("component <> old").isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Columns node and component after further links (a, b), which join the components known so far and new nodes."""
    for end in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")), end, "left")
    ends = links.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    moved = components(stored(ends.where("a <> b").distinct(), "between"))
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    sizes = labels.groupBy("component").agg(F.count("*").alias("_n")).join(to, "component", "left")
    sizes = stored(sizes.select("component", F.coalesce("to", "component").alias("to"), "_n"), "moved")
    known = spread_join(labels, sizes, ["component"], ["node"]).select("node", F.col("to").alias("component"))
    return stored(known.unionByName(moved.join(labels.select("node"), "node", "left_anti")), "labels")
