"""Connected components of links between nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarweave.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``); the root is the same for all nodes linked to each other.

    Links are contracted: each node goes over to its smallest neighbour, and what
    links then remain between different nodes are contracted again, until none is
    left. Every step is a join or an aggregation with map-side sums, so a node
    with very many links is no harder than others, and steps are as many as the
    logarithm of the longest path.
    """
    links = stage(links.select("a", "b").where("a != b").distinct(), "links")
    labels = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node"))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("node"), F.least("a", "near").alias("up"))
        near = stage(near, "near")
        # One hop more, to the neighbour's neighbour.
        far = near.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = stage(near.join(far, "up").select("node", "top"), "step")
        labels = stage(
            labels.join(step.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("top", "root").alias("root")),
            "labels",
        )
        links = (
            links.join(step.select(F.col("node").alias("a"), F.col("top").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("top").alias("y")), "b")
            .where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        links = stage(links, "links")
    return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (``node, root``) after more links: only the classes that these touch are contracted."""
    end = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    between = (
        links.select("a", "b").join(end("a"), "a", "left").join(end("b"), "b", "left")
        .select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    )
    merged = components(between)
    moved = labels.join(merged.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    new = merged.join(labels, "node", "left_anti").select("node", "root")
    return stage(moved.select("node", F.coalesce("top", "root").alias("root")).union(new), "labels")
