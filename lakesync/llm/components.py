"""Connected components of a graph in a table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, spread_join


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root (the smallest node of its component) for every node of edges (a long, b long).

    Each round takes the smallest label among a node and its neighbours, then the label of that label; every round is
    written to scratch, and rounds go on until no label changes. Nulls are no nodes; an empty table has no components.
    """
    edges = edges.where("a is not null and b is not null")
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct()
    both = scratch.table(both, "edges")
    labels = scratch.table(both.groupBy("u").agg(F.least("u", F.min("v")).alias("root")).withColumnRenamed("u", "node"), "labels0")
    degrees = scratch.table(both.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "degrees")
    step = 0
    while True:
        step += 1
        near = spread_join(both, labels.select(F.col("node").alias("v"), F.col("root").alias("near")), "v", F.col("u"), degrees).groupBy("u").agg(F.min("near").alias("near"))
        lower = labels.join(near.withColumnRenamed("u", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("new"))
        lower = scratch.table(lower, "lower")
        jump = labels.select(F.col("node").alias("new"), F.col("root").alias("jump"))
        moved = spread_join(lower, jump, "new", F.col("node"), lower.groupBy("new").agg(F.count(F.lit(1)).alias("n")), "left").select("node", "old", F.least("new", F.coalesce("jump", "new")).alias("root"))
        moved = scratch.table(moved, f"labels{step}")
        changed = moved.where("root <> old").limit(1).count()
        scratch.drop(f"labels{step - 1}")
        labels = moved.select("node", "root")
        if not changed:
            return labels
