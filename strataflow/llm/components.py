"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.session import materialize


TASK_ROWS = 500_000  # rows of a counted table that one task is meant to hold


def tasks_for(df: DataFrame, rows: int, per_task: int = TASK_ROWS) -> DataFrame:
    """``df``, whose rows are about ``rows`` as counted before, in as many tasks as they are worth.

    Never more than it has: a large table keeps its partitions.
    """
    return df.coalesce(max(1, -(-rows // per_task)))


def _settled(links: DataFrame, rows: int) -> bool:
    """Is every node under one root, and no root under another node?"""
    nodes = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ups = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return tasks_for(ups, 2 * rows).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node it reaches.

    Large-star and small-star steps in turn: each round hangs neighbours under
    the smallest one, and the number of rounds grows with the logarithm of a
    component's size. Nodes are never gathered; every step is a join with
    minima, so one node may have a third of all links. An empty list gives none.
    """
    rows = links.count()
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(tasks_for(pairs, rows), "links")
    for _ in range(most_rounds):
        if _settled(links, rows):
            break
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # Large star: every larger neighbour of a goes under a's minimum.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(tasks_for(large, rows), "links")
        # Small star: a and its smaller neighbours go under the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = materialize(tasks_for(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), 2 * rows), "links")
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
