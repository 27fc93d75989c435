"""Levels of a parent-child table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataflow.session import materialize


def hierarchy_levels(nodes: DataFrame, node: str, parent: str, level: str) -> DataFrame:
    """``(node, level)`` for every node that reaches a root; roots have level 1.

    Each round joins a node to what its furthest known ancestor already knows,
    so the distance covered doubles: a chain of depth d takes log2(d) rounds,
    not d. Orphans find no ancestor and drop out. Depths have no gaps, so a
    round that settles nobody leaves only cycles, and the search ends.
    """
    state = materialize(
        nodes.select(F.col(node), F.col(parent).alias("_up"), F.lit(1).cast("long").alias(level)), "levels"
    )
    settled = state.filter(F.col("_up").isNull()).count()
    while True:
        done = state.filter(F.col("_up").isNull())
        ahead = state.select(
            F.col(node).alias("_at"), F.col("_up").alias("_further"), F.col(level).alias("_more")
        )
        jumped = (
            state.filter(F.col("_up").isNotNull())
            .join(ahead, F.col("_up") == F.col("_at"))
            .select(node, F.col("_further").alias("_up"), (F.col(level) + F.col("_more")).alias(level))
        )
        state = materialize(done.unionByName(jumped), "levels")
        reached = state.filter(F.col("_up").isNull()).count()
        if reached == settled:
            return state.filter(F.col("_up").isNull()).select(node, level)
        settled = reached


def with_parent_key(dim: DataFrame, node: str, parent: str, sk: str, parent_sk: str) -> DataFrame:
    """Surrogate key of each row's parent, NULL for roots and unknown parents."""
    lookup = dim.select(F.col(node).alias("_parent"), F.col(sk).alias(parent_sk))
    return dim.drop(parent_sk).join(lookup, F.col(parent) == F.col("_parent"), "left").drop("_parent")
