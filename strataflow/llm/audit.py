"""How filters interact, over every order in which they could be applied.

A document is known by the set of filters that it fails, its mask. Under an
order of the filters it is removed at the first one that it fails. Orders are
ranked lexicographically by their Lehmer code, so the orders that begin with
one sequence of filters are an interval of ranks: a mask is removed at step k
by a filter on exactly the intervals of those prefixes of k filters whose last
one it fails and whose others it passes. Counts are added where an interval
begins and taken off where it ends; a running sum over the ranks gives every
order's figures at once. Only counts by mask are worked on, never documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.session import materialize

# The contract's filters, in the order of their bits.
FILTERS = "ABCDE"
MIN_WORDS = 200  # A: fewer
MIN_DISTINCT = 50  # B: distinct words below so many in a hundred
MAX_CAPITALS = 3  # C: capitals above so many in a hundred code points
SYMBOLS = "[#$%&*|]"  # D: holds any

_GAP = "[ \\x09-\\x0D]+"
_COUNTS = ("docs", "good", "toxic")


def orders(filters: str = FILTERS) -> list[str]:
    """All orders of the filters; an order's place in the list is its rank."""
    return ["".join(p) for p in permutations(sorted(filters))]


def lehmer_interval(prefix: Sequence[int], n: int) -> tuple[int, int]:
    """Ranks, end exclusive, of the orders of 0 .. n - 1 that begin with ``prefix``."""
    rank = 0
    for k, item in enumerate(prefix):
        smaller = sum(1 for j in range(item) if j not in prefix[:k])
        rank += smaller * factorial(n - 1 - k)
    return rank, rank + factorial(n - len(prefix))


def removal_edges(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, change): where intervals in which a mask is removed at a step begin (1) and end (-1).

    Neighbouring intervals are joined. The size depends on ``n`` alone.
    """
    edges: Counter = Counter()
    for step in range(1, n + 1):
        for prefix in permutations(range(n), step):
            lo, hi = lehmer_interval(prefix, n)
            fails, passes = 1 << prefix[-1], sum(1 << p for p in prefix[:-1])
            for mask in range(1 << n):
                if mask & fails and not mask & passes:
                    edges[mask, step, lo] += 1
                    edges[mask, step, hi] -= 1
    return [(*at, change) for at, change in sorted(edges.items()) if change]


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from ``counts`` (part, mask, docs, good, toxic).

    Bit i of a mask stands for the i-th filter by name. Each part gets all its
    rows, zeros included; a part without rows in ``counts`` gets none, so an
    empty table gives an empty result. The work after the counts is the same
    for a part of ten rows and of ten billion.
    """
    names = sorted(filters)
    n = len(names)
    spark = counts.sparkSession
    edges = spark.createDataFrame(removal_edges(n), "mask int, step int, rank int, change int")  # fixed size
    listed = orders(filters)

    def per_filter(test) -> Column:
        return F.array(*[F.sum(F.when(test(1 << i), F.col("docs")).otherwise(0)) for i in range(n)])

    parts = counts.groupBy("part").agg(
        F.sum("docs").alias("total"),
        per_filter(lambda bit: F.col("mask").bitwiseAND(bit) != 0).alias("fails"),
        per_filter(lambda bit: F.col("mask") == bit).alias("alone"),
    )
    grid = parts.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(len(listed) - 1))).alias("rank")
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    changes = counts.join(F.broadcast(edges), "mask").where(F.col("rank") < len(listed))
    sums = [F.sum(F.col(c) * F.col("change")).alias(c) for c in _COUNTS]
    changes = changes.groupBy("part", "step", "rank").agg(*sums)
    ahead = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = [F.sum(F.coalesce(F.col(c), F.lit(0))).over(ahead).alias(c) for c in _COUNTS]
    order = F.element_at(F.array(*map(F.lit, listed)), F.col("rank") + 1)
    at = grid.join(changes, ["part", "step", "rank"], "left").select(
        "part", "total", "fails", "alone", "rank", "step", order.alias("filter_order"), *running
    )
    at = at.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1))).withColumn(
        "bit", F.instr(F.lit("".join(names)), F.col("filter"))
    )
    earlier = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return at.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("docs").over(earlier)).alias("kept"),
        F.col("docs").alias("removed"),
        (F.element_at("fails", F.col("bit")) - F.col("docs")).alias("redundant"),
        F.element_at("alone", F.col("bit")).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("docs").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def _fails(text: Column) -> Column:
    """Bits of the filters that look at one text alone (A to D)."""
    words = F.array_remove(F.split(text, _GAP), "")
    n = F.size(words).cast("bigint")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = (
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * n,
        100 * capitals.cast("bigint") > MAX_CAPITALS * F.length(text),
        text.rlike(SYMBOLS),
    )
    return sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)), F.lit(0))


def failure_counts(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """(part, mask, docs, good, toxic): how many rows of a part fail exactly the filters of a mask.

    Texts leave their row as a hash of 256 bits; equal hashes count as equal
    texts. Each hash's smallest id is found with partial sums, so a text that
    fills a third of the table is one row per task, and rows meet it by hash
    and id together, which no copy shares.

    A null text is empty and a null part the empty string. A row without an id
    fails E never and has no label; rows that share an id and a text are not
    copies of each other, as neither id is smaller. Labels of one id are
    joined: good or toxic if any of its rows is. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("hash"),
        _fails(text).alias("mask"),
    )
    rows = materialize(rows, "marks")
    known = rows.where("id is not null")
    first = materialize(known.groupBy("hash").agg(F.min("id").alias("id")).withColumn("first", F.lit(True)), "first")
    marked = known.join(first, ["hash", "id"], "left").select(
        "id", "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(16)).alias("mask")
    )
    flag = labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    flag = flag.where("id is not null and (good or toxic)").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    flag = materialize(flag, "flags")
    labelled = marked.join(flag, "id", "left").select("part", "mask", "good", "toxic")
    none = F.lit(False)
    return (
        labelled.unionByName(rows.where("id is null").select("part", "mask", none.alias("good"), none.alias("toxic")))
        .groupBy("part", "mask")
        .agg(F.count("*").alias("docs"), *[F.count_if(F.coalesce(F.col(c), none)).alias(c) for c in ("good", "toxic")])
    )


def audit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """Per part, order of the five filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    ``kept`` counts the part's rows after the step, ``removed`` those that go
    there, ``redundant`` those that fail the step's filter and went earlier,
    ``unique_fails`` those that fail no other filter, ``good_lost`` and
    ``toxic_lost`` the labelled ones among the removed, ``shapley`` what the
    filter removes over all orders. Cases: see ``failure_counts`` and ``interactions``.
    """
    counts = failure_counts(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)
    return interactions(materialize(counts, "counts"))
