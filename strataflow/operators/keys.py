"""Dense surrogate keys without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from strataflow.session import materialize


def last_key(dim: DataFrame | None, sk: str) -> int:
    """Highest surrogate key in use, 0 for an empty dimension."""
    if dim is None:
        return 0
    return dim.agg(F.max(sk)).first()[0] or 0


def assign_keys(rows: DataFrame, sk: str, order: Sequence[str], start: int = 0) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in the given order.

    Rows are range-partitioned and sorted, written once, and numbered inside
    each partition; the count of the partitions before it is then added. Only
    those counts, one per partition, are brought together.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "keys")
    part = F.shiftright("_at", 33).alias("_part")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    number = (inside + F.col("_before") + F.lit(start + 1)).cast("long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(number.alias(sk), *rows.columns)
    )
