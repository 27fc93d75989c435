"""The version of a dimension row that was valid on a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from strataflow.session import materialize

SLICE_ROWS = 2_000_000  # rows of one key that one task sorts


def as_of_lookup(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str,
    columns: Sequence[str],
    end: str | None = None,
    tie: str | None = None,
    inner: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``rows`` with ``columns`` of the version of their ``key`` valid at ``at``.

    A version is valid from ``start`` up to the next version's start, and not
    after ``end`` where it has one; of versions with one start the last by
    ``tie`` counts. Rows before the first version, after the last one's end, or
    without key or time get NULLs, or are left out if ``inner``.

    Rows and versions are put in one order of time per key, and each row takes
    the last version before it: one shuffle, no comparison of ranges. A key
    with more than ``slice_rows`` rows is dealt to several slices, each with
    all of the key's versions, so that none is sorted in one task.
    """
    known = rows.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    hot = known.groupBy(F.col(key).alias("_key")).count().filter(F.col("count") > slice_rows)
    hot = hot.select("_key", F.ceil(F.col("count") / slice_rows).cast("int").alias("_slices"))
    hot = materialize(hot, "hot")  # at most one for every slice_rows rows
    slices = F.coalesce("_slices", F.lit(1))
    kind = rows.schema[at].dataType
    last = [F.col(c) for c in (tie,) if c]

    placed = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(start).cast(kind).alias("_at"),
        F.struct(*last, F.lit(0).alias("_first")).alias("_tie"),
        F.struct(
            (F.lit(None) if end is None else F.col(end)).cast(kind).alias("_end"), *(F.col(c) for c in columns)
        ).alias("_version"),
    )
    placed = placed.join(hot, "_key", "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    asked = known.select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.struct(*rows.columns).alias("_row"),
        F.monotonically_increasing_id().alias("_number"),
    )
    asked = asked.join(hot, "_key", "left").withColumn(
        "_slice", F.pmod(F.xxhash64("_number"), slices.cast("long")).cast("int")
    )
    both = placed.drop("_slices").unionByName(asked.drop("_slices", "_number"), allowMissingColumns=True)
    # versions before rows of the same time
    order = [F.col("_at"), F.col("_row").isNotNull(), F.col("_tie")]
    ahead = Window.partitionBy("_key", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_found", F.last("_version", ignorenulls=True).over(ahead)).filter(F.col("_row").isNotNull())
    valid = F.col("_found").isNotNull() & (F.col("_found._end").isNull() | (F.col("_at") <= F.col("_found._end")))
    picked = [F.when(valid, F.col(f"_found.{c}")).alias(c) for c in columns]
    if inner:
        return found.filter(valid).select("_row.*", *picked)
    rest = rows.filter(F.col(key).isNull() | F.col(at).isNull())
    return found.select("_row.*", *picked).unionByName(rest, allowMissingColumns=True)
