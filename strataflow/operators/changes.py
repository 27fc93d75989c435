"""Change feeds: newest change per key, merge, snapshot difference.

A change row is a data row plus ``accion`` ('INSERT' or 'DELETE'). An update
is a DELETE of the old row together with an INSERT of the new one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflow.session import materialize

ACTION = "accion"
INSERT, DELETE = "INSERT", "DELETE"

# Column names that mark a logically deleted row, and the
# columns that order changes, best first.
SOFT_DELETE_COLUMNS = ("_is_deleted", "_dlt_deleted", "is_deleted", "borrado")
ORDER_COLUMNS = ("fecha_modificacion", "fecha_registro")
# What tells deliveries apart where a table has no such column.
DELIVERY_COLUMNS = ("_dlt_load_id", "fecha_ingestion")


def _by_lower(columns: Sequence[str]) -> dict[str, str]:
    return {c.lower(): c for c in columns}


def order_column(columns: Sequence[str], fallback: str | None = None) -> str | None:
    """The column that tells newer from older changes."""
    known = _by_lower(columns)
    return next((known[c] for c in ORDER_COLUMNS if c in known), fallback)


def change_order(columns: Sequence[str]) -> list[str]:
    """What orders landed rows: their own date, or else the delivery that brought them."""
    own, known = order_column(columns), _by_lower(columns)
    return [own] if own else [known[c] for c in DELIVERY_COLUMNS if c in known]


def soft_delete_column(columns: Sequence[str]) -> str | None:
    known = _by_lower(columns)
    return next((known[c] for c in SOFT_DELETE_COLUMNS if c in known), None)


def infer_key(columns: Sequence[str]) -> str | None:
    """First ``id_`` column by name. A child table needs its key stated instead."""
    return min((c for c in columns if c.lower().startswith("id_")), default=None)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``newest_first``.

    Spark keeps one row per key and map task before the shuffle, so a hot key
    sends no more rows than there are tasks.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def _keyless(keys: Sequence[str]) -> Column:
    return reduce(or_, (F.col(k).isNull() for k in keys))


def newest_change(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest change per key; on equal order an INSERT outranks the DELETE.

    Equal changes after that are told apart by a hash of the row, so the
    choice does not depend on how the rows were read. A row without a key is
    no version of any other row: such rows are all kept.
    """
    image = F.xxhash64(*[c for c in changes.columns if c != ACTION])
    ranking = [F.col(c).desc_nulls_last() for c in order]
    ranking += [F.col(ACTION).desc(), image.desc()]
    tagged = changes.withColumn("_own", F.when(_keyless(keys), image))
    return latest_per_key(tagged, [*keys, "_own"], ranking).drop("_own")


def rows_with_keys(df: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(keyed.select(*keys), list(keys), "left_semi")


def rows_without_keys(df: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(keyed.select(*keys), list(keys), "left_anti")


def unmatched(batch: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in ``table``.

    The table is first cut down to the keys of the batch, so only the smaller
    side is broadcast or shuffled twice and the table's keys travel once at most.
    """
    known = rows_with_keys(table.select(*keys), batch.select(*keys), keys)
    return rows_without_keys(batch, known, keys)


def effective_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    soft_delete: str | None = None,
    guard: str | None = None,
    tombstones: DataFrame | None = None,
) -> DataFrame:
    """Reduce one-change-per-key ``changes`` to what acts on ``target``.

    A flagged row deletes its match; without a match it is inserted like any
    other. ``guard`` drops changes older than the row they would replace, or
    than the deletion of that row if ``tombstones`` (keys and ``guard``) has it.
    """
    keys = list(keys)
    if soft_delete is not None:
        flagged = F.coalesce(F.col(soft_delete), F.lit(False)) & (F.col(ACTION) == INSERT)
        matched = rows_with_keys(target.select(*keys), changes.filter(flagged).select(*keys), keys)
        matched = matched.distinct().withColumn("_hit", F.lit(True))
        changes = (
            changes.join(matched, keys, "left")
            .withColumn(ACTION, F.when(flagged & F.col("_hit"), DELETE).otherwise(F.col(ACTION)))
            .drop("_hit")
        )
    if guard is not None:
        held = rows_with_keys(target.select(*keys, guard), changes.select(*keys), keys)
        if tombstones is not None:  # a key is either held or deleted
            held = held.unionByName(rows_with_keys(tombstones.select(*keys, guard), changes.select(*keys), keys))
        held = held.withColumnRenamed(guard, "_held")
        stale = F.coalesce(F.col(guard) < F.col("_held"), F.lit(False))
        changes = changes.join(held, keys, "left").filter(~stale).drop("_held")
    return changes


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the changed keys, plus the rows the changes bring.

    Written as an anti join, so a small batch is broadcast and the target is
    neither shuffled nor sorted. A DELETE without a match does nothing.
    """
    kept = rows_without_keys(target, changes, keys)
    brought = changes.filter(F.col(ACTION) == INSERT).select(*target.columns)
    return kept.unionByName(brought)


def tombstones_after(tombstones: DataFrame, changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """(keys, order): deletions on record once the effective ``changes`` are merged.

    A DELETE leaves one with its own place in the order, whether it met a row or
    not; a row that comes back takes it away. A DELETE without a place in the
    order leaves none, as no change could be older than it.
    """
    kept = rows_without_keys(tombstones.select(*keys, order), changes, keys)
    buried = changes.filter((F.col(ACTION) == DELETE) & F.col(order).isNotNull())
    return kept.unionByName(buried.select(*keys, order))


def merged_state(base: DataFrame, log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``base`` with the newest change of each key in ``log``.

    The log is as ``change_log`` writes it, with ``order`` beside it. The base
    is only anti-joined: a log that fits is broadcast, and the base is neither
    shuffled nor sorted.
    """
    newest = newest_change(log, keys, order).drop(*order)
    return apply_changes(base, newest, keys)


def first_state(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``merged_state`` of one batch of log, as ``change_log`` writes it, over nothing.

    Such a log inserts each key once, so only rows without a key are compared.
    """
    fresh, keyless = log.filter(F.col(ACTION) == INSERT), _keyless(keys)
    rows = fresh.filter(~keyless).unionByName(newest_change(fresh.filter(keyless), keys, order))
    return rows.drop(ACTION, *order)


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    soft_delete: str | None = None,
    guard: str | None = None,
) -> DataFrame:
    """Newest change per key, merged into ``target``.

    The batch is stored once reduced: it is used twice, and its real size lets
    Spark broadcast it.
    """
    newest = materialize(newest_change(changes, keys, order), "changes")
    return apply_changes(target, effective_changes(target, newest, keys, soft_delete, guard), keys)


def change_log(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What ``apply_changes`` does to ``target``, as DELETE and INSERT rows.

    Rows that come back unchanged are left out. Only the matched part of the
    target is read; the rest of the work is of the size of the batch.
    """
    before = rows_with_keys(target, changes, keys)
    after = changes.filter(F.col(ACTION) == INSERT).select(*target.columns)
    return snapshot_diff(before, after, keys)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows that turn ``old`` into ``new``; both sides unique per key.

    Rows without a key match nothing; their own hash joins the key so that
    many of them do not meet in one task.
    """
    on, data = [*keys, "_own"], new.columns
    own = F.when(_keyless(keys), F.xxhash64(*data)).otherwise(F.lit(0)).alias("_own")
    left = old.select(*keys, own, F.struct(*data).alias("_old"))
    right = new.select(*keys, own, F.struct(*data).alias("_new"))
    pairs = left.join(right, on, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    images = F.array(
        F.struct(F.lit(DELETE).alias(ACTION), F.col("_old").alias("row")),
        F.struct(F.lit(INSERT).alias(ACTION), F.col("_new").alias("row")),
    )
    return pairs.select(F.inline(images)).filter(F.col("row").isNotNull()).select(ACTION, "row.*")


def post_images(changes: DataFrame) -> DataFrame:
    """New versions of rows only; deletions never reach the star schema."""
    return changes.filter(F.col(ACTION) == INSERT).drop(ACTION)
