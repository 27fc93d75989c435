"""Incremental refresh, layer by layer, driven by file streams.

Landing tables and change logs are parquet folders that only grow, so each hop
is a file stream with a checkpoint: the offset moves when a batch is done, and
a batch without data never starts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from strataflow.functions.rules import Rule, passes
from strataflow.operators.changes import (
    ACTION,
    INSERT,
    change_log,
    change_order,
    effective_changes,
    newest_change,
    order_column,
    post_images,
    snapshot_diff,
    soft_delete_column,
    tombstones_after,
)
from strataflow.session import materialize
from strataflow.sources.schema import without_technical
from strataflow.streaming.merged import BATCH, MergedTables, log_schema

DELETED = "deleted"  # table of the keys that were deleted, and when


@dataclass(frozen=True)
class Hop:
    """One table on its way: where it lives and what identifies its rows.

    ``remember`` is how long a deletion is kept against older rows that arrive
    after it: an SQL interval back from the newest row of a batch, or for ever
    if none is given.
    """

    name: str
    keys: tuple[str, ...]
    schema: T.StructType
    root: str
    remember: str | None = None

    def raw(self, spark: SparkSession) -> MergedTables:
        order = order_column(self.schema.names)
        schemas = {"rows": self.schema}
        if order is not None:
            schemas[DELETED] = T.StructType([f for f in self.schema.fields if f.name in (*self.keys, order)])
        return MergedTables(spark, f"{self.root}/raw/{self.name}", schemas, self.keys)

    def cleansed(self, spark: SparkSession) -> MergedTables:
        schemas = {"valid": self.schema, "errors": self.schema}
        return MergedTables(spark, f"{self.root}/cleansed/{self.name}", schemas, self.keys)

    def log(self, layer: str) -> str:
        return f"{self.root}/{layer}/{self.name}/log"


def raw_batch(hop: Hop, rows: DataFrame, batch: int, guard: bool = False) -> None:
    """Merge landed rows into the raw table and log what changed.

    The newest row of a key is chosen while the loader's columns are still
    there: they tell deliveries apart in a table without dates of its own. Only
    rows of the keys that arrive are read from the table to be compared, and
    only what changes is written. Where there is nothing to compare with, the
    newest rows are used once, and not stored in between.
    """
    spark = rows.sparkSession
    table = hop.raw(spark)
    if table.holds(batch):
        return
    order = order_column(rows.columns) if guard else None
    changes = newest_change(rows.withColumn(ACTION, F.lit(INSERT)), hop.keys, change_order(rows.columns))
    changes = without_technical(changes)
    if order is not None or not table.empty("rows"):
        changes = materialize(changes, "changes")

    before, graves, old = table.held("rows", changes), None, None
    if order is not None:
        graves = table.held(DELETED, changes)
        if hop.remember is not None:
            newest = F.lit(changes.agg(F.max(order)).first()[0])
            expired = F.col(order) < newest - F.expr(f"interval {hop.remember}")
            graves, old = graves.filter(~expired), table.read(DELETED).filter(expired)
    changes = effective_changes(before, changes, hop.keys, soft_delete_column(rows.columns), order, graves)
    if graves is not None:
        changes = materialize(changes, "effective")
    logs = {"rows": change_log(before, changes, hop.keys)}
    if graves is not None:
        known = graves if old is None else graves.unionByName(old)
        logs[DELETED] = snapshot_diff(known, tombstones_after(graves, changes, hop.keys, order), hop.keys)
    table.publish(batch, logs)


def cleansed_batch(hop: Hop, log: DataFrame, batch: int, rules: Sequence[Rule]) -> None:
    """Merge a change log into the valid and the error table, both or neither.

    Each side takes only the change rows on its side of the rules: a row that
    turns invalid reaches the valid table as the DELETE of its old version and
    the error table as the INSERT of its new one. Rows without a key are errors.
    """
    spark = log.sparkSession
    tables = hop.cleansed(spark)
    if tables.holds(batch):
        return
    keyed = F.lit(True)
    for key in hop.keys:
        keyed &= F.col(key).isNotNull()
    good = passes(rules, log) & keyed
    logs = {}
    for name, side in (("valid", good), ("errors", ~good)):
        changes = newest_change(log.filter(side), hop.keys, [BATCH]).drop(BATCH)
        if not tables.empty(name):  # then they are used more than once
            changes = materialize(changes, "side")
        logs[name] = change_log(tables.held(name, changes), changes, hop.keys)
    tables.publish(batch, logs)


def changed_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One new version per key that a stretch of change log ends with."""
    return post_images(newest_change(log, keys, [BATCH])).drop(BATCH)


def follow(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    every: str | None = None,
    files_per_batch: int | None = None,
    folders: bool = False,
) -> StreamingQuery:
    """Run ``handle`` on what is new under ``path``; once, or ``every`` interval.

    With ``folders`` files are taken from folders of any name, which then are no columns.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", str(folders).lower())
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = reader.parquet(path).writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def follow_raw(
    spark: SparkSession, hop: Hop, landing: str, schema: T.StructType, guard: bool = False, **options
) -> StreamingQuery:
    """Landing to raw. A later batch wins over an earlier one; with ``guard``,
    only if its rows are not older."""
    return follow(
        spark, f"{landing}/{hop.name}", schema, f"{hop.root}/raw/{hop.name}/checkpoint",
        lambda rows, batch: raw_batch(hop, rows, batch, guard), folders=True, **options,
    )


def follow_cleansed(spark: SparkSession, hop: Hop, rules: Sequence[Rule], **options) -> StreamingQuery:
    """Raw to cleansed."""
    return follow(
        spark, hop.log("raw"), log_schema(hop.schema), f"{hop.root}/cleansed/{hop.name}/checkpoint",
        lambda log, batch: cleansed_batch(hop, log, batch, rules), **options,
    )


def follow_changed(
    spark: SparkSession, hop: Hop, reader: str, handle: Callable[[DataFrame, int], None], **options
) -> StreamingQuery:
    """Cleansed to whatever ``handle`` loads from the changed rows.

    Each ``reader`` keeps its own place in the log.
    """
    return follow(
        spark, hop.log("cleansed"), log_schema(hop.schema), f"{hop.root}/readers/{reader}/checkpoint",
        lambda log, batch: handle(changed_rows(log, hop.keys), batch), **options,
    )
