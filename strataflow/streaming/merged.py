"""Tables merged when they are read: a base, and the changes that came after it.

A batch writes its changes and one small record, nothing of the table itself.
The current state is the newest change of each key over the base. When the
changes have grown to a share of the base they are folded into a new one, so
that what is written stays in proportion to what has changed. A batch shows up
with its record, in all its tables at once, or not at all; a batch that is
repeated finds its record and does nothing, and one that was cut off replaces
the files it had left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, types as T

from strataflow.operators.changes import ACTION, first_state, merged_state, rows_with_keys
from strataflow.session import deal_unions_again, materialize, read_or_none

BATCH = "lote"
FOLD_SHARE = 0.25  # changes, as a share of the base, that are folded
MOST_LOGS = 1000  # batches that are folded at the latest


class Record:
    """Lines that say what counts, kept in two slots that are written in turn.

    While one slot is replaced the other still holds the lines before it; the
    higher serial number is the newer one. One writer only.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, f"serial long, {schema}"
        self._serial: int | None = None

    def read(self) -> list:
        """The newest lines; none if nothing was recorded yet."""
        newest: list = []
        for slot in (0, 1):
            rows = read_or_none(self.spark, f"{self.path}/slot={slot}", self.schema)
            lines = [] if rows is None else rows.collect()
            if lines and (not newest or lines[0].serial > newest[0].serial):
                newest = lines
        self._serial = newest[0].serial if newest else -1
        return newest

    def write(self, lines: Sequence[tuple]) -> None:
        if self._serial is None:
            self.read()
        serial = self._serial + 1
        rows = self.spark.createDataFrame([(serial, *line) for line in lines], self.schema).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/slot={serial % 2}")
        self._serial = serial


@dataclass(frozen=True)
class Held:
    """A table's base, named by the batch that it includes, and the batches of changes after it."""

    base: int = -1
    base_rows: int = 0
    logs: Mapping[int, int] = field(default_factory=dict)  # rows by batch


class MergedTables:
    """``schemas`` by table; the first table's changes are the ones that others follow.

    ``lines`` of a record are at most ``MOST_LOGS`` for each table.
    """

    LINE = "batch long, table string, base long, base_rows long, log long, log_rows long"

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schemas: Mapping[str, T.StructType],
        keys: Sequence[str],
        fold_share: float = FOLD_SHARE,
        most_logs: int = MOST_LOGS,
    ):
        self.spark, self.path, self.schemas, self.keys = spark, path, dict(schemas), list(keys)
        self.fold_share, self.most_logs = fold_share, most_logs
        self.record = Record(spark, f"{path}/record", self.LINE)
        self._known: tuple[int, dict[str, Held]] | None = None
        deal_unions_again(spark)  # the current state is a union

    def log(self, table: str) -> str:
        """Folder of a table's changes, one folder in it for each batch."""
        return f"{self.path}/log" if table == next(iter(self.schemas)) else f"{self.path}/{table}/log"

    def _state(self) -> tuple[int, dict[str, Held]]:
        """One stream writes these tables, so what this object has seen stays true."""
        if self._known is None:
            lines = self.record.read()
            last = lines[0].batch if lines else -1
            held: dict[str, Held] = {}
            for r in lines:
                if r.table is not None:
                    before = held.get(r.table, Held(r.base, r.base_rows))
                    held[r.table] = before if r.log is None else replace(before, logs={**before.logs, r.log: r.log_rows})
            self._known = last, held
        return self._known

    def batch(self) -> int:
        return self._state()[0]

    def holds(self, batch: int) -> bool:
        return self.batch() >= batch

    def empty(self, table: str) -> bool:
        """Has nothing been recorded for the table yet?"""
        state = self._state()[1].get(table, Held())
        return state.base < 0 and not state.logs

    def read(self, table: str) -> DataFrame:
        """The table as of the newest record."""
        return self._merged(table, self._state()[1].get(table, Held()))

    def held(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows of the table with the keys of ``rows``, stored: a batch needs them more than once."""
        if self.empty(table):
            return self.read(table)
        return materialize(rows_with_keys(self.read(table), rows, self.keys), "held")

    def _merged(self, table: str, held: Held) -> DataFrame:
        schema = self.schemas[table]
        if held.base < 0:
            # a limit that Spark knows to be empty, so that joins with it are left out of the plan
            base = self.spark.createDataFrame([], schema).limit(0)
        else:
            base = self.spark.read.schema(schema).parquet(f"{self.path}/{table}/base={held.base}")
        if not held.logs:
            return base
        folder = self.log(table)
        paths = [f"{folder}/{BATCH}={batch}" for batch in held.logs]
        log = self.spark.read.schema(log_schema(schema)).option("basePath", folder).parquet(*paths)
        if held.base < 0 and len(held.logs) == 1:
            return first_state(log, self.keys, [BATCH])
        return merged_state(base, log, self.keys, [BATCH])

    def publish(self, batch: int, logs: Mapping[str, DataFrame]) -> None:
        """Record changes, as ``change_log`` writes them, as ``batch``."""
        held = dict(self._state()[1])
        for table, changes in logs.items():
            path = f"{self.log(table)}/{BATCH}={batch}"
            rows = written_rows(changes, path)
            before = held.get(table, Held())
            if rows:
                held[table] = replace(before, logs={**before.logs, batch: rows})
            held[table] = self._folded(table, batch, held.get(table, before))
        lines = [(batch, None, None, None, None, None)]
        for table, h in held.items():
            lines.append((batch, table, h.base, h.base_rows, None, None))
            lines += [(batch, table, h.base, h.base_rows, log, rows) for log, rows in h.logs.items()]
        self.record.write(lines)
        self._known = batch, held

    def _folded(self, table: str, batch: int, held: Held) -> Held:
        waiting = sum(held.logs.values())
        if waiting <= self.fold_share * held.base_rows and len(held.logs) < self.most_logs:
            return held
        path = f"{self.path}/{table}/base={batch}"
        return Held(batch, written_rows(self._merged(table, held), path))


def written_rows(df: DataFrame, path: str) -> int:
    """Replace what is at ``path`` by ``df``, and count it from the files' footers."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def log_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(ACTION, T.StringType()), *schema.fields, T.StructField(BATCH, T.LongType())])
