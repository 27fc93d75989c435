"""Tables that only grow, by whole loads.

A load is written into a folder of its own and then entered in the record, with
the range of its keys. It shows up whole or not at all; a load that was cut off
is replaced by its repetition. A batch that asks which keys are there already
reads only the loads whose range holds one of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.streaming.merged import Record

LOAD = "carga"


@dataclass(frozen=True)
class Load:
    """``low`` and ``high`` are those of its keys, ``last`` is its highest row key."""

    batch: int
    load: int
    rows: int
    low: int | None
    high: int | None
    last: int | None


class Loads:
    """``key`` is an integer column that identifies rows, ``row_key`` their number."""

    LINE = "batch long, load long, rows long, low long, high long, last long"

    def __init__(self, spark: SparkSession, path: str, key: str, row_key: str):
        self.spark, self.path, self.key, self.row_key = spark, path, key, row_key
        self.record = Record(spark, f"{path}/record", self.LINE)
        self._known: list[Load] | None = None

    def loads(self) -> list[Load]:
        if self._known is None:
            self._known = [Load(*(r[c] for c in ("batch", "load", "rows", "low", "high", "last"))) for r in self.record.read()]
        return self._known

    def batch(self) -> int:
        return max((x.batch for x in self.loads()), default=-1)

    def holds(self, batch: int) -> bool:
        return self.batch() >= batch

    def last_key(self) -> int:
        return max((x.last or 0 for x in self.loads()), default=0)

    def read(self, loads: Sequence[int] | None = None) -> DataFrame | None:
        """All loads, or some; None where they have no rows."""
        paths = [
            f"{self.path}/rows/{LOAD}={x.load}" for x in self.loads() if x.rows and (loads is None or x.load in loads)
        ]
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(*paths).drop(LOAD)

    def near(self, rows: DataFrame, column: str) -> DataFrame | None:
        """Rows whose key may be among those of ``rows``: only loads with such a key are read.

        None only where nothing was loaded at all.
        """
        whole = self.read()
        low, high = rows.agg(F.min(column), F.max(column)).first()
        if whole is None or low is None:
            return whole
        ranges = [(x.load, x.low, x.high) for x in self.loads() if x.rows and x.low is not None and x.low <= high and x.high >= low]
        if len(ranges) > 1:  # one line for each load
            known = F.broadcast(self.spark.createDataFrame(ranges, "_load long, _low long, _high long"))
            met = rows.select(column).join(known, F.col(column).between(F.col("_low"), F.col("_high")))
            met = {r[0] for r in met.select("_load").distinct().collect()}
            ranges = [x for x in ranges if x[0] in met]
        if not ranges:
            return whole.limit(0)
        return self.read([x[0] for x in ranges]).filter(F.col(self.key).between(low, high))

    def publish(self, batch: int, rows: DataFrame, by: str) -> Load:
        """Store ``rows``, partitioned by the column ``by`` and sorted by key, as the next load."""
        load = max((x.load for x in self.loads()), default=-1) + 1
        path = f"{self.path}/rows/{LOAD}={load}"
        placed = rows.hint("rebalance", by).sortWithinPartitions(by, self.key)
        # static: what a load that was cut off has left goes, whatever months it was of
        placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
        stats = self.spark.read.schema(rows.schema).parquet(path).agg(
            F.count("*"), F.min(self.key), F.max(self.key), F.max(self.row_key)
        ).first()
        entry = Load(batch, load, *stats)
        self.record.write([(x.batch, x.load, x.rows, x.low, x.high, x.last) for x in [*self.loads(), entry]])
        self._known = [*self.loads(), entry]
        return entry
