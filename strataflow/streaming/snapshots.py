"""Tables that change, kept as plain parquet.

Rows are spread over buckets by a hash of their key. A batch rewrites only the
buckets it touches, into a folder of its own, and then records in one small
file which folder holds each bucket. Readers follow the record, so a
batch shows up whole, in all its tables at once, or not at all; a batch that is
repeated finds its record and does nothing.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strataflow.streaming.merged import Record

RECORD = "batch long, table string, bucket int, version long"


def _number(folder: str, path: str) -> int:
    return int(re.search(rf"/{folder}=(\d+)/", path)[1])


class Snapshots:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schemas: Mapping[str, T.StructType | None],
        keys: Sequence[str],
        buckets: int = 64,
    ):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.schemas = dict(schemas)
        self.record = Record(spark, f"{path}/record", RECORD)
        self._known: tuple[int, dict[tuple[str, int], int]] | None = None

    def _record(self) -> tuple[int, dict[tuple[str, int], int]]:
        """Newest batch, and the version that holds each bucket of each table.

        One stream writes a table, so what this object has seen stays true.
        """
        if self._known is None:
            rows = self.record.read()  # at most one row per table and bucket, plus one
            last = rows[0].batch if rows else -1
            self._known = last, {(r.table, r.bucket): r.version for r in rows if r.table is not None}
        return self._known

    def batch(self) -> int:
        return self._record()[0]

    def holds(self, batch: int) -> bool:
        return self.batch() >= batch

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets the changes fall in; never more than there are buckets."""
        return [r[0] for r in changes.select(self.bucket()).distinct().collect()]

    def read(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The table as of the newest batch, or only some of its buckets.

        Without rows: an empty table, or None where no schema was given.
        """
        schema = self.schemas[table]
        _, held = self._record()
        wanted = None if buckets is None else set(buckets)
        paths = [
            f"{self.path}/{table}/version={version}/bucket={bucket}"
            for (name, bucket), version in sorted(held.items())
            if name == table and (wanted is None or bucket in wanted)
        ]
        if not paths:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def publish(self, batch: int, rows: Mapping[str, DataFrame], buckets: Sequence[int]) -> None:
        """Replace the given buckets of the given tables by ``rows``."""
        _, held = self._record()
        replaced, version = set(buckets), max(held.values(), default=-1) + 1
        for table, df in rows.items():
            target = f"{self.path}/{table}/version={version}"
            # buckets of any size: large ones are split over tasks, small ones merged
            placed = df.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
            writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "static")
            writer.partitionBy("bucket").parquet(target)
            written = {_number("bucket", f) for f in self.spark.read.schema("bucket int").parquet(target).inputFiles()}
            held = {k: v for k, v in held.items() if k[0] != table or k[1] not in replaced}
            held |= {(table, bucket): version for bucket in written}
        lines = [(batch, None, None, None)] + [(batch, t, b, v) for (t, b), v in held.items()]
        self.record.write(lines)
        self._known = batch, held
