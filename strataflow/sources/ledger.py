"""What was landed, load by load.

A load is one folder of a table and one entry here, written after it. A load
without its entry was cut off: the next one takes its number and replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.session import read_or_none

LOAD, FILE = "carga", "fichero_origen"
ENTRY = f"{LOAD} long, marca string, {FILE} string"


class Ledger:
    """``marca`` is the highest cursor value of a load as text; files are listed by name, one line each."""

    def __init__(self, spark: SparkSession, root: str, table: str):
        self.spark, self.path, self.data = spark, f"{root}/ledger/{table}", f"{root}/{table}"

    def lines(self) -> DataFrame | None:
        return read_or_none(self.spark, self.path, ENTRY)

    def loads(self) -> dict[int, str | None]:
        """Mark of each load."""
        lines = self.lines()
        if lines is None:
            return {}
        return {r[0]: r[1] for r in lines.groupBy(LOAD).agg(F.max("marca")).collect()}

    def files(self) -> DataFrame | None:
        lines = self.lines()
        return None if lines is None else lines.filter(F.col(FILE).isNotNull()).select(FILE)

    def folder(self, load: int) -> str:
        return f"{self.data}/{LOAD}={load}"

    def commit(self, load: int, mark: str | None, files: Sequence[str] = ()) -> None:
        lines = [(mark, name) for name in files] or [(mark, None)]
        entry = self.spark.createDataFrame(lines, f"marca string, {FILE} string")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{LOAD}={load}")
