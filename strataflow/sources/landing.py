"""Land newly read rows, load by load."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.session import read_or_none
from strataflow.sources.files import INGESTED, file_names, new_files, read_csv_feed
from strataflow.sources.ledger import LOAD, Ledger
from strataflow.sources.relational import footer_mark, incremental_rows
from strataflow.sources.schema import landing_columns


def landed_rows(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """All rows of a landed table."""
    rows = read_or_none(spark, f"{root}/{table}")
    return None if rows is None else rows.drop(LOAD)


def write_load(rows: DataFrame, path: str) -> int:
    """Store a load in place of what a failed one may have left; how many rows it has."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).count()  # from the files' footers


@dataclass(frozen=True)
class Feed:
    """A table to land: where it is read from and what orders its changes.

    ``read_all`` reads the whole table for a first load, where that needs more
    than one connection.
    """

    table: str
    read: Callable[[SparkSession], DataFrame]
    cursor: str
    keys: tuple[str, ...]
    read_all: Callable[[SparkSession], DataFrame] | None = None


@dataclass(frozen=True)
class CsvFeed:
    """A folder of delimited files to land."""

    table: str
    folder: str


def land(spark: SparkSession, feed: Feed | CsvFeed, root: str, now: datetime) -> bool:
    """Land what is new in one feed, as one load.

    What is new is told by the ledger: files by their names, rows by the mark
    of the loads before. Landed rows are only read at the mark itself, and only
    from the loads that reach it.
    """
    ledger = Ledger(spark, root, feed.table)
    if isinstance(feed, CsvFeed):
        loads, names = ledger.loads(), ledger.files()
        paths = new_files(spark, feed.folder, names)
        if not paths:
            return False
        load = max(loads, default=-1) + 1
        rows = write_load(read_csv_feed(spark, paths, now), ledger.folder(load))
        ledger.commit(load, None, file_names(spark, paths))
        return rows > 0
    loads = ledger.loads()
    load, reached = max(loads, default=-1) + 1, None
    reader = feed.read_all if not loads and feed.read_all is not None else feed.read
    source = landing_columns(reader(spark))
    if loads:
        # marks are texts: compared as values of the cursor, by Spark
        kind = dict(source.dtypes)[feed.cursor]
        marks = spark.createDataFrame([(n, m) for n, m in loads.items() if m is not None], "n long, m string")
        reached = marks.agg(F.max(F.col("m").cast(kind)).cast("string")).first()[0]
    fresh = source
    if reached is not None:
        at = [ledger.folder(n) for n, m in loads.items() if m == reached]
        fresh = incremental_rows(source, spark.read.parquet(*at), feed.cursor, list(feed.keys), mark=reached)
    fresh = fresh.withColumn(INGESTED, F.lit(now).cast("timestamp"))
    if not write_load(fresh, ledger.folder(load)):
        return False
    newest = footer_mark(spark, ledger.folder(load), feed.cursor).first()[0]
    ledger.commit(load, newest if newest is not None else reached)
    return True


def land_all(
    spark: SparkSession, feeds: Iterable[Feed | CsvFeed], root: str, now: datetime, at_once: int = 3
) -> dict[str, bool | Exception]:
    """Land every feed; one that fails is reported and does not stop the others."""

    def attempt(feed):
        try:
            return land(spark, feed, root, now)
        except Exception as error:  # noqa: BLE001 - reported to the caller
            return error

    feeds = list(feeds)
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip((f.table for f in feeds), pool.map(attempt, feeds)))
