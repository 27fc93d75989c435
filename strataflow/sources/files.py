"""Delimited files, each landed once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from strataflow.sources.ledger import FILE

INGESTED = "fecha_ingestion"

# Format of the product feed. A quoted field may hold separators,
# doubled quotes and line breaks; nothing between separators is NULL, while a
# quoted empty text stays one.
CSV_OPTIONS = {
    "sep": ";", "header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"', "multiLine": "true",
    "nullValue": "", "emptyValue": "\x01",
}
EMPTY = CSV_OPTIONS["emptyValue"]  # stands for a quoted empty text until the rows are read


def _decoded(name: str) -> Column:
    """A name or path that comes percent-encoded, with "+" standing for itself."""
    return F.url_decode(F.replace(F.col(name), F.lit("+"), F.lit("%2B")))


def _with_lineage(df: DataFrame, ingested_at) -> DataFrame:
    df = df.select(*(F.when(F.col(f"`{c}`") == EMPTY, "").otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns), "_metadata")
    name = _decoded("_metadata.file_name")
    return df.select(*(f"`{c}`" for c in df.columns[:-1]), name.alias(FILE)).withColumn(INGESTED, ingested_at)


def file_names(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Names of files given by the paths that Spark lists them with."""
    if not paths:
        return []
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    return [r[0] for r in rows.select(F.substring_index("path", "/", -1)).collect()]


def new_files(spark: SparkSession, folder: str, landed: DataFrame | None) -> list[str]:
    """Paths of ``.csv`` files whose name is not in ``landed``, the ledger's list.

    Only names are listed; no file is opened.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    files = listing.select("path", F.substring_index("path", "/", -1).alias(FILE))
    if landed is not None:
        files = files.join(landed.select(FILE), FILE, "left_anti")
    return sorted(row.path for row in files.select("path").collect())


def _by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Paths in groups with equal first lines; only the first block of a file is read."""
    lines = (
        spark.read.option("lineSep", "\n").text(list(paths))
        .select("value", _decoded("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
        .filter("block = 0")
        .withColumn("at", F.monotonically_increasing_id())
    )
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return sorted(row.paths for row in groups.collect())


def read_csv_feed(spark: SparkSession, paths: Sequence[str], ingested_at: datetime) -> DataFrame:
    """All columns as text, with the file and time each row came from.

    Every file is read by its own header: columns may come in another order or
    be missing, and are then NULL. The paths are those of new files only.
    """
    parts = [
        _with_lineage(spark.read.options(**CSV_OPTIONS).csv(group), F.lit(ingested_at).cast("timestamp"))
        for group in _by_header(spark, paths)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stream_csv_feed(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """The same feed as a stream; its checkpoint remembers the files seen.

    A file whose header differs from ``columns`` stops the stream.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS, enforceSchema="false")
        .option("pathGlobFilter", "*.csv")
        .csv(folder)
    )
    return _with_lineage(rows, F.current_timestamp())
