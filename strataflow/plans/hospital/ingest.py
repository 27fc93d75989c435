"""The feeds of the hospital: two databases and a folder of product files."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import SparkSession

from strataflow.plans.hospital.catalog import CLINICAL_TABLES, EQUIPMENT_TABLES, PRODUCT_FEED, TableSpec
from strataflow.sources.landing import CsvFeed, Feed, land_all
from strataflow.sources.relational import jdbc_table

SYSTEMS = {"equipment": EQUIPMENT_TABLES, "clinical": CLINICAL_TABLES}


PARTS = 8  # connections that read a table for its first load


def _feed(spec: TableSpec, options: Mapping[str, str], parts: int = PARTS) -> Feed:
    return Feed(
        spec.name,
        lambda spark: jdbc_table(spark, options, spec.source),
        spec.cursor,
        spec.key,
        lambda spark: jdbc_table(spark, options, spec.source, spec.key[0], parts),
    )


def feeds(databases: Mapping[str, Mapping[str, str]], product_folder: str | None = None) -> list[Feed | CsvFeed]:
    """One feed per table of each system, given the JDBC options of the systems."""
    listed: list[Feed | CsvFeed] = [
        _feed(spec, options) for system, options in databases.items() for spec in SYSTEMS[system]
    ]
    if product_folder is not None:
        listed.append(CsvFeed(PRODUCT_FEED.name, product_folder))
    return listed


def land_hospital(
    spark: SparkSession,
    databases: Mapping[str, Mapping[str, str]],
    landing: str,
    now: datetime,
    product_folder: str | None = None,
) -> dict[str, bool | Exception]:
    """Land what is new in all sources; the outcome of each table by name."""
    return land_all(spark, feeds(databases, product_folder), landing, now)
