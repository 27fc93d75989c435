"""Incremental reads of database tables by a cursor column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def even_bounds(spark: SparkSession, options: Mapping[str, str], table: str, column: str, parts: int) -> list:
    """Values that cut ``column`` into ``parts`` of equal numbers of rows.

    The database works them out; one row for each part comes back.
    """
    query = (
        f"SELECT MIN({column}) AS lo FROM (SELECT {column}, NTILE({parts}) OVER (ORDER BY {column}) AS part "
        f"FROM {table} WHERE {column} IS NOT NULL) t GROUP BY part"
    )
    rows = spark.read.format("jdbc").options(**options).option("query", query).load().collect()
    return sorted(row[0] for row in rows)[1:]


def split_predicates(column: str, bounds: Sequence) -> list[str]:
    """Conditions of which every row meets exactly one, whatever lies between the ``bounds``; NULLs are in the first."""

    def literal(value) -> str:
        return str(value) if isinstance(value, (int, float, Decimal)) else "'" + str(value).replace("'", "''") + "'"

    cuts = [literal(b) for b in dict.fromkeys(bounds)]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def jdbc_table(
    spark: SparkSession, options: Mapping[str, str], table: str, split_on: str | None = None, parts: int = 1
) -> DataFrame:
    """A table read over JDBC, in ``parts`` of equal numbers of rows when ``split_on`` is given.

    Equal widths between the lowest and highest key would not do: keys have
    holes, and one part could get nearly all rows. Filters put on the result
    are pushed into the database by Spark.
    """
    if split_on is None or parts < 2:
        return spark.read.format("jdbc").options(**options).option("dbtable", table).load()
    bounds = even_bounds(spark, options, table, split_on, parts)
    rest = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(options["url"], table, predicates=split_predicates(split_on, bounds), properties=rest)


# Settings under which Parquet answers MIN and MAX from its files' footers.
FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
# Types whose footers hold exact values; others may lack them or cut them short.
FOOTER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def footer_mark(spark: SparkSession, path: str, cursor: str) -> DataFrame:
    """One row: the highest value of ``cursor`` in a Parquet folder, as text.

    Numbers and dates come from the footers, no row is read; other types take
    a scan of that one column.
    """
    session = spark.newSession()  # the settings hold here only
    for name, value in FOOTER_SETTINGS.items():
        session.conf.set(name, value)
    rows = session.read.parquet(path)
    if not isinstance(rows.schema[cursor].dataType, FOOTER_TYPES):
        rows = spark.read.parquet(path)
    return rows.agg(F.max(cursor).alias("marca")).select(F.col("marca").cast("string").alias("marca"))


def high_water_mark(landed: DataFrame | None, cursor: str) -> str | None:
    """Highest cursor value landed so far, as text; None before the first load."""
    if landed is None:
        return None
    return landed.agg(F.max(cursor).cast("string")).first()[0]


def newer_rows(source: DataFrame, cursor: str, mark: str | None, parity: bool = False) -> DataFrame:
    """Rows at or after the mark; all of them without one.

    Rows that share the mark's instant may already be landed: drop them by key,
    as ``incremental_rows`` does. ``parity`` instead starts one millisecond
    later, which can skip a row.
    """
    if mark is None:
        return source
    at = F.lit(mark).cast(dict(source.dtypes)[cursor])
    if parity:
        return source.filter(F.col(cursor) > at + F.expr("interval 1 millisecond"))
    return source.filter(F.col(cursor) >= at)


def incremental_rows(
    source: DataFrame,
    landed: DataFrame | None,
    cursor: str,
    keys: list[str],
    parity: bool = False,
    mark: str | None = None,
) -> DataFrame:
    """Rows of the source that are newer than what is landed.

    At the mark itself, only rows not landed yet: the landed side of that
    check is the rows of one instant. With a ``mark`` that is known already,
    ``landed`` need only hold the rows at it.
    """
    mark = high_water_mark(landed, cursor) if mark is None else mark
    newer = newer_rows(source, cursor, mark, parity)
    if mark is None or parity:
        return newer
    at = F.lit(mark).cast(dict(landed.dtypes)[cursor])
    edge = landed.filter(F.col(cursor) == at).select(*keys, cursor)
    return newer.join(edge, [*keys, cursor], "left_anti")
