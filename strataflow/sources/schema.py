"""Names and types of landed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from strataflow.functions.columns import snake_case

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
REAL = (T.FloatType, T.DoubleType)
KEPT = (T.DecimalType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)


def landing_type(source: T.DataType) -> T.DataType:
    """Type a source column lands as; times of day and unknown types become text."""
    if isinstance(source, WHOLE):
        return T.LongType()
    if isinstance(source, REAL):
        return T.DoubleType()
    if isinstance(source, KEPT):
        return source
    return T.StringType()


def landing_columns(df: DataFrame) -> DataFrame:
    """Snake-case names and landing types, all nullable."""
    return df.select(
        *(F.col(f"`{f.name}`").cast(landing_type(f.dataType)).alias(snake_case(f.name)) for f in df.schema)
    )


# Bookkeeping columns of the loader, not carried past landing.
TECHNICAL_COLUMNS = ("_dlt_load_id", "_dlt_id")


def without_technical(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.lower() in TECHNICAL_COLUMNS))
