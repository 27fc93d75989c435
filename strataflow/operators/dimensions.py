"""Generated dimensions: calendar and combinations of fixed codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strataflow.functions.columns import date_key, decode
from strataflow.operators.keys import assign_keys, last_key

# Month and weekday names of the calendar.
MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
WEEKDAYS = ("Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo")
CALENDAR_START, CALENDAR_END = date(2015, 1, 1), date(2030, 12, 31)


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of a day."""
    month, weekday = F.month(day), F.weekday(day) + 1
    return {
        "sk_fecha": date_key(day),
        "fecha": day,
        "anio": F.year(day),
        "semestre": F.when(month <= 6, 1).otherwise(2),
        "trimestre": F.quarter(day),
        "mes": month,
        "nombre_mes": decode(month, dict(enumerate(MONTHS, 1))),
        "semana_anio": F.weekofyear(day),
        "dia": F.dayofmonth(day),
        "dia_semana": weekday,
        "nombre_dia": decode(weekday, dict(enumerate(WEEKDAYS, 1))),
        "es_fin_semana": weekday >= 6,
        "es_festivo": F.lit(False),
    }


def key_date(key: str) -> Column:
    """The day of a date key."""
    number = F.col(key).cast("int")
    return F.make_date(F.floor(number / 10000).cast("int"), F.floor(number % 10000 / 100).cast("int"), number % 100)


def with_day(rows: DataFrame, days: DataFrame, key: str, **named: str) -> DataFrame:
    """``rows`` with the columns ``named`` (alias=attribute) of the day whose key they hold.

    A day that the calendar ``days`` does not reach is worked out from its key,
    so no row is lost. A row without a key is left out.
    """
    known = days.select(F.col("sk_fecha").alias(key), F.struct(*(F.col(c).alias(a) for a, c in named.items())).alias("_day"))
    own = calendar_columns(key_date(key))
    own = F.struct(*(own[c].alias(a) for a, c in named.items()))
    joined = rows.filter(F.col(key).isNotNull()).join(F.broadcast(known), key, "left")
    # one test per row; attributes are only worked out where the calendar has none
    return joined.withColumn("_day", F.coalesce("_day", own)).select(*rows.columns, *(f"_day.{a}" for a in named))


def calendar(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("fecha")
    )
    return days.select(*(value.alias(name) for name, value in calendar_columns(F.col("fecha")).items()))


def combinations(spark: SparkSession, axes: Mapping[str, Sequence]) -> DataFrame:
    """All combinations of the listed codes, one column per axis."""
    row = spark.range(1)
    exploded = reduce(
        lambda df, axis: df.withColumn(axis, F.explode(F.array(*(F.lit(v) for v in axes[axis])))), axes, row
    )
    return exploded.select(*axes)


def junk_dimension(
    spark: SparkSession, axes: Mapping[str, Sequence], sk: str, existing: DataFrame | None = None
) -> DataFrame:
    """Combinations of the axes with surrogate keys; known ones keep theirs."""
    wanted = combinations(spark, axes)
    if existing is None:
        return assign_keys(wanted, sk, list(axes))
    missing = wanted.join(existing.select(*axes), list(axes), "left_anti")
    return existing.unionByName(assign_keys(missing, sk, list(axes), last_key(existing, sk)))
