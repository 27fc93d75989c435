from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strataflow.functions import columns as fx


@pytest.mark.parametrize(
    "name,expected",
    [
        ("FechaModificacion", "fecha_modificacion"),
        ("CategoriaEquipos", "categoria_equipos"),
        ("diagnosticos_cie10", "diagnosticos_cie10"),
        ("aB1C", "a_b1_c"),
        ("ID", "id"),
    ],
)
def test_snake_case(name, expected):
    assert fx.snake_case(name) == expected


def test_decode_leaves_unknown_null(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (None,)], "c int")
    out = [r[0] for r in df.select(fx.decode(F.col("c"), {1: "uno", 2: "dos"})).collect()]
    assert out == ["uno", "dos", None, None]


def test_date_key(spark):
    df = spark.createDataFrame([(date(2021, 1, 3),), (None,)], "d date")
    assert [r[0] for r in df.select(fx.date_key(F.col("d"))).collect()] == [20210103, None]


@pytest.mark.parametrize(
    "start,end,expected",
    [
        ("10:00:59", "10:01:00", 1),
        ("10:00:00", "10:00:59", 0),
        ("23:50:00", "00:10:00", -1420),
        ("10:01:00", "10:00:59", -1),
    ],
)
def test_minutes_count_boundaries(spark, start, end, expected):
    day = "2024-05-01 "
    row = spark.range(1).select(
        fx.minutes_between(F.lit(day + start).cast("timestamp"), F.lit(day + end).cast("timestamp"))
    ).first()
    assert row[0] == expected


def test_minutes_before_epoch(spark):
    a, b = F.lit(datetime(1960, 1, 1, 0, 0, 30)), F.lit(datetime(1960, 1, 1, 0, 1, 0))
    assert spark.range(1).select(fx.minutes_between(a, b)).first()[0] == 1


@pytest.mark.parametrize(
    "name,given,surnames",
    [
        ("Ana", "Ana", None),
        ("Ana Gil", "Ana", "Gil"),
        ("Ana Gil Ros", "Ana", "Gil Ros"),
        ("Ana Luz Gil Ros", "Ana Luz", "Gil Ros"),
        ("Ana de la Vega Ros", "Ana", "de la Vega Ros"),
        (None, None, None),
    ],
)
def test_person_name(spark, name, given, surnames):
    df = spark.createDataFrame([(name,)], "n string")
    assert tuple(df.select(*fx.person_name(F.col("n"))).first()) == (given, surnames)


@pytest.mark.parametrize(
    "text,prefix,expected",
    [
        ("Bomba - de infusion", "Bomba", "de infusion"),
        ("Otra cosa", "Bomba", "Otra cosa"),
        (None, "Bomba", None),
        ("Bomba - x", None, "Bomba - x"),
        ("Bomba - ", "Bomba", ""),
    ],
)
def test_strip_prefix(spark, text, prefix, expected):
    df = spark.createDataFrame([(text, prefix)], "t string, p string")
    assert df.select(fx.strip_prefix(F.col("t"), F.col("p"))).first()[0] == expected


def test_any_differs_is_null_safe(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, None), (None, None)], "a int, b int")
    out = [r[0] for r in df.select(fx.any_differs([(F.col("a"), F.col("b"))])).collect()]
    assert out == [False, True, True, False]
