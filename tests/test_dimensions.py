from datetime import date

from pyspark.sql import functions as F

from strataflow.operators.dimensions import calendar, junk_dimension
from strataflow.operators.hierarchy import hierarchy_levels, with_parent_key
from strataflow.operators.keys import assign_keys, last_key
from strataflow.operators.scd import current_rows, scd1_merge, scd2_merge
from strataflow.plans.hospital.dimensions import MAINTENANCE_PROFILE, TRIAL_PROFILE

D1, D2, D3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def test_scd1(spark, rows):
    first = spark.createDataFrame([(1, None), (2, "b"), (3, "c"), (4, "d")], "id int, a string")
    dim = scd1_merge(None, first, "id", ["a"], "sk")
    second = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (7, "g")], "id int, a string")
    dim = scd1_merge(dim, second, "id", ["a"], "sk")
    assert rows(dim, "sk", "id", "a") == [(1, 1, "a"), (2, 2, None), (3, 3, "c"), (4, 4, "d"), (5, 7, "g")]


def _scd2(dim, source, day):
    return scd2_merge(dim, source, "id", ["uno"], ["dos"], "sk", day)


def _source(spark, *data):
    return spark.createDataFrame(list(data), "id int, uno string, dos string")


def test_scd2_closed_version_carries_new_type1_values(spark, rows):
    dim = _scd2(None, _source(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", "z")), D1)
    dim = _scd2(dim, _source(spark, (1, "A", "X"), (2, "B", "y"), (4, "d", None)), D2)
    assert rows(dim, "sk", "id", "uno", "dos", "fecha_inicio", "fecha_fin", "es_actual") == [
        (1, 1, "A", "x", D1, date(2024, 1, 31), False),
        (2, 2, "B", "y", D1, None, True),
        (3, 3, "c", "z", D1, None, True),
        (4, 1, "A", "X", D2, None, True),
        (5, 4, "d", None, D2, None, True),
    ]


def test_scd2_null_is_a_value(spark, rows):
    dim = _scd2(None, _source(spark, (1, "a", None), (2, "b", "y")), D1)
    dim = _scd2(dim, _source(spark, (1, "a", "x"), (2, "b", None)), D2)
    assert rows(current_rows(dim), "id", "dos") == [(1, "x"), (2, None)]
    assert dim.count() == 4
    again = _scd2(dim, _source(spark, (1, "a", "x"), (2, "b", None)), D3)
    assert rows(again) == rows(dim)


def test_scd2_same_day_ends_before_it_starts(spark, rows):
    dim = _scd2(None, _source(spark, (1, "a", "x")), D1)
    dim = _scd2(dim, _source(spark, (1, "a", "y")), D1)
    assert rows(dim, "dos", "fecha_inicio", "fecha_fin", "es_actual") == [
        ("x", D1, date(2023, 12, 31), False), ("y", D1, None, True),
    ]


def test_scd2_leaves_history_alone(spark, rows):
    dim = _scd2(None, _source(spark, (1, "a", "x")), D1)
    dim = _scd2(dim, _source(spark, (1, "b", "y")), D2)
    dim = _scd2(dim, _source(spark, (1, "c", "z")), D3)
    assert rows(dim, "uno", "dos", "es_actual") == [("b", "x", False), ("c", "y", False), ("c", "z", True)]
    per_key = current_rows(dim).groupBy("id").count().filter("count > 1")
    assert per_key.isEmpty() and dim.select("sk").distinct().count() == 3


def test_part_of_a_dimension_needs_the_last_key(spark, rows):
    part = scd1_merge(None, spark.createDataFrame([(9, "i")], "id int, a string"), "id", ["a"], "sk", last=41)
    assert rows(part) == [(42, 9, "i")]


def test_surrogate_keys_are_dense_and_ordered(spark):
    ids = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"))
    numbered = assign_keys(ids, "sk", ["id"], start=10).orderBy("id").collect()
    assert [r.sk for r in numbered] == list(range(11, 1011))
    assert last_key(None, "sk") == 0


def test_hierarchy(spark, rows):
    nodes = spark.createDataFrame(
        [(1, None), (2, 1), (3, 2), (4, 99), (5, 6), (6, 5), (7, 4), (8, 5)], "id int, up int"
    )
    assert rows(hierarchy_levels(nodes, "id", "up", "lvl")) == [(1, 1), (2, 2), (3, 3)]


def test_hierarchy_of_a_long_chain(spark):
    chain = spark.range(200).select(
        F.col("id").alias("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("up")
    )
    levels = hierarchy_levels(chain, "id", "up", "lvl")
    assert levels.filter("lvl = id + 1").count() == 200


def test_only_cycles(spark):
    nodes = spark.createDataFrame([(1, 2), (2, 1)], "id int, up int")
    assert hierarchy_levels(nodes, "id", "up", "lvl").isEmpty()


def test_parent_key_of_rows_loaded_together(spark, rows):
    dim = scd1_merge(
        None, spark.createDataFrame([(5, 1), (1, None), (6, 77)], "id int, up int"), "id", ["up"], "sk"
    )
    keyed = with_parent_key(dim, "id", "up", "sk", "sk_up")
    assert rows(keyed, "id", "sk", "sk_up") == [(1, 1, None), (5, 2, 1), (6, 3, None)]


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 5844 == days.select("sk_fecha").distinct().count()
    row = days.filter("sk_fecha = 20210103").first()
    assert (row.semana_anio, row.dia_semana, row.nombre_dia, row.es_fin_semana) == (53, 7, "Domingo", True)
    assert (row.semestre, row.trimestre, row.nombre_mes, row.es_festivo) == (1, 1, "Enero", False)


def test_profiles_load_once(spark):
    for axes, size in ((MAINTENANCE_PROFILE, 192), (TRIAL_PROFILE, 360)):
        profile = junk_dimension(spark, axes, "sk")
        again = junk_dimension(spark, axes, "sk", profile)
        assert profile.count() == again.count() == size
        assert again.select("sk").distinct().count() == size


def test_profile_gains_new_codes(spark, rows):
    profile = junk_dimension(spark, {"a": ("x",), "b": (True, False)}, "sk")
    wider = junk_dimension(spark, {"a": ("x", "y"), "b": (True, False)}, "sk", profile)
    assert rows(wider) == [(1, "x", False), (2, "x", True), (3, "y", False), (4, "y", True)]
