import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from strataflow.functions import rules as r
from strataflow.operators.quality import failure_report, quarantined_rows, valid_rows
from strataflow.plans.hospital.catalog import EMAIL, EMAIL_PARITY, TABLES, quality_rules


def _valid(spark, rule, value, kind):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    ok, bad = valid_rows(df, rule).count(), quarantined_rows(df, rule).count()
    assert ok + bad == 1
    return ok == 1


@pytest.mark.parametrize(
    "rule,kind,cases",
    [
        (r.not_null("c"), "string", {"x": True, None: False}),
        (r.positive("c"), "int", {1: True, 0: False, -1: False, None: False}),
        (r.positive("c"), "string", {"1.5": True, "0": False, "abc": False, None: False}),
        (r.non_negative("c"), "int", {0: True, -1: False, None: False}),
        (r.allowed("c", "M", "F"), "string", {"M": True, "X": False, None: False}),
        (r.allowed("c", 1, 2), "int", {1: True, 3: False}),
        (r.within("c", 1, 4), "int", {1: True, 4: True, 5: False, None: False}),
        (r.matches("c", EMAIL), "string", {"a@b.c": True, "a@bxc": False, "a@b@c.d": False, None: False}),
        # any character passes for the dot there, even another "@"
        (r.matches("c", EMAIL_PARITY), "string", {"a@b.c": True, "a@bxc": True, "a@b@c.d": True, "a@b": False}),
        (r.condition("c", "c > 3 AND c < 5"), "int", {4: True, 5: False, None: False}),
    ],
)
def test_rule_kinds(spark, rule, kind, cases):
    assert {v: _valid(spark, rule, v, kind) for v in cases} == cases


def test_table_without_rules_is_all_valid(spark):
    df = spark.createDataFrame([(None,), (1,)], "c int")
    assert valid_rows(df, []).count() == 2
    assert quarantined_rows(df, []).count() == 0


def test_rules_are_found_whatever_the_case():
    assert r.rules_of(quality_rules(), "EQUIPOS") == quality_rules()["equipos"]
    assert r.rules_of(quality_rules(), "sin_reglas") == []


def test_catalog_size():
    rules = quality_rules()
    assert set(rules) == set(TABLES)
    assert sum(map(len, rules.values())) == 99
    kinds = [x.kind for v in rules.values() for x in v]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 57, "positive": 12, "non_negative": 1, "allowed_values": 15, "regex": 5, "range": 9,
    }


def test_rules_kept_as_data(spark):
    table = spark.createDataFrame(
        [("Pacientes", "EDAD", "EDAD >= 0 OR EDAD = -9"), ("pacientes", "SEXO", "SEXO IN ('M', 'F')")],
        "nombre_tabla string, columna string, condicion string",
    )
    catalog = r.catalog_from_table(table)
    df = spark.createDataFrame([(1, "M"), (-9, "F"), (-1, "M"), (1, None)], "edad int, sexo string")
    assert valid_rows(df, r.rules_of(catalog, "PACIENTES")).count() == 2


def test_failure_report(spark):
    df = spark.createDataFrame([(1, "a"), (0, None), (None, "b")], "n int, t string")
    report = failure_report(df, r.positive("n") + r.not_null("t"))
    assert sorted(map(tuple, report.collect())) == [("n:positive", "n", 2), ("t:not_null", "t", 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.sampled_from("ab")))))
def test_split_is_a_partition(spark, data):
    df = spark.createDataFrame(data, "n int, t string")
    rules = r.positive("n") + r.allowed("t", "a")
    good = [x for x in data if x[0] is not None and x[0] > 0 and x[1] == "a"]
    assert sorted(map(tuple, valid_rows(df, rules).collect())) == sorted(good)
    assert quarantined_rows(df, rules).count() == len(data) - len(good)
