import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from strataflow.operators.asof import as_of_lookup
from strataflow.operators.facts import (
    averages,
    daily_rows,
    day_runs,
    insert_only,
    joined_runs,
    outside_ranges,
    recurrence_flag,
)
from strataflow.plans.hospital.facts import ALERT_RANGES, part_costs

EVENT = "id int, k int, at timestamp, kind string"
T0 = datetime(2024, 3, 1, 12)


def _flags(spark, data):
    events = spark.createDataFrame(data, EVENT)
    out = recurrence_flag(events, events, "k", "at", F.col("kind") == "C", "again")
    return {r.id: r.again for r in out.select("id", "again").collect()}


def test_recurrence_window_edges(spark):
    exact, past = T0 - timedelta(days=30), T0 - timedelta(days=30, microseconds=1)
    assert _flags(spark, [(1, 1, exact, "C"), (2, 1, T0, "P")])[2] is True
    assert _flags(spark, [(1, 1, past, "C"), (2, 1, T0, "P")])[2] is False
    assert _flags(spark, [(1, 1, T0, "C"), (2, 1, T0, "C")]) == {1: False, 2: False}
    assert _flags(spark, [(1, 1, exact, "P"), (2, 1, T0, "P")])[2] is False
    assert _flags(spark, [(1, None, exact, "C"), (2, None, T0, "P"), (3, 1, None, "P")]) == {
        1: False, 2: False, 3: False,
    }


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-60, 60), st.sampled_from("CP")), max_size=25))
def test_recurrence_equals_brute_force(spark, data):
    events = [(i, k, datetime(1970, 1, 1) + timedelta(days=d), c) for i, (k, d, c) in enumerate(data)]
    expected = {
        i: any(
            k == k2 and c2 == "C" and at2 < at and at2 >= at - timedelta(days=30) for _, k2, at2, c2 in events
        )
        for i, k, at, _ in events
    }
    assert _flags(spark, events) == expected


def _alert(spark, **changed):
    normal = {
        "frecuencia_cardiaca": 80.0, "presion_sistolica": 120.0, "presion_diastolica": 80.0,
        "temperatura": 36.5, "saturacion_oxigeno": 98.0, "nivel_glucosa": 100.0,
    }
    values = {**normal, **changed}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} double" for c in values))
    return df.select(outside_ranges(ALERT_RANGES)).first()[0]


def test_alert(spark):
    assert _alert(spark) is False
    for measure, (low, high) in ALERT_RANGES.items():
        for limit, step in ((low, -0.01), (high, 0.01)):
            if limit is not None:
                assert _alert(spark, **{measure: float(limit)}) is False
                assert _alert(spark, **{measure: limit + step}) is True
    assert _alert(spark, temperatura=None) is False
    assert _alert(spark, temperatura=None, nivel_glucosa=300.0) is True


def test_averages_skip_nulls(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 2.0), (2, None)], "s int, v double")
    assert rows(averages(df, "s", ["v"])) == [(1, 1.5), (2, None)]


def test_part_costs(spark, rows):
    df = spark.createDataFrame(
        [(1, 2, Decimal("1.50")), (1, 1, Decimal("0.25"))],
        "id_orden int, cantidad int, precio_unitario_en_momento decimal(12,2)",
    )
    assert rows(part_costs(df)) == [(1, Decimal("3.25"), 3)]


def test_insert_only(spark, rows):
    fact = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "A"), (2, "b")], "k int, v string")
    assert rows(insert_only(batch, fact, ["k"])) == [(2, "b")]
    assert rows(insert_only(batch, None, ["k"])) == [(1, "A"), (2, "b")]


SPAN, VISIT = "k int, desde date, hasta date", "k int, cuando timestamp, n int"
AS_OF = date(2024, 1, 10)


def _daily(spark, spans, visits=(), loaded=None, most_days=None):
    return daily_rows(
        spark.createDataFrame(list(spans), SPAN), spark.createDataFrame(list(visits), VISIT),
        "k", "desde", "hasta", "cuando", "dia", AS_OF, loaded, most_days,
    )


def test_daily_rows(spark):
    j = lambda d: date(2024, 1, d)
    spans = [(1, j(1), j(3)), (2, j(8), None), (3, j(5), j(4)), (4, None, j(4)), (5, date(2000, 1, 1), j(1))]
    visits = [
        (1, datetime(2024, 1, 2, 9), 10), (1, datetime(2024, 1, 2, 17), 11),
        (1, datetime(2024, 1, 9, 9), 12), (1, None, 14), (9, datetime(2024, 1, 2, 9), 13),
    ]
    out = _daily(spark, spans, visits)
    by_key = {r[0]: r[1] for r in out.groupBy("k").count().collect()}
    whole = (date(2024, 1, 1) - date(2000, 1, 1)).days + 1
    assert by_key == {1: 4, 2: 3, 5: whole}
    first = sorted((r.dia, r.n) for r in out.filter("k = 1").collect() if r.n is not None)
    assert first == [(j(2), 10), (j(2), 11)]
    quiet = sorted(r.dia for r in out.filter("k = 1 AND n IS NULL").collect())
    assert quiet == [j(1), j(3)]
    assert out.filter("k = 5").agg(F.max("dia")).first()[0] == j(1)
    cut = _daily(spark, spans, visits, most_days=3650)
    assert {r[0]: r[1] for r in cut.groupBy("k").count().collect()} == {1: 4, 2: 3, 5: 3650}
    assert cut.filter("k = 5").agg(F.max("dia")).first()[0] == date(2000, 1, 1) + timedelta(days=3649)


def test_daily_rows_leave_loaded_days_out(spark):
    j = lambda d: date(2024, 1, d)
    loaded = joined_runs(day_runs(spark.createDataFrame([(1, j(1)), (1, j(2)), (2, j(3))], "k int, dia date"), "k", "dia"), "k")
    visits = [(1, datetime(2024, 1, 2), 1), (1, datetime(2024, 1, 3), 2)]
    out = _daily(spark, [(1, j(1), j(4))], visits, loaded)
    assert sorted((r.dia, r.n) for r in out.collect()) == [(j(3), 2), (j(4), None)]


def test_runs_against_sets_of_days(spark):
    rng = random.Random(3)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    held = {k: {rng.randrange(60) for _ in range(rng.randrange(40))} for k in range(30)}
    days = spark.createDataFrame([(k, day(n)) for k, ns in held.items() for n in ns for _ in range(2)] + [(None, day(1)), (99, None)], "k int, dia date")
    runs = day_runs(days, "k", "dia")
    got = {}
    for r in runs.collect():
        got.setdefault(r.k, []).append(((r.desde - day(0)).days, (r.hasta - day(0)).days))
    for k, ns in held.items():
        mine = sorted(got.get(k, []))
        assert {n for a, b in mine for n in range(a, b + 1)} == ns
        assert all(b + 1 < c for (_, b), (c, _) in zip(mine, mine[1:]))  # no two of them touch
    assert set(got) == {k for k, ns in held.items() if ns}
    # overlapping and touching runs are joined, whatever their order
    loose = [(k, day(a), day(a + rng.randrange(9))) for k in range(30) for a in (rng.randrange(60) for _ in range(k % 7))]
    joined = joined_runs(spark.createDataFrame(loose, "k int, desde date, hasta date"), "k")
    for r in joined.collect():
        mine = [((x.desde - day(0)).days, (x.hasta - day(0)).days) for x in r.tramos]
        assert {n for a, b in mine for n in range(a, b + 1)} == {
            n for k, a, b in loose if k == r.k for n in range((a - day(0)).days, (b - day(0)).days + 1)}
        assert all(b + 1 < c for (_, b), (c, _) in zip(mine, mine[1:]))
    # what an interval has left
    spans = [(k, day(rng.randrange(-5, 50)), day(rng.randrange(5, 80))) for k in range(30)]
    out = _daily(spark, spans, [(3, datetime(2024, 1, 9), 7)], joined_runs(runs, "k"))
    left = {}
    for r in out.collect():
        left.setdefault(r.k, set()).add((r.dia - day(0)).days)
    for k, a, b in spans:
        whole = set(range((a - day(0)).days, (b - day(0)).days + 1))
        assert left.get(k, set()) == whole - held[k]


def test_as_of_lookup_against_a_loop(spark):
    rng = random.Random(4)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    versions = [(10 * k + v, k if k else None, day(rng.randrange(40)), None if rng.random() < 0.5 else day(rng.randrange(60)), f"v{k}{v}")
                for k in range(6) for v in range(4)]
    rows = [(i, rng.choice([None, 1, 1, 1, 2, 3, 4, 5, 77]), None if rng.random() < 0.1 else day(rng.randrange(-5, 60))) for i in range(300)]

    def expected(k, at):
        mine = [v for v in versions if k is not None and at is not None and v[1] == k and v[2] <= at]
        best = max(mine, key=lambda v: (v[2], v[0]), default=None)
        return (best[0], best[4]) if best and (best[3] is None or at <= best[3]) else (None, None)

    dim = spark.createDataFrame(versions, "sk int, k int, desde date, hasta date, texto string")
    facts = spark.createDataFrame(rows, "i int, k int, dia date").repartition(3)
    for slice_rows in (10**6, 7):
        got = as_of_lookup(facts, dim, "k", "dia", "desde", ["sk", "texto"], "hasta", tie="sk", slice_rows=slice_rows)
        assert sorted(map(tuple, got.collect())) == sorted([(*r, *expected(r[1], r[2])) for r in rows], key=lambda r: r[0])
    inner = as_of_lookup(facts, dim, "k", "dia", "desde", ["sk"], "hasta", tie="sk", inner=True)
    assert sorted((r.i, r.sk) for r in inner.collect()) == [(r[0], expected(r[1], r[2])[0]) for r in rows if expected(r[1], r[2])[0] is not None]
    assert as_of_lookup(facts.limit(0), dim, "k", "dia", "desde", ["sk"]).count() == 0
    assert as_of_lookup(facts, dim.limit(0), "k", "dia", "desde", ["sk"]).filter("sk is null").count() == 300
