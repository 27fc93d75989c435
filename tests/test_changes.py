from hypothesis import HealthCheck, given, settings, strategies as st

from strataflow.operators import changes as cdc

ROW = "k int, v string, fecha_modificacion int"
CHANGE = f"accion string, {ROW}"


def test_order_key_and_flag_columns():
    assert cdc.order_column(["a", "FECHA_REGISTRO", "fecha_modificacion"]) == "fecha_modificacion"
    assert cdc.order_column(["a", "FECHA_REGISTRO"]) == "FECHA_REGISTRO"
    assert cdc.order_column(["a"], "load_id") == "load_id"
    assert cdc.soft_delete_column(["x", "Borrado"]) == "Borrado"
    assert cdc.infer_key(["codigo", "id_orden", "id_equipo"]) == "id_equipo"
    assert cdc.infer_key(["codigo"]) is None


def test_newest_change_ignores_arrival_order(spark, rows):
    changes = spark.createDataFrame(
        [("INSERT", 1, "new", 5), ("INSERT", 1, "old", 3), ("DELETE", 2, "x", 4), ("INSERT", 2, "y", 4)], CHANGE
    )
    newest = cdc.newest_change(changes, ["k"], ["fecha_modificacion"])
    assert rows(newest) == [("INSERT", 1, "new", 5), ("INSERT", 2, "y", 4)]


def test_rows_without_key_are_all_kept(spark, rows):
    changes = spark.createDataFrame([("INSERT", None, "a", 1), ("INSERT", None, "b", 2)], CHANGE)
    assert len(rows(cdc.newest_change(changes, ["k"], ["fecha_modificacion"]))) == 2


def test_merge_branches(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], ROW)
    changes = spark.createDataFrame(
        [("DELETE", 1, "a", 2), ("INSERT", 2, "B", 2), ("INSERT", 4, "d", 2), ("DELETE", 5, "e", 2)], CHANGE
    )
    merged = cdc.merge_changes(target, changes, ["k"], ["fecha_modificacion"])
    assert rows(merged) == [(2, "B", 2), (3, "c", 1), (4, "d", 2)]


def test_later_batch_wins_unless_guarded(spark, rows):
    target = spark.createDataFrame([(1, "newer", 9)], ROW)
    late = spark.createDataFrame([("INSERT", 1, "older", 3), ("INSERT", 2, "x", 3)], CHANGE)
    plain = cdc.merge_changes(target, late, ["k"], ["fecha_modificacion"])
    assert rows(plain) == [(1, "older", 3), (2, "x", 3)]
    guarded = cdc.merge_changes(target, late, ["k"], ["fecha_modificacion"], guard="fecha_modificacion")
    assert rows(guarded) == [(1, "newer", 9), (2, "x", 3)]


def test_soft_delete_needs_a_match(spark, rows):
    target = spark.createDataFrame([(1, False), (2, False)], "k int, is_deleted boolean")
    changes = spark.createDataFrame(
        [("INSERT", 1, True), ("INSERT", 2, None), ("INSERT", 3, True)], "accion string, k int, is_deleted boolean"
    )
    merged = cdc.merge_changes(target, changes, ["k"], [], soft_delete="is_deleted")
    assert rows(merged) == [(2, None), (3, True)]


def test_change_log_shows_old_and_new_rows(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], ROW)
    changes = spark.createDataFrame(
        [("INSERT", 1, "A", 2), ("DELETE", 2, "b", 2), ("INSERT", 3, "c", 1), ("INSERT", 4, "d", 2)], CHANGE
    )
    log = cdc.change_log(target, changes, ["k"])
    assert rows(log, "accion", "k", "v") == [
        ("DELETE", 1, "a"), ("DELETE", 2, "b"), ("INSERT", 1, "A"), ("INSERT", 4, "d"),
    ]


def test_diff_of_rows_without_key(spark, rows):
    old = spark.createDataFrame([(None, "a"), (1, "x")], "k int, v string")
    new = spark.createDataFrame([(None, "b"), (None, "c"), (1, "x")], "k int, v string")
    assert rows(cdc.snapshot_diff(old, new, ["k"])) == [
        ("DELETE", None, "a"), ("INSERT", None, "b"), ("INSERT", None, "c"),
    ]


VERSION = st.dictionaries(st.integers(0, 5), st.one_of(st.none(), st.sampled_from("abc")), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(VERSION, VERSION)
def test_diff_applied_gives_the_new_table(spark, old, new):
    a = spark.createDataFrame(list(old.items()), "k int, v string")
    b = spark.createDataFrame(list(new.items()), "k int, v string")
    diff = cdc.snapshot_diff(a, b, ["k"])
    expected = sorted(new.items(), key=repr)
    once = cdc.merge_changes(a, diff, ["k"], [])
    assert sorted(map(tuple, once.collect()), key=repr) == expected
    twice = cdc.merge_changes(once, diff, ["k"], [])
    assert sorted(map(tuple, twice.collect()), key=repr) == expected


def test_unmatched(spark, rows):
    table = spark.createDataFrame([(1,), (2,)], "k int")
    batch = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert rows(cdc.unmatched(batch, table, ["k"])) == [(3, "c")]
