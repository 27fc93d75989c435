from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from strataflow.functions.rules import positive
from strataflow.operators.changes import change_log, rows_with_keys
from strataflow.plans.hospital.warehouse import Warehouse
from strataflow.plans.queries import _fact
from strataflow.plans.roles import role_tables
from strataflow.session import materialize
from strataflow.streaming.refresh import (
    Hop,
    cleansed_batch,
    follow_cleansed,
    follow_raw,
    raw_batch,
)
from strataflow.streaming.loads import Loads
from strataflow.streaming.merged import MergedTables, Record, log_schema
from strataflow.streaming.snapshots import Snapshots

ROW = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("v", T.IntegerType()),
    T.StructField("fecha_modificacion", T.TimestampType()),
    T.StructField("is_deleted", T.BooleanType()),
])


def _landed(spark, *data):
    stamp = F.to_timestamp(F.concat(F.lit("2024-01-01 00:00:"), F.lpad(F.col("t"), 2, "0")))
    return spark.createDataFrame(list(data), "id int, v int, t int, d boolean").select(
        "id", "v", stamp.alias("fecha_modificacion"), F.col("d").alias("is_deleted")
    )


def _hop(root):
    return Hop("cosas", ("id",), ROW, str(root))


def test_later_deliveries_win_without_a_date_column(spark, tmp_path):
    rows = "id int, v int, _dlt_load_id string, fecha_ingestion timestamp"
    stamp = [datetime(2024, 1, 1), datetime(2024, 1, 2)]
    for n, data in enumerate((
        [(1, 9, "b", stamp[0]), (1, 5, "a", stamp[1])],  # the load decides before the time it landed
        [(1, 5, None, stamp[0]), (1, 9, None, stamp[1])],
    )):
        landed = spark.createDataFrame(data, rows)
        schema = T.StructType([f for f in landed.schema.fields if not f.name.startswith("_")])
        hop = Hop("sin_fecha", ("id",), schema, f"{tmp_path}/{n}")
        raw_batch(hop, landed, 0)
        assert [(r.id, r.v) for r in hop.raw(spark).read("rows").collect()] == [(1, 9)]


def _log(spark, hop):
    return spark.read.schema(log_schema(ROW)).parquet(hop.log("raw"))


def _sides(spark, hop):
    tables = hop.cleansed(spark)
    return [sorted(((r.id, r.v) for r in tables.read(n).collect()), key=repr) for n in ("valid", "errors")]


def test_raw_keeps_the_last_state_and_logs_changes(spark, tmp_path):
    hop = _hop(tmp_path)
    raw_batch(hop, _landed(spark, (1, 1, 1, False), (1, 2, 3, False), (2, 5, 1, False)), 0)
    raw_batch(hop, _landed(spark, (2, 5, 4, True), (3, 7, 4, True), (1, 9, 5, False)), 1)
    held = sorted((r.id, r.v) for r in hop.raw(spark).read("rows").collect())
    assert held == [(1, 9), (3, 7)]
    log = sorted((r.lote, r.accion, r.id, r.v) for r in _log(spark, hop).collect())
    assert log == [
        (0, "INSERT", 1, 2), (0, "INSERT", 2, 5),
        (1, "DELETE", 1, 2), (1, "DELETE", 2, 5), (1, "INSERT", 1, 9), (1, "INSERT", 3, 7),
    ]
    raw_batch(hop, _landed(spark, (1, 100, 9, False)), 1)  # the same batch again does nothing
    assert sorted((r.id, r.v) for r in hop.raw(spark).read("rows").collect()) == held


def test_rows_move_between_valid_and_errors(spark, tmp_path):
    hop, rules = _hop(tmp_path), positive("v")
    raw_batch(hop, _landed(spark, (1, 1, 1, None), (2, -2, 1, None), (3, 3, 1, None), (None, 4, 1, None)), 0)
    cleansed_batch(hop, _log(spark, hop), 0, rules)
    assert _sides(spark, hop) == [[(1, 1), (3, 3)], [(2, -2), (None, 4)]]
    raw_batch(hop, _landed(spark, (1, -1, 2, None), (2, 2, 2, None)), 1)
    raw_batch(hop, _landed(spark, (3, -3, 3, None)), 2)
    raw_batch(hop, _landed(spark, (3, 30, 4, None)), 3)
    cleansed_batch(hop, _log(spark, hop).filter("lote > 0"), 1, rules)
    assert _sides(spark, hop) == [[(2, 2), (3, 30)], [(1, -1), (None, 4)]]


def test_streams_continue_where_they_stopped(spark, tmp_path):
    hop, rules = _hop(tmp_path / "dw"), positive("v")
    for batch in ([(1, 1, 1, None), (2, -2, 1, None)], [(2, 20, 2, None), (3, 3, 2, None)]):
        _landed(spark, *batch).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing/cosas")
        for _ in range(2):  # the second pass finds nothing to do
            follow_raw(spark, hop, f"{tmp_path}/landing", ROW).awaitTermination()
            follow_cleansed(spark, hop, rules).awaitTermination()
    assert _sides(spark, hop) == [[(1, 1), (2, 20), (3, 3)], []]
    assert hop.raw(spark).holds(1) and not hop.raw(spark).holds(2)


def test_snapshots_rewrite_only_touched_buckets(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path), {"a": ROW, "b": ROW}, ["id"], buckets=4)
    assert store.read("a").isEmpty()
    everything = _landed(spark, *((i, i, 1, None) for i in range(20)))
    store.publish(0, {"a": everything, "b": everything.limit(0)}, range(4))
    touched = store.touched(everything.filter("id = 7"))
    assert len(touched) == 1
    kept = store.read("a", touched).filter("id <> 7")
    store.publish(1, {"a": kept}, touched)
    fresh = Snapshots(spark, str(tmp_path), {"a": ROW, "b": ROW}, ["id"], buckets=4)
    assert sorted(r.id for r in fresh.read("a").collect()) == [i for i in range(20) if i != 7]
    assert fresh.read("b").isEmpty()
    versions = {f.split("version=")[1][0] for f in fresh.read("a").inputFiles()}
    assert versions == {"0", "1"}


def _many(spark, n, v):
    return spark.range(n).select(
        F.col("id").cast("int"), F.lit(v).alias("v"), F.lit(datetime(2024, 1, v)).alias("fecha_modificacion"),
        F.lit(False).alias("is_deleted"),
    )


def _written(root):
    return {f: f.stat().st_size for f in root.rglob("*.parquet")}


def test_what_a_batch_writes_does_not_grow_with_the_table(spark, tmp_path):
    """A thousand spread keys, in tables of 20,000 and 200,000 rows, through both layers."""
    sizes = {}
    for n in (20_000, 200_000):
        root = tmp_path / str(n)
        hop, rules = _hop(root), positive("v")
        raw_batch(hop, _many(spark, n, 1), 0)
        cleansed_batch(hop, _log(spark, hop), 0, rules)
        before = _written(root)
        raw_batch(hop, _many(spark, n, 2).filter(F.col("id") % (n // 1000) == 3), 1)
        cleansed_batch(hop, _log(spark, hop).filter("lote = 1"), 1, rules)
        sizes[n] = sum(size for f, size in _written(root).items() if before.get(f) != size)
        assert hop.cleansed(spark).read("valid").groupBy("v").count().orderBy("v").collect() == [(1, n - 1000), (2, 1000)]
    assert sizes[200_000] < 1.5 * sizes[20_000]
    assert sizes[200_000] < sum(before.values()) / 20


def test_changes_are_folded_by_their_share(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.IntegerType())])

    def store():  # read from the record each time
        return MergedTables(spark, str(tmp_path), {"a": schema, "b": schema}, ["id"], most_logs=4)

    def changes(lo, hi, v, accion="INSERT"):
        return spark.range(lo, hi).select(F.lit(accion).alias("accion"), "id", F.lit(v).alias("v"))

    none = changes(0, 0, 0)
    assert not store().holds(0) and store().read("a").isEmpty()
    store().publish(0, {"a": changes(0, 100, 0), "b": none})
    store().publish(1, {"a": changes(0, 10, 1), "b": none})
    held = store()._state()[1]["a"]
    assert (held.base, held.base_rows, dict(held.logs)) == (0, 100, {1: 10})
    store().publish(2, {"a": changes(5, 15, 2).union(changes(90, 100, 0, "DELETE")), "b": changes(0, 3, 7)})
    held = store()._state()[1]["a"]
    assert (held.base, held.base_rows, dict(held.logs)) == (2, 90, {})
    for batch in range(3, 7):  # few rows each: folded by their number
        store().publish(batch, {"a": changes(20, 21, batch), "b": none})
    held = store()._state()[1]["a"]
    assert (held.base, dict(held.logs)) == (6, {})
    expected = {i: 1 if i < 5 else 2 if i < 15 else 6 if i == 20 else 0 for i in range(90)}
    assert {r.id: r.v for r in store().read("a").collect()} == expected
    assert sorted(r.id for r in store().read("b").collect()) == [0, 1, 2] and store().holds(6)


def test_a_batch_without_its_record_is_not_seen_and_repeated(spark, tmp_path):
    hop = _hop(tmp_path)
    raw_batch(hop, _landed(spark, *((i, 1, 1, None) for i in range(20))), 0)
    # what a batch that was cut off has left
    _landed(spark, (1, 66, 2, None)).select(F.lit("INSERT").alias("accion"), "*").write.parquet(f"{hop.log('raw')}/lote=1")
    assert {r.v for r in hop.raw(spark).read("rows").collect()} == {1} and not hop.raw(spark).holds(1)
    raw_batch(hop, _landed(spark, (2, 5, 2, None)), 1)
    assert {(r.id, r.v) for r in hop.raw(spark).read("rows").filter("v > 1").collect()} == {(2, 5)}


def test_records_survive_a_slot_that_was_cut_off(spark, tmp_path):
    def record():
        return Record(spark, str(tmp_path), "batch long, v int")

    def seen():
        return sorted((r.batch, r.v) for r in record().read())

    assert seen() == []
    for batch in (0, 1, 1, 2):
        record().write([(batch, batch * 10), (batch, 5)])
        assert seen() == sorted([(batch, batch * 10), (batch, 5)])
    # the fifth write was cut off after its slot was emptied: the fourth is still there
    spark.createDataFrame([], "serial long, batch long, v int").write.mode("overwrite").parquet(f"{tmp_path}/slot=0")
    assert seen() == [(2, 5), (2, 20)]
    record().write([(3, 1)])
    assert seen() == [(3, 1)]


def test_deletions_are_remembered_for_a_while(spark, tmp_path):
    for remember, back in ((None, False), ("20 seconds", False), ("5 seconds", True)):
        hop = Hop("cosas", ("id",), ROW, f"{tmp_path}/{remember}", remember)
        deliveries = [
            [(1, 1, 1, False), (2, 1, 1, False), (None, 1, 1, False)],
            [(1, 1, 5, True), (2, 1, 5, True)],
            [(1, 2, 3, False), (2, 3, 7, False)],  # older than the deletion, and newer
            [(3, 1, 15, False)],
            [(1, 4, 4, False)],  # older still, ten seconds later
            [(2, 9, 6, False)],  # older than the row that came back
        ]
        for batch, rows in enumerate(deliveries):
            raw_batch(hop, _landed(spark, *rows), batch, guard=True)
        held = sorted(((r.id, r.v) for r in hop.raw(spark).read("rows").collect()), key=repr)
        assert held == sorted([(2, 3), (3, 1), (None, 1)] + ([(1, 4)] if back else []), key=repr)
        # without the guard a later delivery wins
    hop = _hop(f"{tmp_path}/plain")
    for batch, rows in enumerate(deliveries[:3]):
        raw_batch(hop, _landed(spark, *rows), batch)
    assert sorted((r.id, r.v) for r in hop.raw(spark).read("rows").filter("id is not null").collect()) == [(1, 2), (2, 3)]


def _loads(spark, path):
    return Loads(spark, str(path), "id", "sk")


def _numbers(spark, lo, hi):
    return spark.range(lo, hi).select("id", (F.col("id") + 1000).alias("sk"), (F.col("id") % 3).cast("int").alias("mes"))


def test_loads_show_up_whole_and_are_read_by_their_keys(spark, tmp_path):
    loads = _loads(spark, tmp_path)
    assert loads.read() is None and loads.near(_numbers(spark, 0, 1), "id") is None and loads.last_key() == 0
    loads.publish(0, _numbers(spark, 0, 100), "mes")
    loads.publish(1, _numbers(spark, 200, 300), "mes")
    loads.publish(1, _numbers(spark, 0, 0), "mes")  # nothing new
    # a load that was cut off: files without an entry, of a month that its repetition does not have
    spark.range(3).select(F.lit(999).alias("id"), F.lit(9).alias("sk")).write.parquet(f"{tmp_path}/rows/carga=3/mes=77")
    assert _loads(spark, tmp_path).read().count() == 200
    _loads(spark, tmp_path).publish(2, _numbers(spark, 90, 250).filter("id < 110 or id >= 240"), "mes")
    fresh = _loads(spark, tmp_path)
    assert fresh.read().count() == 230 and fresh.read().filter("mes = 77").isEmpty()
    assert (fresh.batch(), fresh.last_key()) == (2, 1299)

    def read(*ids):
        found = _loads(spark, tmp_path).near(spark.createDataFrame([(i,) for i in ids], "k long"), "k")
        return {f.split("carga=")[1][0] for f in found.inputFiles()}, found

    assert read(150)[0] == {"3"}  # inside its range, in no other
    assert read(5, 150)[0] == {"0", "3"} and read(5, 260)[0] == {"0", "1"}
    assert read(400)[0] == set() and read(400)[1].isEmpty()
    files, found = read(210, 220)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert files == {"1", "3"} and "GreaterThanOrEqual(id,210)" in plan and "LessThanOrEqual(id,220)" in plan


SF = "/root/testdata/sf0.001"
USED = ("departamentos", "ubicaciones", "fabricantes", "tecnicos", "equipos", "ordenes_mantenimiento",
        "consumo_repuestos")
DAY1, DAY2 = date(2024, 1, 1), date(2024, 2, 1)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """A warehouse after one refresh, and the function that lands more rows."""
    root = tmp_path_factory.mktemp("dw")
    tables = role_tables(spark, SF, *USED)
    tables["consumo_repuestos"] = tables["consumo_repuestos"].withColumn(
        "id_consumo", F.monotonically_increasing_id()
    )

    def stamped(name, df, when):
        df = df.withColumn("fecha_modificacion", F.lit(when).cast("timestamp"))
        return df.withColumn("_dlt_load_id", F.lit("1"))

    def land(name, df, when):
        stamped(name, df, when).coalesce(1).write.mode("append").parquet(f"{root}/landing/{name}")

    schemas = {}
    for name, df in tables.items():
        land(name, df, "2024-01-01 00:00:00")
        schemas[name] = stamped(name, df, "2024-01-01 00:00:00").schema
    schemas["repuestos"] = role_tables(spark, SF, "repuestos")["repuestos"].schema  # nothing landed yet
    store = Warehouse(
        spark, f"{root}/dw", schemas, buckets=2, calendar_days=(date(1995, 1, 1), date(2030, 12, 31)), retry=True
    )
    store.refresh(f"{root}/landing", DAY1)
    return store, land, tables, f"{root}/landing"


def test_streamed_star_equals_batch(spark, warehouse):
    store = warehouse[0]
    streamed = store.fact("fact_mantenimiento_equipos").drop("sk_mantenimiento")
    batch = _fact(spark, SF, "fact_mantenimiento_equipos")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert store.errors("equipos").count() > 0


def test_refresh_follows_changes(spark, warehouse):
    """A moved equipment, a department whose rows become valid, and new orders."""
    store, land, tables, landing = warehouse
    before = store.dimension("dim_equipo")
    in_fact = before.join(store.fact("fact_mantenimiento_equipos"), "sk_equipo", "left_semi")
    moved = in_fact.agg(F.min("id_equipo")).first()[0]
    size, last = before.count(), before.agg(F.max("sk_equipo")).first()[0]
    facts = store.fact("fact_mantenimiento_equipos").count()
    waiting = store.waiting("fact_mantenimiento_equipos")
    assert waiting.filter("size(falta) = 0").isEmpty()
    assert not waiting.filter(F.array_contains("falta", "dim_departamento=24")).isEmpty()

    equipment = tables["equipos"].filter(F.col("id_equipo") == moved)
    land("equipos", equipment.withColumn("estado_codigo", F.lit(4)), "2024-01-02 00:00:00")
    repaired = tables["departamentos"].filter("id_departamento = 24").withColumn(
        "email_departamento", F.lit("d@hospital.es")
    )
    land("departamentos", repaired, "2024-01-02 00:00:00")
    loaded = store.fact("fact_mantenimiento_equipos").select("id_orden")
    template = tables["ordenes_mantenimiento"].filter(F.col("id_equipo") == moved).join(
        loaded, "id_orden", "left_semi"
    ).limit(1)
    land("ordenes_mantenimiento", template.withColumn("id_orden", F.lit(10_000_000).cast("long")),
         "2024-01-02 00:00:00")
    store.refresh(landing, DAY2)

    after = store.dimension("dim_equipo")
    versions = after.filter(F.col("id_equipo") == moved).orderBy("sk_equipo").collect()
    assert [(v.estado_equipo, v.es_actual) for v in versions][-1] == ("Baja", True)
    assert versions[0].fecha_fin == date(2024, 1, 31) and not versions[0].es_actual
    assert after.count() == size + 1 and versions[-1].sk_equipo == last + 1
    assert after.filter("es_actual").groupBy("id_equipo").count().filter("count > 1").isEmpty()

    department = store.dimension("dim_departamento").filter("id_departamento = 24").collect()
    assert len(department) == 1 and department[0].sk_departamento_padre is not None

    fact = store.fact("fact_mantenimiento_equipos")
    assert fact.filter("id_orden = 10000000").count() == 1
    # orders that waited for the department have arrived
    assert fact.count() > facts + 1
    assert fact.select("id_orden").distinct().count() == fact.count()
    assert fact.select("sk_mantenimiento").distinct().count() == fact.count()
    for dim, key in (("dim_equipo", "sk_equipo"), ("dim_departamento", "sk_departamento")):
        assert fact.join(store.dimension(dim), key, "left_anti").isEmpty()


def test_views_leave_closed_versions_out(spark, warehouse):
    store = warehouse[0]
    dims, fact = store.dimensions(), store.fact("fact_mantenimiento_equipos")
    from strataflow.plans.hospital.views import maintenance_view

    narrow, whole = maintenance_view(fact, dims).count(), maintenance_view(fact, dims, all_versions=True).count()
    closed = fact.join(dims["dim_equipo"].filter("NOT es_actual"), "sk_equipo", "left_semi").count()
    assert whole == fact.count() and narrow == whole - closed and closed > 0


def test_repeated_fact_batch_replaces_itself(spark, warehouse):
    store, _, tables, _ = warehouse
    name = "fact_mantenimiento_equipos"
    known = store.fact(name).select("id_orden")
    order = store.cleansed("ordenes_mantenimiento").join(known, "id_orden", "left_semi").limit(1)
    order = order.withColumn("id_orden", F.lit(20_000_000).cast("long"))
    before, last = store.fact(name).count(), store.fact(name).agg(F.max("sk_mantenimiento")).first()[0]
    for _ in range(2):
        store._load_fact(name, order, 50, DAY2)
        fact = store.fact(name)
        assert fact.count() == before + 1
        assert fact.filter("id_orden = 20000000").first().sk_mantenimiento > last


def test_load_object(spark, warehouse):
    store = warehouse[0]
    before = store.fact("fact_mantenimiento_equipos").count()
    assert store.load_object("fact_mantenimiento_equipos", DAY2).isEmpty()
    assert store.fact("fact_mantenimiento_equipos").count() == before
    assert store.load_object("dim_ubicacion", DAY2).count() == store.dimension("dim_ubicacion").count()
    assert store.load_object("dim_perfil_ensayo", DAY2).count() == 360
    assert store.load_object("dim_fecha", DAY2).count() > 5844


def test_first_batch_joins_nothing(spark, tmp_path):
    """A table without rows is known to be empty, so the plan compares with nothing."""
    from strataflow.operators.changes import change_log
    from strataflow.streaming.merged import MergedTables

    changes = spark.createDataFrame([("INSERT", 1, "a"), ("INSERT", 2, "b")], "accion string, id long, v string")
    table = MergedTables(spark, str(tmp_path / "table"), {"rows": changes.drop("accion").schema}, ["id"])
    log = change_log(table.held("rows", changes), changes, ["id"])
    assert "Join" not in log._jdf.queryExecution().optimizedPlan().toString()
    table.publish(0, {"rows": log})
    assert sorted(tuple(r) for r in table.read("rows").collect()) == [(1, "a"), (2, "b")]


def test_first_batch_stores_nothing_in_between(spark, tmp_path, monkeypatch):
    """Newest rows are used once where there is nothing to compare with; a later batch stores them."""
    from strataflow.streaming import refresh

    tags, keep = [], refresh.materialize
    monkeypatch.setattr(refresh, "materialize", lambda df, tag: tags.append(tag) or keep(df, tag))
    hop = _hop(tmp_path)
    data = [(1, 5, 1, False), (1, 6, 2, False), (2, -7, 1, True), (None, 1, 1, False), (None, 1, 1, False)]
    raw_batch(hop, _landed(spark, *data), 0)
    cleansed_batch(hop, _log(spark, hop), 0, positive("v"))
    assert tags == []
    assert _sides(spark, hop) == [[(1, 6)], [(2, -7), (None, 1)]]
    raw_batch(hop, _landed(spark, (1, -6, 3, False), (3, 1, 1, False)), 1)
    cleansed_batch(hop, _log(spark, hop).filter("lote = 1"), 1, positive("v"))
    assert tags == ["changes", "side", "side"]
    assert _sides(spark, hop) == [[(3, 1)], [(1, -6), (2, -7), (None, 1)]]


def test_first_state_is_the_merged_state(spark, rows):
    """Of one log over nothing, also where equal rows without a key repeat; keys are not ranked."""
    from strataflow.operators.changes import first_state, merged_state

    data = [("INSERT", 1, "a", 0), ("INSERT", 2, None, 0), ("INSERT", None, "x", 0), ("INSERT", None, "x", 0), ("INSERT", None, "y", 0)]
    log = spark.createDataFrame(data, "accion string, id long, v string, lote long")
    nothing = log.select("id", "v").limit(0)
    first = first_state(log, ["id"], ["lote"])
    assert first.columns == ["id", "v"]
    assert rows(first) == rows(merged_state(nothing, log, ["id"], ["lote"]))
    assert rows(first_state(log.filter("id is not null"), ["id"], ["lote"])) == [(1, "a"), (2, None)]


def _base_and_log(table, rows):
    """A base of 100 keys, then changes of ten of them and ten new keys, not folded."""
    for batch, changed in enumerate((rows(0, 100), rows(90, 110))):
        table.publish(batch, {"rows": change_log(table.held("rows", changed), changed, table.keys)})
    assert table._state()[1]["rows"].logs


def test_a_merged_table_is_shuffled_before_it_is_joined(spark, tmp_path):
    """Its parts come one after the other, so they must not count as dealt by the key."""
    schema = T.StructType().add("id", T.LongType()).add("v", T.LongType())
    table = MergedTables(spark, str(tmp_path), {"rows": schema}, ["id"], fold_share=10.0)
    _base_and_log(table, lambda a, b: spark.range(a, b).select(F.lit("INSERT").alias("accion"), "id", F.lit(b).alias("v")))
    asked = materialize(spark.range(50, 120), "asked")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = asked.join(rows_with_keys(table.read("rows"), asked, ["id"]), "id", "left")
        plan = met._jdf.queryExecution().executedPlan().toString().splitlines()
        above = [plan[n - 1] for n, line in enumerate(plan) if line.strip(" :+-") == "Union"]
        assert above and all("Exchange" in line for line in above)
        assert met.count() == 70 and met.filter("v is null").count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_days_that_are_held_are_stored(spark, tmp_path):
    """They are joined more than once, and must not be a union then."""
    name, main = "fact_ensayos_clinicos", T.StructType().add("id_participacion", T.LongType())
    store = Warehouse(spark, str(tmp_path), {"participacion_ensayos": main})
    runs = "array(struct(date'2024-01-01' as desde, date_add(date'2024-01-01', {0}) as hasta))"
    for batch, (first, last, days) in enumerate(((0, 100, 1), (95, 105, 2)), 1):
        changed = spark.range(first, last).select(
            F.lit("INSERT").alias("accion"), F.col("id").alias("id_participacion"), F.expr(runs.format(days)).alias("tramos")
        )
        days_table = store._days(name)
        days_table.publish(batch, {"rows": change_log(days_table.held("rows", changed), changed, days_table.keys)})
    assert store._days(name)._state()[1]["rows"].logs
    held = store._held(name, spark.range(90, 200).withColumnRenamed("id", "id_participacion"))
    assert "Union" not in held._jdf.queryExecution().executedPlan().toString()
    longer = held.filter("datediff(tramos[0].hasta, tramos[0].desde) = 2")
    assert (held.count(), longer.count()) == (15, 10)
