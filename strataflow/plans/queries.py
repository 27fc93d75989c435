"""The registered queries, each over whole tables of the test data."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.functions import columns as fx
from strataflow.functions.rules import (
    allowed,
    matches,
    non_negative,
    not_null,
    passes,
    positive,
    rules_of,
    within,
)
from strataflow.operators import changes as cdc
from strataflow.operators.asof import as_of_lookup
from strataflow.operators.dimensions import calendar, junk_dimension
from strataflow.operators.facts import (
    averages,
    daily_rows,
    day_runs,
    insert_only,
    joined_runs,
    outside_ranges,
    recurrence_flag,
)
from strataflow.operators.hierarchy import hierarchy_levels, with_parent_key
from strataflow.operators.keys import assign_keys
from strataflow.operators.quality import failure_report, quarantined_rows, valid_rows
from strataflow.operators.scd import current_rows, scd1_merge, scd2_merge
from strataflow.plans.hospital.catalog import EMAIL, quality_rules
from strataflow.plans.hospital.dimensions import (
    DIMENSIONS,
    MAINTENANCE_PROFILE,
    PROFILES,
    TRIAL_PROFILE,
    load_dimension,
)
from strataflow.plans.hospital.facts import FACTS, PARITY_DAYS, load_fact, trial_coverage
from strataflow.plans.hospital.views import FACT_VIEWS
from strataflow.plans.hospital.warehouse import Warehouse
from strataflow.plans.roles import ROLES, base_tables, cleansed_tables, portable, role_tables, row_key
from strataflow.session import materialize, scratch_path
from strataflow.sources.files import FILE, INGESTED, stream_csv_feed
from strataflow.sources.landing import CsvFeed, land, landed_rows
from strataflow.sources.relational import high_water_mark, incremental_rows
from strataflow.sources.schema import landing_columns, without_technical
from strataflow.streaming.refresh import Hop, follow_cleansed, follow_raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = date(2001, 8, 10)
LANDED_BEFORE = "2000-01-01"


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


# --- sources ---------------------------------------------------------------


@query
def src_high_water_mark(spark, sf_dir):
    t = base_tables(spark, sf_dir)
    marks = [("orders", t["orders"], "o_orderdate"), ("events", t["events"], "ts")]
    rows = [
        df.agg(fx.micros(F.max(cursor)).alias("marca_us")).select(F.lit(name).alias("tabla"), "marca_us")
        for name, df, cursor in marks
    ]
    return rows[0].unionByName(rows[1])


@query
def src_incremental_cursor(spark, sf_dir):
    orders = base_tables(spark, sf_dir)["orders"]
    landed = orders.filter(F.col("o_orderdate") < F.lit(LANDED_BEFORE).cast("timestamp_ntz"))
    fresh = incremental_rows(orders, landed, "o_orderdate", ["o_orderkey"])
    return fresh.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"))


@query
def src_csv_new_files(spark, sf_dir):
    """Two deliveries of the product feed; the second run lands only the second."""
    products = role_tables(spark, sf_dir, "productos_sanitarios")["productos_sanitarios"]
    root = scratch_path(spark, "feed")
    feed, landing = CsvFeed("productos_sanitarios", f"{root}/in"), f"{root}/landing"
    cheap = F.try_to_number("precio_referencia_eur", F.lit("999999.99")) < 1000
    for delivery in (F.coalesce(cheap, F.lit(False)), ~F.coalesce(cheap, F.lit(False))):
        products.filter(delivery).write.mode("append").csv(feed.folder, sep=";", header=True)
        land(spark, feed, landing, datetime(2024, 1, 1))
    rows = landed_rows(spark, landing, feed.table)
    return rows.withColumns({
        FILE: F.col(FILE).endswith(".csv"),
        INGESTED: F.to_date(INGESTED),
    })


@query
def src_csv_dialect(spark, sf_dir):
    """Two files with their columns in another order; quotes, separators and line breaks in fields."""
    part = base_tables(spark, sf_dir)["part"]
    root = scratch_path(spark, "feed")
    feed = CsvFeed("productos", f"{root}/in")
    small = F.col("p_size") <= 25
    rows = part.select(
        F.col("p_partkey").cast("string").alias("codigo"),
        F.concat("p_name", F.lit(' "x" ; \n'), "p_brand").alias("nombre"),
        F.when(small, "").alias("nota"),
        small.alias("pequeno"),
    )
    for picked, columns in ((F.col("pequeno"), ("codigo", "nombre", "nota")), (~F.col("pequeno"), ("nota", "codigo", "nombre"))):
        rows.filter(picked).select(*columns).write.mode("append").csv(feed.folder, sep=";", header=True, escape='"')
    land(spark, feed, f"{root}/landing", datetime(2024, 1, 1))
    return landed_rows(spark, f"{root}/landing", feed.table).select("codigo", "nombre", "nota")


@query
def src_csv_stream(spark, sf_dir):
    """The same feed read as a stream, run twice on one checkpoint."""
    products = role_tables(spark, sf_dir, "productos_sanitarios")["productos_sanitarios"]
    root = scratch_path(spark, "feed")
    out = f"{root}/landing"
    for delivery in (F.col("clase_riesgo") == "I", F.col("clase_riesgo") != "I"):
        products.filter(delivery).write.mode("append").csv(f"{root}/in", sep=";", header=True)
        rows = stream_csv_feed(spark, f"{root}/in", products.columns)
        (
            rows.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return spark.read.parquet(out).withColumn(FILE, F.col(FILE).endswith(".csv")).drop(INGESTED)


@query
def src_snake_case_typed(spark, sf_dir):
    orders = base_tables(spark, sf_dir)["orders"]
    source = orders.select(
        F.col("o_orderkey").alias("IdOrden"),
        F.col("o_custkey").cast("int").alias("IdCliente"),
        F.col("o_totalprice").cast("float").cast("double").alias("ImporteTotal"),
        F.to_date("o_orderdate").alias("FechaOrden"),
        F.col("o_orderstatus").alias("estado_Orden"),
        (F.col("o_orderstatus") == "F").alias("EsFinal"),
    )
    return landing_columns(source)


@query
def src_exclude_technical(spark, sf_dir):
    lines = base_tables(spark, sf_dir)["lineitem"]
    landed = lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.lit("1704067200.1").alias("_DLT_LOAD_ID"), F.col("l_orderkey").cast("string").alias("_DLT_ID"),
    )
    return without_technical(landed)


# --- change capture and merge ------------------------------------------------


@query
def cdc_latest_per_key(spark, sf_dir):
    events = base_tables(spark, sf_dir)["events"]
    newest = cdc.latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return newest.select("user_id", "event_id", "event_type", "value")


def _order_changes(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders already merged, and a batch of changes that updates, inserts and deletes."""
    data = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    target = data.filter(orders.o_orderpriority != "5-LOW")
    arriving = orders.filter(F.col("o_orderstatus") != "F")
    inserts = arriving.select(
        F.lit(cdc.INSERT).alias(cdc.ACTION), "o_orderkey", "o_custkey",
        (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderdate",
    )
    older = inserts.withColumns({
        "o_totalprice": F.lit(-1.0),
        "o_orderdate": F.col("o_orderdate") - F.expr("interval 1 day"),
    })
    deletes = orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)).select(
        F.lit(cdc.DELETE).alias(cdc.ACTION), "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    return target, inserts.unionByName(older).unionByName(deletes)


@query
def cdc_merge_upsert_delete(spark, sf_dir):
    target, changes = _order_changes(base_tables(spark, sf_dir)["orders"])
    merged = cdc.merge_changes(target, changes, ["o_orderkey"], ["o_orderdate"])
    return merged.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query
def cdc_merge_guarded(spark, sf_dir):
    """Changes older than the row they would replace are ignored."""
    orders = base_tables(spark, sf_dir)["orders"]
    target = orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    shift = F.when(F.col("o_orderstatus") == "F", F.expr("interval 1 day")).otherwise(F.expr("interval -1 day"))
    changes = orders.select(
        F.lit(cdc.INSERT).alias(cdc.ACTION), "o_orderkey", F.lit(0.0).alias("o_totalprice"),
        (F.col("o_orderdate") + shift).alias("o_orderdate"),
    )
    merged = cdc.merge_changes(target, changes, ["o_orderkey"], ["o_orderdate"], guard="o_orderdate")
    return merged.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query
def cdc_soft_delete(spark, sf_dir):
    """A flagged row deletes its match; without a match it is inserted."""
    orders = base_tables(spark, sf_dir)["orders"]
    flagged = F.col("o_orderstatus") == "P"
    data = orders.select("o_orderkey", "o_totalprice", flagged.alias("is_deleted"))
    target = data.filter(orders.o_orderpriority != "5-LOW").withColumn("is_deleted", F.lit(False))
    changes = data.filter(orders.o_totalprice > 200000).select(F.lit(cdc.INSERT).alias(cdc.ACTION), "*")
    return cdc.merge_changes(
        target, changes, ["o_orderkey"], [], soft_delete=cdc.soft_delete_column(target.columns)
    )


def _customer_versions(customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    data = customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    old = data.filter(customer.c_mktsegment != "FURNITURE")
    new = data.filter(customer.c_mktsegment != "BUILDING").withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_mktsegment"))
    )
    return old, new


@query
def cdc_snapshot_diff(spark, sf_dir):
    return cdc.snapshot_diff(*_customer_versions(base_tables(spark, sf_dir)["customer"]), ["c_custkey"])


@query
def cdc_post_images(spark, sf_dir):
    return cdc.post_images(cdc_snapshot_diff(spark, sf_dir))


@query
def cdc_valid_invalid_migration(spark, sf_dir):
    """Rows that cross the rules leave one table and enter the other."""
    orders = base_tables(spark, sf_dir)["orders"]
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    negated = F.when(priority == "1-URGENT", -price).otherwise(price + 1)
    missing = F.when(priority != "5-LOW", price)
    old = orders.select("o_orderkey", missing.alias("o_totalprice"), "o_orderstatus")
    new = orders.select("o_orderkey", negated.alias("o_totalprice"), "o_orderstatus")
    rules = positive("o_totalprice")
    log = cdc.snapshot_diff(old, new, ["o_orderkey"])
    sides = []
    for name, pick in (("valida", valid_rows), ("error", quarantined_rows)):
        merged = cdc.merge_changes(pick(old, rules), pick(log, rules), ["o_orderkey"], [])
        sides.append(merged.select(F.lit(name).alias("lado"), "*"))
    return sides[0].unionByName(sides[1])


@query
def cdc_stream_refresh(spark, sf_dir):
    """Landing to raw to cleansed through file streams, in several batches."""
    events = base_tables(spark, sf_dir)["events"]
    root = scratch_path(spark, "stream")
    landed = events.select(
        F.col("user_id").alias("id_usuario"), "event_id", "event_type", "value",
        F.col("ts").alias("fecha_modificacion"), F.lit("carga").alias("_dlt_load_id"),
    )
    hop = Hop("eventos", ("id_usuario",), without_technical(landed).schema, root)
    landed.repartitionByRange(3, "fecha_modificacion").write.parquet(f"{root}/landing/eventos")
    # files of one write come in any order, so older rows must not win
    follow_raw(spark, hop, f"{root}/landing", landed.schema, guard=True, files_per_batch=1).awaitTermination()
    rules = positive("value") + allowed("event_type", "view", "click", "purchase")
    follow_cleansed(spark, hop, rules).awaitTermination()
    tables = hop.cleansed(spark)
    sides = [
        tables.read(name).select(F.lit(name).alias("lado"), "id_usuario", "event_id", "event_type", "value")
        for name in ("valid", "errors")
    ]
    return sides[0].unionByName(sides[1])


@query
def cdc_tombstone_guard(spark, sf_dir):
    """Orders are deleted; older versions that arrive later stay deleted, newer ones come back."""
    orders = base_tables(spark, sf_dir)["orders"]
    root = scratch_path(spark, "tombstones")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    batches = [
        (F.lit(True), 0, F.col("o_totalprice"), False),
        (status == "F", 5, F.col("o_totalprice"), True),
        (key % 3 != 0, 3, F.lit(-1.0), False),
        (key % 2 == 0, 7, F.lit(-2.0), False),
    ]
    hop = None
    for picked, days, price, deleted in batches:
        landed = orders.filter(picked).select(
            key.alias("id_orden"), price.alias("importe"),
            (F.col("o_orderdate") + F.expr(f"interval {days} days")).cast("timestamp").alias("fecha_modificacion"),
            F.lit(deleted).alias("is_deleted"), F.lit("carga").alias("_dlt_load_id"),
        )
        landed.write.mode("append").parquet(f"{root}/landing/ordenes")
        hop = hop or Hop("ordenes", ("id_orden",), without_technical(landed).schema, root)
        follow_raw(spark, hop, f"{root}/landing", landed.schema, guard=True).awaitTermination()
    return hop.raw(spark).read("rows").select("id_orden", "importe", F.to_date("fecha_modificacion").alias("dia"))


@query
def cdc_load_order(spark, sf_dir):
    """Two deliveries of one key wait together; without a date column the later one wins,
    by the time it landed or by its load."""
    part = base_tables(spark, sf_dir)["part"].select("p_partkey", "p_name", "p_size")
    root = scratch_path(spark, "order")
    sides = []
    for side, column, marks in (
        ("fecha", "fecha_ingestion", [datetime(2024, 1, 1), datetime(2024, 1, 2)]),
        ("carga", "_dlt_load_id", ["1704067200.1", "1704153600.2"]),
    ):
        older, newer = (
            part.withColumn("p_size", F.col("p_size") + k).withColumn(column, F.lit(mark)) for k, mark in enumerate(marks)
        )
        newer.unionByName(older).write.parquet(f"{root}/landing/{side}")
        hop = Hop(side, ("p_partkey",), without_technical(older).schema, root)
        follow_raw(spark, hop, f"{root}/landing", older.schema).awaitTermination()
        sides.append(hop.raw(spark).read("rows").select(F.lit(side).alias("lado"), "p_partkey", "p_name", "p_size"))
    return sides[0].unionByName(sides[1])


# --- data quality --------------------------------------------------------------


def _event_rules():
    return [
        *not_null("marca"),
        *positive("value"),
        *non_negative("user_id"),
        *allowed("event_type", "view", "click", "purchase", "signup"),
        *allowed("dia", *range(1, 29)),
        *matches("email", EMAIL),
        *within("value", 1, 200),
    ]


def _event_rows(spark, sf_dir):
    events = base_tables(spark, sf_dir)["events"]
    return events.select(
        "event_id", "user_id", "event_type", "value",
        F.dayofmonth("ts").alias("dia"),
        F.when(F.col("value") < 100, F.lit("x")).alias("marca"),
        F.when(F.col("user_id") < 10, F.lit("u@correo"))
        .otherwise(F.concat(F.lit("u"), "user_id", F.lit("@correo.es"))).alias("email"),
    )


@query
def dq_valid(spark, sf_dir):
    return valid_rows(_event_rows(spark, sf_dir), _event_rules())


@query
def dq_quarantine(spark, sf_dir):
    return quarantined_rows(_event_rows(spark, sf_dir), _event_rules())


@query
def dq_failure_report(spark, sf_dir):
    return failure_report(_event_rows(spark, sf_dir), _event_rules())


@query
def cleansed_layer(spark, sf_dir):
    """Every row of all 21 source tables, by its key, with the side of the rules that it is on."""
    rules, sides = quality_rules(), []
    for name, df in role_tables(spark, sf_dir).items():
        good = passes(rules_of(rules, name.upper()), df)
        key = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in row_key(name)))
        sides.append(df.select(F.lit(name).alias("tabla"), key.alias("clave"), F.when(good, "valida").otherwise("error").alias("lado")))
    return reduce(DataFrame.unionByName, sides)


# --- dimension operators ---------------------------------------------------------


@query
def dim_scd1_merge(spark, sf_dir):
    part = base_tables(spark, sf_dir)["part"]
    data = ("p_name", "p_brand", "p_retailprice")
    first = part.filter(part.p_type != "PROMO").select("p_partkey", *data)
    second = part.filter(part.p_type != "LARGE").select(
        "p_partkey", "p_name",
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("p_brand"),
        (F.col("p_retailprice") + 1).alias("p_retailprice"),
    )
    dim = materialize(scd1_merge(None, first, "p_partkey", data, "sk_part"), "dim")
    return scd1_merge(dim, second, "p_partkey", data, "sk_part")


OVERWRITE, VERSIONED = ("c_name", "c_acctbal"), ("c_mktsegment", "c_nationkey")


def _scd2(dim, source, as_of):
    return scd2_merge(dim, source, "c_custkey", OVERWRITE, VERSIONED, "sk_customer", as_of)


def _customer_rounds(spark, sf_dir, second_day: date | None):
    customer = base_tables(spark, sf_dir)["customer"]
    columns = ("c_custkey", *OVERWRITE, *VERSIONED)
    first = customer.filter(customer.c_mktsegment != "FURNITURE").select(*columns)
    second = customer.filter(customer.c_mktsegment != "BUILDING").select(
        "c_custkey", "c_name", (F.col("c_acctbal") + 100).alias("c_acctbal"),
        F.when(F.col("c_nationkey") < 5, F.lit("MACHINERY"))
        .when(F.col("c_nationkey") == 7, None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_nationkey",
    )
    # a warehouse stores the dimension after every load
    dim = materialize(_scd2(None, first, date(2024, 1, 1)), "dim")
    dim = _scd2(dim, second, date(2024, 2, 1))
    if second_day is None:
        return dim
    return _scd2(materialize(dim, "dim"), customer.select(*columns), second_day)


@query
def dim_scd2_merge(spark, sf_dir):
    return _customer_rounds(spark, sf_dir, None)


@query
def dim_scd2_two_rounds(spark, sf_dir):
    return _customer_rounds(spark, sf_dir, date(2024, 3, 1))


@query
def dim_scd2_same_day(spark, sf_dir):
    return _customer_rounds(spark, sf_dir, date(2024, 2, 1))


@query
def view_current_versions(spark, sf_dir):
    return current_rows(_customer_rounds(spark, sf_dir, date(2024, 3, 1)))


@query
def dim_surrogate_keys(spark, sf_dir):
    orders = base_tables(spark, sf_dir)["orders"]
    return assign_keys(orders.select("o_orderkey", "o_custkey"), "sk_order", ["o_orderkey"], start=1000)


@query
def dim_calendar(spark, sf_dir):
    """Calendar over the span of the orders, with the orders of each day."""
    orders = base_tables(spark, sf_dir)["orders"]
    span = orders.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("fecha")).agg(F.count(F.lit(1)).alias("ordenes"))
    days = calendar(spark, span[0], span[1]).join(per_day, "fecha", "left")
    return days.withColumn("ordenes", F.coalesce("ordenes", F.lit(0)))


def _nodes(spark, sf_dir):
    part = base_tables(spark, sf_dir)["part"]
    above = F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 4))
    return part.select(F.col("p_partkey").alias("id_nodo"), above.alias("id_padre"), "p_name")


@query
def dim_hierarchy(spark, sf_dir):
    return hierarchy_levels(_nodes(spark, sf_dir), "id_nodo", "id_padre", "nivel")


@query
def dim_hierarchy_parent_key(spark, sf_dir):
    dim = scd1_merge(None, _nodes(spark, sf_dir), "id_nodo", ("id_padre", "p_name"), "sk_nodo")
    return with_parent_key(dim, "id_nodo", "id_padre", "sk_nodo", "sk_padre")


def _profile_usage(spark, sf_dir, sk, axes, codes):
    """Every combination of the profile with the number of rows that carry it."""
    rows = codes.groupBy(*axes).agg(F.count(F.lit(1)).alias("filas"))
    profile = junk_dimension(spark, axes, sk)
    profile = junk_dimension(spark, axes, sk, profile)  # loading twice adds nothing
    return profile.join(rows, list(axes), "left").withColumn("filas", F.coalesce("filas", F.lit(0)))


@query
def dim_junk_maintenance(spark, sf_dir):
    from strataflow.plans.hospital.facts import MAINTENANCE_TYPE_ADMITTED, PRIORITY, SEVERITY

    orders = role_tables(spark, sf_dir, "ordenes_mantenimiento")["ordenes_mantenimiento"]
    codes = orders.select(
        fx.decode(F.col("tipo_mantenimiento"), MAINTENANCE_TYPE_ADMITTED).alias("tipo_mantenimiento"),
        fx.decode(F.col("prioridad"), PRIORITY).alias("prioridad"),
        fx.decode(F.col("gravedad"), SEVERITY).alias("gravedad"),
        F.col("es_cubierto_por_garantia").alias("es_garantia"),
        F.col("requiere_parada").alias("requiere_parada_equipo"),
    )
    return _profile_usage(spark, sf_dir, "sk_perfil_mantenimiento", MAINTENANCE_PROFILE, codes)


@query
def dim_junk_trial(spark, sf_dir):
    from strataflow.plans.hospital.facts import ARM, BLINDING, PHASE, RANDOMISATION, ROUTE

    rows = role_tables(spark, sf_dir, "participacion_ensayos")["participacion_ensayos"]
    codes = rows.select(
        fx.decode(F.col("fase"), PHASE).alias("fase_ensayo"),
        fx.decode(F.col("tipo_ciego"), BLINDING).alias("tipo_ciego"),
        fx.decode(F.col("tipo_aleatorizacion"), RANDOMISATION).alias("tipo_aleatorizacion"),
        fx.decode(F.col("grupo_asignado"), ARM).alias("grupo_tratamiento"),
        fx.decode(F.col("via_administracion"), ROUTE).alias("via_administracion"),
    )
    return _profile_usage(spark, sf_dir, "sk_perfil_ensayo", TRIAL_PROFILE, codes)


@query
def dim_name_split(spark, sf_dir):
    part = base_tables(spark, sf_dir)["part"]
    words = F.when(F.col("p_size") > 40, F.substring_index("p_name", " ", 1)).when(
        F.col("p_size") > 30, F.concat_ws(" ", "p_name", "p_brand")
    ).when(F.col("p_size") > 20, F.concat_ws(" ", "p_name", "p_brand", "p_type")).when(
        F.col("p_size") > 10, F.concat_ws(" ", "p_name", "p_brand", "p_type", "p_brand")
    ).otherwise(F.col("p_name"))
    given, surnames = fx.person_name(F.col("completo"))
    return part.select("p_partkey", words.alias("completo")).select(
        "p_partkey", given.alias("nombre"), surnames.alias("apellidos")
    )


@query
def dim_prefix_strip(spark, sf_dir):
    part = base_tables(spark, sf_dir)["part"]
    text = F.when(F.col("p_type") == "SMALL", None).when(F.col("p_type") == "LARGE", F.col("p_brand")).otherwise(
        F.concat_ws(" - ", "p_name", "p_brand")
    )
    return part.select("p_partkey", text.alias("texto"), "p_name").select(
        "p_partkey", fx.strip_prefix(F.col("texto"), F.col("p_name")).alias("descripcion")
    )


@query
def dim_enriched_lookup(spark, sf_dir):
    t = base_tables(spark, sf_dir)
    nation = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    # every fifth nation code is moved out of the lookup's range, so that it is missed
    code = F.when(F.col("c_nationkey") >= 20, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    return (
        t["customer"]
        .join(nation, code == F.col("n_nationkey"), "left")
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "c_custkey",
            F.concat("c_mktsegment", F.lit(" "), "n_name").alias("apellidos"),
            F.coalesce("n_name", F.lit("Sin especialidad")).alias("especialidad"),
            F.col("r_name").alias("departamento"),
        )
    )


@query
def dim_decode(spark, sf_dir):
    orders = base_tables(spark, sf_dir)["orders"]
    return orders.select(
        "o_orderkey",
        fx.decode(F.col("o_orderstatus"), {"F": "Cerrada", "O": "Abierta"}).alias("estado"),
        fx.decode(F.substring("o_orderpriority", 1, 1).cast("int"), {1: "Critica", 2: "Alta", 3: "Media"})
        .alias("prioridad"),
    )


# --- the hospital star ---------------------------------------------------------------

_STORED: dict[tuple, DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table of the star, written once per application as a warehouse would hold it."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _STORED:
        _STORED[slot] = materialize(build(), name)
    return _STORED[slot]


def star_dimensions(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    dims = {}
    for name in names:
        if name == "dim_fecha":
            dims[name] = calendar(spark, date(1995, 1, 1), date(2030, 12, 31))
        elif name in PROFILES:
            sk, axes = PROFILES[name]
            dims[name] = stored(spark, sf_dir, name, lambda sk=sk, axes=axes: junk_dimension(spark, axes, sk))
        else:
            dims[name] = stored(spark, sf_dir, name, lambda name=name: _dimension(spark, sf_dir, name))
    return dims


def _dimension(spark, sf_dir, name):
    lookups = {"departamentos", "ubicaciones", "especialidades"}
    tables = cleansed_tables(spark, sf_dir, DIMENSIONS[name].main, *lookups)
    return load_dimension(spark, name, tables, None, AS_OF)


def _dimension_query(name: str) -> None:
    def build(spark, sf_dir):
        return _dimension(spark, sf_dir, name)

    build.__name__ = name
    query(build)


for _name in DIMENSIONS:
    _dimension_query(_name)

FACT_INPUTS = {
    "fact_mantenimiento_equipos": (
        ("ordenes_mantenimiento", "equipos", "tecnicos", "consumo_repuestos"),
        ("dim_equipo", "dim_tecnico", "dim_departamento", "dim_ubicacion", "dim_fabricante",
         "dim_perfil_mantenimiento"),
    ),
    "fact_monitorizacion_pacientes": (
        ("monitorizaciones", "lecturas_signos_vitales", "equipos", "departamentos", "ubicaciones"),
        ("dim_paciente", "dim_medico", "dim_equipo", "dim_departamento", "dim_ubicacion", "dim_diagnostico"),
    ),
    "fact_ensayos_clinicos": (
        ("participacion_ensayos", "ensayos_clinicos", "departamentos", "visitas_ensayo"),
        ("dim_ensayo", "dim_paciente", "dim_medico", "dim_diagnostico", "dim_departamento", "dim_perfil_ensayo"),
    ),
}


def _fact(spark, sf_dir, name, parity=False, held=None, as_of=AS_OF):
    tables = {
        t: stored(spark, sf_dir, t, lambda t=t: cleansed_tables(spark, sf_dir, t)[t]) for t in FACT_INPUTS[name][0]
    }
    dims = star_dimensions(spark, sf_dir, *FACT_INPUTS[name][1])
    return load_fact(name, tables[FACTS[name]], tables, dims, as_of, held, parity)


@query
def fact_mantenimiento_equipos(spark, sf_dir):
    return _fact(spark, sf_dir, "fact_mantenimiento_equipos")


@query
def fact_mantenimiento_parity(spark, sf_dir):
    """The same load with the source system's own codes: no recurrence, no calibrations."""
    return _fact(spark, sf_dir, "fact_mantenimiento_equipos", parity=True)


@query
def fact_monitorizacion_pacientes(spark, sf_dir):
    return _fact(spark, sf_dir, "fact_monitorizacion_pacientes")


@query
def fact_ensayos_clinicos(spark, sf_dir):
    return _fact(spark, sf_dir, "fact_ensayos_clinicos")


@query
def fact_ensayos_two_loads(spark, sf_dir):
    """A load ten weeks earlier, then today's: open participations are extended."""
    name = "fact_ensayos_clinicos"
    earlier = stored(
        spark, sf_dir, f"{name}_earlier", lambda: _fact(spark, sf_dir, name, as_of=date(2001, 6, 1))
    )
    held = stored(spark, sf_dir, f"{name}_days", lambda: trial_coverage(earlier))
    return earlier.unionByName(_fact(spark, sf_dir, name, held=held))


@query
def fact_mantenimiento_two_loads(spark, sf_dir):
    """Orders that are in the fact already are not loaded again."""
    name = "fact_mantenimiento_equipos"
    whole = stored(spark, sf_dir, name, lambda: _fact(spark, sf_dir, name))
    held = whole.filter(F.col("sk_fecha") < 20000101)
    return held.unionByName(_fact(spark, sf_dir, name, held=held))


def _view(spark, sf_dir, name, all_versions=False):
    fact = stored(spark, sf_dir, name, lambda: _fact(spark, sf_dir, name))
    dims = star_dimensions(spark, sf_dir, "dim_fecha", *FACT_INPUTS[name][1])
    return FACT_VIEWS[name](fact, dims, all_versions)


@query
def view_mantenimiento_equipos(spark, sf_dir):
    return _view(spark, sf_dir, "fact_mantenimiento_equipos")


@query
def view_mantenimiento_calendar(spark, sf_dir):
    """The same view with the default calendar, which none of the orders falls into."""
    fact = stored(spark, sf_dir, "fact_mantenimiento_equipos", lambda: _fact(spark, sf_dir, "fact_mantenimiento_equipos"))
    dims = star_dimensions(spark, sf_dir, *FACT_INPUTS["fact_mantenimiento_equipos"][1])
    return FACT_VIEWS["fact_mantenimiento_equipos"](fact, dims | {"dim_fecha": calendar(spark)})


@query
def view_monitorizacion_pacientes(spark, sf_dir):
    return _view(spark, sf_dir, "fact_monitorizacion_pacientes")


@query
def view_ensayos_clinicos(spark, sf_dir):
    return _view(spark, sf_dir, "fact_ensayos_clinicos")


# --- fact operators on the base tables ------------------------------------------------


def _line_costs(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("coste"),
        F.sum("l_quantity").alias("piezas"),
    )


@query
def fact_order_cost(spark, sf_dir):
    """One row per order: pre-aggregated line costs, lookups, measures, date key."""
    t = base_tables(spark, sf_dir)
    labour = F.round(F.col("o_totalprice") * 2, 2)
    return (
        t["orders"]
        .join(_line_costs(t["lineitem"]), "o_orderkey", "left")
        .join(t["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"].select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            fx.date_key(F.col("o_orderdate")).alias("sk_fecha"),
            "n_name",
            F.round("coste", 4).alias("coste_repuestos"),
            F.round("piezas", 4).alias("piezas"),
            labour.alias("coste_mano_obra"),
            F.round(F.coalesce("coste", F.lit(0.0)) + labour, 4).alias("coste_total"),
        )
    )


@query
def fact_profile_key(spark, sf_dir):
    axes = {"estado": ("F", "O", "P"), "urgente": (True, False)}
    orders = base_tables(spark, sf_dir)["orders"]
    profile = junk_dimension(spark, axes, "sk_perfil")
    coded = orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("estado"),
        (F.col("o_orderpriority") == "1-URGENT").alias("urgente"),
    )
    return coded.join(F.broadcast(profile), list(axes)).select("o_orderkey", "sk_perfil")


@query
def fact_duration(spark, sf_dir):
    events = base_tables(spark, sf_dir)["events"]
    sessions = events.groupBy("user_id", F.to_date("ts").alias("dia")).agg(
        F.min("ts").alias("desde"), F.max("ts").alias("hasta")
    )
    return sessions.select(
        "user_id", "dia",
        fx.minutes_between(F.col("desde"), F.col("hasta")).alias("minutos"),
        fx.minutes_between(F.col("hasta"), F.col("desde")).alias("minutos_atras"),
    )


@query
def fact_recurrence_flag(spark, sf_dir):
    orders = base_tables(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    flagged = recurrence_flag(
        orders, orders, "o_custkey", "o_orderdate", F.col("o_orderpriority") == "1-URGENT", "reincidencia"
    )
    return flagged.select("o_orderkey", "reincidencia")


@query
def fact_session_alert(spark, sf_dir):
    events = base_tables(spark, sf_dir)["events"]
    readings = events.select(
        F.concat_ws("/", "user_id", F.to_date("ts").cast("string")).alias("sesion"),
        F.col("value").cast("decimal(12,2)").alias("a"),
        F.when(F.col("event_type") != "error", F.col("value").cast("decimal(12,2)")).alias("b"),
    )
    means = averages(readings, "sesion", ["a", "b"])
    alert = outside_ranges({"a": (10, 90), "b": (5, None)})
    return means.select("sesion", alert.alias("alerta"))


@query
def fact_daily_expansion(spark, sf_dir):
    """Orders spread over days, with the line items shipped on each."""
    t = base_tables(spark, sf_dir)
    orders = t["orders"].select(
        "o_orderkey", F.to_date("o_orderdate").alias("desde"),
        F.when(
            (F.col("o_orderstatus") != "P") | (F.col("o_orderdate") < F.lit("2001-07-01").cast("timestamp_ntz")),
            F.date_add(F.to_date("o_orderdate"), (F.floor("o_totalprice") % 20 - 3).cast("int")),
        ).alias("hasta"),
    )
    visits = t["lineitem"].select(
        F.col("l_orderkey").alias("o_orderkey"), "l_shipdate",
        F.col("l_linenumber").cast("long").alias("linea"), "l_quantity",
    )
    return daily_rows(orders, visits, "o_orderkey", "desde", "hasta", "l_shipdate", "dia", AS_OF)


def _long_intervals(spark, sf_dir, most_days):
    """Intervals of 3,600 days and more, open ones without visits, counted by day."""
    suppliers = base_tables(spark, sf_dir)["supplier"].select("s_suppkey")
    start = F.lit("1990-01-01").cast("date")
    spans = suppliers.select(
        "s_suppkey", start.alias("desde"), F.date_add(start, (F.col("s_suppkey") % 100 + 3599).cast("int")).alias("hasta")
    )
    visits = suppliers.select("s_suppkey", F.lit("1980-01-01").cast("date").alias("visita"))
    daily = daily_rows(spans, visits, "s_suppkey", "desde", "hasta", "visita", "dia", AS_OF, most_days=most_days)
    return daily.groupBy("s_suppkey").agg(
        F.count("*").cast("int").alias("n_days"), F.min("dia").alias("primero"), F.max("dia").alias("ultimo")
    )


@query
def fact_daily_long(spark, sf_dir):
    return _long_intervals(spark, sf_dir, None)


@query
def fact_daily_long_parity(spark, sf_dir):
    return _long_intervals(spark, sf_dir, PARITY_DAYS)


@query
def fact_daily_gaps(spark, sf_dir):
    """Days of orders that are not loaded yet: what is held has holes and overlaps."""
    t = base_tables(spark, sf_dir)
    orders = t["orders"].select(
        "o_orderkey", F.to_date("o_orderdate").alias("desde"), F.date_add(F.to_date("o_orderdate"), 60).alias("hasta")
    )
    lines = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("dia"), "l_linenumber")
    single = day_runs(lines, "o_orderkey", "dia")
    spread = lines.filter("l_linenumber > 2").select(
        "o_orderkey", F.date_sub("dia", 3).alias("desde"), F.date_add("dia", F.col("l_linenumber")).alias("hasta")
    )
    held = materialize(joined_runs(single.unionByName(spread), "o_orderkey"), "held")
    visits = lines.select("o_orderkey", F.date_add("dia", 9).alias("visita"), F.col("l_linenumber").cast("long").alias("linea"))
    return daily_rows(orders, visits, "o_orderkey", "desde", "hasta", "visita", "dia", AS_OF, held)


@query
def fact_asof_version(spark, sf_dir):
    """Orders take the version of their customer that was valid on a day of their own."""
    orders = base_tables(spark, sf_dir)["orders"].select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"),
        F.date_add(F.lit(date(2023, 12, 20)), (F.col("o_orderkey") % 100).cast("int")).alias("dia"),
    )
    dim = stored(spark, sf_dir, "dim_customer_2", lambda: _customer_rounds(spark, sf_dir, date(2024, 3, 1)))
    columns = ["sk_customer", "c_mktsegment"]
    return as_of_lookup(
        orders, dim, "c_custkey", "dia", "fecha_inicio", columns, end="fecha_fin", tie="sk_customer"
    )


@query
def fact_insert_only(spark, sf_dir):
    orders = base_tables(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    fact = orders.filter(F.col("o_orderstatus") == "F")
    batch = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return fact.unionByName(insert_only(batch, fact, ["o_orderkey"]))


def _versioned_customers(spark, sf_dir):
    return stored(spark, sf_dir, "dim_customer", lambda: _customer_rounds(spark, sf_dir, None))


@query
def fact_current_version(spark, sf_dir):
    """Orders take the version of their customer that is current at load time."""
    orders = base_tables(spark, sf_dir)["orders"]
    dim = current_rows(_versioned_customers(spark, sf_dir))
    return orders.join(dim, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "sk_customer", "c_mktsegment"
    )


def _order_wide(spark, sf_dir, all_versions):
    """Facts loaded against the first versions, read after some were closed."""
    orders = base_tables(spark, sf_dir)["orders"]
    dim = _versioned_customers(spark, sf_dir)
    first = dim.filter(F.col("fecha_inicio") == F.lit(date(2024, 1, 1))).select("c_custkey", "sk_customer")
    fact = orders.join(first, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", fx.date_key(F.col("o_orderdate")).alias("sk_fecha"), "sk_customer", "o_totalprice"
    )
    days = star_dimensions(spark, sf_dir, "dim_fecha")["dim_fecha"]
    versions = dim if all_versions else current_rows(dim)
    return (
        fact.join(F.broadcast(days.select("sk_fecha", "fecha", "nombre_mes", "es_fin_semana")), "sk_fecha")
        .join(versions.select("sk_customer", "c_name", "c_mktsegment"), "sk_customer")
        .drop("sk_fecha", "sk_customer")
    )


@query
def view_order_wide(spark, sf_dir):
    return _order_wide(spark, sf_dir, all_versions=False)


@query
def view_order_wide_all_versions(spark, sf_dir):
    return _order_wide(spark, sf_dir, all_versions=True)


# --- the stored warehouse --------------------------------------------------------------

BEFORE = date(2001, 6, 1)  # day of the first refresh


def _two_rounds(spark, sf_dir):
    """A warehouse of all three facts, refreshed twice: its facts after each round, what waited
    in between, and the trials once they are loaded again as a whole. Built once per application."""
    slot = (spark.sparkContext.applicationId, sf_dir, "warehouse")
    if slot in _STORED:
        return _STORED[slot]
    root = scratch_path(spark, "warehouse")
    mains = {DIMENSIONS[d].main for d in DIMENSIONS}
    used = sorted({*mains, "especialidades", *(t for tables, _ in FACT_INPUTS.values() for t in tables)})
    tables = role_tables(spark, sf_dir, *used)
    for name, number in (("consumo_repuestos", "id_consumo"), ("visitas_ensayo", "id_visita")):
        tables[name] = tables[name].withColumn(number, F.monotonically_increasing_id())
    late = {
        "departamentos": F.col("id_departamento") >= 20,
        "ordenes_mantenimiento": F.col("fecha_inicio_trabajo") >= F.lit("2000-01-01").cast("timestamp"),
        "monitorizaciones": F.col("fecha_monitorizacion") >= F.lit("2024-01-10").cast("date"),
    }
    schemas = {}

    def land(name, rows, when):
        rows = rows.withColumns({"fecha_modificacion": F.lit(when).cast("timestamp"), "_dlt_load_id": F.lit("carga")})
        rows.write.mode("append").parquet(f"{root}/landing/{name}")
        schemas[name] = rows.schema

    early = {n: rows.filter(~F.coalesce(late[n], F.lit(False))) if n in late else rows for n, rows in tables.items()}
    with ThreadPoolExecutor(8) as pool:  # each table has a folder of its own
        list(pool.map(lambda name: land(name, early[name], "2024-01-01"), early))
    store = Warehouse(spark, f"{root}/dw", schemas, buckets=4, calendar_days=(date(1995, 1, 1), date(2030, 12, 31)), retry=True)
    store.refresh(f"{root}/landing", BEFORE)
    waited = materialize(store.waiting("fact_mantenimiento_equipos"), "waited")
    for name, picked in late.items():
        land(name, tables[name].filter(picked), "2024-02-01")
    store.refresh(f"{root}/landing", AS_OF)
    facts = {name: store.fact(name) for name in FACTS}  # these loads: later ones have files of their own
    store.load_object("fact_ensayos_clinicos", AS_OF)
    _STORED[slot] = facts, waited, store.fact("fact_ensayos_clinicos")
    return _STORED[slot]


@query
def dw_refresh_two_rounds(spark, sf_dir):
    """All facts after two refreshes; of the trials the days up to the first."""
    facts, _, _ = _two_rounds(spark, sf_dir)
    parts = [
        facts[name].select(F.lit(name).alias("hecho"), F.col(key).alias("id"), "sk_fecha", F.col(measure).cast("double").alias("medida"))
        for name, key, measure in (
            ("fact_mantenimiento_equipos", "id_orden", "costo_total"),
            ("fact_monitorizacion_pacientes", "id_sesion", "presion_sistolica"),
            ("fact_ensayos_clinicos", "id_participacion", "dosis_administrada"),
        )
    ]
    parts[2] = parts[2].filter(F.col("sk_fecha") <= fx.date_key(F.lit(BEFORE)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def fact_late_dimension(spark, sf_dir):
    """Orders that waited for their department, and have arrived with it."""
    facts, waited, _ = _two_rounds(spark, sf_dir)
    fact = facts["fact_mantenimiento_equipos"].select("id_orden", "costo_total", "indicador_reincidencia")
    return waited.select("id_orden", "id_equipo").join(fact, "id_orden")


@query
def dw_load_object(spark, sf_dir):
    """The trials loaded as a whole: open participations reach the day of the load."""
    return _two_rounds(spark, sf_dir)[2].drop("sk_ensayo_clinico", "sk_departamento")


assert set(FACT_VIEWS) == set(FACT_INPUTS) == set(FACTS) and set(ROLES) >= set(FACTS.values())
