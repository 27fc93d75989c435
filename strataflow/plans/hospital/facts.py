"""The three fact tables.

Lookups of one business key are first joined with each other, so a fact row
meets one lookup per key instead of one per dimension. Sizes decide how Spark
runs those joins; only the profile dimensions, of fixed size, carry a hint.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from strataflow.functions.columns import date_key, decode, hours_between, minutes_between
from strataflow.operators.asof import as_of_lookup
from strataflow.operators.changes import rows_with_keys
from strataflow.operators.dimensions import key_date
from strataflow.operators.facts import (
    averages,
    daily_rows,
    day_runs,
    insert_only,
    joined_runs,
    outside_ranges,
    recurrence_flag,
)
from strataflow.operators.scd import VALID_FROM, VALID_TO, current_rows
from strataflow.session import materialize

# Fixed value: days after which the source system stops expanding a participation.
PARITY_DAYS = 3650

Tables = Mapping[str, DataFrame]

# Codes of the sources and the texts the profiles hold.
MAINTENANCE_TYPE = {"PREV": "Preventivo", "CORR": "Correctivo", "CAL": "Calibracion", "INSP": "Inspeccion"}
MAINTENANCE_TYPE_ADMITTED = {**MAINTENANCE_TYPE, "CALIB": "Calibracion"}
PRIORITY = {1: "Baja", 2: "Media", 3: "Alta", 4: "Critica"}
SEVERITY = {1: "Leve", 2: "Moderada", 3: "Grave"}
PHASE = {"F1": "Fase I", "F2": "Fase II", "F3": "Fase III", "F4": "Fase IV"}
BLINDING = {"AB": "Abierto", "SC": "Simple Ciego", "DC": "Doble Ciego"}
RANDOMISATION = {"AL": "Aleatorizado", "NA": "No Aleatorizado"}
ARM = {"EXP": "Experimental", "CTR": "Control", "PLA": "Placebo"}
ROUTE = {"ORL": "Oral", "IV": "Intravenosa", "SC": "Subcutanea", "TOP": "Topica", "INH": "Inhalatoria"}

# Clinical ranges outside which a session raises an alert.
ALERT_RANGES = {
    "frecuencia_cardiaca": (60, 100),
    "presion_sistolica": (90, 140),
    "presion_diastolica": (60, 90),
    "temperatura": (36.0, 37.5),
    "saturacion_oxigeno": (95, None),
    "nivel_glucosa": (70, 140),
}

# The code of a corrective order, and the text the source system
# compared with instead (it never matches, so the flag was always false).
CORRECTIVE, CORRECTIVE_PARITY = "CORR", "Correctivo"

FACTS = {
    "fact_mantenimiento_equipos": "ordenes_mantenimiento",
    "fact_monitorizacion_pacientes": "monitorizaciones",
    "fact_ensayos_clinicos": "participacion_ensayos",
}
FACT_KEYS = {
    "fact_mantenimiento_equipos": ("id_orden",),
    "fact_monitorizacion_pacientes": ("id_sesion",),
    "fact_ensayos_clinicos": ("id_participacion", "sk_fecha"),
}
FACT_SK = {
    "fact_mantenimiento_equipos": "sk_mantenimiento",
    "fact_monitorizacion_pacientes": "sk_monitorizacion",
    "fact_ensayos_clinicos": "sk_ensayo_clinico",
}


def _keys(dim: DataFrame, key: str, sk: str) -> DataFrame:
    return dim.select(key, sk)


def _profiled(rows: DataFrame, profile: DataFrame, codes: Mapping) -> DataFrame:
    """Decode the codes and replace them by the key of their combination."""
    named = rows.withColumns({f"_p_{c}": value for c, value in codes.items()})
    lookup = profile.withColumnsRenamed({c: f"_p_{c}" for c in codes})
    on = [f"_p_{c}" for c in codes]
    return named.join(F.broadcast(lookup), on).drop(*on)


def part_costs(consumption: DataFrame) -> DataFrame:
    return consumption.groupBy("id_orden").agg(
        F.sum(F.col("cantidad") * F.col("precio_unitario_en_momento")).alias("costo_repuestos"),
        F.sum("cantidad").cast("long").alias("numero_piezas_reemplazadas"),
    )


def maintenance_fact(
    orders: DataFrame,
    tables: Tables,
    dims: Tables,
    fact: DataFrame | None = None,
    parity: bool = False,
    by_date: bool = False,
) -> DataFrame:
    """One row per work order. Only orders the fact does not hold are loaded.

    Orders take the versions of equipment and technician that are current at
    load time, or with ``by_date`` those valid on the day the work started.
    """
    orders = insert_only(orders, fact, ["id_orden"])
    consumption, history = tables["consumo_repuestos"], tables["ordenes_mantenimiento"]
    if fact is not None:
        consumption = rows_with_keys(consumption, orders, ["id_orden"])
        history = rows_with_keys(history, orders, ["id_equipo"])

    # stored, as are the technicians: the order side of the joins below may then be
    # split at a hot piece of equipment or technician
    equipment = materialize(
        tables["equipos"]
        .select("id_equipo", "id_departamento", "id_ubicacion", "id_fabricante")
        .join(_keys(current_rows(dims["dim_equipo"]), "id_equipo", "sk_equipo"), "id_equipo")
        .join(_keys(dims["dim_departamento"], "id_departamento", "sk_departamento"), "id_departamento")
        .join(_keys(dims["dim_ubicacion"], "id_ubicacion", "sk_ubicacion"), "id_ubicacion")
        .join(_keys(dims["dim_fabricante"], "id_fabricante", "sk_fabricante"), "id_fabricante")
        .drop("id_departamento", "id_ubicacion", "id_fabricante"),
        "equipment",
    )
    technicians = materialize(
        tables["tecnicos"]
        .select("id_tecnico", "tarifa_hora")
        .join(_keys(current_rows(dims["dim_tecnico"]), "id_tecnico", "sk_tecnico"), "id_tecnico"),
        "technicians",
    )
    # first, as the profile is narrower than its codes, and orders that find no equipment are lost
    types = MAINTENANCE_TYPE if parity else MAINTENANCE_TYPE_ADMITTED
    profiled = _profiled(
        orders,
        dims["dim_perfil_mantenimiento"],
        {
            "tipo_mantenimiento": decode(F.col("tipo_mantenimiento"), types),
            "prioridad": decode(F.col("prioridad"), PRIORITY),
            "gravedad": decode(F.col("gravedad"), SEVERITY),
            "es_garantia": F.col("es_cubierto_por_garantia"),
            "requiere_parada_equipo": F.col("requiere_parada"),
        },
    )
    corrective = CORRECTIVE_PARITY if parity else CORRECTIVE
    flagged = recurrence_flag(
        profiled.join(equipment, "id_equipo"), history, "id_equipo", "fecha_inicio_trabajo",
        F.col("tipo_mantenimiento") == corrective, "indicador_reincidencia",
    )
    named = flagged.join(technicians, "id_tecnico")
    if by_date:
        named = named.drop("sk_equipo", "sk_tecnico").withColumn("_day", F.to_date("fecha_inicio_trabajo"))
        for dim, key, sk in (("dim_equipo", "id_equipo", "sk_equipo"), ("dim_tecnico", "id_tecnico", "sk_tecnico")):
            named = as_of_lookup(named, dims[dim], key, "_day", VALID_FROM, [sk], VALID_TO, tie=sk, inner=True)
    labour = F.col("horas_trabajadas") * F.col("tarifa_hora")
    return named.join(part_costs(consumption), "id_orden", "left").select(
        date_key(F.col("fecha_inicio_trabajo")).alias("sk_fecha"),
        "sk_equipo", "sk_tecnico", "sk_departamento", "sk_ubicacion", "sk_fabricante",
        "sk_perfil_mantenimiento", "id_orden",
        F.col("horas_trabajadas").cast("decimal(8,2)").alias("horas_trabajadas"),
        F.col("tarifa_hora").cast("decimal(10,2)").alias("tarifa_hora"),
        F.col("costo_repuestos").cast("decimal(12,2)").alias("costo_repuestos"),
        labour.cast("decimal(12,2)").alias("costo_mano_obra"),
        (F.coalesce("costo_repuestos", F.lit(0)) + labour).cast("decimal(12,2)").alias("costo_total"),
        hours_between(F.col("fecha_inicio_trabajo"), F.col("fecha_fin_trabajo"))
        .cast("decimal(8,2)").alias("duracion_horas"),
        "numero_piezas_reemplazadas",
        "indicador_reincidencia",
    )


def monitoring_fact(
    sessions: DataFrame, tables: Tables, dims: Tables, fact: DataFrame | None = None
) -> DataFrame:
    """One row per monitoring session that has readings."""
    sessions = sessions.withColumnRenamed("id_monitorizacion", "id_sesion")
    sessions = insert_only(sessions, fact, ["id_sesion"])
    readings = tables["lecturas_signos_vitales"].withColumnRenamed("id_monitorizacion", "id_sesion")
    if fact is not None:
        readings = rows_with_keys(readings, sessions, ["id_sesion"])

    equipment = (
        tables["equipos"].select("codigo_equipo", "id_equipo")
        .join(_keys(current_rows(dims["dim_equipo"]), "id_equipo", "sk_equipo"), "id_equipo")
        .drop("id_equipo")
    )
    departments = (
        tables["departamentos"].select("codigo_departamento", "id_departamento")
        .join(_keys(dims["dim_departamento"], "id_departamento", "sk_departamento"), "id_departamento")
        .drop("id_departamento")
    )
    places = (
        tables["ubicaciones"].select("codigo_ubicacion", "id_ubicacion")
        .join(_keys(dims["dim_ubicacion"], "id_ubicacion", "sk_ubicacion"), "id_ubicacion")
        .drop("id_ubicacion")
    )
    return (
        sessions
        .join(averages(readings, "id_sesion", list(ALERT_RANGES)), "id_sesion")
        .join(equipment, "codigo_equipo")
        .join(departments, "codigo_departamento")
        .join(places, "codigo_ubicacion")
        .join(_keys(current_rows(dims["dim_paciente"]), "id_paciente", "sk_paciente"), "id_paciente")
        .join(_keys(current_rows(dims["dim_medico"]), "id_medico", "sk_medico"), "id_medico")
        .join(_keys(dims["dim_diagnostico"], "id_diagnostico", "sk_diagnostico"), "id_diagnostico")
        .select(
            date_key(F.col("fecha_monitorizacion")).alias("sk_fecha"),
            "sk_paciente", "sk_medico", "sk_equipo", "sk_departamento", "sk_ubicacion",
            "sk_diagnostico", "id_sesion",
            minutes_between(F.col("hora_inicio"), F.col("hora_fin")).alias("duracion_monitorizacion_min"),
            F.col("frecuencia_cardiaca").cast("decimal(6,2)").alias("frecuencia_cardiaca"),
            F.col("presion_sistolica").cast("decimal(6,2)").alias("presion_sistolica"),
            F.col("presion_diastolica").cast("decimal(6,2)").alias("presion_diastolica"),
            F.col("temperatura").cast("decimal(5,2)").alias("temperatura"),
            F.col("saturacion_oxigeno").cast("decimal(5,2)").alias("saturacion_oxigeno"),
            F.col("nivel_glucosa").cast("decimal(8,2)").alias("nivel_glucosa"),
            outside_ranges(ALERT_RANGES).alias("alerta_generada"),
        )
    )


def trial_fact(
    participations: DataFrame,
    tables: Tables,
    dims: Tables,
    as_of: date,
    loaded: DataFrame | None = None,
    parity: bool = False,
) -> DataFrame:
    """One row per participation and day, up to ``as_of`` while it is open.

    ``loaded`` are the days that the fact has already, as ``trial_coverage``
    gives them: the fact itself is not read. With ``parity`` no participation
    goes past the source system's day limit.
    """
    # stored, so that the participations may be split at a hot trial
    trials = materialize(
        tables["ensayos_clinicos"].select("id_ensayo", "codigo_departamento")
        .join(_keys(dims["dim_ensayo"], "id_ensayo", "sk_ensayo"), "id_ensayo")
        .join(tables["departamentos"].select("codigo_departamento", "id_departamento"), "codigo_departamento")
        .join(_keys(dims["dim_departamento"], "id_departamento", "sk_departamento"), "id_departamento")
        .select("id_ensayo", "sk_ensayo", "sk_departamento"),
        "trials",
    )
    rows = (
        participations.join(trials, "id_ensayo")
        .join(_keys(current_rows(dims["dim_paciente"]), "id_paciente", "sk_paciente"), "id_paciente")
        .join(
            _keys(current_rows(dims["dim_medico"]), "id_medico", "sk_medico"),
            F.col("id_medico_asignado") == F.col("id_medico"),
        )
        .join(_keys(dims["dim_diagnostico"], "id_diagnostico", "sk_diagnostico"), "id_diagnostico")
    )
    intervals = _profiled(rows, dims["dim_perfil_ensayo"], {
        "fase_ensayo": decode(F.col("fase"), PHASE),
        "tipo_ciego": decode(F.col("tipo_ciego"), BLINDING),
        "tipo_aleatorizacion": decode(F.col("tipo_aleatorizacion"), RANDOMISATION),
        "grupo_tratamiento": decode(F.col("grupo_asignado"), ARM),
        "via_administracion": decode(F.col("via_administracion"), ROUTE),
    }).select(
        "id_participacion", "fecha_inicio_participacion", "fecha_fin_participacion",
        "sk_ensayo", "sk_paciente", "sk_medico", "sk_diagnostico", "sk_departamento", "sk_perfil_ensayo",
    )
    intervals = materialize(intervals, "participations")  # one narrow row each, read again below
    visits = tables["visitas_ensayo"].select(
        "id_participacion", "fecha_visita", "dosis_administrada", "unidad_dosis",
        "numero_efectos_adversos", "resultado_medicion_principal", "resultado_medicion_secundaria",
        "nivel_eficacia",
    )
    daily = daily_rows(
        intervals, visits, "id_participacion", "fecha_inicio_participacion",
        "fecha_fin_participacion", "fecha_visita", "fecha", as_of, loaded, PARITY_DAYS if parity else None,
    )
    return daily.select(
        date_key(F.col("fecha")).alias("sk_fecha"),
        date_key(F.col("fecha_inicio_participacion")).alias("sk_fecha_inicio"),
        date_key(F.col("fecha_fin_participacion")).alias("sk_fecha_fin"),
        "sk_ensayo", "sk_paciente", "sk_medico", "sk_diagnostico", "sk_departamento",
        "sk_perfil_ensayo", "id_participacion",
        F.col("dosis_administrada").cast("decimal(10,4)").alias("dosis_administrada"),
        "unidad_dosis",
        F.col("numero_efectos_adversos").cast("long").alias("numero_efectos_adversos"),
        F.col("resultado_medicion_principal").cast("decimal(8,4)").alias("resultado_medicion_principal"),
        F.col("resultado_medicion_secundaria").cast("decimal(8,4)").alias("resultado_medicion_secundaria"),
        F.col("nivel_eficacia").cast("decimal(5,4)").alias("nivel_eficacia"),
    )


def trial_coverage(fact: DataFrame) -> DataFrame:
    """(id_participacion, tramos): the days that rows of the trial fact cover."""
    days = fact.select("id_participacion", key_date("sk_fecha").alias("fecha"))
    return joined_runs(day_runs(days, "id_participacion", "fecha"), "id_participacion")


def load_fact(
    name: str,
    batch: DataFrame,
    tables: Tables,
    dims: Tables,
    as_of: date,
    held: DataFrame | None = None,
    parity: bool = False,
    by_date: bool = False,
) -> DataFrame:
    """New rows of a fact for the batch of its main table.

    ``held`` is what was loaded before: the fact, or its days (``trial_coverage``)
    for the trials. With ``by_date`` maintenance orders take the versions of
    equipment and technician that were valid on the day of the work.
    """
    if name == "fact_mantenimiento_equipos":
        return maintenance_fact(batch, tables, dims, held, parity, by_date)
    if name == "fact_monitorizacion_pacientes":
        return monitoring_fact(batch, tables, dims, held)
    if name == "fact_ensayos_clinicos":
        return trial_fact(batch, tables, dims, as_of, held, parity)
    raise ValueError(f"unknown fact {name!r}")


def numbered(rows: DataFrame, name: str, last: int = 0) -> DataFrame:
    """Give new fact rows a row key: unique and above ``last``.

    Nothing refers to these keys, so gaps are allowed and no shuffle is spent.
    """
    return rows.select(
        (F.monotonically_increasing_id() + F.lit(last + 1)).alias(FACT_SK[name]), *rows.columns
    )


def lookups(name: str, tables: Tables, dims: Tables) -> list[tuple[str, DataFrame, str, str, list[str]]]:
    """What a main row must find to become a fact row, in order.

    Each lookup has a name, the rows it is looked up in, their key, the column
    of the main row (or of an earlier lookup) that holds it, and columns that
    later lookups start from.
    """

    def dim(dimension: str, key: str, column: str | None = None):
        rows = dims[dimension]
        return dimension, current_rows(rows) if "es_actual" in rows.columns else rows, key, column or key, []

    def table(source: str, key: str, column: str, *carried: str):
        return source, tables[source], key, column, list(carried)

    if name == "fact_mantenimiento_equipos":
        return [
            table("equipos", "id_equipo", "id_equipo", "id_departamento", "id_ubicacion", "id_fabricante"),
            table("tecnicos", "id_tecnico", "id_tecnico"),
            dim("dim_equipo", "id_equipo"), dim("dim_tecnico", "id_tecnico"),
            dim("dim_departamento", "id_departamento"), dim("dim_ubicacion", "id_ubicacion"),
            dim("dim_fabricante", "id_fabricante"),
        ]
    if name == "fact_monitorizacion_pacientes":
        return [
            table("lecturas_signos_vitales", "id_monitorizacion", "id_monitorizacion"),
            table("equipos", "codigo_equipo", "codigo_equipo", "id_equipo"),
            table("departamentos", "codigo_departamento", "codigo_departamento", "id_departamento"),
            table("ubicaciones", "codigo_ubicacion", "codigo_ubicacion", "id_ubicacion"),
            dim("dim_equipo", "id_equipo"), dim("dim_departamento", "id_departamento"),
            dim("dim_ubicacion", "id_ubicacion"), dim("dim_paciente", "id_paciente"),
            dim("dim_medico", "id_medico"), dim("dim_diagnostico", "id_diagnostico"),
        ]
    return [
        table("ensayos_clinicos", "id_ensayo", "id_ensayo", "codigo_departamento"),
        table("departamentos", "codigo_departamento", "codigo_departamento", "id_departamento"),
        dim("dim_ensayo", "id_ensayo"), dim("dim_departamento", "id_departamento"), dim("dim_paciente", "id_paciente"),
        dim("dim_medico", "id_medico", "id_medico_asignado"), dim("dim_diagnostico", "id_diagnostico"),
    ]


def with_missing(rows: DataFrame, name: str, tables: Tables, dims: Tables) -> DataFrame:
    """``rows`` with ``falta``: what each one looks up and does not find, as ``lookup=key``.

    Nothing is named where the key itself is NULL, since no later row could
    mend that: such a row is lost, like one whose codes are unknown.
    """
    found, names = rows, []
    for n, (lookup, known, key, column, carried) in enumerate(lookups(name, tables, dims)):
        fresh = [c for c in carried if c not in rows.columns]
        known = known.filter(F.col(key).isNotNull()).dropDuplicates([key]).select(
            F.col(key).alias(f"_k{n}"), *(F.col(c).alias(f"_c_{c}") for c in fresh)
        )
        held = column if column in rows.columns else f"_c_{column}"
        found = found.join(known, F.col(held) == F.col(f"_k{n}"), "left")
        gone = F.col(held).isNotNull() & F.col(f"_k{n}").isNull()
        names.append(F.when(gone, F.concat(F.lit(f"{lookup}="), F.col(held).cast("string"))))
    missing = F.filter(F.array(*names), lambda x: x.isNotNull())
    return found.select(*rows.columns, missing.alias("falta"))


def found_keys(name: str, tables: Tables, dims: Tables) -> DataFrame:
    """All that ``with_missing`` could name and that is there, as ``lookup=key``."""
    parts = [
        known.filter(F.col(key).isNotNull()).select(F.concat(F.lit(f"{lookup}="), F.col(key).cast("string")).alias("falta"))
        for lookup, known, key, _, _ in lookups(name, tables, dims)
    ]
    return reduce(DataFrame.unionByName, parts)
