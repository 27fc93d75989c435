"""Serving views: three wide facts and the dimensions in their current state.

What a fact row gains from a dimension is not shuffled again if it can be
helped: large dimensions come first, the widest last of them, and small ones
and the calendar, which Spark broadcasts, after them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from strataflow.operators.dimensions import key_date, with_day
from strataflow.operators.scd import current_rows
from strataflow.plans.hospital.dimensions import ALL_DIMENSIONS, CURRENT_ONLY

Tables = Mapping[str, DataFrame]

DAYS_PER_TASK = 500_000  # rows of a day-grain fact that one task joins

def _pick(dim: DataFrame, key: str, columns: Sequence[str], **renamed: str) -> DataFrame:
    return dim.select(key, *columns, *(F.col(c).alias(alias) for alias, c in renamed.items()))


def _placed(wide: DataFrame, *parts: Sequence[str]) -> DataFrame:
    """The columns of the parts, in order, without keys."""
    return wide.select(*(c for part in parts for c in part if not c.startswith("sk_")))


def _versions(dim: DataFrame, all_versions: bool) -> DataFrame:
    """Facts of closed versions are left out of a view unless asked for."""
    return dim if all_versions else current_rows(dim)


def maintenance_view(fact: DataFrame, dims: Tables, all_versions: bool = False) -> DataFrame:
    day = ("fecha", "anio", "semestre", "trimestre", "mes", "nombre_mes", "semana_anio", "dia",
           "nombre_dia", "es_fin_semana")
    equipment = _pick(_versions(dims["dim_equipo"], all_versions), "sk_equipo", (
        "nombre_equipo", "numero_serie", "modelo", "clase_riesgo", "estado_equipo",
        "fecha_adquisicion", "fecha_fin_garantia"),
        departamento_equipo="departamento_actual", ubicacion_equipo="ubicacion_actual")
    technician = _pick(_versions(dims["dim_tecnico"], all_versions), "sk_tecnico", (
        "nivel_certificacion", "anios_experiencia"),
        nombre_tecnico="nombre", apellidos_tecnico="apellidos", especialidad_tecnico="especialidad")
    department = _pick(dims["dim_departamento"], "sk_departamento", ("nombre_departamento",),
                       nivel_jerarquia_departamento="nivel_jerarquia")
    place = _pick(dims["dim_ubicacion"], "sk_ubicacion", ("edificio", "planta", "ala", "sala", "tipo_sala"))
    maker = _pick(dims["dim_fabricante"], "sk_fabricante", (
        "nombre_fabricante", "pais_origen", "certificacion_iso"))
    profile = _pick(dims["dim_perfil_mantenimiento"], "sk_perfil_mantenimiento", (
        "tipo_mantenimiento", "prioridad", "gravedad", "es_garantia", "requiere_parada_equipo"))
    wide = (
        fact.join(equipment, "sk_equipo")
        .join(technician, "sk_tecnico")
        .join(maker, "sk_fabricante")
        .join(department, "sk_departamento")
        .join(place, "sk_ubicacion")
        .join(F.broadcast(profile), "sk_perfil_mantenimiento")
    )
    wide = with_day(wide, dims["dim_fecha"], "sk_fecha", **{c: c for c in day})
    return _placed(
        wide, fact.columns, day, *(x.columns for x in (equipment, technician, department, place, maker, profile))
    )


def monitoring_view(fact: DataFrame, dims: Tables, all_versions: bool = False) -> DataFrame:
    day = ("fecha", "anio", "trimestre", "mes", "nombre_mes", "nombre_dia", "es_fin_semana")
    patient = _pick(_versions(dims["dim_paciente"], all_versions), "sk_paciente", (
        "fecha_nacimiento", "genero", "grupo_sanguineo", "seguro_medico", "tipo_seguro"),
        nombre_paciente="nombre", apellidos_paciente="apellidos", ciudad_paciente="ciudad")
    physician = _pick(_versions(dims["dim_medico"], all_versions), "sk_medico", ("numero_colegiado",),
                      nombre_medico="nombre", apellidos_medico="apellidos", especialidad_medico="especialidad")
    equipment = _pick(_versions(dims["dim_equipo"], all_versions), "sk_equipo", (
        "nombre_equipo", "clase_riesgo", "estado_equipo"))
    department = _pick(dims["dim_departamento"], "sk_departamento", ("nombre_departamento",))
    place = _pick(dims["dim_ubicacion"], "sk_ubicacion", ("edificio", "sala", "tipo_sala"))
    diagnosis = _pick(dims["dim_diagnostico"], "sk_diagnostico", (
        "codigo_cie10", "descripcion_diagnostico", "es_cronico"),
        categoria_diagnostico="categoria", subcategoria_diagnostico="subcategoria")
    wide = (
        fact.join(equipment, "sk_equipo")
        .join(diagnosis, "sk_diagnostico")
        .join(patient, "sk_paciente")
        .join(physician, "sk_medico")
        .join(department, "sk_departamento")
        .join(place, "sk_ubicacion")
    )
    wide = with_day(wide, dims["dim_fecha"], "sk_fecha", **{c: c for c in day})
    return _placed(
        wide, fact.columns, day, *(x.columns for x in (patient, physician, equipment, department, place, diagnosis))
    )


def trial_view(fact: DataFrame, dims: Tables, all_versions: bool = False) -> DataFrame:
    """Lookups are made once for each combination of keys, as the days of a
    participation share theirs; the days themselves are joined once, in tasks of
    about ``DAYS_PER_TASK``. ``fact`` is counted and read twice: store it.
    """
    days = dims["dim_fecha"]
    last = days.select(F.col("sk_fecha").alias("sk_fecha_fin"),
                       F.col("fecha").alias("fecha_fin_participacion"))
    trial = _pick(dims["dim_ensayo"], "sk_ensayo", (
        "codigo_ensayo", "nombre_ensayo", "patrocinador", "estado_ensayo", "molecula_farmaco",
        "objetivo_principal", "fecha_inicio_ensayo", "fecha_fin_prevista"))
    patient = _pick(_versions(dims["dim_paciente"], all_versions), "sk_paciente", (
        "genero", "fecha_nacimiento", "grupo_sanguineo"),
        nombre_paciente="nombre", apellidos_paciente="apellidos")
    physician = _pick(_versions(dims["dim_medico"], all_versions), "sk_medico", (),
                      nombre_medico="nombre", apellidos_medico="apellidos", especialidad_medico="especialidad")
    diagnosis = _pick(dims["dim_diagnostico"], "sk_diagnostico", (
        "codigo_cie10", "descripcion_diagnostico", "es_cronico"), categoria_diagnostico="categoria")
    department = _pick(dims["dim_departamento"], "sk_departamento", ("nombre_departamento",))
    profile = _pick(dims["dim_perfil_ensayo"], "sk_perfil_ensayo", (
        "fase_ensayo", "tipo_ciego", "tipo_aleatorizacion", "grupo_tratamiento", "via_administracion"))
    lookups = {
        "sk_diagnostico": diagnosis, "sk_paciente": patient, "sk_ensayo": trial, "sk_medico": physician,
        "sk_departamento": department,
    }
    found = fact.select(*lookups).dropna().distinct()
    for key, lookup in lookups.items():
        found = found.join(lookup, key)
    days_held = fact.count()
    if days_held > DAYS_PER_TASK:
        least = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(least, days_held // DAYS_PER_TASK)
        named = fact.repartition(tasks, *lookups).join(found, list(lookups))
    else:
        named = fact.join(found, list(lookups))
    wide = named.join(F.broadcast(profile), "sk_perfil_ensayo")
    visited = {
        "fecha_visita": "fecha", "anio_visita": "anio", "trimestre_visita": "trimestre", "mes_visita": "mes",
        "nombre_mes_visita": "nombre_mes",
    }
    wide = with_day(wide, days, "sk_fecha", **visited)
    wide = with_day(wide, days, "sk_fecha_inicio", fecha_inicio_participacion="fecha")
    wide = wide.join(F.broadcast(last), "sk_fecha_fin", "left").withColumn(
        "fecha_fin_participacion", F.coalesce("fecha_fin_participacion", key_date("sk_fecha_fin"))
    )
    return _placed(
        wide, fact.columns, visited, ["fecha_inicio_participacion", "fecha_fin_participacion"],
        *(x.columns for x in (trial, patient, physician, diagnosis, department, profile)),
    )


FACT_VIEWS = {
    "fact_mantenimiento_equipos": maintenance_view,
    "fact_monitorizacion_pacientes": monitoring_view,
    "fact_ensayos_clinicos": trial_view,
}


def serving_views(facts: Tables, dims: Tables, all_versions: bool = False) -> dict[str, DataFrame]:
    """The fifteen views by name."""
    views = {name: view(facts[name], dims, all_versions) for name, view in FACT_VIEWS.items()}
    for name in ALL_DIMENSIONS:
        views[name] = current_rows(dims[name]) if name in CURRENT_ONLY else dims[name]
    return views
