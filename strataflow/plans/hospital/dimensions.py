"""The twelve dimensions: attributes of each and how they are derived."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.functions.columns import decode, person_name, strip_prefix
from strataflow.operators.dimensions import calendar, junk_dimension
from strataflow.operators.hierarchy import hierarchy_levels, with_parent_key
from strataflow.operators.scd import scd1_merge, scd2_merge

Tables = Mapping[str, DataFrame]

# Texts that codes stand for.
CERTIFICATION = {1: "Junior", 2: "Senior", 3: "Especialista", 4: "Jefe"}
EQUIPMENT_STATE = {1: "Activo", 2: "En Reparacion", 3: "Fuera de Servicio", 4: "Baja"}
NO_SPECIALTY = "Sin especialidad"

# The codes each profile dimension combines.
MAINTENANCE_PROFILE = {
    "tipo_mantenimiento": ("Preventivo", "Correctivo", "Calibracion", "Inspeccion"),
    "prioridad": ("Baja", "Media", "Alta", "Critica"),
    "gravedad": ("Leve", "Moderada", "Grave"),
    "es_garantia": (True, False),
    "requiere_parada_equipo": (True, False),
}
TRIAL_PROFILE = {
    "fase_ensayo": ("Fase I", "Fase II", "Fase III", "Fase IV"),
    "tipo_ciego": ("Abierto", "Simple Ciego", "Doble Ciego"),
    "tipo_aleatorizacion": ("Aleatorizado", "No Aleatorizado"),
    "grupo_tratamiento": ("Experimental", "Control", "Placebo"),
    "via_administracion": ("Oral", "Intravenosa", "Subcutanea", "Topica", "Inhalatoria"),
}


@dataclass(frozen=True)
class DimSpec:
    """A dimension loaded from ``main``; ``attributes`` derives its columns."""

    main: str
    key: str
    sk: str
    attributes: Callable[[Tables], DataFrame]
    overwrite: tuple[str, ...]
    versioned: tuple[str, ...] = ()


def _department_names(tables: Tables, on: str) -> DataFrame:
    return tables["departamentos"].select(on, F.col("nombre_departamento").alias("_departamento"))


def _location(t: Tables) -> DataFrame:
    return t["ubicaciones"]


def _manufacturer(t: Tables) -> DataFrame:
    return t["fabricantes"].withColumnRenamed("razon_social", "nombre_fabricante")


def _physician(t: Tables) -> DataFrame:
    specialties = t["especialidades"].select("id_especialidad", "nombre_especialidad")
    return (
        t["medicos"]
        .join(specialties, "id_especialidad", "left")
        .join(_department_names(t, "codigo_departamento"), "codigo_departamento", "left")
        .withColumns({
            "apellidos": F.concat("apellido1", F.lit(" "), "apellido2"),
            "especialidad": F.coalesce("nombre_especialidad", F.lit(NO_SPECIALTY)),
            "departamento": F.col("_departamento"),
        })
    )


def _technician(t: Tables) -> DataFrame:
    given, surnames = person_name(F.col("nombre_tecnico"))
    return (
        t["tecnicos"]
        .join(_department_names(t, "id_departamento"), "id_departamento", "left")
        .withColumns({
            "nombre": given,
            "apellidos": surnames,
            "telefono": F.col("telefono_movil"),
            "email": F.col("email_corporativo"),
            "departamento": F.col("_departamento"),
            "nivel_certificacion": decode(F.col("nivel_certificacion"), CERTIFICATION),
        })
    )


def _patient(t: Tables) -> DataFrame:
    return t["pacientes"].withColumns({
        "apellidos": F.concat("apellido1", F.lit(" "), "apellido2"),
        "genero": F.col("sexo"),
        "telefono": F.col("telefono_movil"),
        "seguro_medico": F.col("compania_seguro"),
        "tipo_seguro": F.col("tipo_cobertura"),
    })


def _equipment(t: Tables) -> DataFrame:
    places = t["ubicaciones"].select(
        "id_ubicacion", F.concat("edificio", F.lit(" - "), "sala").alias("ubicacion_actual")
    )
    return (
        t["equipos"]
        .join(_department_names(t, "id_departamento"), "id_departamento", "left")
        .join(places, "id_ubicacion", "left")
        .withColumns({
            "descripcion": strip_prefix(F.col("descripcion"), F.col("nombre_equipo")),
            "estado_equipo": decode(F.col("estado_codigo"), EQUIPMENT_STATE),
            "departamento_actual": F.col("_departamento"),
        })
    )


def _trial(t: Tables) -> DataFrame:
    return t["ensayos_clinicos"].withColumnsRenamed({
        "titulo_ensayo": "nombre_ensayo",
        "descripcion_ensayo": "descripcion",
        "fecha_inicio": "fecha_inicio_ensayo",
    })


def _diagnosis(t: Tables) -> DataFrame:
    return t["diagnosticos_cie10"].withColumnsRenamed({
        "descripcion": "descripcion_diagnostico",
        "capitulo": "categoria",
        "grupo": "subcategoria",
    })


def _department(t: Tables) -> DataFrame:
    rows = t["departamentos"].withColumnRenamed("nombre_responsable", "responsable")
    levels = hierarchy_levels(rows, "id_departamento", "id_departamento_padre", "nivel_jerarquia")
    return rows.join(levels, "id_departamento")


DIMENSIONS = {
    "dim_departamento": DimSpec(
        "departamentos", "id_departamento", "sk_departamento", _department,
        ("nombre_departamento", "id_departamento_padre", "nivel_jerarquia", "responsable",
         "telefono_departamento", "email_departamento"),
    ),
    "dim_ubicacion": DimSpec(
        "ubicaciones", "id_ubicacion", "sk_ubicacion", _location,
        ("edificio", "planta", "ala", "sala", "tipo_sala", "capacidad"),
    ),
    "dim_fabricante": DimSpec(
        "fabricantes", "id_fabricante", "sk_fabricante", _manufacturer,
        ("nombre_fabricante", "pais_origen", "telefono_contacto", "email_contacto", "sitio_web",
         "certificacion_iso"),
    ),
    "dim_medico": DimSpec(
        "medicos", "id_medico", "sk_medico", _physician,
        ("nombre", "apellidos", "numero_colegiado", "telefono", "email"),
        ("especialidad", "departamento"),
    ),
    "dim_tecnico": DimSpec(
        "tecnicos", "id_tecnico", "sk_tecnico", _technician,
        ("nombre", "apellidos", "especialidad", "anios_experiencia", "telefono", "email"),
        ("departamento", "nivel_certificacion"),
    ),
    "dim_paciente": DimSpec(
        "pacientes", "id_paciente", "sk_paciente", _patient,
        ("nombre", "apellidos", "fecha_nacimiento", "genero", "telefono", "email", "grupo_sanguineo"),
        ("direccion", "ciudad", "codigo_postal", "seguro_medico", "tipo_seguro"),
    ),
    "dim_equipo": DimSpec(
        "equipos", "id_equipo", "sk_equipo", _equipment,
        ("nombre_equipo", "descripcion", "numero_serie", "modelo", "fecha_adquisicion",
         "fecha_fin_garantia", "clase_riesgo"),
        ("estado_equipo", "departamento_actual", "ubicacion_actual"),
    ),
    "dim_ensayo": DimSpec(
        "ensayos_clinicos", "id_ensayo", "sk_ensayo", _trial,
        ("codigo_ensayo", "nombre_ensayo", "descripcion", "patrocinador", "fecha_inicio_ensayo",
         "fecha_fin_prevista", "estado_ensayo", "objetivo_principal", "molecula_farmaco"),
    ),
    "dim_diagnostico": DimSpec(
        "diagnosticos_cie10", "id_diagnostico", "sk_diagnostico", _diagnosis,
        ("codigo_cie10", "descripcion_diagnostico", "categoria", "subcategoria", "es_cronico"),
    ),
}

PROFILES = {
    "dim_perfil_mantenimiento": ("sk_perfil_mantenimiento", MAINTENANCE_PROFILE),
    "dim_perfil_ensayo": ("sk_perfil_ensayo", TRIAL_PROFILE),
}

# Loaded in any order; facts come after all of them.
ALL_DIMENSIONS = ("dim_fecha", *DIMENSIONS, *PROFILES)
CURRENT_ONLY = tuple(name for name, spec in DIMENSIONS.items() if spec.versioned)


def load_dimension(
    spark: SparkSession,
    name: str,
    tables: Tables,
    existing: DataFrame | None,
    as_of: date,
    changed: DataFrame | None = None,
    last: int | None = None,
) -> DataFrame:
    """The dimension after loading the cleansed ``tables``.

    ``changed`` restricts the load to those rows of the main table, one per
    key, as an incremental refresh does; lookups still see the whole tables.
    ``last`` is needed when ``existing`` is only the part those rows belong to.
    """
    if name == "dim_fecha":
        return calendar(spark)
    if name in PROFILES:
        sk, axes = PROFILES[name]
        return junk_dimension(spark, axes, sk, existing)
    spec = DIMENSIONS[name]
    if name == "dim_departamento" and existing is not None:
        existing = existing.drop("sk_departamento_padre")
    # levels depend on all departments, so that table is always read whole
    if changed is not None and name != "dim_departamento":
        tables = {**tables, spec.main: changed}
    source = spec.attributes(tables)
    if spec.versioned:
        return scd2_merge(existing, source, spec.key, spec.overwrite, spec.versioned, spec.sk, as_of, last)
    dim = scd1_merge(existing, source, spec.key, spec.overwrite, spec.sk, last)
    if name == "dim_departamento":
        dim = with_parent_key(
            dim, "id_departamento", "id_departamento_padre", "sk_departamento", "sk_departamento_padre"
        )
    return dim
