"""Source tables, their keys, and the quality rules of each."""

from __future__ import annotations

from dataclasses import dataclass

from strataflow.functions.columns import snake_case
from strataflow.functions.rules import allowed, matches, non_negative, not_null, positive, within


@dataclass(frozen=True)
class TableSpec:
    """A landed table. ``key`` identifies a row; ``cursor`` orders its changes."""

    source: str
    key: tuple[str, ...]
    cursor: str | None = "fecha_modificacion"

    @property
    def name(self) -> str:
        return snake_case(self.source)


# Source tables of the equipment system, the clinical system and
# the product feed, with the business key of each.
EQUIPMENT_TABLES = (
    TableSpec("CategoriaEquipos", ("id_categoria",)),
    TableSpec("ConsumoRepuestos", ("id_consumo",)),
    TableSpec("Departamentos", ("id_departamento",)),
    TableSpec("Equipos", ("id_equipo",)),
    TableSpec("Fabricantes", ("id_fabricante",)),
    TableSpec("PlanificacionPreventivos", ("id_planificacion",)),
    TableSpec("Repuestos", ("id_repuesto",)),
    TableSpec("Tecnicos", ("id_tecnico",)),
    TableSpec("Ubicaciones", ("id_ubicacion",)),
    TableSpec("OrdenesMantenimiento", ("id_orden",)),
)
CLINICAL_TABLES = (
    TableSpec("diagnosticos_cie10", ("id_diagnostico",)),
    TableSpec("ensayos_clinicos", ("id_ensayo",)),
    TableSpec("especialidades", ("id_especialidad",)),
    TableSpec("lecturas_signos_vitales", ("id_lectura",)),
    TableSpec("medicos", ("id_medico",)),
    TableSpec("monitorizaciones", ("id_monitorizacion",)),
    TableSpec("paciente_diagnostico", ("id_paciente", "id_diagnostico")),
    TableSpec("pacientes", ("id_paciente",)),
    TableSpec("participacion_ensayos", ("id_participacion",)),
    TableSpec("visitas_ensayo", ("id_visita",)),
)
PRODUCT_FEED = TableSpec("productos_sanitarios", ("codigo_producto",), cursor="fecha_ingestion")

TABLES = {t.name: t for t in (*EQUIPMENT_TABLES, *CLINICAL_TABLES, PRODUCT_FEED)}

# The two shapes of the e-mail test. The first wants a real dot;
# the second is the test as the source system ran it, where the dot stands for
# any character.
EMAIL = r"^[^@]+@[^@]+\.[^@]+$"
EMAIL_PARITY = r"^[^@]+@[^@]+.[^@]+$"

RISK_CLASSES = ("I", "IIa", "IIb", "III")


def quality_rules(parity: bool = False) -> dict[str, list]:
    """The rules of every table."""
    email = EMAIL_PARITY if parity else EMAIL
    return {
        "productos_sanitarios": [
            *not_null("codigo_producto", "nombre_producto"),
            *allowed("clase_riesgo", *RISK_CLASSES),
            *positive("vida_util_anios", "precio_referencia_eur"),
        ],
        "especialidades": not_null("codigo_especialidad", "nombre_especialidad"),
        "medicos": [
            *not_null("codigo_medico", "nombre", "apellido1", "numero_colegiado"),
            *matches("email", email),
        ],
        "pacientes": [
            *not_null("numero_historia", "nombre", "apellido1", "fecha_nacimiento"),
            *allowed("sexo", "M", "F", "O"),
            *allowed("grupo_sanguineo", "A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"),
            *allowed("tipo_cobertura", "BAS", "COM", "PRE"),
            *matches("email", email),
        ],
        "diagnosticos_cie10": not_null("codigo_cie10", "descripcion"),
        "paciente_diagnostico": not_null("id_paciente", "id_diagnostico", "fecha_diagnostico"),
        "ensayos_clinicos": [
            *not_null("codigo_ensayo", "titulo_ensayo", "fecha_inicio"),
            *allowed("estado_ensayo", "PLN", "ACT", "COM", "SUS"),
            *positive("objetivo_reclutamiento"),
        ],
        "participacion_ensayos": [
            *not_null("id_ensayo", "id_paciente", "fecha_inicio_participacion"),
            *allowed("fase", "F1", "F2", "F3", "F4"),
            *allowed("tipo_ciego", "AB", "SC", "DC"),
            *allowed("tipo_aleatorizacion", "AL", "NA"),
            *allowed("grupo_asignado", "EXP", "CTR", "PLA"),
            *allowed("via_administracion", "ORL", "IV", "SC", "TOP", "INH"),
        ],
        "visitas_ensayo": [
            *not_null("id_participacion", "fecha_visita"),
            *positive("numero_visita"),
            *within("nivel_eficacia", 0, 1),
            *positive("dosis_administrada"),
            *non_negative("numero_efectos_adversos"),
        ],
        "monitorizaciones": not_null("id_paciente", "id_medico", "codigo_equipo", "fecha_monitorizacion"),
        "lecturas_signos_vitales": [
            *not_null("id_monitorizacion"),
            *within("frecuencia_cardiaca", 20, 300),
            *within("presion_sistolica", 40, 300),
            *within("presion_diastolica", 20, 200),
            *within("temperatura", 30, 45),
            *within("saturacion_oxigeno", 50, 100),
            *within("nivel_glucosa", 20, 600),
        ],
        "departamentos": [
            *not_null("codigo_departamento", "nombre_departamento"),
            *matches("email_departamento", email),
        ],
        "fabricantes": [
            *not_null("codigo_fabricante", "razon_social"),
            *matches("email_contacto", email),
        ],
        "ubicaciones": [
            *not_null("codigo_ubicacion", "edificio", "sala"),
            *allowed("tipo_sala", "Quirófano", "UCI", "Consulta", "Laboratorio", "Almacén"),
            *positive("capacidad"),
        ],
        "equipos": [
            *not_null("codigo_equipo", "nombre_equipo", "numero_serie"),
            *not_null("id_fabricante", "id_departamento", "id_ubicacion"),
            *allowed("estado_codigo", 1, 2, 3, 4),
            *allowed("clase_riesgo", *RISK_CLASSES),
            *positive("precio_adquisicion"),
        ],
        "tecnicos": [
            *not_null("codigo_empleado", "nombre_tecnico", "id_departamento"),
            *allowed("nivel_certificacion", 1, 2, 3, 4),
            *positive("tarifa_hora"),
            *matches("email_corporativo", email),
        ],
        "ordenes_mantenimiento": [
            *not_null("numero_orden", "id_equipo", "id_tecnico"),
            *allowed("tipo_mantenimiento", "PREV", "CORR", "CALIB", "INSP"),
            *within("prioridad", 1, 4),
            *within("gravedad", 1, 3),
            *positive("horas_trabajadas"),
        ],
        "consumo_repuestos": [
            *not_null("id_orden", "id_repuesto"),
            *positive("cantidad", "precio_unitario_en_momento"),
        ],
        "repuestos": [*not_null("codigo_repuesto", "nombre_repuesto"), *positive("precio_unitario")],
        "categoria_equipos": not_null("codigo_categoria", "nombre_categoria"),
        "planificacion_preventivos": not_null("id_equipo", "fecha_planificada"),
    }
