"""SQL equivalents of the registered queries, for an independent engine.

The fixed values (rules, code texts, profile axes) come from the configuration;
what is done with them is stated here in SQL of its own: range windows, USING
joins, list lookups and set operations rather than the Spark formulation.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from strataflow.functions.rules import Rule
from strataflow.operators.dimensions import MONTHS, WEEKDAYS
from strataflow.plans.hospital import dimensions as dim, facts as fact
from strataflow.plans.hospital.catalog import EMAIL, quality_rules
from strataflow.plans.roles import ROLES, row_key

AS_OF = "DATE '2001-08-10'"
TEXT_NUMBERS = ("vida_util_anios", "precio_referencia_eur")


def _literal(value) -> str:
    return str(value).upper() if isinstance(value, bool) else str(value) if not isinstance(value, str) else f"'{value}'"


def _test(rule: Rule) -> str:
    """A rule as a SQL predicate."""
    column = f"TRY_CAST({rule.column} AS DOUBLE)" if rule.column in TEXT_NUMBERS else rule.column
    if rule.kind == "not_null":
        return f"{rule.column} IS NOT NULL"
    if rule.kind == "positive":
        return f"{column} > 0"
    if rule.kind == "non_negative":
        return f"{column} >= 0"
    if rule.kind == "allowed_values":
        return f"{rule.column} IN ({', '.join(map(_literal, rule.args))})"
    if rule.kind == "regex":
        return f"regexp_matches({rule.column}, '{rule.args[0]}')"
    low, high = rule.args
    return f"{column} BETWEEN {low} AND {high}"


def _named(columns: Sequence[str]) -> str:
    """Columns as one text."""
    return " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '~')" for c in columns)


VALID = {table: " AND ".join(f"({_test(r)})" for r in rules) for table, rules in quality_rules().items()}


def _texts(column: str, texts: Mapping) -> str:
    """Code to text through a map literal; other codes give NULL."""
    pairs = ", ".join(f"{_literal(code)}: {_literal(text)}" for code, text in texts.items())
    return f"MAP {{{pairs}}}[{column}]"


# Named subqueries; a query pulls in those it mentions, and theirs.
PARTS: dict[str, str] = {}
for _table, _text in ROLES.items():
    PARTS[f"r_{_table}"] = _text
    PARTS[f"v_{_table}"] = f"SELECT * FROM r_{_table} WHERE {VALID[_table]}"


def _dates(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS BIGINT)"


def _nth(words: Sequence[str], position: str) -> str:
    return f"[{', '.join(map(_literal, words))}][{position}]"


def _calendar(first: str, last: str) -> str:
    numbers = {
        "anio": "year(fecha)", "semestre": "(quarter(fecha) + 1) // 2", "trimestre": "quarter(fecha)",
        "mes": "month(fecha)", "semana_anio": "weekofyear(fecha)", "dia": "day(fecha)",
        "dia_semana": "isodow(fecha)",
    }
    whole = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in numbers.items())
    return f"""
        SELECT fecha, {_dates('fecha')} AS sk_fecha, {whole},
               {_nth(MONTHS, 'month(fecha)')} AS nombre_mes, {_nth(WEEKDAYS, 'isodow(fecha)')} AS nombre_dia,
               isodow(fecha) > 5 AS es_fin_semana, FALSE AS es_festivo
        FROM (SELECT CAST(unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS DATE) AS fecha) AS dias"""


PARTS["dim_fecha"] = _calendar("DATE '1995-01-01'", "DATE '2030-12-31'")


def _first_load(sk: str, key: str, body: str, versioned: bool = False) -> str:
    extra = (
        f", {AS_OF} AS fecha_inicio, CAST(NULL AS DATE) AS fecha_fin, TRUE AS es_actual" if versioned else ""
    )
    return f"SELECT row_number() OVER (ORDER BY {key}) AS {sk}, t.*{extra} FROM ({body}) t"


PARTS["jerarquia"] = """
        SELECT id_departamento, CAST(1 AS BIGINT) AS nivel FROM v_departamentos WHERE id_departamento_padre IS NULL
        UNION ALL
        SELECT hijo.id_departamento, jerarquia.nivel + 1
        FROM v_departamentos hijo, jerarquia WHERE hijo.id_departamento_padre = jerarquia.id_departamento"""
PARTS["dep_base"] = _first_load("sk_departamento", "id_departamento", """
        SELECT id_departamento, nombre_departamento, id_departamento_padre, nivel AS nivel_jerarquia,
               nombre_responsable AS responsable, telefono_departamento, email_departamento
        FROM v_departamentos JOIN jerarquia USING (id_departamento)""")
PARTS["dim_departamento"] = """
        SELECT hijo.*, padre.sk_departamento AS sk_departamento_padre
        FROM dep_base hijo LEFT JOIN dep_base padre ON padre.id_departamento = hijo.id_departamento_padre"""
PARTS["dim_ubicacion"] = _first_load("sk_ubicacion", "id_ubicacion", """
        SELECT id_ubicacion, edificio, planta, ala, sala, tipo_sala, capacidad FROM v_ubicaciones""")
PARTS["dim_fabricante"] = _first_load("sk_fabricante", "id_fabricante", """
        SELECT id_fabricante, razon_social AS nombre_fabricante, pais_origen, telefono_contacto,
               email_contacto, sitio_web, certificacion_iso FROM v_fabricantes""")
PARTS["dim_medico"] = _first_load("sk_medico", "id_medico", f"""
        SELECT id_medico, nombre, concat_ws(' ', apellido1, apellido2) AS apellidos, numero_colegiado, telefono, email,
               ifnull(nombre_especialidad, '{dim.NO_SPECIALTY}') AS especialidad,
               nombre_departamento AS departamento
        FROM v_medicos LEFT JOIN v_especialidades USING (id_especialidad)
        LEFT JOIN v_departamentos USING (codigo_departamento)""", True)


def _given(name: str) -> str:
    return f"ifnull(nullif(regexp_extract({name}, '{FOUR_WORDS}', 1), ''), regexp_extract({name}, '^[^ ]*'))"


def _surnames(name: str) -> str:
    return (
        f"CASE WHEN regexp_matches({name}, '{FOUR_WORDS}') THEN regexp_extract({name}, '{FOUR_WORDS}', 2) "
        f"ELSE nullif(regexp_replace({name}, '^[^ ]* ?', ''), '') END"
    )


FOUR_WORDS = "^([^ ]* [^ ]*) ([^ ]* [^ ]*)$"
PARTS["dim_tecnico"] = _first_load("sk_tecnico", "id_tecnico", f"""
        SELECT id_tecnico, {_given('nombre_tecnico')} AS nombre, {_surnames('nombre_tecnico')} AS apellidos,
               especialidad, anios_experiencia, telefono_movil AS telefono, email_corporativo AS email,
               nombre_departamento AS departamento,
               {_texts('nivel_certificacion', dim.CERTIFICATION)} AS nivel_certificacion
        FROM v_tecnicos LEFT JOIN v_departamentos USING (id_departamento)""", True)
PARTS["dim_paciente"] = _first_load("sk_paciente", "id_paciente", """
        SELECT id_paciente, nombre,
               CASE WHEN apellido2 IS NOT NULL THEN concat_ws(' ', apellido1, apellido2) END AS apellidos, fecha_nacimiento, sexo AS genero,
               telefono_movil AS telefono, email, grupo_sanguineo, direccion, ciudad, codigo_postal,
               compania_seguro AS seguro_medico, tipo_cobertura AS tipo_seguro FROM v_pacientes""", True)
PARTS["dim_equipo"] = _first_load("sk_equipo", "id_equipo", f"""
        SELECT id_equipo, nombre_equipo,
               CASE WHEN starts_with(descripcion, nombre_equipo || ' - ')
                    THEN right(descripcion, length(descripcion) - length(nombre_equipo) - 3)
                    ELSE descripcion END AS descripcion,
               numero_serie, modelo, fecha_adquisicion, fecha_fin_garantia, clase_riesgo,
               {_texts('estado_codigo', dim.EQUIPMENT_STATE)} AS estado_equipo,
               nombre_departamento AS departamento_actual, concat(edificio, ' - ', sala) AS ubicacion_actual
        FROM v_equipos LEFT JOIN v_departamentos USING (id_departamento)
        LEFT JOIN v_ubicaciones USING (id_ubicacion)""", True)
PARTS["dim_ensayo"] = _first_load("sk_ensayo", "id_ensayo", """
        SELECT id_ensayo, codigo_ensayo, titulo_ensayo AS nombre_ensayo, descripcion_ensayo AS descripcion,
               patrocinador, fecha_inicio AS fecha_inicio_ensayo, fecha_fin_prevista, estado_ensayo,
               objetivo_principal, molecula_farmaco FROM v_ensayos_clinicos""")
PARTS["dim_diagnostico"] = _first_load("sk_diagnostico", "id_diagnostico", """
        SELECT id_diagnostico, codigo_cie10, descripcion AS descripcion_diagnostico, capitulo AS categoria,
               grupo AS subcategoria, es_cronico FROM v_diagnosticos_cie10""")


def _profile(sk: str, axes: Mapping[str, Sequence]) -> str:
    order = ", ".join(axes)
    lists = ", ".join(
        f"(SELECT unnest([{', '.join(map(_literal, values))}]) AS {axis}) AS l_{axis}" for axis, values in axes.items()
    )
    return f"SELECT row_number() OVER (ORDER BY {order}) AS {sk}, {order} FROM {lists}"


for _perfil, (_sk, _axes) in dim.PROFILES.items():
    PARTS[_perfil] = _profile(_sk, _axes)

# keys of everything that hangs on one business key
PARTS["k_equipo"] = """
        SELECT id_equipo, sk_equipo, sk_departamento, sk_ubicacion, sk_fabricante
        FROM (SELECT id_equipo, id_departamento, id_ubicacion, id_fabricante FROM v_equipos)
        JOIN (SELECT id_equipo, sk_equipo FROM dim_equipo WHERE es_actual) USING (id_equipo)
        JOIN dim_departamento USING (id_departamento) JOIN dim_ubicacion USING (id_ubicacion)
        JOIN dim_fabricante USING (id_fabricante)"""
PARTS["k_tecnico"] = """
        SELECT id_tecnico, tarifa_hora, sk_tecnico FROM v_tecnicos
        JOIN (SELECT id_tecnico, sk_tecnico FROM dim_tecnico WHERE es_actual) USING (id_tecnico)"""
PARTS["costes"] = """
        SELECT id_orden, SUM(cantidad * precio_unitario_en_momento) AS repuestos, SUM(cantidad) AS piezas
        FROM v_consumo_repuestos GROUP BY id_orden"""


def _earlier(counted: str, key: str, at: str) -> str:
    """Whether a counted row of the same key lies up to 30 days before."""
    return (
        f"COALESCE(bool_or({counted}) OVER (PARTITION BY {key} ORDER BY {at} "
        "RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), FALSE)"
    )


def _coded_orders(table: str, types: Mapping) -> str:
    return f"""SELECT id_orden, id_equipo, id_tecnico, horas_trabajadas, fecha_inicio_trabajo, fecha_fin_trabajo,
               tipo_mantenimiento AS codigo, {_texts('tipo_mantenimiento', types)} AS tipo_mantenimiento,
               {_texts('prioridad', fact.PRIORITY)} AS prioridad, {_texts('gravedad', fact.SEVERITY)} AS gravedad,
               es_cubierto_por_garantia AS es_garantia, requiere_parada AS requiere_parada_equipo FROM {table}"""


PARTS["ordenes_texto"] = _coded_orders("v_ordenes_mantenimiento", fact.MAINTENANCE_TYPE_ADMITTED)
PARTS["ordenes_texto_parity"] = _coded_orders("v_ordenes_mantenimiento", fact.MAINTENANCE_TYPE)
PARTS["ordenes_todas"] = _coded_orders("r_ordenes_mantenimiento", fact.MAINTENANCE_TYPE_ADMITTED)


def _cents(whole_100: str, count: str = "1") -> str:
    """Round a sum of hundredths over a count half up, exactly, and give units."""
    return f"CAST((2 * CAST({whole_100} AS BIGINT) + {count}) // (2 * {count}) AS DOUBLE) / 100"


def _maintenance(orders: str, corrective: str) -> str:
    minutes = "date_diff('minute', fecha_inicio_trabajo, fecha_fin_trabajo)"
    earlier = _earlier(f"codigo = '{corrective}'", "id_equipo", "fecha_inicio_trabajo")
    return f"""
        SELECT id_orden, {_dates('fecha_inicio_trabajo')} AS sk_fecha, sk_equipo, sk_tecnico, sk_departamento,
               sk_ubicacion, sk_fabricante, sk_perfil_mantenimiento, indicador_reincidencia,
               CAST(piezas AS BIGINT) AS numero_piezas_reemplazadas,
               CAST(horas_trabajadas AS DOUBLE) AS horas_trabajadas, CAST(tarifa_hora AS DOUBLE) AS tarifa_hora,
               CAST(repuestos AS DOUBLE) AS costo_repuestos, CAST(mano_obra AS DOUBLE) AS costo_mano_obra,
               CAST(mano_obra + ifnull(repuestos, 0) AS DOUBLE) AS costo_total,
               CAST((200 * {minutes} + 60) // 120 AS DOUBLE) / 100 AS duracion_horas
        FROM (SELECT *, horas_trabajadas * tarifa_hora AS mano_obra
              FROM (SELECT *, {earlier} AS indicador_reincidencia FROM {orders})
              JOIN k_equipo USING (id_equipo) JOIN k_tecnico USING (id_tecnico)
              JOIN dim_perfil_mantenimiento
                   USING (tipo_mantenimiento, prioridad, gravedad, es_garantia, requiere_parada_equipo)
              LEFT JOIN costes USING (id_orden))"""


PARTS["fact_mantenimiento_equipos"] = _maintenance("ordenes_texto", fact.CORRECTIVE)
PARTS["fact_mantenimiento_parity"] = _maintenance("ordenes_texto_parity", fact.CORRECTIVE_PARITY)

_VITALS = tuple(fact.ALERT_RANGES)
PARTS["lecturas_sesion"] = (
    "SELECT id_monitorizacion, count(*) AS n, "
    + ", ".join(f"SUM(CAST({v} * 100 AS BIGINT)) AS s_{v}" for v in _VITALS)
    + " FROM v_lecturas_signos_vitales GROUP BY id_monitorizacion"
)


def _beyond(measure: str, low, high) -> str:
    """Whether the mean of a session is out of range, in whole hundredths."""
    above = "" if high is None else f" OR s_{measure} > {int(high * 100)} * n"
    return f"s_{measure} < {int(low * 100)} * n{above}"


PARTS["fact_monitorizacion_pacientes"] = f"""
        SELECT id_monitorizacion AS id_sesion, {_dates('fecha_monitorizacion')} AS sk_fecha, sk_paciente, sk_medico,
               sk_equipo, sk_departamento, sk_ubicacion, sk_diagnostico,
               CAST(date_diff('minute', hora_inicio, hora_fin) AS BIGINT) AS duracion_monitorizacion_min,
               {', '.join(f"{_cents(f's_{v}', 'n')} AS {v}" for v in _VITALS)},
               ({' OR '.join(_beyond(v, *limits) for v, limits in fact.ALERT_RANGES.items())}) AS alerta_generada
        FROM v_monitorizaciones JOIN lecturas_sesion USING (id_monitorizacion)
        JOIN (SELECT codigo_equipo, sk_equipo FROM v_equipos JOIN dim_equipo USING (id_equipo) WHERE es_actual)
             USING (codigo_equipo)
        JOIN (SELECT codigo_departamento, sk_departamento FROM v_departamentos
              JOIN dim_departamento USING (id_departamento)) USING (codigo_departamento)
        JOIN (SELECT codigo_ubicacion, sk_ubicacion FROM v_ubicaciones JOIN dim_ubicacion USING (id_ubicacion))
             USING (codigo_ubicacion)
        JOIN (SELECT id_paciente, sk_paciente FROM dim_paciente WHERE es_actual) USING (id_paciente)
        JOIN (SELECT id_medico, sk_medico FROM dim_medico WHERE es_actual) USING (id_medico)
        JOIN (SELECT id_diagnostico, sk_diagnostico FROM dim_diagnostico) USING (id_diagnostico)"""


def _days(table: str, start: str, end: str, as_of: str) -> str:
    """Each row once per day of its interval."""
    length = f"CAST(COALESCE({end}, {as_of}) - {start} AS BIGINT) + 1"
    return f"""SELECT b.*, b.{start} + CAST(b.n AS INTEGER) AS dia_fecha
               FROM (SELECT a.*, unnest(range(0, greatest({length}, 0))) AS n FROM {table} a) b"""


def _coded_trials(table: str) -> str:
    return f"""SELECT id_participacion, id_ensayo, id_paciente, id_medico_asignado AS id_medico, id_diagnostico,
               fecha_inicio_participacion, fecha_fin_participacion, {_texts('fase', fact.PHASE)} AS fase_ensayo,
               {_texts('tipo_ciego', fact.BLINDING)} AS tipo_ciego,
               {_texts('tipo_aleatorizacion', fact.RANDOMISATION)} AS tipo_aleatorizacion,
               {_texts('grupo_asignado', fact.ARM)} AS grupo_tratamiento,
               {_texts('via_administracion', fact.ROUTE)} AS via_administracion FROM {table}"""


PARTS["participaciones_texto"] = _coded_trials("v_participacion_ensayos")
PARTS["participaciones_todas"] = _coded_trials("r_participacion_ensayos")
PARTS["visitas_dia"] = """
        SELECT id_participacion, CAST(fecha_visita AS DATE) AS dia_fecha,
               CAST(dosis_administrada AS DOUBLE) AS dosis_administrada, unidad_dosis,
               CAST(numero_efectos_adversos AS BIGINT) AS numero_efectos_adversos,
               CAST(resultado_medicion_principal AS DOUBLE) AS resultado_medicion_principal,
               CAST(resultado_medicion_secundaria AS DOUBLE) AS resultado_medicion_secundaria,
               CAST(nivel_eficacia AS DOUBLE) AS nivel_eficacia
        FROM v_visitas_ensayo"""
PARTS["k_ensayo"] = """
        SELECT id_ensayo, sk_ensayo, sk_departamento
        FROM (SELECT id_ensayo, codigo_departamento FROM v_ensayos_clinicos)
        JOIN (SELECT id_ensayo, sk_ensayo FROM dim_ensayo) USING (id_ensayo)
        JOIN (SELECT codigo_departamento, sk_departamento FROM v_departamentos
              JOIN dim_departamento USING (id_departamento)) USING (codigo_departamento)"""
_DAYS = _days("participaciones_texto", "fecha_inicio_participacion", "fecha_fin_participacion", AS_OF)
PARTS["fact_ensayos_clinicos"] = f"""
        SELECT id_participacion, {_dates('dia_fecha')} AS sk_fecha,
               {_dates('fecha_inicio_participacion')} AS sk_fecha_inicio,
               {_dates('fecha_fin_participacion')} AS sk_fecha_fin,
               sk_ensayo, sk_paciente, sk_medico, sk_diagnostico, sk_departamento, sk_perfil_ensayo,
               dosis_administrada, unidad_dosis, numero_efectos_adversos, resultado_medicion_principal,
               resultado_medicion_secundaria, nivel_eficacia
        FROM ({_DAYS}) JOIN k_ensayo USING (id_ensayo)
        JOIN (SELECT id_paciente, sk_paciente FROM dim_paciente WHERE es_actual) USING (id_paciente)
        JOIN (SELECT id_medico, sk_medico FROM dim_medico WHERE es_actual) USING (id_medico)
        JOIN (SELECT id_diagnostico, sk_diagnostico FROM dim_diagnostico) USING (id_diagnostico)
        JOIN dim_perfil_ensayo
             USING (fase_ensayo, tipo_ciego, tipo_aleatorizacion, grupo_tratamiento, via_administracion)
        LEFT JOIN visitas_dia USING (id_participacion, dia_fecha)"""


def _versions(name: str, before: str, source: str, as_of: str) -> None:
    """One round of a mixed type 1 and 2 load, in its three steps."""
    PARTS[f"{name}_1"] = f"""
        SELECT t.sk_customer, t.c_custkey,
               CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
               CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
               t.c_mktsegment, t.c_nationkey, t.fecha_inicio, t.fecha_fin, t.es_actual
        FROM {before} t LEFT JOIN {source} s ON s.c_custkey = t.c_custkey AND t.es_actual"""
    PARTS[f"{name}_2"] = f"""
        SELECT t.sk_customer, t.c_custkey, t.c_name, t.c_acctbal, t.c_mktsegment, t.c_nationkey, t.fecha_inicio,
               CASE WHEN s.c_custkey IS NOT NULL THEN {as_of} - 1 ELSE t.fecha_fin END AS fecha_fin,
               t.es_actual AND s.c_custkey IS NULL AS es_actual
        FROM {name}_1 t LEFT JOIN {source} s ON s.c_custkey = t.c_custkey AND t.es_actual
             AND (t.c_mktsegment IS DISTINCT FROM s.c_mktsegment OR t.c_nationkey IS DISTINCT FROM s.c_nationkey)"""
    PARTS[name] = f"""
        SELECT * FROM {name}_2
        UNION ALL
        SELECT (SELECT max(sk_customer) FROM {name}_2) + row_number() OVER (ORDER BY c_custkey),
               c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey, {as_of}, CAST(NULL AS DATE), TRUE
        FROM {source} s
        WHERE NOT EXISTS (SELECT 1 FROM {name}_2 t WHERE t.c_custkey = s.c_custkey AND t.es_actual)"""


PARTS["cli_0"] = """
        SELECT row_number() OVER (ORDER BY c_custkey) AS sk_customer, c_custkey, c_name, c_acctbal, c_mktsegment,
               CAST(c_nationkey AS BIGINT) AS c_nationkey, DATE '2024-01-01' AS fecha_inicio,
               CAST(NULL AS DATE) AS fecha_fin, TRUE AS es_actual
        FROM customer WHERE c_mktsegment <> 'FURNITURE'"""
PARTS["cli_s1"] = """
        SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal,
               CASE WHEN c_nationkey < 5 THEN 'MACHINERY' WHEN c_nationkey = 7 THEN NULL ELSE c_mktsegment END
                   AS c_mktsegment,
               CAST(c_nationkey AS BIGINT) AS c_nationkey
        FROM customer WHERE c_mktsegment <> 'BUILDING'"""
PARTS["cli_s2"] = """
        SELECT c_custkey, c_name, c_acctbal, c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer"""
_versions("cli_1", "cli_0", "cli_s1", "DATE '2024-02-01'")
_versions("cli_2", "cli_1", "cli_s2", "DATE '2024-03-01'")
_versions("cli_2b", "cli_1", "cli_s2", "DATE '2024-02-01'")

PARTS["ordenes_cambio"] = """
        SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, o_orderdate, 'INSERT' AS accion
        FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT o_orderkey, o_custkey, -1, o_orderdate - INTERVAL 1 DAY, 'INSERT' FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, 'DELETE'
        FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000"""
PARTS["ordenes_ultimo"] = """
        SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) AS rn
                       FROM ordenes_cambio c) x WHERE rn = 1"""

PARTS["cli_old"] = "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'FURNITURE'"
PARTS["cli_new"] = """
        SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM customer WHERE c_mktsegment <> 'BUILDING'"""
PARTS["cli_igual"] = """
        SELECT o.c_custkey FROM cli_old o JOIN cli_new n ON n.c_custkey = o.c_custkey
        WHERE o.c_acctbal IS NOT DISTINCT FROM n.c_acctbal AND o.c_mktsegment IS NOT DISTINCT FROM n.c_mktsegment"""

PARTS["migra_old"] = """
        SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice,
               o_orderstatus FROM orders"""
PARTS["migra_new"] = """
        SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice + 1 END
               AS o_totalprice, o_orderstatus FROM orders"""

PARTS["eventos_fila"] = """
        SELECT event_id, user_id, event_type, value, CAST(day(ts) AS BIGINT) AS dia,
               CASE WHEN value < 100 THEN 'x' END AS marca,
               CASE WHEN user_id < 10 THEN 'u@correo' ELSE 'u' || user_id || '@correo.es' END AS email
        FROM events"""
_EVENT_TESTS = {
    ("marca", "not_null"): "marca IS NOT NULL",
    ("value", "positive"): "value > 0",
    ("user_id", "non_negative"): "user_id >= 0",
    ("event_type", "allowed_values"): "event_type IN ('view', 'click', 'purchase', 'signup')",
    ("dia", "allowed_values"): "dia BETWEEN 1 AND 28",
    ("email", "regex"): f"regexp_matches(email, '{EMAIL}')",
    ("value", "range"): "value >= 1 AND value <= 200",
}
_EVENT_OK = " AND ".join(f"({t})" for t in _EVENT_TESTS.values())

PARTS["nodos"] = """
        SELECT p_partkey AS id_nodo, CASE WHEN p_partkey > 0 THEN p_partkey // 4 END AS id_padre, p_name FROM part"""
PARTS["niveles"] = """
        SELECT id_nodo, CAST(1 AS BIGINT) AS nivel FROM nodos WHERE id_padre IS NULL
        UNION ALL
        SELECT n.id_nodo, j.nivel + 1 FROM nodos n JOIN niveles j ON j.id_nodo = n.id_padre"""

PARTS["pedidos_intervalo"] = """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS desde,
               CASE WHEN o_orderstatus <> 'P' OR o_orderdate < DATE '2001-07-01'
                    THEN CAST(o_orderdate AS DATE) + (CAST(floor(o_totalprice) AS INTEGER) % 20 - 3) END AS hasta
        FROM orders"""

PARTS["nombres"] = """
        SELECT p_partkey,
               CASE WHEN p_size > 40 THEN split_part(p_name, ' ', 1) WHEN p_size > 30 THEN p_name || ' ' || p_brand
                    WHEN p_size > 20 THEN p_name || ' ' || p_brand || ' ' || p_type
                    WHEN p_size > 10 THEN p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_brand
                    ELSE p_name END AS n FROM part"""
PARTS["partes_1"] = """
        SELECT row_number() OVER (ORDER BY p_partkey) AS sk_part, p_partkey, p_name, p_brand, p_retailprice
        FROM part WHERE p_type <> 'PROMO'"""
PARTS["partes_2"] = """
        SELECT p_partkey, p_name, CASE WHEN p_size > 10 THEN p_brand END AS p_brand,
               p_retailprice + 1 AS p_retailprice FROM part WHERE p_type <> 'LARGE'"""


# What each wide view shows of its fact and of every dimension.
WIDE = {
    "fact_mantenimiento_equipos": {
        "fact": "id_orden, horas_trabajadas, tarifa_hora, costo_repuestos, costo_mano_obra, costo_total, "
                "duracion_horas, numero_piezas_reemplazadas, indicador_reincidencia",
        "dim_fecha": "fecha, anio, semestre, trimestre, mes, nombre_mes, semana_anio, dia, nombre_dia, es_fin_semana",
        "dim_equipo": "nombre_equipo, numero_serie, modelo, clase_riesgo, estado_equipo, fecha_adquisicion, "
                      "fecha_fin_garantia, departamento_actual AS departamento_equipo, "
                      "ubicacion_actual AS ubicacion_equipo",
        "dim_tecnico": "nombre AS nombre_tecnico, apellidos AS apellidos_tecnico, "
                       "especialidad AS especialidad_tecnico, nivel_certificacion, anios_experiencia",
        "dim_departamento": "nombre_departamento, nivel_jerarquia AS nivel_jerarquia_departamento",
        "dim_ubicacion": "edificio, planta, ala, sala, tipo_sala",
        "dim_fabricante": "nombre_fabricante, pais_origen, certificacion_iso",
        "dim_perfil_mantenimiento": "tipo_mantenimiento, prioridad, gravedad, es_garantia, requiere_parada_equipo",
    },
    "fact_monitorizacion_pacientes": {
        "fact": "id_sesion, duracion_monitorizacion_min, frecuencia_cardiaca, presion_sistolica, "
                "presion_diastolica, temperatura, saturacion_oxigeno, nivel_glucosa, alerta_generada",
        "dim_fecha": "fecha, anio, trimestre, mes, nombre_mes, nombre_dia, es_fin_semana",
        "dim_paciente": "nombre AS nombre_paciente, apellidos AS apellidos_paciente, fecha_nacimiento, genero, "
                        "grupo_sanguineo, ciudad AS ciudad_paciente, seguro_medico, tipo_seguro",
        "dim_medico": "nombre AS nombre_medico, apellidos AS apellidos_medico, especialidad AS especialidad_medico, "
                      "numero_colegiado",
        "dim_equipo": "nombre_equipo, clase_riesgo, estado_equipo",
        "dim_departamento": "nombre_departamento",
        "dim_ubicacion": "edificio, sala, tipo_sala",
        "dim_diagnostico": "codigo_cie10, descripcion_diagnostico, categoria AS categoria_diagnostico, "
                           "subcategoria AS subcategoria_diagnostico, es_cronico",
    },
    "fact_ensayos_clinicos": {
        "fact": "id_participacion, dosis_administrada, unidad_dosis, numero_efectos_adversos, "
                "resultado_medicion_principal, resultado_medicion_secundaria, nivel_eficacia",
        "dim_fecha": "fecha AS fecha_visita, anio AS anio_visita, trimestre AS trimestre_visita, "
                     "mes AS mes_visita, nombre_mes AS nombre_mes_visita",
        "dim_ensayo": "codigo_ensayo, nombre_ensayo, patrocinador, estado_ensayo, molecula_farmaco, "
                      "objetivo_principal, fecha_inicio_ensayo, fecha_fin_prevista",
        "dim_paciente": "nombre AS nombre_paciente, apellidos AS apellidos_paciente, genero, fecha_nacimiento, "
                        "grupo_sanguineo",
        "dim_medico": "nombre AS nombre_medico, apellidos AS apellidos_medico, especialidad AS especialidad_medico",
        "dim_diagnostico": "codigo_cie10, descripcion_diagnostico, categoria AS categoria_diagnostico, es_cronico",
        "dim_departamento": "nombre_departamento",
        "dim_perfil_ensayo": "fase_ensayo, tipo_ciego, tipo_aleatorizacion, grupo_tratamiento, via_administracion",
    },
}


def _wide(name: str) -> str:
    shown = dict(WIDE[name])
    wanted = [*shown.pop("fact").split(", ")]
    joins = []
    for table, columns in shown.items():
        sk = table.replace("dim_", "sk_")
        only = " WHERE es_actual" if table in dim.CURRENT_ONLY else ""
        joins.append(f"JOIN (SELECT {sk}, {columns} FROM {table}{only}) USING ({sk})")
        wanted += [c.split(" AS ")[-1] for c in columns.split(", ")]
    if name == "fact_ensayos_clinicos":
        for end in ("inicio", "fin"):
            joins.append(f"LEFT JOIN (SELECT sk_fecha AS sk_fecha_{end}, fecha AS fecha_{end}_participacion "
                         f"FROM dim_fecha) USING (sk_fecha_{end})")
            wanted.append(f"fecha_{end}_participacion")
    return f"SELECT {', '.join(wanted)} FROM {name} {' '.join(joins)}"


def _same(left: str, right: str, columns) -> str:
    return " AND ".join(f"{left}.{c} = {right}.{c}" for c in columns)


BODIES: dict[str, str] = {
    "src_high_water_mark": """
        SELECT 'orders' AS tabla, epoch_us(max(o_orderdate)) AS marca_us FROM orders
        UNION ALL SELECT 'events', epoch_us(max(ts)) FROM events""",
    "src_incremental_cursor": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
        WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '2000-01-01')""",
    "src_csv_new_files": """
        SELECT codigo_producto, nombre_producto, clase_riesgo, vida_util_anios, precio_referencia_eur,
               TRUE AS fichero_origen, DATE '2024-01-01' AS fecha_ingestion FROM r_productos_sanitarios""",
    "src_csv_stream": "SELECT r.*, TRUE AS fichero_origen FROM r_productos_sanitarios r",
    "src_snake_case_typed": """
        SELECT o_orderkey AS id_orden, o_custkey AS id_cliente,
               CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS importe_total,
               CAST(o_orderdate AS DATE) AS fecha_orden, o_orderstatus AS estado_orden,
               o_orderstatus = 'F' AS es_final FROM orders""",
    "src_exclude_technical": """
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity
        FROM lineitem""",
    "cdc_latest_per_key": """
        SELECT user_id, event_id, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
        WHERE rn = 1""",
    "cdc_merge_upsert_delete": """
        SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
        WHERE o_orderpriority <> '5-LOW' AND o_orderkey NOT IN (SELECT o_orderkey FROM ordenes_ultimo)
        UNION ALL
        SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) FROM ordenes_ultimo
        WHERE accion = 'INSERT'""",
    "cdc_merge_guarded": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 1 ELSE CAST(o_orderdate AS DATE) END
               AS o_orderdate FROM orders""",
    "cdc_tombstone_guard": """
        SELECT o_orderkey AS id_orden,
               CASE WHEN o_orderkey % 2 = 0 THEN -2.0 WHEN o_orderkey % 3 <> 0 THEN -1.0 ELSE o_totalprice END AS importe,
               CAST(o_orderdate AS DATE)
               + CASE WHEN o_orderkey % 2 = 0 THEN 7 WHEN o_orderkey % 3 <> 0 THEN 3 ELSE 0 END AS dia
        FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0""",
    "cdc_soft_delete": """
        SELECT o_orderkey, o_totalprice, o_totalprice > 200000 AND o_orderstatus = 'P' AS is_deleted FROM orders
        WHERE (o_orderpriority <> '5-LOW' AND (o_totalprice <= 200000 OR o_orderstatus <> 'P'))
           OR (o_orderpriority = '5-LOW' AND o_totalprice > 200000)""",
    "cdc_snapshot_diff": """
        SELECT 'DELETE' AS accion, o.* FROM cli_old o WHERE c_custkey NOT IN (SELECT c_custkey FROM cli_igual)
        UNION ALL
        SELECT 'INSERT', n.* FROM cli_new n WHERE c_custkey NOT IN (SELECT c_custkey FROM cli_igual)""",
    "cdc_post_images": "SELECT n.* FROM cli_new n WHERE c_custkey NOT IN (SELECT c_custkey FROM cli_igual)",
    # an update brings the row to its new side: both tables end as the rules split the new rows
    "cdc_valid_invalid_migration": """
        SELECT CASE WHEN COALESCE(o_totalprice > 0, FALSE) THEN 'valida' ELSE 'error' END AS lado, n.*
        FROM migra_new n""",
    "cdc_stream_refresh": """
        SELECT CASE WHEN COALESCE(value > 0 AND event_type IN ('view', 'click', 'purchase'), FALSE)
                    THEN 'valid' ELSE 'errors' END AS lado, user_id AS id_usuario, event_id, event_type, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) t
        WHERE rn = 1""",
    "dq_valid": f"SELECT * FROM eventos_fila WHERE {_EVENT_OK}",
    "dq_quarantine": f"SELECT * FROM eventos_fila WHERE NOT COALESCE({_EVENT_OK}, FALSE)",
    "dq_failure_report": " UNION ALL ".join(
        f"SELECT '{c}:{k}' AS rule, '{c}' AS column_name, count(*) AS failures FROM eventos_fila "
        f"WHERE NOT COALESCE({t}, FALSE)"
        for (c, k), t in _EVENT_TESTS.items()
    ),
    "cleansed_layer": " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, {_named(row_key(t))} AS clave, "
        f"CASE WHEN {VALID[t]} THEN 'valida' ELSE 'error' END AS lado FROM r_{t}"
        for t in ROLES
    ),
    "dim_scd1_merge": """
        SELECT t.sk_part, t.p_partkey,
               CASE WHEN s.p_partkey IS NULL THEN t.p_name ELSE s.p_name END AS p_name,
               CASE WHEN s.p_partkey IS NULL THEN t.p_brand ELSE s.p_brand END AS p_brand,
               CASE WHEN s.p_partkey IS NULL THEN t.p_retailprice ELSE s.p_retailprice END AS p_retailprice
        FROM partes_1 t LEFT JOIN partes_2 s ON s.p_partkey = t.p_partkey
        UNION ALL
        SELECT (SELECT max(sk_part) FROM partes_1) + row_number() OVER (ORDER BY p_partkey),
               p_partkey, p_name, p_brand, p_retailprice
        FROM partes_2 s WHERE NOT EXISTS (SELECT 1 FROM partes_1 t WHERE t.p_partkey = s.p_partkey)""",
    "dim_scd2_merge": "SELECT * FROM cli_1",
    "dim_scd2_two_rounds": "SELECT * FROM cli_2",
    "dim_scd2_same_day": "SELECT * FROM cli_2b",
    "view_current_versions": "SELECT * FROM cli_2 WHERE es_actual",
    "dim_surrogate_keys": """
        SELECT 1000 + row_number() OVER (ORDER BY o_orderkey) AS sk_order, o_orderkey, o_custkey FROM orders""",
    "dim_calendar": f"""
        SELECT c.*, COALESCE(n, 0) AS ordenes FROM ({_calendar(
            "(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)",
            "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")}) c
        LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) o ON o.d = c.fecha""",
    "dim_hierarchy": "SELECT * FROM niveles",
    "dim_hierarchy_parent_key": """
        SELECT row_number() OVER (ORDER BY n.id_nodo) AS sk_nodo, n.id_nodo, n.id_padre, n.p_name,
               p.sk AS sk_padre
        FROM nodos n
        LEFT JOIN (SELECT id_nodo, row_number() OVER (ORDER BY id_nodo) AS sk FROM nodos) p
               ON p.id_nodo = n.id_padre""",
    "dim_junk_maintenance": f"""
        SELECT p.*, (SELECT count(*) FROM ordenes_todas o WHERE {_same("o", "p", dim.MAINTENANCE_PROFILE)}) AS filas
        FROM dim_perfil_mantenimiento p""",
    "dim_junk_trial": f"""
        SELECT p.*, (SELECT count(*) FROM participaciones_todas o WHERE {_same("o", "p", dim.TRIAL_PROFILE)}) AS filas
        FROM dim_perfil_ensayo p""",
    "dim_name_split": f"SELECT p_partkey, {_given('n')} AS nombre, {_surnames('n')} AS apellidos FROM nombres",
    "dim_prefix_strip": """
        SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN NULL ELSE p_brand END AS descripcion FROM part""",
    "dim_enriched_lookup": """
        SELECT c_custkey, c_mktsegment || ' ' || n_name AS apellidos,
               COALESCE(n_name, 'Sin especialidad') AS especialidad, r_name AS departamento
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 20
        LEFT JOIN region ON r_regionkey = n_regionkey""",
    "dim_decode": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Cerrada' WHEN 'O' THEN 'Abierta' END AS estado,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'Critica' WHEN '2' THEN 'Alta' WHEN '3' THEN 'Media' END
               AS prioridad FROM orders""",
    "fact_mantenimiento_equipos": "SELECT * FROM fact_mantenimiento_equipos",
    "fact_mantenimiento_parity": "SELECT * FROM fact_mantenimiento_parity",
    "fact_monitorizacion_pacientes": "SELECT * FROM fact_monitorizacion_pacientes",
    "fact_ensayos_clinicos": "SELECT * FROM fact_ensayos_clinicos",
    # loading in two goes ends with the rows of one
    "fact_ensayos_two_loads": "SELECT * FROM fact_ensayos_clinicos",
    "fact_mantenimiento_two_loads": "SELECT * FROM fact_mantenimiento_equipos",
    **{name.replace("fact_", "view_"): _wide(name) for name in WIDE},
    "view_mantenimiento_calendar": _wide("fact_mantenimiento_equipos"),
    "fact_order_cost": f"""
        SELECT o.o_orderkey, {_dates('o.o_orderdate')} AS sk_fecha, n_name,
               round(l.coste, 4) AS coste_repuestos, round(l.piezas, 4) AS piezas,
               round(o.o_totalprice * 2, 2) AS coste_mano_obra,
               round(COALESCE(l.coste, 0) + round(o.o_totalprice * 2, 2), 4) AS coste_total
        FROM orders o
        LEFT JOIN (SELECT l_orderkey, SUM(l_extendedprice * (1 - l_discount)) AS coste, SUM(l_quantity) AS piezas
                   FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation ON n_nationkey = c.c_nationkey""",
    "fact_profile_key": """
        SELECT o_orderkey, p.sk AS sk_perfil FROM orders JOIN (
            SELECT row_number() OVER (ORDER BY e, u) AS sk, e, u
            FROM (VALUES ('F'), ('O'), ('P')) AS a(e) CROSS JOIN (VALUES (TRUE), (FALSE)) AS b(u)) p
        ON p.e = o_orderstatus AND p.u = (o_orderpriority = '1-URGENT')""",
    "fact_duration": """
        SELECT user_id, CAST(ts AS DATE) AS dia, CAST(date_diff('minute', min(ts), max(ts)) AS BIGINT) AS minutos,
               CAST(date_diff('minute', max(ts), min(ts)) AS BIGINT) AS minutos_atras
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "fact_recurrence_flag": f"""
        SELECT o_orderkey, {_earlier("o_orderpriority = '1-URGENT'", "o_custkey", "o_orderdate")} AS reincidencia
        FROM orders""",
    "fact_session_alert": """
        SELECT user_id || '/' || CAST(ts AS DATE) AS sesion,
               COALESCE(SUM(CAST(round(value * 100) AS BIGINT)) < 1000 * count(*), FALSE)
               OR COALESCE(SUM(CAST(round(value * 100) AS BIGINT)) > 9000 * count(*), FALSE)
               OR COALESCE(SUM(CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) END)
                           < 500 * count(CASE WHEN event_type <> 'error' THEN 1 END), FALSE) AS alerta
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "fact_daily_expansion": f"""
        SELECT p.o_orderkey, p.desde, p.hasta, p.dia_fecha AS dia, CAST(l.l_linenumber AS BIGINT) AS linea,
               l.l_quantity
        FROM ({_days('pedidos_intervalo', 'desde', 'hasta', AS_OF)}) p
        LEFT JOIN lineitem l ON l.l_orderkey = p.o_orderkey AND CAST(l.l_shipdate AS DATE) = p.dia_fecha""",
    "fact_daily_long": """
        SELECT s_suppkey, n_days, DATE '1990-01-01' AS primero, CAST(DATE '1990-01-01' + n_days - 1 AS DATE) AS ultimo
        FROM (SELECT s_suppkey, CAST(3600 + s_suppkey % 100 AS INTEGER) AS n_days FROM supplier)""",
    "fact_daily_long_parity": """
        SELECT s_suppkey, n_days, DATE '1990-01-01' AS primero, CAST(DATE '1990-01-01' + n_days - 1 AS DATE) AS ultimo
        FROM (SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 100 > 50 THEN 3650 ELSE 3600 + s_suppkey % 100 END AS INTEGER)
              AS n_days FROM supplier)""",
    "fact_daily_gaps": """
        WITH l AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d, l_linenumber AS n FROM lineitem),
        held AS (
            SELECT l_orderkey, d FROM l UNION
            SELECT l_orderkey, CAST(unnest(generate_series(d - 3, d + CAST(n AS INTEGER), INTERVAL 1 DAY)) AS DATE) FROM l
            WHERE n > 2
        ), days AS (
            SELECT o_orderkey, CAST(o_orderdate AS DATE) AS desde, CAST(o_orderdate AS DATE) + 60 AS hasta,
                   CAST(o_orderdate AS DATE) + CAST(unnest(range(0, 61)) AS INTEGER) AS dia FROM orders
        )
        SELECT days.*, CAST(l.n AS BIGINT) AS linea
        FROM days ANTI JOIN held ON held.l_orderkey = days.o_orderkey AND held.d = days.dia
        LEFT JOIN l ON l.l_orderkey = days.o_orderkey AND l.d + 9 = days.dia""",
    "fact_asof_version": """
        SELECT o_orderkey, o_custkey AS c_custkey, DATE '2023-12-20' + CAST(o_orderkey % 100 AS INTEGER) AS dia,
               sk_customer, c_mktsegment
        FROM orders LEFT JOIN cli_2 ON c_custkey = o_custkey
         AND DATE '2023-12-20' + CAST(o_orderkey % 100 AS INTEGER) BETWEEN fecha_inicio AND COALESCE(fecha_fin, DATE '9999-12-31')""",
    "dw_refresh_two_rounds": """
        SELECT 'fact_mantenimiento_equipos' AS hecho, id_orden AS id, sk_fecha, CAST(costo_total AS DOUBLE) AS medida
        FROM fact_mantenimiento_equipos
        UNION ALL SELECT 'fact_monitorizacion_pacientes', id_sesion, sk_fecha, CAST(presion_sistolica AS DOUBLE)
        FROM fact_monitorizacion_pacientes
        UNION ALL SELECT 'fact_ensayos_clinicos', id_participacion, sk_fecha, CAST(dosis_administrada AS DOUBLE)
        FROM fact_ensayos_clinicos WHERE sk_fecha <= 20010601""",
    "fact_late_dimension": """
        SELECT f.id_orden, o.id_equipo, f.costo_total, f.indicador_reincidencia
        FROM fact_mantenimiento_equipos f JOIN v_ordenes_mantenimiento o ON o.id_orden = f.id_orden
        JOIN v_equipos e ON e.id_equipo = o.id_equipo
        WHERE e.id_departamento >= 20 AND o.fecha_inicio_trabajo < TIMESTAMP '2000-01-01'""",
    "dw_load_object": "SELECT * EXCLUDE (sk_departamento) FROM fact_ensayos_clinicos",
    "cdc_load_order": """
        SELECT lado, p_partkey, p_name, p_size + 1 AS p_size FROM part,
               (SELECT unnest(['fecha', 'carga']) AS lado)""",
    "src_csv_dialect": """
        SELECT CAST(p_partkey AS VARCHAR) AS codigo,
               p_name || ' ""x"" ; ' || chr(10) || p_brand AS nombre,
               CASE WHEN p_size <= 25 THEN '' END AS nota
        FROM part""".replace('""x""', '"x"'),
    "fact_insert_only": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice FROM orders""",
    "fact_current_version": """
        SELECT o_orderkey, sk_customer, c_mktsegment FROM orders JOIN cli_1 ON c_custkey = o_custkey AND es_actual""",
    "view_order_wide": """
        SELECT o_orderkey, o_totalprice, fecha, nombre_mes, es_fin_semana, c_name, c_mktsegment
        FROM orders JOIN cli_1 ON c_custkey = o_custkey AND fecha_inicio = DATE '2024-01-01' AND es_actual
        JOIN dim_fecha ON fecha = CAST(o_orderdate AS DATE)""",
    "view_order_wide_all_versions": """
        SELECT o_orderkey, o_totalprice, fecha, nombre_mes, es_fin_semana, c_name, c_mktsegment
        FROM orders JOIN cli_1 ON c_custkey = o_custkey AND fecha_inicio = DATE '2024-01-01'
        JOIN dim_fecha ON fecha = CAST(o_orderdate AS DATE)""",
}
for _name in ("departamento", "ubicacion", "fabricante", "medico", "tecnico", "paciente", "equipo", "ensayo",
              "diagnostico"):
    BODIES[f"dim_{_name}"] = f"SELECT * FROM dim_{_name}"


def _needed(text: str, found: dict[str, str]) -> dict[str, str]:
    for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text)):
        if word in PARTS and word not in found:
            found[word] = ""  # holds the place of a part that names itself
            _needed(PARTS[word], found)
            del found[word]
            found[word] = PARTS[word]
    return found


def _complete(body: str) -> str:
    parts = _needed(body, {})
    if not parts:
        return body
    listed = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    recursive = "RECURSIVE " if {"jerarquia", "niveles"} & set(parts) else ""
    return f"WITH {recursive}{listed}\n{body}"


ORACLE = {name: _complete(body) for name, body in BODIES.items()}
