"""DuckDB SQL for the registered queries, written against the raw tables.

Common table expressions rebuild each role; ``_sql`` adds the ones a statement needs.  Ratios are computed with
integers, so rounding does not depend on floating point.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from starloom.operators.calendar import DAY_NAMES, DAY_SHORT_NAMES, MONTH_NAMES, MONTH_SHORT_NAMES
from starloom.schemas import (
    CONTRACT_STATES, FOREIGN_KEYS, MAX_LENGTHS, NULLABLE, PRIMARY_KEYS, PRODUCT_TYPES, RATING_LABELS, SOURCE_COLUMNS, YES_NO,
)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _label(code: str) -> str:
    return f"({_list(RATING_LABELS.values())})[{code}]"


def _ratio(top: str, bottom: str, digits: int, scale: int = 1) -> str:
    """top / bottom * scale rounded half away from zero, with integer arithmetic; NULL for a zero denominator."""
    unit = 10 ** digits
    a, b = f"CAST({top} AS HUGEINT)", f"CAST(NULLIF({bottom}, 0) AS HUGEINT)"
    whole = f"((2 * abs({a}) * {scale * unit} + {b}) // (2 * {b}))"
    return f"CAST(sign({a}) * {whole} AS DOUBLE) / {unit}"


CTES = {
    "anios": """SELECT least(o.lo, s.lo) AS lo, greatest(o.hi, s.hi) AS hi, o.lo AS olo, o.hi AS ohi, o.until AS until FROM
        (SELECT year(min(o_orderdate)) AS lo, year(max(o_orderdate)) AS hi, CAST(max(o_orderdate) AS DATE) AS until FROM orders) o,
        (SELECT year(min(l_shipdate)) AS lo, year(max(l_shipdate)) AS hi FROM lineitem) s""",
    "dias": """SELECT CAST(unnest(generate_series(CAST(make_date(lo, 1, 1) AS TIMESTAMP), CAST(make_date(hi, 12, 31) AS TIMESTAMP),
        INTERVAL 1 DAY)) AS DATE) AS d FROM anios""",
    "calendario": f"""SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS sk_dim_tiempo,
        CAST(year(d) AS BIGINT) AS cod_annio, CAST(month(d) AS BIGINT) AS cod_mes, CAST(dayofyear(d) AS BIGINT) AS cod_dia_annio,
        CAST(day(d) AS BIGINT) AS cod_dia_mes, CAST(dayofweek(d) + 1 AS BIGINT) AS cod_dia_semana, CAST(week(d) AS BIGINT) AS cod_semana,
        {_list(DAY_NAMES)}[dayofweek(d) + 1] AS desc_dia_semana, {_list(DAY_SHORT_NAMES)}[dayofweek(d) + 1] AS desc_dia_semana_corta,
        {_list(MONTH_NAMES)}[month(d)] AS desc_mes, {_list(MONTH_SHORT_NAMES)}[month(d)] AS desc_mes_corta,
        'Q' || quarter(d) AS desc_trimestre, CASE WHEN month(d) <= 6 THEN 'S1' ELSE 'S2' END AS desc_semestre,
        CAST(d AS VARCHAR) AS fecha_completa FROM dias""",
    "pais": "SELECT r_regionkey AS cod_pais, r_name AS nb_pais FROM region",
    "ciudad": "SELECT n_nationkey AS cod_ciudad, n_name AS nb_ciudad, n_regionkey AS cod_pais FROM nation",
    "sucursal": "SELECT s_suppkey AS cod_sucursal, s_name AS nb_sucursal, s_nationkey AS cod_ciudad FROM supplier",
    "tipo_producto": """SELECT p_type AS nb_tipo_producto, row_number() OVER (ORDER BY p_type) AS cod_tipo_producto
        FROM (SELECT DISTINCT p_type FROM part)""",
    "producto": """SELECT p_partkey AS cod_producto, p_name AS nb_producto, p_brand AS descripcion,
        CAST(p_size % 5 + 1 AS DECIMAL(3,2)) AS calificacion, cod_tipo_producto, nb_tipo_producto
        FROM part JOIN tipo_producto ON p_type = nb_tipo_producto""",
    "cliente": """SELECT c_custkey AS cod_cliente, c_name AS nb_cliente, 'C-' || c_custkey AS ci_rif,
        CASE WHEN c_acctbal >= 0 THEN '555-' || c_custkey END AS telefono, c_mktsegment AS direccion,
        CASE WHEN c_acctbal >= 5000 THEN 'M' ELSE 'F' END AS sexo, lower(c_mktsegment) || '@example.org' AS email,
        c_custkey % (SELECT count(*) FROM supplier) AS cod_sucursal FROM customer""",
    "evaluacion_servicio": f"""SELECT c AS cod_evaluacion_servicio, {_label('c')} AS nb_descripcion
        FROM (SELECT DISTINCT CAST(event_id % 5 + 1 AS INTEGER) AS c FROM events)""",
    "contrato": "SELECT o_orderkey AS nro_contrato, 'Order ' || o_orderkey || ' ' || o_orderpriority AS descrip_contrato FROM orders",
    "siniestro": """SELECT n AS nro_siniestro, 'Claim ' || n AS descripcion_siniestro
        FROM (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS n FROM lineitem WHERE l_returnflag <> 'N')""",
    "registro_contrato": """SELECT l_orderkey AS nro_contrato, l_partkey AS cod_producto, o_custkey AS cod_cliente,
        CAST(o_orderdate AS DATE) AS fecha_inicio, CAST(l_shipdate AS DATE) AS fecha_fin, CAST(l_extendedprice AS DECIMAL(18,2)) AS monto,
        CASE o_orderstatus WHEN 'O' THEN 'Activo' WHEN 'F' THEN 'VENCIDO' ELSE 'suspendido' END AS estado_contrato
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "registro_siniestro": """SELECT l_orderkey * 10 + l_linenumber AS nro_siniestro, l_orderkey AS nro_contrato,
        CAST(o_orderdate AS DATE) AS fecha_siniestro, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS fecha_respuesta,
        CASE WHEN l_returnflag = 'R' THEN 'SI' ELSE 'NO' END AS id_rechazo,
        CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DECIMAL(18,2))
             ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END END AS monto_reconocido,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS monto_solicitado
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'N'""",
    "recomienda": """SELECT user_id AS cod_cliente, CAST(event_id % 5 + 1 AS INTEGER) AS cod_evaluacion_servicio,
        event_id % (SELECT count(*) FROM part) AS cod_producto,
        CASE WHEN event_type IN ('purchase', 'click') THEN 'SI' WHEN event_type = 'error' THEN NULL ELSE 'NO' END AS recomienda_amigo
        FROM events""",
    "metas": """SELECT anio, p_partkey AS cod_producto, CAST(CAST(p_retailprice AS DECIMAL(18,2)) * (anio - olo + 1) AS DECIMAL(18,2))
        AS monto_meta_ingreso, p_size AS meta_renovacion, p_size * 2 AS meta_asegurados
        FROM part, (SELECT unnest(generate_series(olo, ohi)) AS anio, olo FROM anios)""",
    "lineas": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY nro_contrato, cod_producto, cod_cliente
        ORDER BY fecha_inicio DESC NULLS LAST, fecha_fin DESC NULLS LAST, monto DESC NULLS LAST, estado_contrato DESC NULLS LAST) AS rn
        FROM registro_contrato) WHERE rn = 1""",
    "ultima": """SELECT * EXCLUDE (rn) FROM (SELECT nro_contrato, r.cod_cliente, cod_producto, cod_sucursal, row_number() OVER
        (PARTITION BY nro_contrato ORDER BY r.cod_cliente DESC, cod_producto DESC) AS rn
        FROM registro_contrato r JOIN cliente c ON c.cod_cliente = r.cod_cliente) WHERE rn = 1""",
    "reclamos": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY nro_siniestro, nro_contrato
        ORDER BY fecha_siniestro DESC NULLS LAST, fecha_respuesta DESC NULLS LAST, id_rechazo DESC NULLS LAST,
        monto_reconocido DESC NULLS LAST, monto_solicitado DESC NULLS LAST) AS rn FROM registro_siniestro) WHERE rn = 1""",
    "reclamos_con": """SELECT r.*, u.cod_cliente, u.cod_sucursal, u.cod_producto FROM reclamos r JOIN ultima u ON u.nro_contrato = r.nro_contrato""",
    "pares": "SELECT cod_cliente, cod_producto, max(fecha_fin) AS fecha_eval FROM registro_contrato GROUP BY cod_cliente, cod_producto",
    "votos": """SELECT v.*, p.fecha_eval FROM (SELECT *, row_number() OVER (PARTITION BY cod_cliente, cod_producto
        ORDER BY cod_evaluacion_servicio DESC, recomienda_amigo DESC NULLS LAST) AS rn FROM recomienda) v
        JOIN pares p ON p.cod_cliente = v.cod_cliente AND p.cod_producto = v.cod_producto WHERE rn = 1""",
    "d_cli": "SELECT row_number() OVER (ORDER BY cod_cliente) AS sk, * FROM cliente",
    "d_pro": "SELECT row_number() OVER (ORDER BY cod_producto) AS sk, * FROM producto",
    "d_con": "SELECT row_number() OVER (ORDER BY nro_contrato) AS sk, * FROM contrato",
    "d_suc": "SELECT row_number() OVER (ORDER BY cod_sucursal) AS sk, * FROM sucursal",
    "d_sin": "SELECT row_number() OVER (ORDER BY nro_siniestro) AS sk, * FROM siniestro",
    "d_eva": "SELECT row_number() OVER (ORDER BY cod_evaluacion_servicio) AS sk, * FROM evaluacion_servicio",
    "d_est": "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}', '{d}')" for i, (c, d) in enumerate(CONTRACT_STATES, 1))
             + ") v(sk, cod_estado, descrip_estado)",
    "f_con": """SELECT CAST(year(fecha_inicio) * 10000 + month(fecha_inicio) * 100 + day(fecha_inicio) AS BIGINT) AS ini,
        CAST(year(fecha_fin) * 10000 + month(fecha_fin) * 100 + day(fecha_fin) AS BIGINT) AS fin,
        c.sk AS cli, k.sk AS con, p.sk AS pro, e.sk AS est, s.sk AS suc, l.monto, l.nro_contrato, l.cod_producto, l.cod_cliente,
        c.nb_cliente, p.nb_producto, p.nb_tipo_producto, s.nb_sucursal, e.descrip_estado, year(fecha_inicio) AS anio
        FROM lineas l JOIN d_cli c ON c.cod_cliente = l.cod_cliente JOIN d_con k ON k.nro_contrato = l.nro_contrato
        JOIN d_pro p ON p.cod_producto = l.cod_producto JOIN d_est e ON e.cod_estado = upper(l.estado_contrato)
        JOIN d_suc s ON s.cod_sucursal = c.cod_sucursal""",
    "f_sin": """SELECT year(fecha_siniestro) * 10000 + month(fecha_siniestro) * 100 + day(fecha_siniestro) AS ini,
        year(fecha_respuesta) * 10000 + month(fecha_respuesta) * 100 + day(fecha_respuesta) AS fin,
        c.sk AS cli, k.sk AS con, s.sk AS suc, p.sk AS pro, n.sk AS sin, r.*, c.nb_cliente, p.nb_producto
        FROM reclamos_con r JOIN d_cli c ON c.cod_cliente = r.cod_cliente JOIN d_con k ON k.nro_contrato = r.nro_contrato
        JOIN d_suc s ON s.cod_sucursal = r.cod_sucursal JOIN d_pro p ON p.cod_producto = r.cod_producto
        JOIN d_sin n ON n.nro_siniestro = r.nro_siniestro""",
    "f_eva": """SELECT year(fecha_eval) * 10000 + month(fecha_eval) * 100 + day(fecha_eval) AS dia, c.sk AS cli, p.sk AS pro, e.sk AS eva,
        CASE WHEN upper(recomienda_amigo) = 'SI' THEN 1 ELSE 0 END AS reco, v.cod_evaluacion_servicio, e.nb_descripcion,
        c.nb_cliente, p.nb_producto, v.cod_cliente, v.cod_producto
        FROM votos v JOIN d_cli c ON c.cod_cliente = v.cod_cliente JOIN d_pro p ON p.cod_producto = v.cod_producto
        JOIN d_eva e ON e.cod_evaluacion_servicio = v.cod_evaluacion_servicio""",
    "f_met": """SELECT m.*, p.sk AS pro, p.nb_producto FROM metas m JOIN d_pro p ON p.cod_producto = m.cod_producto""",
}

# The source after the change batch: the same tables with rows replaced and added; everything else follows from them.
_NEW = "-n_nationkey - 1"
_DAY = lambda month, day: f"make_date((SELECT ohi FROM anios), {month}, {day})"
_PRODUCT, _BRANCH = "(SELECT min(p_partkey) FROM part)", "(SELECT min(s_suppkey) FROM supplier)"
_AFTER = {
    "cliente": f"""{CTES['cliente']} UNION ALL SELECT {_NEW}, 'Client of ' || n_name, 'N' || ({_NEW}), NULL, n_name, 'F',
        lower(n_name || '@example.org'), {_BRANCH} FROM nation""",
    "contrato": f"{CTES['contrato']} UNION ALL SELECT {_NEW}, n_name FROM nation",
    "siniestro": f"{CTES['siniestro']} UNION ALL SELECT {_NEW}, n_name FROM nation",
    "registro_contrato": f"""SELECT * REPLACE (CASE estado_contrato WHEN 'suspendido' THEN 'VENCIDO' ELSE estado_contrato END AS estado_contrato,
        CAST(CASE estado_contrato WHEN 'suspendido' THEN monto + 100 ELSE monto END AS DECIMAL(18,2)) AS monto) FROM ({CTES['registro_contrato']})
        UNION ALL SELECT {_NEW}, {_PRODUCT}, {_NEW}, {_DAY(1, 2)}, {_DAY(12, 30)}, CAST(1000 + n_nationkey AS DECIMAL(18,2)), 'Activo'
        FROM nation, anios""",
    "registro_siniestro": f"""SELECT * EXCLUDE (abierto) REPLACE (coalesce(fecha_respuesta, fecha_siniestro + 30) AS fecha_respuesta,
        CASE WHEN fecha_respuesta IS NULL THEN 'NO' ELSE id_rechazo END AS id_rechazo,
        CASE WHEN fecha_respuesta IS NULL THEN monto_solicitado ELSE monto_reconocido END AS monto_reconocido)
        FROM (SELECT *, bool_or(fecha_respuesta IS NULL) OVER (PARTITION BY nro_siniestro, nro_contrato) AS abierto
              FROM ({CTES['registro_siniestro']})) WHERE fecha_respuesta IS NULL OR NOT abierto
        UNION ALL SELECT {_NEW}, {_NEW}, {_DAY(6, 1)}, {_DAY(6, 15)}, 'SI', CAST(0 AS DECIMAL(18,2)), CAST(500 AS DECIMAL(18,2)) FROM nation, anios""",
    "recomienda": f"{CTES['recomienda']} UNION ALL SELECT {_NEW}, 5, {_PRODUCT}, 'SI' FROM nation",
}
# The source with misses: an unknown state, days a century before, an unknown rating.
_PLANTED = {
    "registro_contrato": f"""SELECT * REPLACE (CASE estado_contrato WHEN 'suspendido' THEN 'anulado' ELSE estado_contrato END AS estado_contrato)
        FROM ({CTES['registro_contrato']})""",
    "registro_siniestro": f"""SELECT * REPLACE (CASE WHEN fecha_respuesta IS NULL THEN CAST(fecha_siniestro - INTERVAL 1200 MONTH AS DATE)
        ELSE fecha_siniestro END AS fecha_siniestro) FROM ({CTES['registro_siniestro']})""",
    "recomienda": f"""SELECT * REPLACE (CASE WHEN recomienda_amigo IS NULL THEN 9 ELSE cod_evaluacion_servicio END AS cod_evaluacion_servicio)
        FROM ({CTES['recomienda']})""",
}
_BEFORE = dict(CTES)


@contextmanager
def _source_with(changed: dict[str, str] = _AFTER):
    """Statements built inside are about a changed source, by default the one after the change batch."""
    CTES.update(changed)
    try:
        yield
    finally:
        CTES.update(_BEFORE)


_TYPES = {"l": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}


def _sql(body: str) -> str:
    """The statement with every table expression it refers to, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        words = set(re.findall(r"\b[a-z_]+\b", text))
        for name in CTES:
            if name in words and name not in order and name != "":
                if re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                    need(CTES[name])
                    if name not in order:
                        order.append(name)

    need(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body


def _typed(columns: str, body: str) -> str:
    """Cast ``name=expression:type`` items (expression defaults to the name) of a FROM/WHERE body."""
    items = []
    for item in [c.strip() for c in columns.split(";") if c.strip()]:
        head, kind = item.rsplit(":", 1)
        name, _, expr = head.partition("=")
        items.append(f"CAST({expr or name} AS {_TYPES[kind]}) AS {name}")
    return _sql("SELECT " + ", ".join(items) + " " + body)


_CONTRACT_FACT = ("sk_dim_tiempo_fecha_inicio=ini:l; sk_dim_tiempo_fecha_fin=fin:l; sk_dim_cliente=cli:l; sk_dim_contrato=con:l;"
                  " sk_dim_producto=pro:l; sk_dim_estado_contrato=est:l; sk_dim_sucursal=suc:l; monto:d; cantidad=1:l;"
                  " cantidad_cliente=1:l; cantidad_producto=1:l; cantidad_contrato=1:l")
_RATING_FACT = ("sk_dim_tiempo_evaluacion=dia:l; sk_dim_cliente=cli:l; sk_dim_producto=pro:l; sk_dim_evaluacion_servicio=eva:l;"
                " cantidad=1:l; recomienda_amigo=reco:d")
_GOAL_FACT = ("sk_dim_fecha_inicio_meta=anio * 10000 + 101:l; sk_dim_fecha_fin_meta=anio * 10000 + 1231:l; sk_dim_producto=pro:l;"
              " monto_meta_ingreso:d; meta_renovacion:l; meta_asegurados:l")


def _scd1(cte: str, natural: str, source: str, out_key: str, out_natural: str, attributes: dict[str, str]) -> str:
    """Old state with doubled natural keys, upserted from the present source."""
    kinds = {out_natural: "l", out_key: "l", **{n: e.rsplit(":", 1)[1] for n, e in attributes.items()}}
    cols = ", ".join(f"{e.rsplit(':', 1)[0]} AS {n}" for n, e in attributes.items())
    picks = ", ".join(f"CASE WHEN s.nk IS NOT NULL THEN s.{n} ELSE t.{n} END AS {n}" for n in attributes)
    new = ", ".join(f"s.{n}" for n in attributes)
    body = f"""FROM (
      SELECT t.sk AS {out_key}, t.nk AS {out_natural}, {picks} FROM viejo t LEFT JOIN nuevo s ON s.nk = t.nk
      UNION ALL
      SELECT (SELECT max(sk) FROM viejo) + row_number() OVER (ORDER BY s.nk), s.nk, {new}
      FROM nuevo s WHERE NOT EXISTS (SELECT 1 FROM viejo t WHERE t.nk = s.nk))"""
    head = "; ".join(f"{n}:{k}" for n, k in kinds.items())
    statement = _typed(head, body)
    base = _sql(f"SELECT 1 FROM {cte}")
    prefix = base[: base.rindex("SELECT 1 FROM")] if base.startswith("WITH") else "WITH "
    prefix = prefix.rstrip()
    prefix += "" if prefix == "WITH" else ","
    return (f"{prefix} nuevo AS (SELECT {natural} AS nk, {cols} FROM {source}),\n"
            f"viejo AS (SELECT row_number() OVER (ORDER BY nk) AS sk, nk * 2 AS nk, * EXCLUDE (nk) FROM nuevo)\n{statement}")


def _violation(rule: str, table: str, key: str, detail: str, body: str, n: str = "1") -> str:
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key, CAST({detail} AS VARCHAR) AS detail,"
            f" CAST({n} AS BIGINT) AS n_rows {body}")


def _key(*columns: str) -> str:
    return " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)


def _unique(table: str, *columns: str, rule: str | None = None) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    group = ", ".join(columns)
    return _violation(rule or f"unique:{','.join(columns)}", table, _key(*columns), "'duplicate'",
                      f"FROM {table} WHERE {present} GROUP BY {group} HAVING count(*) > 1", "count(*)")


def _foreign(table: str, columns: list[str], parent: str) -> str:
    on = " AND ".join(f"p.{c} = t.{c}" for c in columns)
    present = " AND ".join(f"t.{c} IS NOT NULL" for c in columns)
    group = ", ".join(f"t.{c}" for c in columns)
    return _violation(f"foreign_key:{','.join(columns)}", table, _key(*[f"t.{c}" for c in columns]), f"'no {parent}'",
                      f"FROM {table} t WHERE {present} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {on}) GROUP BY {group}", "count(*)")


def _summary(parts: list[str]) -> str:
    union = "\nUNION ALL\n".join(parts)
    return _sql(f"SELECT table_name, rule, count(*) AS n_violations, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM (\n{union}\n) GROUP BY table_name, rule")


def _source_quality() -> str:
    """Every declared constraint of every source table."""
    checks = {
        "tipo_producto": {"domain:nb_tipo_producto": f"upper(nb_tipo_producto) NOT IN {_in(PRODUCT_TYPES)}"},
        "producto": {"range:calificacion": "calificacion NOT BETWEEN 1 AND 5"},
        "cliente": {"domain:sexo": "upper(sexo) NOT IN ('M', 'F')"},
        "evaluacion_servicio": {
            "range:cod_evaluacion_servicio": "cod_evaluacion_servicio NOT BETWEEN 1 AND 5",
            "pair:cod_evaluacion_servicio,nb_descripcion": f"upper(nb_descripcion) <> {_label('cod_evaluacion_servicio')}"},
        "recomienda": {"domain:recomienda_amigo": f"upper(recomienda_amigo) NOT IN {_in(YES_NO)}"},
        "registro_contrato": {
            "domain:estado_contrato": f"upper(estado_contrato) NOT IN {_in(c for c, _ in CONTRACT_STATES)}",
            "order:fecha_inicio,fecha_fin": "fecha_fin < fecha_inicio"},
        "registro_siniestro": {
            "domain:id_rechazo": f"upper(id_rechazo) NOT IN {_in(YES_NO)}",
            "order:fecha_siniestro,fecha_respuesta": "fecha_respuesta < fecha_siniestro"},
    }
    parts = []
    for table, key in PRIMARY_KEYS.items():
        if table == "metas":
            continue
        parts.append(_unique(table, *key))
        for c in SOURCE_COLUMNS[table]:
            if c not in NULLABLE.get(table, set()):
                parts.append(_violation(f"not_null:{c}", table, _key(*key), "'NULL'", f"FROM {table} WHERE {c} IS NULL"))
        for c, n in MAX_LENGTHS.get(table, {}).items():
            parts.append(_violation(f"length:{c}", table, _key(*key), f"length({c})", f"FROM {table} WHERE length({c}) > {n}"))
        for rule, broken in checks.get(table, {}).items():
            parts.append(_violation(rule, table, _key(*key), "''", f"FROM {table} WHERE {broken}"))
        for c, parent in FOREIGN_KEYS.get(table, []):
            parts.append(_foreign(table, [c], parent))
    parts.append(_unique("cliente", "ci_rif"))
    return _summary(parts)


_DIRTY = """sucia AS (SELECT p_partkey || '-' || y AS row_no,
  CASE p_brand WHEN 'Brand#2' THEN 'n/a' WHEN 'Brand#3' THEN CAST(olo - 500 AS VARCHAR) WHEN 'Brand#4' THEN CAST(ohi AS VARCHAR)
       WHEN 'Brand#5' THEN y || '.7' ELSE CAST(y AS VARCHAR) END AS anio,
  CASE p_brand WHEN 'Brand#6' THEN NULL WHEN 'Brand#7' THEN '-' || (p_partkey + 1) ELSE CAST(p_partkey AS VARCHAR) END AS cod_producto,
  CASE WHEN p_size = 1 THEN '-1.00' ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS monto_meta_ingreso,
  CASE WHEN p_size = 2 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS meta_renovacion,
  CAST(p_size - 3 AS VARCHAR) AS meta_asegurados
  FROM part, (SELECT unnest(generate_series(olo, ohi)) AS y, olo, ohi FROM anios)),
tipada AS (SELECT *, CASE WHEN regexp_full_match(anio, '[+-]?[0-9]+') THEN CAST(anio AS INTEGER) END AS t_anio,
  CASE WHEN regexp_full_match(cod_producto, '[+-]?[0-9]+') THEN CAST(cod_producto AS INTEGER) END AS t_prod,
  CAST(monto_meta_ingreso AS DECIMAL(18,2)) AS t_monto, CAST(meta_renovacion AS INTEGER) AS t_reno,
  CAST(meta_asegurados AS INTEGER) AS t_aseg FROM sucia)"""


def _dq_goals() -> str:
    key = _key("row_no", "anio", "cod_producto")
    parts = []
    for c in ["anio", "cod_producto", "monto_meta_ingreso", "meta_renovacion", "meta_asegurados"]:
        parts.append(_violation(f"null:{c}", "metas", key, "'NULL'", f"FROM tipada WHERE {c} IS NULL"))
    parts.append(_violation("type:anio", "metas", key, "anio", "FROM tipada WHERE anio IS NOT NULL AND t_anio IS NULL"))
    parts.append(_violation("range:anio", "metas", key, "anio", "FROM tipada WHERE t_anio < 2000 OR t_anio > 2100"))
    for c, t in [("monto_meta_ingreso", "t_monto"), ("meta_renovacion", "t_reno"), ("meta_asegurados", "t_aseg")]:
        parts.append(_violation(f"negative:{c}", "metas", key, c, f"FROM tipada WHERE {t} < 0"))
    parts.append(_violation("duplicate:anio,cod_producto", "metas", "t_anio || ',' || t_prod", "'duplicate'",
                            "FROM tipada WHERE t_anio IS NOT NULL AND t_prod IS NOT NULL GROUP BY t_anio, t_prod HAVING count(*) > 1", "count(*)"))
    parts.append(_violation("product:cod_producto", "metas", "t_anio || ',' || t_prod", "'no dim_producto'",
                            "FROM tipada WHERE t_anio IS NOT NULL AND t_prod IS NOT NULL AND NOT EXISTS"
                            " (SELECT 1 FROM part WHERE p_partkey = t_prod) GROUP BY t_anio, t_prod", "count(*)"))
    for edge, offset, broken in [("start", 101, "t_anio < olo OR t_anio > ohi"), ("end", 1231, "t_anio < olo OR t_anio >= ohi")]:
        parts.append(_violation(f"calendar:{edge}", "metas", "t_anio", f"'no day ' || (t_anio * 10000 + {offset})",
                                f"FROM tipada, anios WHERE {broken} GROUP BY t_anio", "count(*)"))
    body = _sql("SELECT 1 FROM anios")
    prefix = body[: body.rindex("SELECT 1 FROM")].rstrip()
    return f"{prefix},\n{_DIRTY}\n" + "\nUNION ALL\n".join(parts)


def _dq_domain() -> str:
    return _sql("\nUNION ALL\n".join([
        _violation("range:calificacion", "producto", "cod_producto", "calificacion", "FROM producto WHERE calificacion NOT BETWEEN 2 AND 5"),
        _violation("length:nb_producto", "producto", "cod_producto", "length(nb_producto)", "FROM producto WHERE length(nb_producto) > 10"),
        _violation("domain:descripcion", "producto", "cod_producto", "descripcion",
                   "FROM producto WHERE upper(descripcion) NOT IN ('BRAND#1', 'BRAND#2', 'BRAND#3')"),
        _violation("domain:sexo", "cliente", "cod_cliente", "sexo", "FROM cliente WHERE sexo <> 'm'"),
        _violation("length:telefono", "cliente", "cod_cliente", "length(telefono)", "FROM cliente WHERE length(telefono) > 7"),
    ]))


def _counts(tables: dict[str, str]) -> str:
    return _sql("\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {f}" for n, f in tables.items()))


_TABLES = {
    "dim_tiempo": "dias", "dim_cliente": "cliente", "dim_producto": "producto", "dim_contrato": "contrato", "dim_estado_contrato": "d_est",
    "dim_evaluacion_servicio": "evaluacion_servicio", "dim_sucursal": "sucursal", "dim_siniestro": "siniestro",
    "fact_registro_contrato": "f_con", "fact_registro_siniestro": "f_sin", "fact_evaluacion_servicio": "f_eva", "fact_metas": "f_met",
}

_MERGE_METRICS = f"""SELECT count(*) FILTER (t IS NULL) AS inserted, count(*) FILTER (t IS NOT NULL AND s IS NOT NULL) AS matched,
  count(*) FILTER (t <> s) AS changed, count(*) FILTER (s IS NULL) AS deleted, CAST(0 AS BIGINT) AS kept FROM
  (SELECT con, pro, cli, CASE WHEN est = 3 THEN monto + 1 ELSE monto END AS t FROM f_con, anios WHERE anio < ohi)
  FULL JOIN (SELECT con, pro, cli, monto AS s FROM f_con, anios WHERE anio > olo) USING (con, pro, cli)"""

_RESET = {
    "dim_cliente": "cliente WHERE direccion <> 'MACHINERY'",
    "dim_contrato": "contrato WHERE nro_contrato NOT IN (SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY')",
    "dim_siniestro": """siniestro WHERE nro_siniestro NOT IN (SELECT l_orderkey * 10 + l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY' AND l_returnflag <> 'N')""",
    "fact_registro_contrato": "f_con WHERE cod_cliente NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')",
    "fact_registro_siniestro": """f_sin WHERE nro_siniestro NOT IN (SELECT l_orderkey * 10 + l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY' AND l_returnflag <> 'N')""",
    "fact_evaluacion_servicio": "f_eva WHERE cod_cliente NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')",
}

_CUSTOMER = {"c_acctbal": "CAST(c_acctbal AS DECIMAL(18,2))", "c_custkey": "c_custkey", "c_mktsegment": "c_mktsegment", "c_name": "c_name", "c_nationkey": "c_nationkey"}


def _fingerprint(columns: dict[str, str], table: str) -> str:
    """SHA-256 of names and values, each with its length in front, summed as four numbers of 64 bits."""
    parts = []
    for name, value in sorted(columns.items()):
        text = f"CAST({value} AS VARCHAR)"
        parts.append(f"'{len(name)}:{name}=' || coalesce(length({text}) || ':' || {text}, 'N')")
    row = " || ';' || ".join(parts)
    limbs = [
        f"CAST(coalesce(sum(CAST(CAST('0x' || substring(h, {16 * i + 1}, 16) AS UBIGINT) AS HUGEINT)), 0) AS VARCHAR)" for i in range(4)
    ]
    return f"SELECT count(*) AS n_rows, {" || '-' || ".join(limbs)} AS fingerprint FROM (SELECT sha256({row}) AS h FROM {table})"


_CLIENT_COLUMNS = {"nb_cliente": "nb_cliente:s", "ci_rif": "ci_rif:s", "telefono": "telefono:s", "direccion": "direccion:s", "sexo": "sexo:s", "email": "email:s"}
_BRANCH_SQL = """sucursal su JOIN ciudad ci ON ci.cod_ciudad = su.cod_ciudad JOIN pais pa ON pa.cod_pais = ci.cod_pais"""


def _attainment(where: str) -> str:
    real = "(SELECT pro, anio, sum(monto) AS real FROM f_con GROUP BY pro, anio)"
    return _typed(
        "nb_producto:s; anio=m.anio:l; monto_meta_ingreso:d; monto_real=coalesce(real, 0):d; pct_cumplimiento="
        + _ratio("coalesce(real, 0) * 100", "monto_meta_ingreso * 100", 1, 100) + ":d",
        f"FROM f_met m LEFT JOIN {real} r ON r.pro = m.pro AND r.anio = m.anio {where}")


def _kpis() -> dict[str, str]:
    out: dict[str, str] = {}
    days = "date_diff('day', fecha_siniestro, fecha_respuesta)"
    out["kpi_response_days"] = _typed("dias_promedio_respuesta=" + _ratio(f"sum({days})", "count(*)", 2) + ":d", "FROM f_sin WHERE fecha_respuesta IS NOT NULL")
    out["kpi_contracts_by_state"] = _sql("SELECT descrip_estado, count(*) AS cantidad_contratos FROM f_con GROUP BY descrip_estado")
    out["kpi_claim_rate"] = _typed(
        "nb_producto:s; contratos=coalesce(c.n, 0):l; siniestros=coalesce(s.n, 0):l; tasa_siniestralidad=" + _ratio("coalesce(s.n, 0)", "coalesce(c.n, 0)", 2) + ":d",
        "FROM d_pro p LEFT JOIN (SELECT pro, count(*) AS n FROM f_con GROUP BY pro) c ON c.pro = p.sk"
        " LEFT JOIN (SELECT pro, count(*) AS n FROM f_sin GROUP BY pro) s ON s.pro = p.sk")
    out["kpi_rating_recommend"] = _typed(
        "nb_producto:s; calificacion_promedio=" + _ratio("sum(cod_evaluacion_servicio)", "count(*)", 2) + ":d; pct_recomienda="
        + _ratio("sum(reco)", "count(*)", 1, 100) + ":d", "FROM f_eva GROUP BY nb_producto")
    out["kpi_goal_attainment"] = _attainment("")
    out["kpi_income_by_type"] = _typed("nb_tipo_producto:s; ingreso_total=sum(monto):d", "FROM f_con GROUP BY nb_tipo_producto")
    rejected = "count(*) FILTER (id_rechazo = 'SI')"
    out["kpi_rejected_share"] = _typed(f"rechazados={rejected}:l; total_siniestros=count(*):l; pct_rechazados=" + _ratio(rejected, "count(*)", 1, 100) + ":d", "FROM f_sin")
    out["kpi_amount_by_branch"] = _typed("nb_sucursal:s; monto_total=sum(monto):d", "FROM f_con GROUP BY nb_sucursal")
    return out


def _details() -> dict[str, str]:
    out: dict[str, str] = {}
    out["contract_detail"] = _typed(
        "nb_cliente:s; nro_contrato_nk=nro_contrato:l; nb_producto:s; nb_sucursal:s; descrip_estado:s; fecha_inicio_aaaammdd=ini:l; fecha_fin_aaaammdd=fin:l;"
        " monto:d; cantidad=1:l", "FROM f_con")
    out["contract_no_duplicate"] = _typed("nro_contrato_nk=nro_contrato:l; cod_producto_nk=cod_producto:l; cod_cliente_nk=cod_cliente:l; descrip_estado:s", "FROM f_con")
    out["claim_detail"] = _typed(
        "nro_siniestro_nk=nro_siniestro:l; nro_contrato_nk=nro_contrato:l; nb_cliente:s; nb_producto:s; fecha_siniestro:s; fecha_respuesta:s; id_rechazo:s;"
        " monto_reconocido:d; monto_solicitado:d", "FROM f_sin")
    out["claim_resolved"] = _typed("nro_siniestro_nk=nro_siniestro:l; nro_contrato_nk=nro_contrato:l; fecha_siniestro:s; fecha_respuesta:s; id_rechazo:s;"
                                   " monto_reconocido:d", "FROM f_sin")
    out["evaluation_detail"] = _typed("nb_cliente:s; nb_producto:s; cod_evaluacion_nk=cod_evaluacion_servicio:l; nb_descrip=nb_descripcion:s; recomienda_amigo=reco:d",
                                      "FROM f_eva")
    return out


_KPI_GROUPS = {
    "response_days": [], "contracts_by_state": ["descrip_estado"], "claim_rate": ["nb_producto"], "rating_recommend": ["nb_producto"],
    "goal_attainment": ["nb_producto", "anio"], "income_by_type": ["nb_tipo_producto"], "rejected_share": [], "amount_by_branch": ["nb_sucursal"],
}
_KPI_MEASURES = {
    "response_days": ["dias_promedio_respuesta"], "contracts_by_state": ["cantidad_contratos"],
    "claim_rate": ["contratos", "siniestros", "tasa_siniestralidad"], "rating_recommend": ["calificacion_promedio", "pct_recomienda"],
    "goal_attainment": ["monto_meta_ingreso", "monto_real", "pct_cumplimiento"], "income_by_type": ["ingreso_total"],
    "rejected_share": ["rechazados", "total_siniestros", "pct_rechazados"], "amount_by_branch": ["monto_total"],
}


def _presence(before: str, after: str, keys: str, group: list[str], columns: list[str]) -> str:
    def side(body: str, suffix: str) -> str:
        values = "".join(f", max({c}) AS {c}_{suffix}" for c in columns)
        return f"(SELECT {', '.join(group)}, count(*) AS filas_{suffix}{values} FROM ({body}) GROUP BY {', '.join(group)})"

    picked = ", ".join([f"k.{g}" for g in group] + [f"coalesce(filas_{s}, 0) AS filas_{s}" for s in ("antes", "despues")]
                       + [f"{c}_{s}" for s in ("antes", "despues") for c in columns])
    using = ", ".join(group)
    return (f"SELECT {picked} FROM ({keys}) k LEFT JOIN {side(before, 'antes')} b USING ({using})"
            f" LEFT JOIN {side(after, 'despues')} a USING ({using})")


def _changes() -> dict[str, str]:
    """States and KPIs around the change batch."""
    before_kpis, before_details = _kpis(), _details()
    with _source_with():
        after_kpis, after_details = _kpis(), _details()
    out = {"change_load_contracts": after_details["contract_detail"], "change_load_claims": after_details["claim_detail"],
           "change_load_ratings": after_details["evaluation_detail"]}
    for name, group in _KPI_GROUPS.items():
        sides = [f"({kpis[f'kpi_{name}']}) {alias}" for kpis, alias in ((before_kpis, "b"), (after_kpis, "a"))]
        columns = ", ".join(group + [f"{alias}.{m} AS {m}_{s}" for alias, s in (("b", "antes"), ("a", "despues")) for m in _KPI_MEASURES[name]])
        joined = f"{sides[0]} FULL JOIN {sides[1]} USING ({', '.join(group)})" if group else f"{sides[0]}, {sides[1]}"
        out[f"kpi_change_{name}"] = f"SELECT {columns} FROM {joined}"
    with _source_with(_PLANTED):
        details = _details()
        out["quarantine_contract_detail"], out["quarantine_rating_detail"] = details["contract_detail"], details["evaluation_detail"]
        lines = "FROM lineas l JOIN d_cli c ON c.cod_cliente = l.cod_cliente WHERE l.estado_contrato = 'anulado'"
        out["quarantine_contracts"] = _typed(
            "nro_contrato=l.nro_contrato:l; cod_producto=l.cod_producto:l; cod_cliente=l.cod_cliente:l;"
            " failed='sk_dim_estado_contrato unresolved':s", lines)
        out["quarantine_claims"] = _typed(
            "nro_siniestro:l; nro_contrato:l; failed='sk_fecha_siniestro outside the calendar':s",
            "FROM reclamos_con, anios WHERE year(fecha_siniestro) < lo")
        out["quarantine_ratings"] = _typed(
            "cod_cliente:l; cod_producto:l; cod_evaluacion_servicio:l; failed=f:s",
            """FROM (SELECT *, concat_ws(chr(59) || ' ', CASE WHEN NOT EXISTS (SELECT 1 FROM cliente c WHERE c.cod_cliente = v.cod_cliente)
            THEN 'sk_dim_cliente unresolved' END, CASE WHEN cod_evaluacion_servicio = 9 THEN 'sk_dim_evaluacion_servicio unresolved' END) AS f
            FROM votos v) WHERE f <> ''""")
        out["load_abort"] = _sql(f"""SELECT 'fact_registro_contrato' AS table_name, 'sk_dim_estado_contrato unresolved' AS failed,
            count(*) AS n, CAST(0 AS BIGINT) AS version {lines} HAVING count(*) > 0""")
    out["change_load_parts"] = _sql("""SELECT table_name, CAST(anio AS BIGINT) AS anio FROM (
        SELECT 'fact_registro_contrato' AS table_name, anio FROM f_con WHERE est = 3
        UNION SELECT 'fact_registro_siniestro', year(fecha_siniestro) FROM f_sin WHERE fecha_respuesta IS NULL
        UNION SELECT t, ohi FROM anios, (VALUES ('fact_registro_contrato'), ('fact_registro_siniestro'), ('fact_evaluacion_servicio')) v(t))""")
    out["reload_parts"] = _sql("\nUNION ALL\n".join(
        f"SELECT '{fact}' AS table_name, count(DISTINCT {year}) AS n_parts, CAST(0 AS BIGINT) AS n_written FROM {table}"
        for fact, table, year in (("fact_registro_contrato", "f_con", "anio"), ("fact_registro_siniestro", "f_sin", "ini // 10000"),
                                  ("fact_evaluacion_servicio", "f_eva", "dia // 10000"), ("fact_metas", "f_met", "anio"))))
    out["check_new_clients"] = f"SELECT {_NEW} AS cod_cliente_nk, CAST(0 AS BIGINT) AS filas_antes, CAST(1 AS BIGINT) AS filas_despues FROM nation"
    lines = _sql(f"""SELECT DISTINCT nro_contrato AS nro_contrato_nk, cod_producto AS cod_producto_nk, cod_cliente AS cod_cliente_nk
        FROM registro_contrato WHERE estado_contrato = 'suspendido' UNION ALL SELECT {_NEW}, {_PRODUCT}, {_NEW} FROM nation""")
    out["check_no_duplicates"] = _presence(
        before_details["contract_no_duplicate"], after_details["contract_no_duplicate"], lines,
        ["nro_contrato_nk", "cod_producto_nk", "cod_cliente_nk"], ["descrip_estado"])
    claims = _sql(f"""SELECT DISTINCT nro_siniestro AS nro_siniestro_nk, nro_contrato AS nro_contrato_nk FROM registro_siniestro
        WHERE fecha_respuesta IS NULL UNION ALL SELECT {_NEW}, {_NEW} FROM nation""")
    out["check_resolved_claims"] = _presence(
        before_details["claim_resolved"], after_details["claim_resolved"], claims, ["nro_siniestro_nk", "nro_contrato_nk"],
        ["fecha_respuesta", "id_rechazo", "monto_reconocido"])
    return out


_REFERENCES = {
    "f_con": ("fact_registro_contrato", {"sk_dim_tiempo_fecha_inicio": "ini", "sk_dim_tiempo_fecha_fin": "fin", "sk_dim_cliente": "cli",
              "sk_dim_contrato": "con", "sk_dim_producto": "pro", "sk_dim_estado_contrato": "est", "sk_dim_sucursal": "suc"}),
    "f_sin": ("fact_registro_siniestro", {"sk_fecha_siniestro": "ini", "sk_fecha_respuesta": "fin", "sk_dim_cliente": "cli",
              "sk_dim_contrato": "con", "sk_dim_sucursal": "suc", "sk_dim_producto": "pro", "sk_dim_siniestro": "sin"}),
    "f_eva": ("fact_evaluacion_servicio", {"sk_dim_tiempo_evaluacion": "dia", "sk_dim_cliente": "cli", "sk_dim_producto": "pro",
              "sk_dim_evaluacion_servicio": "eva"}),
    "f_met": ("fact_metas", {"sk_dim_fecha_inicio_meta": "anio * 10000 + 101", "sk_dim_fecha_fin_meta": "anio * 10000 + 1231",
              "sk_dim_producto": "pro"}),
}


def _references(known: dict[str, str]) -> str:
    """Keys and rows per reference; ``known`` says of a column which of its keys the dimension has."""
    parts = []
    for table, (fact, columns) in _REFERENCES.items():
        for column, key in columns.items():
            missing = f"NOT ({known[column].format(key)})" if column in known else "false"
            parts.append(
                f"SELECT '{fact}' AS table_name, 'foreign_key:{column}' AS rule, count(DISTINCT {key}) AS n_keys, count({key}) AS n_rows,"
                f" count(DISTINCT {key}) FILTER ({missing}) AS n_missing_keys, count({key}) FILTER ({missing}) AS n_missing_rows FROM {table}")
    return _sql("\nUNION ALL\n".join(parts))


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["calendar_dim"] = _sql("SELECT * FROM calendario")
    out["calendar_extend"] = _sql(
        "SELECT * REPLACE (CASE WHEN CAST(fecha_completa AS DATE) <= until THEN lower(desc_trimestre) ELSE desc_trimestre END AS desc_trimestre)"
        " FROM (SELECT c.*, until FROM calendario c, anios)").replace("SELECT * REPLACE", "SELECT * EXCLUDE (until) REPLACE")
    out["smart_key_counts"] = """SELECT CAST(k AS BIGINT) AS sk_dim_tiempo, count(*) AS n_lines FROM (SELECT CASE WHEN l_linestatus = 'F'
        THEN year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) END AS k FROM lineitem) GROUP BY k"""
    out["smart_key_sql"] = out["smart_key_counts"]
    out["fixed_domain_dim"] = """WITH v AS (SELECT row_number() OVER (ORDER BY c) AS sk, c FROM (SELECT DISTINCT CASE WHEN l_linestatus = 'O'
        THEN 'ACTIVO' ELSE 'VENCIDO' END AS c FROM lineitem)),
        n AS (SELECT * FROM (VALUES (1, 'ACTIVO', 'Activo'), (2, 'VENCIDO', 'Vencido'), (3, 'SUSPENDIDO', 'Suspendido')) d(o, c, t)
        WHERE c NOT IN (SELECT c FROM v))
        SELECT sk AS sk_dim_estado_contrato, c AS cod_estado, lower(c) AS descrip_estado FROM v
        UNION ALL SELECT (SELECT max(sk) FROM v) + row_number() OVER (ORDER BY o), c, t FROM n"""
    out["surrogate_keys"] = _typed(
        "nro_siniestro:l; sk_dim_siniestro=(SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY nro_siniestro):l", "FROM siniestro")
    out["surrogate_keys_sentinel"] = "SELECT c_custkey AS cod_cliente, row_number() OVER (ORDER BY c_custkey) AS sk FROM customer"
    out["control_totals_goals"] = _typed("n_rows=count(*):l; total=coalesce(sum(monto_meta_ingreso), 0):d", "FROM metas")
    out["apply_change_batch"] = """SELECT o_orderkey AS nro_contrato, o_custkey AS cod_cliente, CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END AS estado,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS monto FROM orders
        UNION ALL SELECT -o_orderkey - 1, o_custkey, 'O', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) FROM orders WHERE o_orderstatus = 'F'"""
    out["resolve_open_claims"] = _typed(
        "nro_siniestro:l; nro_contrato:l; fecha_siniestro:s; fecha_respuesta=coalesce(fecha_respuesta, fecha_siniestro + 30):s;"
        " id_rechazo=CASE WHEN fecha_respuesta IS NULL THEN 'NO' ELSE id_rechazo END:s;"
        " monto_reconocido=CASE WHEN fecha_respuesta IS NULL THEN monto_solicitado ELSE monto_reconocido END:d; monto_solicitado:d", "FROM reclamos_con")
    out["staging_load"] = _typed("anio:l; cod_producto:l; monto_meta_ingreso:d; meta_renovacion:l; meta_asegurados:l",
                                 "FROM metas JOIN part ON p_partkey = cod_producto WHERE p_brand <> 'Brand#1'")
    out["product_type_lookup"] = _typed(
        "cod_producto_nk=cod_producto:l; nb_producto:s; descrip_producto=descripcion:s; cod_tipo_producto:s; nb_tipo_producto:s; calificacion:d", "FROM producto")
    out["branch_flatten"] = _typed("cod_sucursal_nk=cod_sucursal:l; nb_sucursal:s; cod_ciudad=ci.cod_ciudad:l; nb_ciudad:s; cod_pais=pa.cod_pais:l; nb_pais:s",
                                   f"FROM {_BRANCH_SQL}")
    line = "nro_contrato:l; cod_producto:l; cod_cliente=r.cod_cliente:l; fecha_inicio:s; fecha_fin:s; monto:d; estado_contrato:s; cod_sucursal:l"
    out["contract_enrich"] = _typed(line + "; cantidad=1:l; cantidad_cliente=1:l; cantidad_producto=1:l; cantidad_contrato=1:l",
                                    "FROM registro_contrato r JOIN cliente c ON c.cod_cliente = r.cod_cliente")
    out["claim_enrich_dedup"] = _typed(
        "nro_siniestro:l; nro_contrato:l; fecha_siniestro:s; fecha_respuesta:s; id_rechazo:s; monto_reconocido:d; monto_solicitado:d;"
        " cod_cliente:l; cod_sucursal:l; cod_producto:l", "FROM reclamos_con")
    out["key_lookup_miss"] = _typed(
        "n_rows=count(*):l; missing_sk_dim_cliente=count(*) FILTER (c.c_custkey IS NULL):l; missing_sk_dim_producto=count(*) FILTER (p.p_partkey IS NULL):l;"
        " missing_sk_dim_estado_contrato=count(*) FILTER (e.sk IS NULL):l",
        "FROM registro_contrato r LEFT JOIN customer c ON c.c_custkey * 2 = r.cod_cliente LEFT JOIN part p ON p.p_partkey * 2 = r.cod_producto"
        " LEFT JOIN d_est e ON e.cod_estado = upper(r.estado_contrato)")
    out["scd1_client"] = _scd1("cliente", "cod_cliente", "cliente", "sk_dim_cliente", "cod_cliente_nk", _CLIENT_COLUMNS)
    out["scd1_product"] = _scd1("producto", "cod_producto", "producto", "sk_dim_producto", "cod_producto_nk", {
        "nb_producto": "nb_producto:s", "descrip_producto": "descripcion:s", "cod_tipo_producto": "cod_tipo_producto:s",
        "nb_tipo_producto": "nb_tipo_producto:s", "calificacion": "calificacion:d"})
    out["scd1_branch"] = _scd1(_BRANCH_SQL, "cod_sucursal", _BRANCH_SQL, "sk_dim_sucursal", "cod_sucursal_nk", {
        "nb_sucursal": "nb_sucursal:s", "cod_ciudad": "ci.cod_ciudad:l", "nb_ciudad": "nb_ciudad:s", "cod_pais": "pa.cod_pais:l", "nb_pais": "nb_pais:s"})
    out["scd1_contract"] = _scd1("contrato", "nro_contrato", "contrato", "sk_dim_contrato", "nro_contrato_nk", {"descrip_contrato": "descrip_contrato:s"})
    out["scd1_rating"] = _scd1("evaluacion_servicio", "cod_evaluacion_servicio", "evaluacion_servicio", "sk_dim_evaluacion", "cod_evaluacion_nk",
                               {"nb_descrip": "nb_descripcion:s"})
    out["scd1_claim"] = _scd1("siniestro", "nro_siniestro", "siniestro", "sk_dim_siniestro", "nro_siniestro_nk", {"descrip_siniestro": "descripcion_siniestro:s"})
    out["scd1_repeated_keys"] = """
        SELECT row_number() OVER (ORDER BY l_orderkey) AS sk_dim_siniestro, l_orderkey AS nro_siniestro_nk,
               max(l_returnflag || l_linestatus || ' ' || strftime(l_shipdate, '%Y-%m-%d')) AS descrip_siniestro
        FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey"""
    out["scd1_null_overwrite"] = _typed("sk_dim_cliente=cod_cliente + 1:l; cod_cliente_nk=cod_cliente:l; telefono:s", "FROM cliente")
    out["fact_contract_load"] = _typed(_CONTRACT_FACT, "FROM f_con")
    out["fact_claim_load"] = _typed(
        "sk_fecha_siniestro=ini:l; sk_fecha_respuesta=fin:l; sk_dim_cliente=cli:l; sk_dim_contrato=con:l; sk_dim_sucursal=suc:l; sk_dim_producto=pro:l;"
        " sk_dim_siniestro=sin:l; cantidad=1:l; monto_reconocido:d; monto_solicitado:d; id_rechazo:s", "FROM f_sin")
    out["fact_evaluation_load"] = _typed(_RATING_FACT, "FROM f_eva")
    out["fact_goals_load"] = _typed(_GOAL_FACT, "FROM f_met")
    # Upserts: the source, with the old day of matched ratings, and claims of every second contract kept with their old amount.
    out["fact_contract_upsert"] = out["fact_contract_load"]
    claim, rating = out["fact_claim_load"], out["fact_evaluation_load"]
    out["fact_claim_upsert_kept"] = f"""
        SELECT * FROM ({claim}) UNION ALL
        SELECT * REPLACE (CAST(monto_solicitado + 1 AS DECIMAL(18,2)) AS monto_solicitado, 2 * sk_dim_siniestro AS sk_dim_siniestro) FROM ({claim}) o
        WHERE sk_dim_contrato % 2 = 0 AND NOT EXISTS
            (SELECT 1 FROM ({claim}) s WHERE s.sk_dim_siniestro = 2 * o.sk_dim_siniestro AND s.sk_dim_contrato = o.sk_dim_contrato)"""
    out["fact_evaluation_upsert"] = f"""
        SELECT * REPLACE (CASE WHEN EXISTS (SELECT 1 FROM ({rating}) o WHERE 2 * o.sk_dim_cliente = s.sk_dim_cliente
            AND o.sk_dim_producto = s.sk_dim_producto) THEN 20000101 ELSE sk_dim_tiempo_evaluacion END AS sk_dim_tiempo_evaluacion)
        FROM ({rating}) s"""
    out["fact_goals_upsert"] = out["fact_goals_load"]
    out["evaluation_rejects"] = _typed(
        "cod_cliente:l; cod_evaluacion_servicio:l; cod_producto:l; recomienda_amigo:s",
        "FROM recomienda r WHERE NOT EXISTS (SELECT 1 FROM pares p WHERE p.cod_cliente = r.cod_cliente AND p.cod_producto = r.cod_producto)")
    out["goals_empty_guard"] = out["fact_goals_load"]
    out["sync_delete_contracts"] = _typed(_CONTRACT_FACT, "FROM f_con, anios WHERE anio > olo")
    out["evaluation_sync"] = _typed(
        _RATING_FACT, "FROM f_eva f WHERE EXISTS (SELECT 1 FROM registro_contrato r, anios WHERE r.cod_cliente = f.cod_cliente"
        " AND r.cod_producto = f.cod_producto AND year(r.fecha_inicio) > olo)")
    out["merge_metrics_contracts"] = _sql(_MERGE_METRICS)
    out["merge_rerun"] = "SELECT table_name, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS changed, CAST(0 AS BIGINT) AS deleted FROM (VALUES " \
        + ", ".join(f"('{t}')" for t in _TABLES) + ") v(table_name)"
    out["warehouse_counts"] = _counts({**_TABLES, "stg_metas": "metas"})
    out["scoped_reset"] = _counts(_RESET)
    out["dq_primary_key"] = _sql(_unique("registro_contrato", "nro_contrato", "cod_producto", "cod_cliente") + "\nUNION ALL\n"
                                 + _unique("registro_siniestro", "nro_siniestro", "nro_contrato"))
    out["dq_unique"] = _sql(_unique("cliente", "ci_rif") + "\nUNION ALL\n" + _unique("producto", "nb_producto"))
    claim_key = ("nro_siniestro", "nro_contrato")
    out["dq_not_null"] = _summary(
        [_violation(f"not_null:{c}", "registro_siniestro", _key(*claim_key), "'NULL'", f"FROM registro_siniestro WHERE {c} IS NULL")
         for c in ("fecha_respuesta", "monto_reconocido", "monto_solicitado")]
        + [_violation("not_null:recomienda_amigo", "recomienda", _key("cod_cliente", "cod_producto"), "'NULL'", "FROM recomienda WHERE recomienda_amigo IS NULL")])
    out["dq_domain"] = _dq_domain()
    code = "event_id % 5 + 1"
    shifted = f"CASE WHEN event_type = 'error' THEN ({code}) % 5 + 1 ELSE {code} END"
    out["dq_pair_domain"] = _violation("pair:codigo,etiqueta", "eventos", "event_id", f"({code}) || ',' || lower({_label(shifted)})",
                                       "FROM events WHERE event_type = 'error'")
    out["dq_foreign_key"] = _sql("\nUNION ALL\n".join([
        _foreign("recomienda", ["cod_cliente", "cod_producto"], "registro_contrato"), _foreign("recomienda", ["cod_cliente"], "cliente"),
        _foreign("registro_contrato", ["cod_cliente"], "cliente")]))
    out["dq_date_order"] = _sql(
        _violation("order:fecha_inicio,fecha_fin", "registro_contrato", _key("nro_contrato", "cod_producto", "cod_cliente"),
                   _key("fecha_inicio", "fecha_fin"), "FROM registro_contrato WHERE fecha_fin < fecha_inicio") + "\nUNION ALL\n"
        + _violation("order:fecha_siniestro,fecha_respuesta", "registro_siniestro", _key(*claim_key),
                     _key("fecha_siniestro", "fecha_respuesta"), "FROM registro_siniestro WHERE fecha_respuesta < fecha_siniestro"))
    out["dq_goals"] = _dq_goals()
    out["source_quality"] = _source_quality()
    out["warehouse_references"] = _references({})
    doubled = "{{0}} % 2 = 0 AND {{0}} <= 2 * (SELECT count(*) FROM {0})"
    out["dq_reference_misses"] = _references({"sk_dim_cliente": doubled.format("cliente"), "sk_dim_producto": doubled.format("producto")})
    out.update(_kpis())
    out["kpi_goal_attainment_year"] = _attainment("WHERE m.anio = (SELECT ohi FROM anios)")
    out["kpi_before_after"] = _typed("nb_sucursal:s; monto_total_antes=sum(monto) FILTER (anio < ohi):d; monto_total_despues=sum(monto):d",
                                     "FROM f_con, anios GROUP BY nb_sucursal")
    out["client_present"] = _typed("sk_dim_cliente=sk:l; cod_cliente_nk=cod_cliente:l; nb_cliente:s; ci_rif:s; telefono:s; direccion:s; sexo:s; email:s", "FROM d_cli")
    out.update(_details())
    out.update(_changes())
    out["snapshot_fingerprint"] = _fingerprint(_CUSTOMER, "customer")
    out["snapshot_stream"] = _typed(
        _GOAL_FACT.replace("monto_meta_ingreso:d", "monto_meta_ingreso=monto_meta_ingreso * 2:d").replace("anio *", "(anio + greatest(2000 - olo, 0)) *"),
        "FROM f_met, anios")
    out["snapshot_quarantine"] = _sql(
        "SELECT 'negative:meta_renovacion' AS rule, 'metas' AS table_name,"
        " fila || ',' || (anio + greatest(2000 - olo, 0)) || ',' || cod_producto AS row_key, '-1' AS detail,"
        " CAST(1 AS BIGINT) AS n_rows, 's3' AS snapshot"
        " FROM (SELECT *, 1 + row_number() OVER (ORDER BY anio, cod_producto) AS fila FROM metas), anios WHERE meta_renovacion = 1")
    out["watch_all_clients"] = _typed(
        "sk_dim_cliente=sk:l; cod_cliente_nk=cod_cliente:l; nb_cliente:s; ci_rif:s; telefono:s; direccion:s; sexo:s; email=email || '.c2':s", "FROM d_cli")
    out["watch_all_products"] = _sql(
        "SELECT CAST(p_partkey AS BIGINT) AS cod_producto_nk, p_name AS nb_producto, p_brand || ' p1' AS descrip_producto FROM part")
    out["watch_all_goals"] = _typed(_GOAL_FACT.replace("anio *", "(anio + greatest(2000 - olo, 0)) *"), "FROM f_met, anios")
    out["watch_all_bound"] = _sql(
        "SELECT 'cliente' AS source, 'c2' AS snapshot, count(*) AS n_rows FROM customer"
        " UNION ALL SELECT 'metas', 'g1', count(*) FROM metas UNION ALL SELECT 'producto', 'p1', count(*) FROM part")
    out["watch_all_quarantine"] = _sql(
        "SELECT 'negative:monto_meta_ingreso' AS rule, 'g2' AS snapshot, count(*) AS n, CAST(2 AS BIGINT) AS first_row, 1 + count(*) AS last_row FROM metas")
    out["goal_guards"] = _sql(
        "SELECT guard, stopped_by, n_rows, CAST(version AS BIGINT) AS version FROM (SELECT count(*) AS n_rows FROM metas),"
        " (VALUES ('column', 'columns', NULL), ('empty', 'empty', NULL), ('product', 'MissingPrerequisite', 1)) AS g(guard, stopped_by, version)")
    out["staging_load_time"] = _sql(
        "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unstamped, CAST(1 AS BIGINT) AS n_load_times FROM metas")
    return out
