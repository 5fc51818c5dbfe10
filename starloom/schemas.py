"""Declared schemas, business keys and constraint rules of the source and warehouse tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import quality as q

MONEY = "decimal(18,2)"


# Column names and types of the source tables and of the goals staging table.
SOURCE_COLUMNS = {
    "pais": {"cod_pais": "long", "nb_pais": "string"},
    "ciudad": {"cod_ciudad": "long", "nb_ciudad": "string", "cod_pais": "long"},
    "sucursal": {"cod_sucursal": "long", "nb_sucursal": "string", "cod_ciudad": "long"},
    "tipo_producto": {"cod_tipo_producto": "long", "nb_tipo_producto": "string"},
    "producto": {
        "cod_producto": "long", "nb_producto": "string", "descripcion": "string", "calificacion": "decimal(3,2)",
        "cod_tipo_producto": "long",
    },
    "cliente": {
        "cod_cliente": "long", "nb_cliente": "string", "ci_rif": "string", "telefono": "string", "direccion": "string",
        "sexo": "string", "email": "string", "cod_sucursal": "long",
    },
    "evaluacion_servicio": {"cod_evaluacion_servicio": "long", "nb_descripcion": "string"},
    "contrato": {"nro_contrato": "long", "descrip_contrato": "string"},
    "siniestro": {"nro_siniestro": "long", "descripcion_siniestro": "string"},
    "recomienda": {
        "cod_cliente": "long", "cod_evaluacion_servicio": "long", "cod_producto": "long", "recomienda_amigo": "string",
    },
    "registro_contrato": {
        "nro_contrato": "long", "cod_producto": "long", "cod_cliente": "long", "fecha_inicio": "date",
        "fecha_fin": "date", "monto": MONEY, "estado_contrato": "string",
    },
    "registro_siniestro": {
        "nro_siniestro": "long", "nro_contrato": "long", "fecha_siniestro": "date", "fecha_respuesta": "date",
        "id_rechazo": "string", "monto_reconocido": MONEY, "monto_solicitado": MONEY,
    },
    "metas": {
        "anio": "int", "cod_producto": "long", "monto_meta_ingreso": MONEY, "meta_renovacion": "int",
        "meta_asegurados": "int", "fecha_carga": "timestamp",
    },
}
PRIMARY_KEYS = {
    "pais": ["cod_pais"],
    "ciudad": ["cod_ciudad"],
    "sucursal": ["cod_sucursal"],
    "tipo_producto": ["cod_tipo_producto"],
    "producto": ["cod_producto"],
    "cliente": ["cod_cliente"],
    "evaluacion_servicio": ["cod_evaluacion_servicio"],
    "contrato": ["nro_contrato"],
    "siniestro": ["nro_siniestro"],
    "recomienda": ["cod_cliente", "cod_producto", "cod_evaluacion_servicio"],
    "registro_contrato": ["nro_contrato", "cod_producto", "cod_cliente"],
    "registro_siniestro": ["nro_siniestro", "nro_contrato"],
    "metas": ["anio", "cod_producto"],
}

# The domains that the source schema admits.
PRODUCT_TYPES = ["PRESTACIÓN DE SERVICIOS", "PERSONALES", "DAÑOS", "PATRIMONIALES"]
SEXES = ["M", "F"]
YES_NO = ["SI", "NO"]
RATING_LABELS = {1: "MALO", 2: "REGULAR", 3: "BUENO", 4: "MUY BUENO", 5: "EXCELENTE"}
CONTRACT_STATES = [("ACTIVO", "Activo"), ("VENCIDO", "Vencido"), ("SUSPENDIDO", "Suspendido")]
MAX_LENGTHS = {
    "pais": {"nb_pais": 100},
    "ciudad": {"nb_ciudad": 100},
    "sucursal": {"nb_sucursal": 100},
    "tipo_producto": {"nb_tipo_producto": 100},
    "producto": {"nb_producto": 100, "descripcion": 255},
    "cliente": {"nb_cliente": 150, "ci_rif": 20, "telefono": 20, "direccion": 255, "sexo": 1, "email": 100},
    "evaluacion_servicio": {"nb_descripcion": 50},
    "contrato": {"descrip_contrato": 255},
    "siniestro": {"descripcion_siniestro": 255},
    "recomienda": {"recomienda_amigo": 2},
    "registro_contrato": {"estado_contrato": 20},
    "registro_siniestro": {"id_rechazo": 2},
}
NULLABLE = {
    "producto": {"descripcion", "calificacion"},
    "cliente": {"telefono", "direccion", "sexo", "email"},
    "recomienda": {"recomienda_amigo"},
    "registro_siniestro": {"fecha_respuesta", "monto_reconocido"},
}
FOREIGN_KEYS = {
    "ciudad": [("cod_pais", "pais")],
    "sucursal": [("cod_ciudad", "ciudad")],
    "producto": [("cod_tipo_producto", "tipo_producto")],
    "cliente": [("cod_sucursal", "sucursal")],
    "recomienda": [
        ("cod_cliente", "cliente"), ("cod_evaluacion_servicio", "evaluacion_servicio"), ("cod_producto", "producto"),
    ],
    "registro_contrato": [("nro_contrato", "contrato"), ("cod_producto", "producto"), ("cod_cliente", "cliente")],
    "registro_siniestro": [("nro_siniestro", "siniestro"), ("nro_contrato", "contrato")],
}

# Warehouse table layouts.  Surrogate keys are LONG so that they never run out.
DIMENSIONS = {
    "dim_cliente": ("sk_dim_cliente", "cod_cliente_nk",
                    ["nb_cliente", "ci_rif", "telefono", "direccion", "sexo", "email"]),
    "dim_producto": ("sk_dim_producto", "cod_producto_nk",
                     ["nb_producto", "descrip_producto", "cod_tipo_producto", "nb_tipo_producto", "calificacion"]),
    "dim_contrato": ("sk_dim_contrato", "nro_contrato_nk", ["descrip_contrato"]),
    "dim_estado_contrato": ("sk_dim_estado_contrato", "cod_estado", ["descrip_estado"]),
    "dim_evaluacion_servicio": ("sk_dim_evaluacion", "cod_evaluacion_nk", ["nb_descrip"]),
    "dim_sucursal": ("sk_dim_sucursal", "cod_sucursal_nk",
                     ["nb_sucursal", "cod_ciudad", "nb_ciudad", "cod_pais", "nb_pais"]),
    "dim_siniestro": ("sk_dim_siniestro", "nro_siniestro_nk", ["descrip_siniestro"]),
}
FACT_COLUMNS = {
    "fact_registro_contrato": [
        "sk_dim_tiempo_fecha_inicio", "sk_dim_tiempo_fecha_fin", "sk_dim_cliente", "sk_dim_contrato",
        "sk_dim_producto", "sk_dim_estado_contrato", "sk_dim_sucursal", "monto", "cantidad", "cantidad_cliente",
        "cantidad_producto", "cantidad_contrato",
    ],
    "fact_registro_siniestro": [
        "sk_fecha_siniestro", "sk_fecha_respuesta", "sk_dim_cliente", "sk_dim_contrato", "sk_dim_sucursal",
        "sk_dim_producto", "sk_dim_siniestro", "cantidad", "monto_reconocido", "monto_solicitado", "id_rechazo",
    ],
    "fact_evaluacion_servicio": [
        "sk_dim_tiempo_evaluacion", "sk_dim_cliente", "sk_dim_producto", "sk_dim_evaluacion_servicio", "cantidad",
        "recomienda_amigo",
    ],
    "fact_metas": [
        "sk_dim_fecha_inicio_meta", "sk_dim_fecha_fin_meta", "sk_dim_producto", "monto_meta_ingreso",
        "meta_renovacion", "meta_asegurados",
    ],
}
FACT_KEYS = {
    "fact_registro_contrato": ["sk_dim_contrato", "sk_dim_producto", "sk_dim_cliente"],
    "fact_registro_siniestro": ["sk_dim_siniestro", "sk_dim_contrato"],
    "fact_evaluacion_servicio": ["sk_dim_cliente", "sk_dim_producto"],
    "fact_metas": ["sk_dim_fecha_inicio_meta", "sk_dim_producto"],
}
# Key columns of a fact that may not be NULL, and those that point at the calendar.
FACT_REQUIRED = {
    "fact_registro_contrato": FACT_COLUMNS["fact_registro_contrato"][:7],
    "fact_registro_siniestro": [
        "sk_fecha_siniestro", "sk_dim_cliente", "sk_dim_contrato", "sk_dim_sucursal", "sk_dim_producto", "sk_dim_siniestro",
    ],
    "fact_evaluacion_servicio": FACT_COLUMNS["fact_evaluacion_servicio"][:4],
    "fact_metas": FACT_COLUMNS["fact_metas"][:3],
}
FACT_DATES = {
    "fact_registro_contrato": ["sk_dim_tiempo_fecha_inicio", "sk_dim_tiempo_fecha_fin"],
    "fact_registro_siniestro": ["sk_fecha_siniestro", "sk_fecha_respuesta"],
    "fact_evaluacion_servicio": ["sk_dim_tiempo_evaluacion"],
    "fact_metas": ["sk_dim_fecha_inicio_meta", "sk_dim_fecha_fin_meta"],
}
# What tells the source rows of a fact apart, kept beside the names of the keys that a quarantined row lacks.
FACT_NATURALS = {
    "fact_registro_contrato": ["nro_contrato", "cod_producto", "cod_cliente"],
    "fact_registro_siniestro": ["nro_siniestro", "nro_contrato"],
    "fact_evaluacion_servicio": ["cod_cliente", "cod_producto", "cod_evaluacion_servicio"],
    "fact_metas": ["anio", "cod_producto"],
}
# The key whose hash bucket a kept register is laid out by.
REGISTER_KEYS = {
    "reg_cliente": "cod_cliente", "reg_registro_contrato": "nro_contrato", "reg_registro_siniestro": "nro_contrato",
    "reg_recomienda": "cod_cliente", "idx_cliente_contrato": "cod_cliente",
}
# The date key whose year a fact is laid out by.
FACT_YEARS = {fact: dates[0] for fact, dates in FACT_DATES.items()}
_FACT_PARENTS = {
    "sk_dim_cliente": ("dim_cliente", "sk_dim_cliente"),
    "sk_dim_contrato": ("dim_contrato", "sk_dim_contrato"),
    "sk_dim_producto": ("dim_producto", "sk_dim_producto"),
    "sk_dim_estado_contrato": ("dim_estado_contrato", "sk_dim_estado_contrato"),
    "sk_dim_sucursal": ("dim_sucursal", "sk_dim_sucursal"),
    "sk_dim_siniestro": ("dim_siniestro", "sk_dim_siniestro"),
    "sk_dim_evaluacion_servicio": ("dim_evaluacion_servicio", "sk_dim_evaluacion"),
}


def source_schema(table: str) -> str:
    """Schema of a source table as DDL text, for ``DataFrameReader.schema``."""
    return ", ".join(f"{c} {t}" for c, t in SOURCE_COLUMNS[table].items())


def _check_rules(table: str) -> list[q.RowRule]:
    """CHECK constraints of the source tables."""
    return {
        "tipo_producto": [q.domain("nb_tipo_producto", PRODUCT_TYPES)],
        "producto": [q.between("calificacion", 1, 5)],
        "cliente": [q.domain("sexo", SEXES)],
        "evaluacion_servicio": [
            q.between("cod_evaluacion_servicio", 1, 5),
            q.pair_domain("cod_evaluacion_servicio", "nb_descripcion", RATING_LABELS),
        ],
        "recomienda": [q.domain("recomienda_amigo", YES_NO)],
        "registro_contrato": [
            q.domain("estado_contrato", [code for code, _ in CONTRACT_STATES]), q.not_before("fecha_fin", "fecha_inicio"),
        ],
        "registro_siniestro": [q.domain("id_rechazo", YES_NO), q.not_before("fecha_respuesta", "fecha_siniestro")],
    }.get(table, [])


def source_rules(table: str) -> q.TableRules:
    """Every constraint of one source table as rules."""
    key = PRIMARY_KEYS[table]
    rules: list = [q.unique(*key)]
    if table == "cliente":
        rules.append(q.unique("ci_rif"))
    required = [c for c in SOURCE_COLUMNS[table] if c not in NULLABLE.get(table, set())]
    rules += [q.not_null(c) for c in required if c != "fecha_carga"]
    rules += [q.max_length(c, n) for c, n in MAX_LENGTHS.get(table, {}).items()]
    rules += _check_rules(table)
    rules += [q.foreign_key([c], parent, [c]) for c, parent in FOREIGN_KEYS.get(table, [])]
    return q.TableRules(table, key, rules)


def warehouse_rules(table: str) -> q.TableRules:
    """Unique keys, required columns and foreign keys of one warehouse table."""
    if table in DIMENSIONS:
        key, natural, _ = DIMENSIONS[table]
        return q.TableRules(table, [natural], [q.unique(key), q.unique(natural), q.not_null(key), q.not_null(natural)])
    if table == "dim_tiempo":
        return q.TableRules(table, ["fecha_completa"], [q.unique("sk_dim_tiempo"), q.unique("fecha_completa")])
    rules: list = [q.unique(*FACT_KEYS[table])]
    rules += [q.not_null(c) for c in FACT_REQUIRED[table]]
    rules += [q.foreign_key([c], "dim_tiempo", ["sk_dim_tiempo"]) for c in FACT_DATES[table]]
    rules += [q.foreign_key([c], *_parent(c)) for c in FACT_COLUMNS[table] if c in _FACT_PARENTS]
    return q.TableRules(table, FACT_KEYS[table], rules)


def _parent(column: str) -> tuple[str, list[str]]:
    table, key = _FACT_PARENTS[column]
    return table, [key]


def state_rows(spark):
    """The fixed contract-state domain with its key order."""
    rows = [(i, code, label) for i, (code, label) in enumerate(CONTRACT_STATES, 1)]
    return spark.createDataFrame(rows, "orden INT, cod_estado STRING, descrip_estado STRING")


def fit_schema(df, table: str):
    """Select and cast the declared columns of a source table."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in SOURCE_COLUMNS[table].items()])
