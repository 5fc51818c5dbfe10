"""Fact sources: source rows joined, keyed against the dimensions and reduced to one row per business key.

The big inputs (contract lines, claims, ratings) are joined as few times as possible.  Everything that hangs on
one entity is folded onto that entity first: a client row carries its own key and its branch key, a contract row
its key and the client and product of its last line.  The fact then needs one join per entity.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import smart_key, year_end_key, year_start_key
from starloom.operators.keys import last_wins, last_wins_counted
from starloom.operators.lookup import lookup
from starloom.operators.merge import is_empty, merge_fact
from starloom.plans.dimensions import unique_entities
from starloom.schemas import FACT_COLUMNS, FACT_KEYS, FACT_NATURALS

Tables = Mapping[str, DataFrame]
Hot = Mapping[str, Sequence[int]]

# Which hot keys are worth measuring, per big source table.
HOT_KEY_SETS = {
    "registro_contrato": {"client": ["cod_cliente"], "product": ["cod_producto"], "contract": ["nro_contrato"]},
    "registro_siniestro": {"contract": ["nro_contrato"], "claim": ["nro_siniestro"]},
    "recomienda": {
        "pair": ["cod_cliente", "cod_producto"], "client": ["cod_cliente"], "product": ["cod_producto"],
    },
}


# Source rows that a fact row stands for: repeated keys, and lines of the contract of a claim.  Fact sources carry it, so
# that a load counts its source rows while it writes; ``ordered`` leaves it out.
SOURCE_ROWS = "_source_rows"

_CLAIM_ORDER = ["fecha_siniestro", "fecha_respuesta", "id_rechazo", "monto_reconocido", "monto_solicitado"]


class MissingPrerequisite(ValueError):
    """A table that must be loaded earlier is empty."""


def _hot(hot: Hot | None, name: str) -> Sequence[int]:
    return (hot or {}).get(name, ())


def client_keys(src: Tables, dims: Tables) -> DataFrame:
    """One row per client: its key and the key of its branch.  The client join comes last, so that the result is
    already partitioned for the facts that join it on the client."""
    branches = dims["dim_sucursal"].select("cod_sucursal_nk", "sk_dim_sucursal")
    clients = unique_entities(src)["cliente"].select("cod_cliente", "cod_sucursal")
    placed = lookup(clients, branches, {"cod_sucursal": "cod_sucursal_nk"}, ["sk_dim_sucursal"])
    return lookup(placed, dims["dim_cliente"], {"cod_cliente": "cod_cliente_nk"}, ["sk_dim_cliente"])


def enrich_lines(src: Tables) -> DataFrame:
    """Contract lines with the branch of their client and the unit counters; lines of unknown clients drop out."""
    lines = lookup(
        src["registro_contrato"], unique_entities(src)["cliente"], ["cod_cliente"], ["cod_sucursal"], "inner"
    )
    return lines.select("*", *_counters())


def _counters():
    return [F.lit(1).alias(c) for c in ("cantidad", "cantidad_cliente", "cantidad_producto", "cantidad_contrato")]


def _naturals(fact: str, wanted: bool) -> list[Column]:
    return [F.col(c).alias(f"nk_{c}") for c in FACT_NATURALS[fact]] if wanted else []


def contract_fact_source(
    src: Tables, dims: Tables, hot: Hot | None = None, unique_keys: bool = False, naturals: bool = False
) -> DataFrame:
    """Keyed contract lines, with their natural keys if ``naturals``.  The contract join comes first: its shuffle on the contract number also serves the
    deduplication, whose key starts with it.  ``unique_keys`` skips the deduplication."""
    lines = src["registro_contrato"]
    spread = ["nro_contrato", "cod_producto", "cod_cliente"]
    order = ["fecha_inicio", "fecha_fin", "monto", "estado_contrato"]
    states = dims["dim_estado_contrato"].select("cod_estado", "sk_dim_estado_contrato")
    keyed = lookup(
        lines, dims["dim_contrato"], {"nro_contrato": "nro_contrato_nk"}, ["sk_dim_contrato"],
        hot=_hot(hot, "contract"), spread_by=spread,
    )
    keyed = keyed.withColumn(SOURCE_ROWS, F.lit(1).cast("long")) if unique_keys else last_wins_counted(keyed, spread, order, SOURCE_ROWS)
    keyed = lookup(
        keyed, client_keys(src, dims), ["cod_cliente"], ["sk_dim_cliente", "sk_dim_sucursal"], "inner",
        hot=_hot(hot, "client"), spread_by=spread,
    )
    keyed = lookup(
        keyed, dims["dim_producto"], {"cod_producto": "cod_producto_nk"}, ["sk_dim_producto"],
        hot=_hot(hot, "product"), spread_by=spread,
    )
    keyed = keyed.withColumn("cod_estado", F.upper("estado_contrato"))
    keyed = lookup(keyed, F.broadcast(states), ["cod_estado"], ["sk_dim_estado_contrato"])
    return keyed.select(
        smart_key(F.col("fecha_inicio")).alias("sk_dim_tiempo_fecha_inicio"),
        smart_key(F.col("fecha_fin")).alias("sk_dim_tiempo_fecha_fin"),
        "sk_dim_cliente", "sk_dim_contrato", "sk_dim_producto", "sk_dim_estado_contrato", "sk_dim_sucursal",
        F.col("monto").cast("decimal(18,2)").alias("monto"),
        *_counters(), SOURCE_ROWS, *_naturals("fact_registro_contrato", naturals),
    )


def last_line_per_contract(
    src: Tables, clients: DataFrame, columns: Sequence[str], hot: Hot | None = None, count: str | None = None
) -> DataFrame:
    """The highest (client, product) line of each contract, with ``columns`` of its client and, if asked for, the number of
    its lines.

    Joining claims to this instead of to the lines gives the row that would survive the fan-out anyway, without
    producing it.
    """
    lines = src["registro_contrato"].select("nro_contrato", "cod_cliente", "cod_producto")
    known = lookup(
        lines, clients, ["cod_cliente"], columns, "inner", hot=_hot(hot, "client"),
        spread_by=["nro_contrato", "cod_producto"],
    )
    if count:
        return last_wins_counted(known, ["nro_contrato"], ["cod_cliente", "cod_producto"], count)
    return last_wins(known, ["nro_contrato"], ["cod_cliente", "cod_producto"])


def claim_source(src: Tables, hot_lines: Hot | None = None, hot_claims: Hot | None = None) -> DataFrame:
    """One row per (claim, contract) with client, branch and product of the contract's last line."""
    claims = last_wins(src["registro_siniestro"], ["nro_siniestro", "nro_contrato"], _CLAIM_ORDER)
    return lookup(
        claims, last_line_per_contract(src, unique_entities(src)["cliente"], ["cod_sucursal"], hot_lines), ["nro_contrato"],
        ["cod_cliente", "cod_sucursal", "cod_producto"],
        "inner", hot=_hot(hot_claims, "contract"), spread_by=["nro_siniestro", "nro_contrato"],
    )


def claim_fact_source(
    src: Tables, dims: Tables, hot_lines: Hot | None = None, hot_claims: Hot | None = None, unique_keys: bool = False,
    naturals: bool = False,
) -> DataFrame:
    """Keyed claims: contract-level keys are resolved once per contract, then joined to the claims.  The contract key
    comes last, so its shuffle also serves the join with the claims."""
    spread = ["nro_siniestro", "nro_contrato"]
    contracts = last_line_per_contract(
        src, client_keys(src, dims), ["sk_dim_cliente", "sk_dim_sucursal"], hot_lines, count="_lines")
    contracts = lookup(
        contracts, dims["dim_producto"], {"cod_producto": "cod_producto_nk"}, ["sk_dim_producto"],
        hot=_hot(hot_lines, "product"), spread_by=["nro_contrato"],
    )
    contracts = lookup(contracts, dims["dim_contrato"], {"nro_contrato": "nro_contrato_nk"}, ["sk_dim_contrato"])
    claims = src["registro_siniestro"]
    if unique_keys:
        claims = claims.withColumn("_claims", F.lit(1).cast("long"))
    else:
        claims = last_wins_counted(claims, spread, _CLAIM_ORDER, "_claims")
    keyed = lookup(
        claims, contracts, ["nro_contrato"],
        ["sk_dim_contrato", "sk_dim_cliente", "sk_dim_sucursal", "sk_dim_producto", "_lines"], "inner",
        hot=_hot(hot_claims, "contract"), spread_by=spread,
    )
    keyed = lookup(
        keyed, dims["dim_siniestro"], {"nro_siniestro": "nro_siniestro_nk"}, ["sk_dim_siniestro"],
        hot=_hot(hot_claims, "claim"), spread_by=spread,
    )
    return keyed.select(
        smart_key(F.col("fecha_siniestro")).alias("sk_fecha_siniestro"),
        smart_key(F.col("fecha_respuesta")).alias("sk_fecha_respuesta"),
        "sk_dim_cliente", "sk_dim_contrato", "sk_dim_sucursal", "sk_dim_producto", "sk_dim_siniestro",
        F.lit(1).alias("cantidad"), "monto_reconocido", "monto_solicitado", "id_rechazo",
        (F.col("_claims") * F.col("_lines")).alias(SOURCE_ROWS), *_naturals("fact_registro_siniestro", naturals),
    )


def live_contract_keys(src: Tables, dims: Tables, hot: Hot | None = None) -> DataFrame:
    """Keys of the contract facts that the source still has lines for: no other column is read or joined."""
    spread = ["nro_contrato", "cod_producto", "cod_cliente"]
    keys = src["registro_contrato"].select(*spread).distinct()
    for dim, column, key, label in (
        ("dim_contrato", "nro_contrato", "sk_dim_contrato", "contract"), ("dim_producto", "cod_producto", "sk_dim_producto", "product"),
        ("dim_cliente", "cod_cliente", "sk_dim_cliente", "client"),
    ):
        keys = lookup(keys, dims[dim], {column: f"{column}_nk"}, [key], "inner", hot=_hot(hot, label), spread_by=spread)
    return keys.select(*FACT_KEYS["fact_registro_contrato"])


def live_claim_keys(src: Tables, dims: Tables) -> DataFrame:
    """Keys the claim sync must keep: every registered claim, even when its contract has no line any more."""
    keys = src["registro_siniestro"].select("nro_siniestro", "nro_contrato").distinct()
    keys = lookup(keys, dims["dim_siniestro"], {"nro_siniestro": "nro_siniestro_nk"}, ["sk_dim_siniestro"], "inner")
    keys = lookup(keys, dims["dim_contrato"], {"nro_contrato": "nro_contrato_nk"}, ["sk_dim_contrato"], "inner")
    return keys.select("sk_dim_siniestro", "sk_dim_contrato")


def latest_end_per_pair(src: Tables) -> DataFrame:
    """Latest contract end per (client, product)."""
    return src["registro_contrato"].groupBy("cod_cliente", "cod_producto").agg(F.max("fecha_fin").alias("fecha_eval"))


def kept_ratings(src: Tables) -> DataFrame:
    """The winning rating of every (client, product) that has a contract, dated by the latest contract end."""
    ratings = last_wins_counted(
        src["recomienda"], ["cod_cliente", "cod_producto"], ["cod_evaluacion_servicio", "recomienda_amigo"], SOURCE_ROWS)
    dated = lookup(ratings, latest_end_per_pair(src), ["cod_cliente", "cod_producto"], ["fecha_eval"], "inner")
    return dated.where("fecha_eval IS NOT NULL")


def rejected_ratings(src: Tables, hot: Hot | None = None) -> DataFrame:
    """Ratings of pairs without a contract, every row kept for the report."""
    pairs = latest_end_per_pair(src).where("fecha_eval IS NOT NULL")
    return lookup(
        src["recomienda"], pairs, ["cod_cliente", "cod_producto"], how="anti", hot=_hot(hot, "pair"),
        spread_by=src["recomienda"].columns,
    )


def rating_fact_source(src: Tables, dims: Tables, hot: Hot | None = None, naturals: bool = False) -> DataFrame:
    """Keyed ratings; a NULL recommendation counts as no."""
    keyed = kept_ratings(src)
    keyed = lookup(
        keyed, dims["dim_cliente"], {"cod_cliente": "cod_cliente_nk"}, ["sk_dim_cliente"],
        hot=_hot(hot, "client"), spread_by=["cod_cliente", "cod_producto"],
    )
    keyed = lookup(
        keyed, dims["dim_producto"], {"cod_producto": "cod_producto_nk"}, ["sk_dim_producto"],
        hot=_hot(hot, "product"), spread_by=["cod_cliente", "cod_producto"],
    )
    ratings = dims["dim_evaluacion_servicio"].select("cod_evaluacion_nk", "sk_dim_evaluacion")
    keyed = lookup(
        keyed, ratings, {"cod_evaluacion_servicio": "cod_evaluacion_nk"}, ["sk_dim_evaluacion"]
    )
    flag = F.when(F.upper("recomienda_amigo") == "SI", F.lit(1)).otherwise(F.lit(0)).cast("decimal(5,2)")
    return keyed.select(
        smart_key(F.col("fecha_eval")).alias("sk_dim_tiempo_evaluacion"), "sk_dim_cliente", "sk_dim_producto",
        F.col("sk_dim_evaluacion").alias("sk_dim_evaluacion_servicio"), F.lit(1).alias("cantidad"),
        flag.alias("recomienda_amigo"), SOURCE_ROWS, *_naturals("fact_evaluacion_servicio", naturals),
    )


def goal_fact_source(goals: DataFrame, dims: Tables, naturals: bool = False) -> DataFrame:
    """Keyed goals; each covers its whole calendar year."""
    keyed = lookup(goals, dims["dim_producto"], {"cod_producto": "cod_producto_nk"}, ["sk_dim_producto"])
    return keyed.select(
        year_start_key(F.col("anio")).alias("sk_dim_fecha_inicio_meta"),
        year_end_key(F.col("anio")).alias("sk_dim_fecha_fin_meta"),
        "sk_dim_producto",
        F.col("monto_meta_ingreso").cast("decimal(18,2)").alias("monto_meta_ingreso"),
        "meta_renovacion", "meta_asegurados", *_naturals("fact_metas", naturals),
    )


def load_goals(goals: DataFrame, dims: Tables, target: DataFrame | None) -> DataFrame | None:
    """Goal fact after upsert and sync.  Empty staging leaves the fact alone; an empty product dimension is an
    error.  NULL product keys (unknown products) are left for the caller's key check."""
    if is_empty(goals):
        return target
    if is_empty(dims["dim_producto"]):
        raise MissingPrerequisite("dim_producto is empty; load the dimensions before the goals")
    return merge_fact(target, goal_fact_source(goals, dims), FACT_KEYS["fact_metas"])


def ordered(df: DataFrame, fact: str) -> DataFrame:
    """Columns of a fact in their declared order."""
    return df.select(*FACT_COLUMNS[fact])
