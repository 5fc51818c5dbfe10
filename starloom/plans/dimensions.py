"""Dimension sources (projection, renaming, flattening) and their loads."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import last_wins
from starloom.operators.lookup import lookup
from starloom.operators.merge import MergeResult, insert_only, scd1_upsert
from starloom.schemas import DIMENSIONS, PRIMARY_KEYS, state_rows

Tables = Mapping[str, DataFrame]

# Registers hold events, not entities: their loads reduce them by their own order.
REGISTERS = ("registro_contrato", "registro_siniestro", "recomienda", "metas")


class UniqueEntities(Mapping[str, DataFrame]):
    """Source tables in which every entity key occurs once.

    Files enforce no key.  Row after row, the last row of a key would win; files have no order either, so the row that
    is highest in its other columns stands for the key, the same one for every table that is joined to it.  Rows without
    a key are left out.  Every lookup side below is therefore unique, and no repeated entity can multiply a fact.
    """

    def __init__(self, src: Tables):
        self._src = src

    def __getitem__(self, name: str) -> DataFrame:
        df = self._src[name]
        if name in REGISTERS or name not in PRIMARY_KEYS:
            return df
        keys = PRIMARY_KEYS[name]
        return last_wins(df.dropna(subset=keys), keys, [c for c in df.columns if c not in keys])

    def __iter__(self):
        return iter(self._src)

    def __len__(self) -> int:
        return len(self._src)


def unique_entities(src: Tables) -> Tables:
    return src if isinstance(src, UniqueEntities) else UniqueEntities(src)


def client_rows(src: Tables) -> DataFrame:
    """Clients; their branch is used by the facts and is not kept here."""
    attributes = DIMENSIONS["dim_cliente"][2]
    return src["cliente"].select(F.col("cod_cliente").alias("cod_cliente_nk"), *attributes)


def product_rows(src: Tables) -> DataFrame:
    """Products with the name of their type; a product of an unknown type is left out."""
    typed = lookup(src["producto"], src["tipo_producto"], ["cod_tipo_producto"], ["nb_tipo_producto"], "inner")
    return typed.select(
        F.col("cod_producto").alias("cod_producto_nk"),
        "nb_producto",
        F.col("descripcion").alias("descrip_producto"),
        F.col("cod_tipo_producto").cast("string").alias("cod_tipo_producto"),
        "nb_tipo_producto",
        "calificacion",
    )


def contract_rows(src: Tables) -> DataFrame:
    return src["contrato"].select(F.col("nro_contrato").alias("nro_contrato_nk"), "descrip_contrato")


def rating_rows(src: Tables) -> DataFrame:
    return src["evaluacion_servicio"].select(
        F.col("cod_evaluacion_servicio").alias("cod_evaluacion_nk"), F.col("nb_descripcion").alias("nb_descrip")
    )


def branch_rows(src: Tables) -> DataFrame:
    """Branch, city and country flattened into one row per branch."""
    cities = lookup(src["ciudad"], src["pais"], ["cod_pais"], ["nb_pais"], "inner")
    flat = lookup(src["sucursal"], cities, ["cod_ciudad"], ["nb_ciudad", "cod_pais", "nb_pais"], "inner")
    return flat.select(
        F.col("cod_sucursal").alias("cod_sucursal_nk"), "nb_sucursal", "cod_ciudad", "nb_ciudad", "cod_pais", "nb_pais"
    )


def claim_rows(src: Tables) -> DataFrame:
    return src["siniestro"].select(
        F.col("nro_siniestro").alias("nro_siniestro_nk"), F.col("descripcion_siniestro").alias("descrip_siniestro")
    )


# Natural-key dimensions by table, each loaded with a type-1 upsert.
SOURCES: dict[str, Callable[[Tables], DataFrame]] = {
    "dim_cliente": client_rows,
    "dim_producto": product_rows,
    "dim_contrato": contract_rows,
    "dim_evaluacion_servicio": rating_rows,
    "dim_sucursal": branch_rows,
    "dim_siniestro": claim_rows,
}


def load_dimension(name: str, src: Tables, target: DataFrame | None) -> MergeResult:
    """Type-1 load of one natural-key dimension."""
    key, natural, attributes = DIMENSIONS[name]
    return scd1_upsert(target, SOURCES[name](unique_entities(src)), natural, key, attributes)


def load_states(spark, target: DataFrame | None) -> MergeResult:
    """Insert-only load of the fixed contract-state domain."""
    key, natural, _ = DIMENSIONS["dim_estado_contrato"]
    return insert_only(target, state_rows(spark), natural, key, ["orden"])
