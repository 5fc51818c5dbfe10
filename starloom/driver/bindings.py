"""The given tables in the roles of the source tables.

Every role is a projection or join over the whole table; the names of the columns are those of the source schema,
keys are LONG.  Rows that repeat a business key in the given data are left in: the loads reduce them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.calendar import year_range
from starloom.operators.keys import assign_surrogate_keys
from starloom.operators.lookup import find_hot_keys, lookup
from starloom.plans.warehouse_load import LoadReport, run_load
from starloom.schemas import RATING_LABELS
from starloom.session import lasting_tables, materialise, scratch_path
from starloom.sources.store import WarehouseStore

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Roles:
    """Source roles over one data folder; scalars (row counts, year range) are read once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._memo: dict[str, object] = {}

    def _once(self, name: str, make):
        if name not in self._memo:
            with lasting_tables():  # a load may be the first to ask
                self._memo[name] = make()
        return self._memo[name]

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def rows(self, name: str) -> int:
        return self._once(f"rows-{name}", lambda: self.raw(name).count())

    @property
    def hot_orders(self) -> list[int]:
        return self._once("hot", lambda: find_hot_keys(self.raw("lineitem"), {"o": ["l_orderkey"]})["o"])

    def years(self) -> tuple[dt.date, dt.date]:
        """Whole years covering order and ship dates."""
        def read():
            o = year_range(self.raw("orders"), ["o_orderdate"])
            s = year_range(self.raw("lineitem"), ["l_shipdate"])
            return min(o[0], s[0]), max(o[1], s[1])
        return self._once("years", read)

    def order_years(self) -> tuple[dt.date, dt.date]:
        return self._once("order_years", lambda: year_range(self.raw("orders"), ["o_orderdate"]))

    # --- small masters ---

    def pais(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").alias("cod_pais"), F.col("r_name").alias("nb_pais"))

    def ciudad(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("cod_ciudad"), F.col("n_name").alias("nb_ciudad"), F.col("n_regionkey").alias("cod_pais"))

    def sucursal(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("cod_sucursal"), F.col("s_name").alias("nb_sucursal"), F.col("s_nationkey").alias("cod_ciudad"))

    def tipo_producto(self) -> DataFrame:
        def make():
            names = self.raw("part").select(F.col("p_type").alias("nb_tipo_producto")).distinct()
            return assign_surrogate_keys(names, ["nb_tipo_producto"], "cod_tipo_producto")
        return self._once("tipo", make)

    def evaluacion_servicio(self) -> DataFrame:
        labels = F.create_map(*[F.lit(x) for pair in RATING_LABELS.items() for x in pair])
        codes = self.raw("events").select((F.col("event_id") % 5 + 1).cast("int").alias("cod_evaluacion_servicio")).distinct()
        return codes.withColumn("nb_descripcion", F.element_at(labels, F.col("cod_evaluacion_servicio")))

    # --- masters that grow with the data ---

    def producto(self) -> DataFrame:
        typed = lookup(self.raw("part"), self.tipo_producto(), {"p_type": "nb_tipo_producto"}, ["cod_tipo_producto"])
        return typed.select(
            F.col("p_partkey").alias("cod_producto"), F.col("p_name").alias("nb_producto"),
            F.col("p_brand").alias("descripcion"), (F.col("p_size") % 5 + 1).cast("decimal(3,2)").alias("calificacion"),
            "cod_tipo_producto")

    def cliente(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("cod_cliente"), F.col("c_name").alias("nb_cliente"),
            F.concat(F.lit("C-"), key.cast("string")).alias("ci_rif"),
            F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("555-"), key.cast("string"))).alias("telefono"),
            F.col("c_mktsegment").alias("direccion"),
            F.when(F.col("c_acctbal") >= 5000, "M").otherwise("F").alias("sexo"),
            F.concat(F.lower("c_mktsegment"), F.lit("@example.org")).alias("email"),
            (key % self.rows("supplier")).alias("cod_sucursal"))

    def contrato(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("nro_contrato"),
            F.concat_ws(" ", F.lit("Order"), F.col("o_orderkey").cast("string"), "o_orderpriority").alias("descrip_contrato"))

    def _claims(self) -> DataFrame:
        """Returned lines."""
        number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return self.raw("lineitem").where("l_returnflag <> 'N'").withColumn("nro_siniestro", number)

    def siniestro(self) -> DataFrame:
        numbers = self._claims().select("nro_siniestro").distinct()
        return numbers.select(
            "nro_siniestro", F.concat(F.lit("Claim "), F.col("nro_siniestro").cast("string")).alias("descripcion_siniestro"))

    # --- registers ---

    def registro_contrato(self) -> DataFrame:
        """Contract lines: a table in the source model, so the join is written once and not repeated by every reader."""
        return self._once("registro_contrato", lambda: materialise(self._contract_lines(), "registro_contrato"))

    def _contract_lines(self) -> DataFrame:
        lines = lookup(
            self.raw("lineitem"), self.raw("orders"), {"l_orderkey": "o_orderkey"},
            ["o_custkey", "o_orderdate", "o_orderstatus"], "inner", hot=self.hot_orders)
        state = F.when(F.col("o_orderstatus") == "O", "Activo").when(F.col("o_orderstatus") == "F", "VENCIDO").otherwise("suspendido")
        return lines.select(
            F.col("l_orderkey").alias("nro_contrato"), F.col("l_partkey").alias("cod_producto"),
            F.col("o_custkey").alias("cod_cliente"), F.to_date("o_orderdate").alias("fecha_inicio"),
            F.to_date("l_shipdate").alias("fecha_fin"), F.col("l_extendedprice").cast(MONEY).alias("monto"),
            state.alias("estado_contrato"))

    def registro_siniestro(self) -> DataFrame:
        """Claims, written once like the contract lines."""
        return self._once("registro_siniestro", lambda: materialise(self._claim_lines(), "registro_siniestro"))

    def _claim_lines(self) -> DataFrame:
        claims = lookup(
            self._claims(), self.raw("orders"), {"l_orderkey": "o_orderkey"}, ["o_orderdate"], "inner", hot=self.hot_orders)
        amount, closed = F.col("l_extendedprice").cast(MONEY), F.col("l_linestatus") == "F"
        rejected = F.col("l_returnflag") == "R"
        return claims.select(
            "nro_siniestro", F.col("l_orderkey").alias("nro_contrato"), F.to_date("o_orderdate").alias("fecha_siniestro"),
            F.when(closed, F.to_date("l_shipdate")).alias("fecha_respuesta"),
            F.when(rejected, "SI").otherwise("NO").alias("id_rechazo"),
            F.when(closed, F.when(rejected, F.lit(0).cast(MONEY)).otherwise(amount)).alias("monto_reconocido"),
            amount.alias("monto_solicitado"))

    def recomienda(self) -> DataFrame:
        kind = F.col("event_type")
        return self.raw("events").select(
            F.col("user_id").alias("cod_cliente"), (F.col("event_id") % 5 + 1).cast("int").alias("cod_evaluacion_servicio"),
            (F.col("event_id") % self.rows("part")).alias("cod_producto"),
            F.when(kind.isin("purchase", "click"), "SI").when(kind == "error", F.lit(None)).otherwise("NO").alias("recomienda_amigo"))

    def metas(self) -> DataFrame:
        """A goal per product and order year."""
        lo, hi = (d.year for d in self.order_years())
        grid = self.raw("part").select(
            "p_partkey", "p_retailprice", "p_size", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("anio"))
        return grid.select(
            "anio", F.col("p_partkey").alias("cod_producto"),
            (F.col("p_retailprice").cast(MONEY) * (F.col("anio") - lo + 1)).cast(MONEY).alias("monto_meta_ingreso"),
            F.col("p_size").alias("meta_renovacion"), (F.col("p_size") * 2).alias("meta_asegurados"))

    def source(self) -> "Source":
        return Source(self)


class Source(Mapping[str, DataFrame]):
    """The source tables by name; a role is built when it is asked for."""

    NAMES = ["pais", "ciudad", "sucursal", "tipo_producto", "producto", "cliente", "evaluacion_servicio", "contrato",
             "siniestro", "recomienda", "registro_contrato", "registro_siniestro", "metas"]

    def __init__(self, r: Roles, replaced: Mapping[str, DataFrame] | None = None):
        self._roles, self._replaced = r, dict(replaced or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._replaced:
            return self._replaced[name]
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self._roles, name)()

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def with_table(self, name: str, df: DataFrame) -> "Source":
        return Source(self._roles, {**self._replaced, name: df})


_roles: dict[tuple[str, str], Roles] = {}
_tables: dict[tuple[str, str], Mapping[str, DataFrame]] = {}
_loaded: dict[tuple[str, str], tuple[WarehouseStore, LoadReport]] = {}


def roles(spark: SparkSession, sf_dir: str) -> Roles:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roles:
        _roles[key] = Roles(spark, sf_dir)
    return _roles[key]


def load_store(spark: SparkSession, sf_dir: str) -> tuple[WarehouseStore, LoadReport]:
    """A fresh warehouse loaded from the given tables."""
    r = roles(spark, sf_dir)
    store = WarehouseStore(spark, scratch_path(spark, "warehouse"))
    first, last = r.years()
    return store, run_load(store, r.source(), first, last)


def loaded(spark: SparkSession, sf_dir: str) -> tuple[WarehouseStore, LoadReport]:
    """The published warehouse of this application, loaded on first use: KPI reports read it, they do not rebuild it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        _loaded[key] = load_store(spark, sf_dir)
    return _loaded[key]


def warehouse(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Tables of the first published version; they are opened once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        _tables[key] = loaded(spark, sf_dir)[0].tables()
    return _tables[key]
