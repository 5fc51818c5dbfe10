"""One registered query per operator, each over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.driver.bindings import MONEY, Roles, Source, loaded, roles, warehouse
from starloom.functions.dates import key_year, register_sql_functions, smart_key
from starloom.functions.digests import table_fingerprint
from starloom.operators import quality as q
from starloom.operators.calendar import calendar_rows, date_series, extend_calendar
from starloom.operators.keys import assign_surrogate_keys, max_key
from starloom.operators.lookup import lookup, miss_counts
from starloom.operators.merge import apply_changes, apply_updates, insert_only, merge_fact, merge_metrics, scd1_upsert, sync_delete
from starloom.operators.totals import control_totals
from starloom.plans import dimensions, facts, kpis
from starloom.plans.change_load import rewritten_parts, run_change_load
from starloom.plans.warehouse_load import LoadAborted, refresh_goals, reset_scope, run_load
from starloom.schemas import CONTRACT_STATES, DIMENSIONS, FACT_KEYS, RATING_LABELS, source_rules, state_rows, warehouse_rules
from starloom.session import scratch_path
from starloom.sources.goals import FIRST_YEAR, checked_goals, goal_violations, normalise_goals, stage, typed_goals
from starloom.sources.store import PublishedTables, WarehouseStore
from starloom.streaming.snapshots import announced_snapshots, bound_snapshots, land_snapshot, quarantined, watch, watch_sources

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def conform(df: DataFrame) -> DataFrame:
    """Plain result types: integers as LONG, decimals as DOUBLE, dates as text."""
    plain = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "date": "string"}
    columns = []
    for name, kind in df.dtypes:
        target = "double" if kind.startswith("decimal") else plain.get(kind)
        columns.append(F.col(f"`{name}`").cast(target).alias(name) if target else F.col(f"`{name}`"))
    return df.select(*columns)


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: conform(fn(spark, sf_dir))
    return fn


# --- calendar and keys -------------------------------------------------------------------------------------


@query
def calendar_dim(spark, sf_dir):
    """Calendar over the whole years of the order and ship dates."""
    return calendar_rows(date_series(spark, *roles(spark, sf_dir).years()))


@query
def calendar_extend(spark, sf_dir):
    """A calendar that ends at the last order day, extended to whole years; its days (marked) stay as they are."""
    r = roles(spark, sf_dir)
    first, last = r.years()
    until = r.raw("orders").agg(F.to_date(F.max("o_orderdate"))).first()[0]
    existing = calendar_rows(date_series(spark, first, until)).withColumn("desc_trimestre", F.lower("desc_trimestre"))
    return extend_calendar(spark, existing, first, last)


@query
def smart_key_counts(spark, sf_dir):
    """Lines per ship-date key; open lines have no date and so no key."""
    day = F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate"))
    return roles(spark, sf_dir).raw("lineitem").groupBy(smart_key(day).alias("sk_dim_tiempo")).agg(
        F.count(F.lit(1)).alias("n_lines"))


@query
def smart_key_sql(spark, sf_dir):
    """The same count by the SQL form of the key function."""
    register_sql_functions(spark)
    return spark.sql(
        "SELECT fn_sk_tiempo(CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END) AS sk_dim_tiempo, count(*) AS n_lines"
        " FROM {lines} GROUP BY ALL", lines=roles(spark, sf_dir).raw("lineitem"))


@query
def fixed_domain_dim(spark, sf_dir):
    """The fixed state domain added to the states that the line status already implies."""
    implied = F.when(F.col("l_linestatus") == "O", CONTRACT_STATES[0][0]).otherwise(CONTRACT_STATES[1][0])
    known = roles(spark, sf_dir).raw("lineitem").select(implied.alias("cod_estado")).distinct()
    existing = assign_surrogate_keys(known, ["cod_estado"], "sk_dim_estado_contrato").withColumn(
        "descrip_estado", F.lower("cod_estado"))
    return insert_only(existing, state_rows(spark), "cod_estado", "sk_dim_estado_contrato", ["orden"]).state


@query
def surrogate_keys(spark, sf_dir):
    """New keys for every claim number, continuing after the largest order key."""
    r = roles(spark, sf_dir)
    seed = max_key(r.raw("orders"), "o_orderkey")
    return assign_surrogate_keys(r.siniestro().select("nro_siniestro"), ["nro_siniestro"], "sk_dim_siniestro", seed)


@query
def surrogate_keys_sentinel(spark, sf_dir):
    """Keys <= 0 never seed the sequence: the existing keys here are all sentinels."""
    r = roles(spark, sf_dir)
    existing = r.raw("supplier").select((-F.col("s_suppkey")).alias("sk"))
    return assign_surrogate_keys(r.cliente().select("cod_cliente"), ["cod_cliente"], "sk", max_key(existing, "sk"))


# --- sources and staging -----------------------------------------------------------------------------------


@query
def control_totals_goals(spark, sf_dir):
    return control_totals(roles(spark, sf_dir).metas(), "monto_meta_ingreso")


@query
def apply_change_batch(spark, sf_dir):
    """Every suspended order expires (update) and every finished one is renewed under a new number (insert)."""
    base = roles(spark, sf_dir).raw("orders").select(
        F.col("o_orderkey").alias("nro_contrato"), F.col("o_custkey").alias("cod_cliente"),
        F.col("o_orderstatus").alias("estado"), F.col("o_totalprice").cast(MONEY).alias("monto"))
    expired = base.where("estado = 'P'").withColumn("estado", F.lit("F"))
    renewed = base.where("estado = 'F'").withColumn("nro_contrato", -F.col("nro_contrato") - 1).withColumn("estado", F.lit("O"))
    return apply_changes(base, expired.unionByName(renewed), ["nro_contrato"])


@query
def resolve_open_claims(spark, sf_dir):
    """Column-wise updates: every open claim is answered after 30 days and paid in full."""
    claims = facts.claim_source(roles(spark, sf_dir).source()).select(
        "nro_siniestro", "nro_contrato", "fecha_siniestro", "fecha_respuesta", "id_rechazo", "monto_reconocido",
        "monto_solicitado")
    updates = claims.where("fecha_respuesta IS NULL").select(
        "nro_siniestro", "nro_contrato", F.date_add("fecha_siniestro", 30).alias("fecha_respuesta"),
        F.lit("NO").alias("id_rechazo"), F.col("monto_solicitado").alias("monto_reconocido"))
    return apply_updates(claims, updates, ["nro_siniestro", "nro_contrato"], ["fecha_respuesta", "id_rechazo", "monto_reconocido"])


def _text_goals(r: Roles) -> DataFrame:
    """The goals as a landed sheet: untidy headers, an extra column, blank rows where the brand is Brand#1."""
    brands = r.raw("part").select(F.col("p_partkey").alias("cod_producto"), "p_brand")
    goals = r.metas().join(brands.hint("merge"), "cod_producto")  # as compressed files, even many products look fit for a broadcast
    cell = lambda c: F.when(F.col("p_brand") != "Brand#1", F.col(c).cast("string"))
    return goals.select(
        cell("anio").alias(" Anio "), cell("cod_producto").alias("COD_PRODUCTO"),
        cell("monto_meta_ingreso").alias("monto_meta_ingreso "), cell("meta_renovacion").alias("Meta_Renovacion"),
        cell("meta_asegurados").alias("META_ASEGURADOS"), F.when(F.col("p_brand") != "Brand#1", F.lit("x")).alias("comment"))


@query
def staging_load(spark, sf_dir):
    """The landed sheet normalised and typed (the load timestamp is left out)."""
    return typed_goals(normalise_goals(_text_goals(roles(spark, sf_dir))))


# --- joins -------------------------------------------------------------------------------------------------


@query
def product_type_lookup(spark, sf_dir):
    r = roles(spark, sf_dir)
    return dimensions.product_rows({"producto": r.producto(), "tipo_producto": r.tipo_producto()})


@query
def branch_flatten(spark, sf_dir):
    r = roles(spark, sf_dir)
    return dimensions.branch_rows({"pais": r.pais(), "ciudad": r.ciudad(), "sucursal": r.sucursal()})


@query
def contract_enrich(spark, sf_dir):
    r = roles(spark, sf_dir)
    return facts.enrich_lines({"registro_contrato": r.registro_contrato(), "cliente": r.cliente()})


@query
def claim_enrich_dedup(spark, sf_dir):
    return facts.claim_source(roles(spark, sf_dir).source())


@query
def key_lookup_miss(spark, sf_dir):
    """Contract lines keyed against dimensions that know only even client and product numbers."""
    r = roles(spark, sf_dir)
    clients = r.raw("customer").select((F.col("c_custkey") * 2).alias("nk"), F.col("c_custkey").alias("sk_dim_cliente"))
    products = r.raw("part").select((F.col("p_partkey") * 2).alias("nk"), F.col("p_partkey").alias("sk_dim_producto"))
    keyed = lookup(r.registro_contrato(), clients, {"cod_cliente": "nk"}, ["sk_dim_cliente"])
    keyed = lookup(keyed, products, {"cod_producto": "nk"}, ["sk_dim_producto"])
    states = state_rows(spark).select("cod_estado", F.col("orden").alias("sk_dim_estado_contrato"))
    keyed = lookup(keyed.withColumn("cod_estado", F.upper("estado_contrato")), states, ["cod_estado"], ["sk_dim_estado_contrato"])
    return miss_counts(keyed, ["sk_dim_cliente", "sk_dim_producto", "sk_dim_estado_contrato"])


# --- dimension merges --------------------------------------------------------------------------------------


def _doubled(rows: DataFrame, name: str) -> DataFrame:
    """An older state of a dimension in which every natural key was twice what it is now: even keys match,
    odd keys are new, keys above the present maximum are gone from the source."""
    key, natural, attributes = DIMENSIONS[name]
    keyed = assign_surrogate_keys(rows, [natural], key)
    return keyed.select(key, (F.col(natural) * 2).cast(dict(rows.dtypes)[natural]).alias(natural), *attributes)


def _scd1(spark, sf_dir, name: str) -> DataFrame:
    r = roles(spark, sf_dir)
    src = r.source()
    return dimensions.load_dimension(name, src, _doubled(dimensions.SOURCES[name](src), name)).state


@query
def scd1_client(spark, sf_dir):
    return _scd1(spark, sf_dir, "dim_cliente")


@query
def scd1_product(spark, sf_dir):
    return _scd1(spark, sf_dir, "dim_producto")


@query
def scd1_branch(spark, sf_dir):
    return _scd1(spark, sf_dir, "dim_sucursal")


@query
def scd1_contract(spark, sf_dir):
    return _scd1(spark, sf_dir, "dim_contrato")


@query
def scd1_rating(spark, sf_dir):
    return _scd1(spark, sf_dir, "dim_evaluacion_servicio")


@query
def scd1_claim(spark, sf_dir):
    return _scd1(spark, sf_dir, "dim_siniestro")


@query
def scd1_null_overwrite(spark, sf_dir):
    """A NULL in the source replaces a value in the dimension."""
    clients = dimensions.client_rows({"cliente": roles(spark, sf_dir).cliente()})
    target = clients.select((F.col("cod_cliente_nk") + 1).alias("sk_dim_cliente"), "cod_cliente_nk", F.lit("old").alias("telefono"))
    return scd1_upsert(target, clients, "cod_cliente_nk", "sk_dim_cliente", ["telefono"]).state


@query
def scd1_repeated_keys(spark, sf_dir):
    """First load of a dimension whose source repeats its key: every line of an order is a row of one claim."""
    described = F.concat("l_returnflag", "l_linestatus", F.lit(" "), F.date_format("l_shipdate", "yyyy-MM-dd"))
    claims = roles(spark, sf_dir).raw("lineitem").select(
        F.col("l_orderkey").alias("nro_siniestro"), described.alias("descripcion_siniestro"))
    return dimensions.load_dimension("dim_siniestro", {"siniestro": claims}, None).state


# --- fact loads --------------------------------------------------------------------------------------------


@query
def fact_contract_load(spark, sf_dir):
    return warehouse(spark, sf_dir)["fact_registro_contrato"]


@query
def fact_claim_load(spark, sf_dir):
    return warehouse(spark, sf_dir)["fact_registro_siniestro"]


@query
def fact_evaluation_load(spark, sf_dir):
    return warehouse(spark, sf_dir)["fact_evaluacion_servicio"]


@query
def fact_goals_load(spark, sf_dir):
    return warehouse(spark, sf_dir)["fact_metas"]


# Upserts on a fact that exists.  The source is the whole fact.  The old fact has one of its keys doubled: rows whose key is
# twice another one match, and have other values there; keys beyond the greatest are gone from the source; the rest is new.

def _upsert(spark, sf_dir, name: str, key: str, old: Mapping[str, Column], **options) -> DataFrame:
    fact = warehouse(spark, sf_dir)[name]
    previous = fact.withColumns({**old, key: F.col(key) * 2}).select(*fact.columns)
    return merge_fact(previous, fact, FACT_KEYS[name], **options)


@query
def fact_contract_upsert(spark, sf_dir):
    return _upsert(spark, sf_dir, "fact_registro_contrato", "sk_dim_contrato", {"monto": (F.col("monto") + 1).cast(MONEY)})


@query
def fact_claim_upsert_kept(spark, sf_dir):
    """Of the old claims that the source lacks, those of every second contract are kept as they were."""
    keys = FACT_KEYS["fact_registro_siniestro"]
    fact = warehouse(spark, sf_dir)["fact_registro_siniestro"]
    live = fact.withColumn("sk_dim_siniestro", F.col("sk_dim_siniestro") * 2).where("sk_dim_contrato % 2 = 0").select(*keys)
    old = {"monto_solicitado": (F.col("monto_solicitado") + 1).cast(MONEY)}
    return _upsert(spark, sf_dir, "fact_registro_siniestro", "sk_dim_siniestro", old, retain_keys=live)


@query
def fact_evaluation_upsert(spark, sf_dir):
    """A match replaces rating and recommendation, and keeps the day of the old row."""
    day = F.lit(20000101).cast("int")
    return _upsert(spark, sf_dir, "fact_evaluacion_servicio", "sk_dim_cliente", {"sk_dim_tiempo_evaluacion": day},
                   overwrite=["sk_dim_evaluacion_servicio", "cantidad", "recomienda_amigo"])


@query
def fact_goals_upsert(spark, sf_dir):
    old = {"meta_renovacion": F.col("meta_renovacion") + 1}
    return _upsert(spark, sf_dir, "fact_metas", "sk_dim_producto", old, guard_empty=True)


@query
def evaluation_rejects(spark, sf_dir):
    return facts.rejected_ratings(roles(spark, sf_dir).source())


@query
def goals_empty_guard(spark, sf_dir):
    """Empty staging (no goal is negative) leaves the loaded goals alone."""
    wh = warehouse(spark, sf_dir)
    staged = roles(spark, sf_dir).metas().where("monto_meta_ingreso < 0")
    return facts.load_goals(staged, wh, wh["fact_metas"])


def _without_first_year(r: Roles) -> Mapping[str, DataFrame]:
    """The source after the contracts that started in the first order year were purged."""
    cut = dt.date(r.order_years()[0].year + 1, 1, 1)
    kept = r.registro_contrato().where(F.col("fecha_inicio") >= F.lit(cut))
    return r.source().with_table("registro_contrato", kept)


@query
def sync_delete_contracts(spark, sf_dir):
    """Contract facts left after a purge of the source."""
    wh, r = warehouse(spark, sf_dir), roles(spark, sf_dir)
    live = facts.live_contract_keys(_without_first_year(r), wh)
    return sync_delete(wh["fact_registro_contrato"], live, FACT_KEYS["fact_registro_contrato"])


@query
def evaluation_sync(spark, sf_dir):
    """Rating facts left after the same purge: the pair must be rated and still have a contract."""
    wh, r = warehouse(spark, sf_dir), roles(spark, sf_dir)
    src = _without_first_year(r)
    rated = src["recomienda"].select("cod_cliente", "cod_producto").distinct()
    covered = lookup(rated, src["registro_contrato"].select("cod_cliente", "cod_producto").distinct(), ["cod_cliente", "cod_producto"], how="semi")
    keyed = lookup(covered, wh["dim_cliente"], {"cod_cliente": "cod_cliente_nk"}, ["sk_dim_cliente"], "inner")
    keyed = lookup(keyed, wh["dim_producto"], {"cod_producto": "cod_producto_nk"}, ["sk_dim_producto"], "inner")
    return sync_delete(wh["fact_evaluacion_servicio"], keyed, FACT_KEYS["fact_evaluacion_servicio"])


@query
def merge_metrics_contracts(spark, sf_dir):
    """What a load does when the fact lacks the last order year, has amounts one higher for one state, and the
    source lacks the first year."""
    wh, r = warehouse(spark, sf_dir), roles(spark, sf_dir)
    lo, hi = (d.year for d in r.order_years())
    fact = wh["fact_registro_contrato"]
    year = key_year(F.col("sk_dim_tiempo_fecha_inicio"))
    bumped = F.when(F.col("sk_dim_estado_contrato") == 3, F.col("monto") + 1).otherwise(F.col("monto")).cast(MONEY)
    previous = fact.where(year < hi).withColumn("monto", bumped)
    return merge_metrics(previous, fact.where(year > lo), FACT_KEYS["fact_registro_contrato"])


@query
def merge_rerun(spark, sf_dir):
    """Metrics of a second load from the same source: nothing inserted, changed or deleted."""
    r = roles(spark, sf_dir)
    store, _ = loaded(spark, sf_dir)
    report = run_load(store, r.source(), *r.years())
    return report.frame(spark).select(
        "table_name", "inserted", F.coalesce("changed", F.lit(0)).alias("changed"), F.coalesce("deleted", F.lit(0)).alias("deleted"))


@query
def warehouse_counts(spark, sf_dir):
    """Rows per published table."""
    counts = None
    for name, df in sorted(warehouse(spark, sf_dir).items()):
        one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query
def scoped_reset(spark, sf_dir):
    """Rows per table after every client of one segment, with its contracts and their claims, was removed."""
    wh, r = warehouse(spark, sf_dir), roles(spark, sf_dir)
    gone = r.raw("customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("cod_cliente_nk"))
    contracts = r.raw("orders").join(gone, F.col("o_custkey") == F.col("cod_cliente_nk"), "left_semi").select(
        F.col("o_orderkey").alias("nro_contrato_nk"))
    claims = r.registro_siniestro().join(contracts, F.col("nro_contrato") == F.col("nro_contrato_nk"), "left_semi").select(
        F.col("nro_siniestro").alias("nro_siniestro_nk")).distinct()
    after = reset_scope(wh, gone, contracts, claims)
    names = ["dim_cliente", "dim_contrato", "dim_siniestro", "fact_registro_contrato", "fact_registro_siniestro", "fact_evaluacion_servicio"]
    counts = [after[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in names]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


# --- data quality ------------------------------------------------------------------------------------------


@query
def dq_primary_key(spark, sf_dir):
    """Repeated business keys of the contract and claim registers."""
    src = roles(spark, sf_dir).source()
    return q.violations(src, [
        q.TableRules(t, k, [q.unique(*k)])
        for t, k in {"registro_contrato": ["nro_contrato", "cod_producto", "cod_cliente"],
                     "registro_siniestro": ["nro_siniestro", "nro_contrato"]}.items()])


@query
def dq_unique(spark, sf_dir):
    """Attributes that should be unique: client document and product name."""
    src = roles(spark, sf_dir).source()
    return q.violations(src, [
        q.TableRules("cliente", ["cod_cliente"], [q.unique("ci_rif")]),
        q.TableRules("producto", ["cod_producto"], [q.unique("nb_producto")])])


@query
def dq_not_null(spark, sf_dir):
    """Missing responses, amounts and recommendations, counted per rule."""
    src = roles(spark, sf_dir).source()
    return q.summarise(q.violations(src, [
        q.TableRules("registro_siniestro", ["nro_siniestro", "nro_contrato"],
                     [q.not_null("fecha_respuesta"), q.not_null("monto_reconocido"), q.not_null("monto_solicitado")]),
        q.TableRules("recomienda", ["cod_cliente", "cod_producto"], [q.not_null("recomienda_amigo")])]))


@query
def dq_domain(spark, sf_dir):
    """Domain, range and length rules over products, clients and types; NULL passes."""
    src = roles(spark, sf_dir).source()
    return q.violations(src, [
        q.TableRules("producto", ["cod_producto"], [
            q.between("calificacion", 2, 5), q.max_length("nb_producto", 10), q.domain("descripcion", ["BRAND#1", "BRAND#2", "BRAND#3"])]),
        q.TableRules("cliente", ["cod_cliente"], [q.domain("sexo", ["m"], upper=False), q.max_length("telefono", 7)])])


@query
def dq_pair_domain(spark, sf_dir):
    """Rating code and label must belong together; events of one type carry the label of the next code."""
    code = F.col("event_id") % 5 + 1
    shifted = F.when(F.col("event_type") == "error", code % 5 + 1).otherwise(code).cast("int")
    labels = F.create_map(*[F.lit(x) for p in RATING_LABELS.items() for x in p])
    rated = roles(spark, sf_dir).raw("events").select(
        "event_id", code.cast("int").alias("codigo"), F.lower(F.element_at(labels, shifted)).alias("etiqueta"))
    return q.violations({"eventos": rated}, [q.TableRules("eventos", ["event_id"], [q.pair_domain("codigo", "etiqueta", RATING_LABELS)])])


@query
def dq_foreign_key(spark, sf_dir):
    """References without a parent: rated pairs without a contract line, and clients of ratings and contracts."""
    src = roles(spark, sf_dir).source()
    return q.violations(src, [
        q.TableRules("recomienda", ["cod_cliente", "cod_producto"], [
            q.foreign_key(["cod_cliente", "cod_producto"], "registro_contrato", ["cod_cliente", "cod_producto"]),
            q.foreign_key(["cod_cliente"], "cliente", ["cod_cliente"])]),
        q.TableRules("registro_contrato", ["nro_contrato"], [q.foreign_key(["cod_cliente"], "cliente", ["cod_cliente"])])])


@query
def dq_date_order(spark, sf_dir):
    """Contracts that end before they start and claims answered before they happened."""
    src = roles(spark, sf_dir).source()
    return q.violations(src, [
        q.TableRules("registro_contrato", ["nro_contrato", "cod_producto", "cod_cliente"], [q.not_before("fecha_fin", "fecha_inicio")]),
        q.TableRules("registro_siniestro", ["nro_siniestro", "nro_contrato"], [q.not_before("fecha_respuesta", "fecha_siniestro")])])


def _dirty_goals(r: Roles) -> DataFrame:
    """Goals spoilt by rule: every kind of violation occurs in some brand or size."""
    brand, size = F.col("p_brand"), F.col("p_size")
    lo, hi = (d.year for d in r.order_years())
    grid = r.raw("part").withColumn("y", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
    return grid.select(
        F.concat_ws("-", F.col("p_partkey").cast("string"), F.col("y").cast("string")).alias("row_no"),
        F.when(brand == "Brand#2", "n/a").when(brand == "Brand#3", F.lit(str(lo - 500))).when(brand == "Brand#4", F.lit(str(hi)))
        .when(brand == "Brand#5", F.concat(F.col("y").cast("string"), F.lit(".7"))).otherwise(F.col("y").cast("string")).alias("anio"),
        F.when(brand == "Brand#6", F.lit(None)).when(brand == "Brand#7", F.concat(F.lit("-"), (F.col("p_partkey") + 1).cast("string")))
        .otherwise(F.col("p_partkey").cast("string")).alias("cod_producto"),
        F.when(size == 1, F.lit("-1.00")).otherwise(F.col("p_retailprice").cast(MONEY).cast("string")).alias("monto_meta_ingreso"),
        F.when(size == 2, F.lit(" ")).otherwise(size.cast("string")).alias("meta_renovacion"),
        (size - 3).cast("string").alias("meta_asegurados"))


@query
def dq_goals(spark, sf_dir):
    """Every violation of a spoilt goals sheet, checked against the product and calendar dimensions."""
    r = roles(spark, sf_dir)
    products = r.raw("part").select(F.col("p_partkey").alias("cod_producto_nk"))
    lo, hi = r.order_years()
    calendar = calendar_rows(date_series(spark, lo, dt.date(hi.year, 6, 30)))
    return goal_violations(normalise_goals(_dirty_goals(r)), products, calendar)


@query
def source_quality(spark, sf_dir):
    """All declared constraints of the source tables, counted per rule: one scan of each table."""
    src = roles(spark, sf_dir).source()
    return q.quality_summary({t: src[t] for t in src if t != "metas"}, [source_rules(t) for t in src if t != "metas"])


@query
def warehouse_references(spark, sf_dir):
    """The 21 references of the facts: different keys and rows, and those without a dimension row."""
    wh = {n: df for n, df in warehouse(spark, sf_dir).items() if n.startswith(("dim_", "fact_"))}
    return q.reference_summary(wh, [warehouse_rules(t) for t in wh])


@query
def dq_reference_misses(spark, sf_dir):
    """The references again, against client and product dimensions that know only every key that another one is twice of."""
    wh = {n: df for n, df in warehouse(spark, sf_dir).items() if n.startswith(("dim_", "fact_"))}
    for name, key in (("dim_cliente", "sk_dim_cliente"), ("dim_producto", "sk_dim_producto")):
        wh[name] = wh[name].withColumn(key, F.col(key) * 2)
    return q.reference_summary(wh, [warehouse_rules(t) for t in wh])


# --- KPIs and reports --------------------------------------------------------------------------------------


@query
def kpi_response_days(spark, sf_dir):
    return kpis.response_days(warehouse(spark, sf_dir))


@query
def kpi_contracts_by_state(spark, sf_dir):
    return kpis.contracts_by_state(warehouse(spark, sf_dir))


@query
def kpi_claim_rate(spark, sf_dir):
    return kpis.claim_rate(warehouse(spark, sf_dir))


@query
def kpi_rating_recommend(spark, sf_dir):
    return kpis.rating_recommend(warehouse(spark, sf_dir))


@query
def kpi_goal_attainment(spark, sf_dir):
    return kpis.goal_attainment(warehouse(spark, sf_dir))


@query
def kpi_goal_attainment_year(spark, sf_dir):
    """Attainment in the last order year: a filter on the year computed from the date key."""
    return kpis.goal_attainment(warehouse(spark, sf_dir), year=roles(spark, sf_dir).order_years()[1].year)


@query
def kpi_income_by_type(spark, sf_dir):
    return kpis.income_by_type(warehouse(spark, sf_dir))


@query
def kpi_rejected_share(spark, sf_dir):
    return kpis.rejected_share(warehouse(spark, sf_dir))


@query
def kpi_amount_by_branch(spark, sf_dir):
    return kpis.amount_by_branch(warehouse(spark, sf_dir))


@query
def kpi_before_after(spark, sf_dir):
    """Contracted amount per branch before and after the contracts of the last order year arrived."""
    wh, r = warehouse(spark, sf_dir), roles(spark, sf_dir)
    fact = wh["fact_registro_contrato"]
    before = {**wh, "fact_registro_contrato": fact.where(key_year(F.col("sk_dim_tiempo_fecha_inicio")) < r.order_years()[1].year)}
    return kpis.compare(kpis.amount_by_branch(before), kpis.amount_by_branch(wh), ["nb_sucursal"])


@query
def client_present(spark, sf_dir):
    return kpis.client_present(warehouse(spark, sf_dir))


@query
def contract_detail(spark, sf_dir):
    return kpis.contract_detail(warehouse(spark, sf_dir))


@query
def contract_no_duplicate(spark, sf_dir):
    return kpis.contract_state(warehouse(spark, sf_dir))


@query
def claim_detail(spark, sf_dir):
    return kpis.claim_detail(warehouse(spark, sf_dir))


@query
def claim_resolved(spark, sf_dir):
    return kpis.claim_resolution(warehouse(spark, sf_dir))


@query
def evaluation_detail(spark, sf_dir):
    return kpis.rating_detail(warehouse(spark, sf_dir))


# --- change batches ----------------------------------------------------------------------------------------


def _change_batch(r: Roles) -> dict[str, DataFrame]:
    """New and changed source rows: every suspended line expires and costs 100 more, every open claim is answered after 30
    days and paid in full, and each nation has a new client with a contract, a rejected claim and a rating."""
    day = r.order_years()[1].year
    product, branch = (r.raw(t).agg(F.min(c)).first()[0] for t, c in (("part", "p_partkey"), ("supplier", "s_suppkey")))
    nation = r.raw("nation")
    new = (-F.col("n_nationkey") - 1).cast("long")
    on = lambda month, d: F.lit(dt.date(day, month, d))
    money = lambda v: F.lit(v).cast(MONEY)
    client = nation.select(
        new.alias("cod_cliente"), F.concat(F.lit("Client of "), "n_name").alias("nb_cliente"), F.concat(F.lit("N"), new.cast("string")).alias("ci_rif"),
        F.lit(None).cast("string").alias("telefono"), F.col("n_name").alias("direccion"), F.lit("F").alias("sexo"),
        F.lower(F.concat("n_name", F.lit("@example.org"))).alias("email"), F.lit(branch).alias("cod_sucursal"))
    line = nation.select(
        new.alias("nro_contrato"), F.lit(product).alias("cod_producto"), new.alias("cod_cliente"), on(1, 2).alias("fecha_inicio"),
        on(12, 30).alias("fecha_fin"), (F.col("n_nationkey") + 1000).cast(MONEY).alias("monto"), F.lit("Activo").alias("estado_contrato"))
    claim = nation.select(
        new.alias("nro_siniestro"), new.alias("nro_contrato"), on(6, 1).alias("fecha_siniestro"), on(6, 15).alias("fecha_respuesta"),
        F.lit("SI").alias("id_rechazo"), money(0).alias("monto_reconocido"), money(500).alias("monto_solicitado"))
    expired = r.registro_contrato().where("estado_contrato = 'suspendido'").withColumns(
        {"estado_contrato": F.lit("VENCIDO"), "monto": (F.col("monto") + 100).cast(MONEY)})
    answered = r.registro_siniestro().where("fecha_respuesta IS NULL").withColumns(
        {"fecha_respuesta": F.date_add("fecha_siniestro", 30), "id_rechazo": F.lit("NO"), "monto_reconocido": F.col("monto_solicitado")})
    return {
        "cliente": client, "contrato": nation.select(new.alias("nro_contrato"), F.col("n_name").alias("descrip_contrato")),
        "siniestro": nation.select(new.alias("nro_siniestro"), F.col("n_name").alias("descripcion_siniestro")),
        "registro_contrato": expired.unionByName(line), "registro_siniestro": answered.unionByName(claim),
        "recomienda": nation.select(
            new.alias("cod_cliente"), F.lit(5).alias("cod_evaluacion_servicio"), F.lit(product).alias("cod_producto"),
            F.lit("SI").alias("recomienda_amigo")),
    }


_changes: dict[tuple[str, str], tuple[PublishedTables, PublishedTables]] = {}


def _changed(spark, sf_dir) -> tuple[PublishedTables, PublishedTables]:
    """The warehouse before and after the change batch was loaded into a store that keeps registers and KPI parts."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _changes:
        r = roles(spark, sf_dir)
        store = WarehouseStore(spark, scratch_path(spark, "changes"))
        run_load(store, r.source(), *r.years(), with_metrics=False, register_buckets=8, keep_kpis=True)
        before = store.tables()
        run_change_load(store, _change_batch(r))
        _changes[key] = before, store.tables()
    return _changes[key]


@query
def change_load_contracts(spark, sf_dir):
    return kpis.contract_detail(_changed(spark, sf_dir)[1])


@query
def change_load_claims(spark, sf_dir):
    return kpis.claim_detail(_changed(spark, sf_dir)[1])


@query
def change_load_ratings(spark, sf_dir):
    return kpis.rating_detail(_changed(spark, sf_dir)[1])


@query
def change_load_parts(spark, sf_dir):
    """Years of the facts that the batch made the load write; nothing else of a fact was."""
    before, after = _changed(spark, sf_dir)
    parts = [p for p in rewritten_parts(before, after) if p[0].startswith("fact_")]
    return spark.createDataFrame(parts, "table_name STRING, anio LONG")


@query
def reload_parts(spark, sf_dir):
    """Parts per fact, and how many of them a second load of the same source has written: none."""
    r = roles(spark, sf_dir)
    store = WarehouseStore(spark, scratch_path(spark, "reload"))
    load = store.open_load()
    load.adopt(loaded(spark, sf_dir)[0].paths())
    load.publish()
    before = store.tables()
    run_load(store, r.source(), *r.years(), with_metrics=False)
    written = [name for name, _ in rewritten_parts(before, store.tables())]
    counts = [(n, len(before.parts(n)), written.count(n)) for n in sorted(FACT_KEYS)]
    return spark.createDataFrame(counts, "table_name STRING, n_parts LONG, n_written LONG")


# --- quarantine --------------------------------------------------------------------------------------------


def _planted(r: Roles) -> Source:
    """The source with misses: suspended lines get a state that is unknown, open claims a date a century before, and
    ratings without a recommendation a code that is unknown."""
    line, claim, rating = r.registro_contrato(), r.registro_siniestro(), r.recomienda()
    state = F.when(F.col("estado_contrato") == "suspendido", "anulado").otherwise(F.col("estado_contrato"))
    day = F.when(F.col("fecha_respuesta").isNull(), F.add_months("fecha_siniestro", -1200)).otherwise(F.col("fecha_siniestro"))
    code = F.when(F.col("recomienda_amigo").isNull(), 9).otherwise(F.col("cod_evaluacion_servicio"))
    return Source(r, {
        "registro_contrato": line.withColumn("estado_contrato", state),
        "registro_siniestro": claim.withColumn("fecha_siniestro", day),
        "recomienda": rating.withColumn("cod_evaluacion_servicio", code.cast(rating.schema["cod_evaluacion_servicio"].dataType)),
    })


_quarantined: dict[tuple[str, str], PublishedTables] = {}


def _with_quarantine(spark, sf_dir) -> PublishedTables:
    """The warehouse after a quarantine load of the planted source."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _quarantined:
        r = roles(spark, sf_dir)
        store = WarehouseStore(spark, scratch_path(spark, "quarantine"))
        run_load(store, _planted(r), *r.years(), with_metrics=False, quarantine=True)
        _quarantined[key] = store.tables()
    return _quarantined[key]


def _set_aside(fact: str):
    def rows(spark, sf_dir):
        misses = _with_quarantine(spark, sf_dir)[f"quarantine_{fact}"]
        return misses.withColumn("failed", F.array_join("failed", "; "))

    return rows


for _fact, _name in (("fact_registro_contrato", "contracts"), ("fact_registro_siniestro", "claims"), ("fact_evaluacion_servicio", "ratings")):
    _rows = _set_aside(_fact)
    _rows.__name__, _rows.__doc__ = f"quarantine_{_name}", "Rows that the quarantine load set aside, with what they lack."
    query(_rows)


@query
def quarantine_contract_detail(spark, sf_dir):
    """What the same load published as the contract fact."""
    return kpis.contract_detail(_with_quarantine(spark, sf_dir))


@query
def quarantine_rating_detail(spark, sf_dir):
    return kpis.rating_detail(_with_quarantine(spark, sf_dir))


@query
def load_abort(spark, sf_dir):
    """Without quarantine the load of that source aborts: what its first failing fact lacks, and the version readers see."""
    r = roles(spark, sf_dir)
    store = WarehouseStore(spark, scratch_path(spark, "abort"))
    try:
        run_load(store, _planted(r), *r.years(), with_metrics=False)
        found = []
    except LoadAborted as stop:
        found = [(stop.table, check, n, store.version()) for check, n in stop.counts.items()]
    return spark.createDataFrame(found, "table_name STRING, failed STRING, n LONG, version LONG")


def _kpi_change(name: str) -> None:
    def before_after(spark, sf_dir):
        before, after = _changed(spark, sf_dir)
        sides = [conform(kpis.from_kept(name, wh)) for wh in (before, after)]  # each row once, not once per row of the result
        return kpis.compare(*sides, kpis.KPIS[name][1])

    before_after.__name__ = f"kpi_change_{name}"
    before_after.__doc__ = "The KPI before and after the batch, from the parts that the loads kept: no fact is read."
    query(before_after)


for _name in kpis.KPIS:
    _kpi_change(_name)


@query
def check_new_clients(spark, sf_dir):
    """Every client of the batch: rows in the dimension before the load and after it (0 and 1)."""
    before, after = _changed(spark, sf_dir)
    keys = _change_batch(roles(spark, sf_dir))["cliente"].select(F.col("cod_cliente").alias("cod_cliente_nk"))
    return kpis.presence(kpis.client_present(before), kpis.client_present(after), keys)


@query
def check_no_duplicates(spark, sf_dir):
    """Every line of the batch: rows and state of its business key before the load and after it."""
    before, after = _changed(spark, sf_dir)
    lines = _change_batch(roles(spark, sf_dir))["registro_contrato"]
    business = {"nro_contrato": "nro_contrato_nk", "cod_producto": "cod_producto_nk", "cod_cliente": "cod_cliente_nk"}
    keys = lines.select(*[F.col(c).alias(n) for c, n in business.items()]).distinct()
    return kpis.presence(kpis.contract_state(before), kpis.contract_state(after), keys, ["descrip_estado"])


@query
def check_resolved_claims(spark, sf_dir):
    """Every claim of the batch: rows, response, rejection and amount before the load and after it."""
    before, after = _changed(spark, sf_dir)
    claims = _change_batch(roles(spark, sf_dir))["registro_siniestro"]
    keys = claims.select(F.col("nro_siniestro").alias("nro_siniestro_nk"), F.col("nro_contrato").alias("nro_contrato_nk")).distinct()
    return kpis.presence(kpis.claim_resolution(before), kpis.claim_resolution(after), keys,
                         ["fecha_respuesta", "id_rechazo", "monto_reconocido"])


# --- snapshots ---------------------------------------------------------------------------------------------


def _customer_fingerprint(spark, sf_dir):
    """Every column; the balance as a decimal, which both sides print alike."""
    customer = roles(spark, sf_dir).raw("customer")
    return table_fingerprint(customer.withColumn("c_acctbal", F.col("c_acctbal").cast(MONEY)))


@query
def snapshot_fingerprint(spark, sf_dir):
    return _customer_fingerprint(spark, sf_dir)


def _sheet_goals(r: Roles) -> tuple[DataFrame, dt.date, dt.date]:
    """Goals moved to years that a sheet admits, and a calendar range that covers them."""
    lo, hi = (d.year for d in r.order_years())
    shift = max(FIRST_YEAR - lo, 0)
    return r.metas().withColumn("anio", F.col("anio") + shift), dt.date(lo, 1, 1), dt.date(hi + shift, 12, 31)


_watched: dict[tuple[str, str], WarehouseStore] = {}


def _watched_store(spark, sf_dir) -> WarehouseStore:
    """A store that has watched four goal sheets: good, the same again, a spoilt one, and a revised one.

    A sheet admits no year before 2000, so the goals, and the calendar with them, are moved to start there.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _watched:
        return _watched[key]
    r = roles(spark, sf_dir)
    base, _ = loaded(spark, sf_dir)
    store = WarehouseStore(spark, scratch_path(spark, "watch"))
    load = store.open_load()
    load.adopt({n: p for n, p in base.paths().items() if n.startswith("dim_")})
    good, first, last = _sheet_goals(r)
    load.write("dim_tiempo", extend_calendar(spark, base.tables()["dim_tiempo"], first, last))
    load.publish()
    landing = scratch_path(spark, "landing")
    spoilt = good.withColumn("meta_renovacion", F.when(F.col("meta_renovacion") == 1, -1).otherwise(F.col("meta_renovacion")))
    revised = good.withColumn("monto_meta_ingreso", (F.col("monto_meta_ingreso") * 2).cast(MONEY))
    for name, sheet in (("s1", good), ("s2", good), ("s3", spoilt), ("s4", revised)):
        land_snapshot(sheet.orderBy("anio", "cod_producto"), landing, name)
    watch(store, announced_snapshots(spark, landing, per_batch=1), scratch_path(spark, "watch-state"), interval=None).awaitTermination()
    _watched[key] = store
    return store


@query
def snapshot_stream(spark, sf_dir):
    """Goal fact after the watch: the revised sheet."""
    return _watched_store(spark, sf_dir).tables()["fact_metas"]


@query
def snapshot_quarantine(spark, sf_dir):
    """Violations of the spoilt sheet, with its row numbers."""
    return quarantined(_watched_store(spark, sf_dir)).select("rule", "table_name", "row_key", "detail", "n_rows", "snapshot")


def _fully_watched(spark, sf_dir) -> WarehouseStore:
    """A store that has watched all source tables: one batch with a client snapshot, a newer one and a goals sheet, then one
    with a spoilt sheet and a revised product table."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} (all tables)")
    if key in _watched:
        return _watched[key]
    r = roles(spark, sf_dir)
    store = WarehouseStore(spark, scratch_path(spark, "watch-all"))
    load = store.open_load()
    load.adopt(loaded(spark, sf_dir)[0].paths())
    load.publish()
    good, first, last = _sheet_goals(r)
    landing, state = scratch_path(spark, "landing-all"), scratch_path(spark, "watch-all-state")
    clients = r.cliente()
    batches = [
        [("c1", "cliente", clients.withColumn("telefono", F.lit("none"))),
         ("c2", "cliente", clients.withColumn("email", F.concat("email", F.lit(".c2")))), ("g1", "metas", good)],
        [("g2", "metas", good.withColumn("monto_meta_ingreso", -F.col("monto_meta_ingreso"))),
         ("p1", "producto", r.producto().withColumn("descripcion", F.concat("descripcion", F.lit(" p1"))))],
    ]
    for batch in batches:
        for name, table, df in batch:
            land_snapshot(df, landing, name, table)
        watch_sources(store, announced_snapshots(spark, landing), state, r.source(), first, last,
                      interval=None, with_metrics=False).awaitTermination()
    _watched[key] = store
    return store


@query
def watch_all_clients(spark, sf_dir):
    """Clients after the watch over all tables: the newer of two snapshots of one batch."""
    return kpis.client_present(_fully_watched(spark, sf_dir).tables())


@query
def watch_all_products(spark, sf_dir):
    """Products after the watch: the second batch loads them although its goals sheet is refused."""
    return _fully_watched(spark, sf_dir).tables()["dim_producto"].select("cod_producto_nk", "nb_producto", "descrip_producto")


@query
def watch_all_goals(spark, sf_dir):
    """Goal fact after the watch: the sheet bound by the first batch."""
    return _fully_watched(spark, sf_dir).tables()["fact_metas"]


@query
def watch_all_bound(spark, sf_dir):
    """The snapshot that the published version read each table from, with its rows."""
    bound = bound_snapshots(_fully_watched(spark, sf_dir))
    read = {"metas": lambda path: spark.read.option("header", True).csv(path)}
    rows = [(s, e["snapshot"], read.get(s, spark.read.parquet)(e["path"]).count()) for s, e in sorted(bound.items())]
    return spark.createDataFrame(rows, "source STRING, snapshot STRING, n_rows LONG")


@query
def watch_all_quarantine(spark, sf_dir):
    """Violations of the refused sheet per rule, with the sheet's first and last row."""
    found = quarantined(_fully_watched(spark, sf_dir))
    row = F.substring_index("row_key", ",", 1).cast("long")
    return found.groupBy("rule", "snapshot").agg(
        F.count(F.lit(1)).alias("n"), F.min(row).alias("first_row"), F.max(row).alias("last_row"))


@query
def goal_guards(spark, sf_dir):
    """What stops a load of goals before it starts: a column is missing, every cell is blank, there is no product."""
    r = roles(spark, sf_dir)
    goals = r.metas()
    blank = goals.select(*[F.when(F.col(c).isNull(), F.col(c)).cast("string").alias(c) for c in goals.columns])
    found = []
    for guard, raw in (("column", goals.drop("meta_renovacion")), ("empty", blank)):
        _, _, error = checked_goals(raw)
        found.append((guard, error.rule if error else None, raw.count(), None))
    store = WarehouseStore(spark, scratch_path(spark, "guards"))
    load = store.open_load()
    base = loaded(spark, sf_dir)[0].tables()
    for name in ("dim_producto", "dim_tiempo"):
        load.write(name, base[name].limit(0) if name == "dim_producto" else base[name])
    load.publish()
    try:
        refresh_goals(store, stage(goals))
        stopped = None
    except LoadAborted as stop:
        stopped = type(stop.__cause__).__name__
    found.append(("product", stopped, goals.count(), store.version()))
    return spark.createDataFrame(found, "guard STRING, stopped_by STRING, n_rows LONG, version LONG")


@query
def staging_load_time(spark, sf_dir):
    """Staged goals of a full load: rows, rows without a load time, and load times other than the one of their load."""
    staged = loaded(spark, sf_dir)[0].tables()["stg_metas"]
    stamps = staged.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("fecha_carga").isNull()).alias("n_unstamped"),
                        F.count_distinct("fecha_carga").alias("n_load_times"))
    return stamps


def queries() -> Mapping[str, Query]:
    return dict(REGISTRY)
