"""The eight star KPIs and the denormalised check reports.

Facts are aggregated by surrogate key before any dimension is joined, so the shuffle carries one row per key
and map task instead of the fact, and a hot key is combined map-side.  Names are grouped after the join, because
equal names must merge.

What a KPI takes from a fact are additive parts: counts and sums per key.  They can be kept, and updated with the rows
that a change batch added and removed; a report is made from kept parts as from the fact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import shuffle_partitions
from starloom.session import materialise

Tables = Mapping[str, DataFrame]
_EXACT = "decimal(22,2)"  # leaves 16 digits for the quotient before it is rounded
_SUM = "decimal(28,2)"


@dataclass(frozen=True)
class Parts:
    """Additive parts of one fact: per key (name -> SQL expression) the rows ``n`` and sums (name -> SQL expression)."""

    fact: str
    keys: Mapping[str, str]
    sums: Mapping[str, str] = field(default_factory=dict)

    def of(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        keys = [F.expr(e).alias(k) for k, e in self.keys.items()]
        sums = [(F.coalesce(F.sum(F.expr(e).cast(_SUM)), F.lit(0)) * sign).cast(_SUM).alias(k) for k, e in self.sums.items()]
        return rows.groupBy(*keys).agg((F.count(F.lit(1)) * sign).cast("long").alias("n"), *sums)

    def updated(self, kept: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
        """Kept parts after rows were added to and removed from the fact; only these rows are read."""
        moved = kept.unionByName(self.of(added)).unionByName(self.of(removed, -1))
        sums = [F.sum(k).cast(_SUM).alias(k) for k in self.sums]
        total = moved.groupBy(*self.keys).agg(F.sum("n").cast("long").alias("n"), *sums)
        return total.where("n <> 0") if self.keys else total


_CONTRACTS, _CLAIMS, _RATINGS = "fact_registro_contrato", "fact_registro_siniestro", "fact_evaluacion_servicio"
_PRODUCT = {"sk_dim_producto": "sk_dim_producto"}
# Parts of each KPI by name.
KPI_PARTS: dict[str, dict[str, Parts]] = {
    "response_days": {"claims": Parts(_CLAIMS, {c: c for c in ("sk_fecha_siniestro", "sk_fecha_respuesta")})},
    "contracts_by_state": {"contracts": Parts(_CONTRACTS, {"sk_dim_estado_contrato": "sk_dim_estado_contrato"})},
    "claim_rate": {"contracts": Parts(_CONTRACTS, _PRODUCT), "claims": Parts(_CLAIMS, _PRODUCT)},
    "rating_recommend": {"ratings": Parts(
        _RATINGS, {**_PRODUCT, "sk_dim_evaluacion_servicio": "sk_dim_evaluacion_servicio"},
        {"yes": "recomienda_amigo", "told": "CASE WHEN recomienda_amigo IS NOT NULL THEN 1 ELSE 0 END"})},
    "goal_attainment": {"contracts": Parts(
        _CONTRACTS, {**_PRODUCT, "anio": "CAST(sk_dim_tiempo_fecha_inicio div 10000 AS INT)"}, {"monto": "monto"})},
    "income_by_type": {"contracts": Parts(_CONTRACTS, _PRODUCT, {"monto": "monto"})},
    "rejected_share": {"claims": Parts(_CLAIMS, {}, {"rejected": "CASE WHEN id_rechazo = 'SI' THEN 1 ELSE 0 END"})},
    "amount_by_branch": {"contracts": Parts(_CONTRACTS, {"sk_dim_sucursal": "sk_dim_sucursal"}, {"monto": "monto"})},
}


def kept_name(kpi: str, part: str) -> str:
    """Table in which the parts of a KPI are kept."""
    return f"kpi_{kpi}_{part}"


def kpi_parts(wh: Tables) -> dict[str, DataFrame]:
    """All parts of all KPIs, from the facts, by the name of the table that keeps them."""
    return {kept_name(kpi, part): spec.of(wh[spec.fact]) for kpi, parts in KPI_PARTS.items() for part, spec in parts.items()}


def updated_parts(kept: Tables, added: Tables, removed: Tables) -> dict[str, DataFrame]:
    """All kept parts after rows were added to and removed from facts (by fact; a fact may be missing)."""
    out = {}
    for kpi, parts in KPI_PARTS.items():
        for part, spec in parts.items():
            if spec.fact in added:
                name = kept_name(kpi, part)
                out[name] = spec.updated(kept[name], added[spec.fact], removed[spec.fact])
    return out


def from_kept(kpi: str, wh: Tables) -> DataFrame:
    """A KPI from the parts that the warehouse keeps: no fact is read, except the goals."""
    return KPIS[kpi][0](wh, parts={part: wh[kept_name(kpi, part)] for part in KPI_PARTS[kpi]})


def _parts(kpi: str, wh: Tables, parts: Tables | None) -> Tables:
    return parts if parts is not None else {name: spec.of(wh[spec.fact]) for name, spec in KPI_PARTS[kpi].items()}


def _ratio(top: Column, bottom: Column, digits: int, percent: bool = False) -> Column:
    """top / bottom, or that in percent, rounded half up; NULL when the denominator is zero."""
    quotient = top.cast(_EXACT) / F.nullif(bottom.cast(_EXACT), F.lit(0).cast(_EXACT))
    return F.round(quotient * F.lit(100).cast("decimal(3,0)") if percent else quotient, digits)


def _amount_by_name(per_key: DataFrame, dim: DataFrame, key: str, name: str, out: str) -> DataFrame:
    named = per_key.join(dim.select(key, name), key)
    totals = named.groupBy(name).agg(F.round(F.sum("monto"), 2).alias(out))
    return totals.orderBy(F.col(out).desc_nulls_last(), name)


def response_days(wh: Tables, parts: Tables | None = None) -> DataFrame:
    """Mean days from claim to response; open claims drop out of the second date join."""
    days = wh["dim_tiempo"].select("sk_dim_tiempo", "fecha_completa")
    opened = days.select(F.col("sk_dim_tiempo").alias("sk_fecha_siniestro"), F.col("fecha_completa").alias("_from"))
    closed = days.select(F.col("sk_dim_tiempo").alias("sk_fecha_respuesta"), F.col("fecha_completa").alias("_to"))
    per_dates = _parts("response_days", wh, parts)["claims"]
    dated = per_dates.join(opened, "sk_fecha_siniestro").join(closed, "sk_fecha_respuesta")
    total = F.sum((F.datediff("_to", "_from") * F.col("n")).cast(_SUM))
    return dated.agg(_ratio(total, F.sum("n"), 2).alias("dias_promedio_respuesta"))


def contracts_by_state(wh: Tables, parts: Tables | None = None) -> DataFrame:
    per_key = _parts("contracts_by_state", wh, parts)["contracts"]
    states = wh["dim_estado_contrato"].select("sk_dim_estado_contrato", "descrip_estado")
    counts = per_key.join(states, "sk_dim_estado_contrato").groupBy("descrip_estado").agg(
        F.sum("n").alias("cantidad_contratos"))
    return counts.orderBy(F.desc("cantidad_contratos"), "descrip_estado")


def claim_rate(wh: Tables, parts: Tables | None = None) -> DataFrame:
    """Claims per contract and product; every product is shown, also without contracts."""
    per_key = _parts("claim_rate", wh, parts)
    contracts = per_key["contracts"].withColumnRenamed("n", "_c")
    claims = per_key["claims"].withColumnRenamed("n", "_s")
    products = wh["dim_producto"].select("sk_dim_producto", "nb_producto")
    n_contracts, n_claims = F.coalesce("_c", F.lit(0)), F.coalesce("_s", F.lit(0))
    rates = products.join(contracts, "sk_dim_producto", "left").join(claims, "sk_dim_producto", "left").select(
        "nb_producto",
        n_contracts.alias("contratos"),
        n_claims.alias("siniestros"),
        _ratio(n_claims, n_contracts, 2).alias("tasa_siniestralidad"),
    )
    return rates.orderBy(F.col("tasa_siniestralidad").desc_nulls_last(), "nb_producto", "contratos", "siniestros")


def rating_recommend(wh: Tables, parts: Tables | None = None) -> DataFrame:
    """Mean rating code and share of recommendations per product name; products without ratings are absent."""
    per_key = _parts("rating_recommend", wh, parts)["ratings"]
    ratings = wh["dim_evaluacion_servicio"].select(
        F.col("sk_dim_evaluacion").alias("sk_dim_evaluacion_servicio"), "cod_evaluacion_nk")
    products = wh["dim_producto"].select("sk_dim_producto", "nb_producto")
    named = per_key.join(ratings, "sk_dim_evaluacion_servicio").join(products, "sk_dim_producto")
    points = F.sum(F.col("cod_evaluacion_nk") * F.col("n"))
    means = named.groupBy("nb_producto").agg(
        _ratio(points, F.sum("n"), 2).alias("calificacion_promedio"),
        _ratio(F.sum("yes"), F.sum("told"), 1, percent=True).alias("pct_recomienda"),
    )
    return means.orderBy(F.col("calificacion_promedio").desc_nulls_last(), "nb_producto")


def _starting_in(wh: Tables, year: int) -> DataFrame:
    """Contract facts of one year; a published fact is laid out by it, so the other years' folders are not read."""
    low, high, key = year * 10000 + 101, year * 10000 + 1231, "sk_dim_tiempo_fecha_inicio"
    pruned = getattr(wh, "between", None)
    return pruned(_CONTRACTS, key, low, high) if pruned else wh[_CONTRACTS].where(F.col(key).between(low, high))


def goal_attainment(wh: Tables, product: int | None = None, year: int | None = None, parts: Tables | None = None) -> DataFrame:
    """Real income against the goal per product and year, optionally for one product and one year."""
    goals = wh["fact_metas"].withColumn("anio", F.expr("CAST(sk_dim_fecha_inicio_meta div 10000 AS INT)"))
    products = wh["dim_producto"].select("sk_dim_producto", "cod_producto_nk", "nb_producto")
    if product is not None:
        products = products.where(F.col("cod_producto_nk") == product)
    if year is not None:
        goals = goals.where(F.col("anio") == year)
        if parts is None:
            parts = {"contracts": KPI_PARTS["goal_attainment"]["contracts"].of(_starting_in(wh, year))}
    real = _parts("goal_attainment", wh, parts)["contracts"].select("sk_dim_producto", "anio", F.col("monto").alias("_real"))
    joined = goals.join(products, "sk_dim_producto").join(real, ["sk_dim_producto", "anio"], "left")
    amount = F.coalesce("_real", F.lit(0).cast("decimal(18,2)"))
    return joined.select(
        "nb_producto", "anio", "monto_meta_ingreso", amount.alias("monto_real"),
        _ratio(amount, F.col("monto_meta_ingreso"), 1, percent=True).alias("pct_cumplimiento"),
    )


def income_by_type(wh: Tables, parts: Tables | None = None) -> DataFrame:
    per_key = _parts("income_by_type", wh, parts)["contracts"]
    return _amount_by_name(per_key, wh["dim_producto"], "sk_dim_producto", "nb_tipo_producto", "ingreso_total")


def rejected_share(wh: Tables, parts: Tables | None = None) -> DataFrame:
    """Share of claims whose rejection code is exactly 'SI'; NULL for an empty fact."""
    rejected, total = F.coalesce(F.sum("rejected"), F.lit(0)).cast("long"), F.coalesce(F.sum("n"), F.lit(0))
    return _parts("rejected_share", wh, parts)["claims"].agg(
        rejected.alias("rechazados"), total.alias("total_siniestros"),
        _ratio(rejected, total, 1, percent=True).alias("pct_rechazados"),
    )


def amount_by_branch(wh: Tables, parts: Tables | None = None) -> DataFrame:
    per_key = _parts("amount_by_branch", wh, parts)["contracts"]
    return _amount_by_name(per_key, wh["dim_sucursal"], "sk_dim_sucursal", "nb_sucursal", "monto_total")


# KPI name -> (report, group columns); a KPI without group columns is a single row.
KPIS: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "response_days": (response_days, []),
    "contracts_by_state": (contracts_by_state, ["descrip_estado"]),
    "claim_rate": (claim_rate, ["nb_producto"]),
    "rating_recommend": (rating_recommend, ["nb_producto"]),
    "goal_attainment": (goal_attainment, ["nb_producto", "anio"]),
    "income_by_type": (income_by_type, ["nb_tipo_producto"]),
    "rejected_share": (rejected_share, []),
    "amount_by_branch": (amount_by_branch, ["nb_sucursal"]),
}


BLOCK_ROWS = 2_048  # of one group and side that meet as one block
TASK_PAIRS = 8_000_000  # result rows that a task of a comparison makes


def compare(before: DataFrame, after: DataFrame, group: list[str]) -> DataFrame:
    """A KPI on two warehouse states side by side: a full join by group, measures suffixed _antes and _despues.

    Where a report has several rows of one group (products of one name), every row before meets every row after, so a group
    is cut into blocks of ``BLOCK_ROWS``: a pair of blocks is a key of its own, and the pairs are dealt over as many tasks as
    the result needs.  The rows after of a block lie in one sorted array, which every row before is paired with.
    """
    def side(df: DataFrame, suffix: str) -> DataFrame:
        measures = [c for c in df.columns if c not in group]
        return df.select(*group, *[F.col(c).alias(f"{c}_{suffix}") for c in measures])

    old, new = side(before, "antes"), side(after, "despues")
    if not group:
        return old.withColumn("_one", F.lit(1)).join(new.withColumn("_one", F.lit(1)), "_one", "full_outer").drop("_one")
    old, new = materialise(old, "compare-antes"), materialise(new, "compare-despues")
    measures = {"_b": [c for c in old.columns if c not in group], "_a": [c for c in new.columns if c not in group]}
    sizes = {name: df.groupBy(*group).agg(F.count(F.lit(1)).alias(name)) for name, df in (("_b", old), ("_a", new))}
    pairs = sizes["_b"].join(sizes["_a"], group).agg(F.sum(F.col("_b").cast("double") * F.col("_a"))).first()[0] or 0
    tasks = int(min(max(math.ceil(pairs / TASK_PAIRS), shuffle_partitions(old.sparkSession)), 100_000))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows with their block, a function of the row and, among equal ones, its number; ``other`` is NULL where no row
        of the other side has the group."""
        counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        single = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).drop("_n")
        block = F.pmod(F.xxhash64(*df.columns, "_copy"), blocks(own)).cast("int").alias(f"{own}_block")
        sized = single.join(sizes[own], group, "left").join(sizes[other], group, "left")
        return sized.select(*df.columns, own, other, block)

    left, right = placed(old, "_b", "_a"), placed(new, "_a", "_b")
    key = [*group, "_b_block", "_a_block"]
    rows = left.where("_a IS NOT NULL").select("*", every("_a").alias("_a_block")).select(*key, *measures["_b"])
    lists = right.where("_b IS NOT NULL").groupBy(*group, "_a_block", "_b").agg(
        F.sort_array(F.collect_list(F.struct(*measures["_a"]))).alias("_rows"))
    lists = lists.select("*", every("_b").alias("_b_block")).select(*key, "_rows")
    met = rows.repartition(tasks, *key).join(lists.repartition(tasks, *key).hint("merge"), key)
    met = met.select(*group, *measures["_b"], F.inline("_rows"))
    gone = left.where("_a IS NULL").select(*group, *measures["_b"])
    fresh = right.where("_b IS NULL").select(*group, *measures["_a"])
    return met.unionByName(gone, allowMissingColumns=True).unionByName(fresh, allowMissingColumns=True)


def presence(before: DataFrame, after: DataFrame, keys: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The rows that each of ``keys`` has in a report before and after a load: their number, and the greatest value of the
    named columns.  One row where there was none, one where there was one: nothing is missing and nothing is doubled."""
    def side(df: DataFrame, suffix: str) -> DataFrame:
        values = [F.max(c).alias(f"{c}_{suffix}") for c in columns or []]
        counted = df.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias(f"filas_{suffix}"), *values)
        return keys.join(counted, keys.columns, "left").fillna(0, [f"filas_{suffix}"])

    return side(before, "antes").join(side(after, "despues"), keys.columns)


# --- denormalised check reports ---------------------------------------------------------------------------


def _client(wh: Tables) -> DataFrame:
    return wh["dim_cliente"].select("sk_dim_cliente", "cod_cliente_nk", "nb_cliente")


def _contract(wh: Tables) -> DataFrame:
    return wh["dim_contrato"].select("sk_dim_contrato", "nro_contrato_nk")


def _product(wh: Tables) -> DataFrame:
    return wh["dim_producto"].select("sk_dim_producto", "cod_producto_nk", "nb_producto")


def _state(wh: Tables) -> DataFrame:
    return wh["dim_estado_contrato"].select("sk_dim_estado_contrato", "descrip_estado")


def client_present(wh: Tables, where: Column | None = None) -> DataFrame:
    """Client dimension rows, all or those that match: the existence probe before and after a load."""
    rows = wh["dim_cliente"]
    return rows if where is None else rows.where(where)


def contract_detail(wh: Tables, where: Column | None = None) -> DataFrame:
    """Contract fact with client, contract, product, branch and state spelled out."""
    branch = wh["dim_sucursal"].select("sk_dim_sucursal", "nb_sucursal")
    star = (
        wh["fact_registro_contrato"].join(_client(wh), "sk_dim_cliente").join(_contract(wh), "sk_dim_contrato")
        .join(_product(wh), "sk_dim_producto").join(branch, "sk_dim_sucursal").join(_state(wh), "sk_dim_estado_contrato")
    )
    star = star if where is None else star.where(where)
    return star.select(
        "nb_cliente", "nro_contrato_nk", "nb_producto", "nb_sucursal", "descrip_estado",
        F.col("sk_dim_tiempo_fecha_inicio").alias("fecha_inicio_aaaammdd"),
        F.col("sk_dim_tiempo_fecha_fin").alias("fecha_fin_aaaammdd"), "monto", "cantidad",
    )


def contract_state(wh: Tables, where: Column | None = None) -> DataFrame:
    """Contract, product, client and state of each contract fact: one row per business key when nothing is doubled."""
    star = (
        wh["fact_registro_contrato"].join(_contract(wh), "sk_dim_contrato").join(_product(wh), "sk_dim_producto")
        .join(_client(wh), "sk_dim_cliente").join(_state(wh), "sk_dim_estado_contrato")
    )
    star = star if where is None else star.where(where)
    return star.select("nro_contrato_nk", "cod_producto_nk", "cod_cliente_nk", "descrip_estado")


def _dated_claims(wh: Tables) -> DataFrame:
    days = wh["dim_tiempo"].select("sk_dim_tiempo", "fecha_completa")
    opened = days.select(F.col("sk_dim_tiempo").alias("sk_fecha_siniestro"), F.col("fecha_completa").alias("fecha_siniestro"))
    closed = days.select(F.col("sk_dim_tiempo").alias("sk_fecha_respuesta"), F.col("fecha_completa").alias("fecha_respuesta"))
    claim = wh["dim_siniestro"].select("sk_dim_siniestro", "nro_siniestro_nk")
    return (
        wh["fact_registro_siniestro"].join(claim, "sk_dim_siniestro").join(_contract(wh), "sk_dim_contrato")
        .join(opened, "sk_fecha_siniestro")
        .join(closed, "sk_fecha_respuesta", "left")
    )


def claim_detail(wh: Tables, where: Column | None = None) -> DataFrame:
    """Claim fact with both dates; open claims stay, with a NULL response date."""
    star = _dated_claims(wh).join(_client(wh), "sk_dim_cliente").join(_product(wh), "sk_dim_producto")
    star = star if where is None else star.where(where)
    return star.select(
        "nro_siniestro_nk", "nro_contrato_nk", "nb_cliente", "nb_producto", "fecha_siniestro", "fecha_respuesta",
        "id_rechazo", "monto_reconocido", "monto_solicitado",
    )


def claim_resolution(wh: Tables, where: Column | None = None) -> DataFrame:
    """Claim fact reduced to its dates and outcome."""
    star = _dated_claims(wh)
    star = star if where is None else star.where(where)
    return star.select(
        "nro_siniestro_nk", "nro_contrato_nk", "fecha_siniestro", "fecha_respuesta", "id_rechazo", "monto_reconocido")


def rating_detail(wh: Tables, where: Column | None = None) -> DataFrame:
    """Rating fact with client, product and rating spelled out."""
    ratings = wh["dim_evaluacion_servicio"].select(
        F.col("sk_dim_evaluacion").alias("sk_dim_evaluacion_servicio"), "cod_evaluacion_nk", "nb_descrip")
    star = (
        wh["fact_evaluacion_servicio"].join(_client(wh), "sk_dim_cliente").join(_product(wh), "sk_dim_producto")
        .join(ratings, "sk_dim_evaluacion_servicio")
    )
    star = star if where is None else star.where(where)
    return star.select("nb_cliente", "nb_producto", "cod_evaluacion_nk", "nb_descrip", "recomienda_amigo")
