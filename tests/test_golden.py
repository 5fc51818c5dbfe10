"""Known results on the small fixture: first load, second load, change batch."""

from decimal import ROUND_HALF_UP, Decimal

import pytest

from fixture_data import changed_rows, changed_source, goals, source, source_rows, sql
from starloom.plans import kpis
from starloom.plans.warehouse_load import run_load
from starloom.sources.store import WarehouseStore

DIM_ROWS = {
    "dim_tiempo": 5113, "dim_cliente": 25, "dim_producto": 10, "dim_contrato": 60, "dim_estado_contrato": 3,
    "dim_evaluacion_servicio": 5, "dim_sucursal": 8, "dim_siniestro": 30,
}
BEFORE, AFTER = source_rows(), changed_rows()
_PAIRS = "(SELECT DISTINCT cod_cliente, cod_producto FROM registro_contrato)"
# Ratings of pairs with a contract; of several of one pair the highest counts.
_KEPT = f"""(SELECT cod_cliente, cod_producto, max(cod_evaluacion_servicio) AS code, arg_max(recomienda_amigo, cod_evaluacion_servicio) AS friend,
    count(*) AS n FROM recomienda SEMI JOIN {_PAIRS} p USING (cod_cliente, cod_producto) GROUP BY 1, 2)"""
RATED, SOURCED = sql(BEFORE, f"SELECT count(*), CAST(sum(n) AS BIGINT) FROM {_KEPT}")[0]
FACT_ROWS = {"fact_registro_contrato": 60, "fact_registro_siniestro": 30, "fact_evaluacion_servicio": RATED}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    store = WarehouseStore(spark, str(tmp_path_factory.mktemp("golden")))
    src = source(spark)
    first = run_load(store, src)
    before = store.tables()
    second = run_load(store, {**src, "metas": goals(spark)})
    again = store.tables()
    third = run_load(store, {**changed_source(spark), "metas": goals(spark)})
    return {"store": store, "first": first, "before": before, "second": second, "again": again,
            "third": third, "after": store.tables()}


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_first_load_row_counts(loaded):
    counts = {name: df.count() for name, df in loaded["before"].items()}
    assert counts == {**DIM_ROWS, **FACT_ROWS}


def test_second_load_changes_nothing(loaded):
    metrics = loaded["second"].metrics
    for name in [*DIM_ROWS, *FACT_ROWS]:
        assert metrics[name]["inserted"] == 0, name
        assert metrics[name].get("changed", 0) == 0, name
        assert metrics[name].get("deleted", 0) == 0, name
        assert sorted(rows(loaded["before"][name]), key=str) == sorted(rows(loaded["again"][name]), key=str)
    assert metrics["fact_metas"]["inserted"] == 50
    assert metrics["fact_evaluacion_servicio"]["discarded"] == len(BEFORE["recomienda"]) - SOURCED
    assert metrics["fact_registro_contrato"]["matched"] == 60


def test_surrogate_keys_follow_natural_order(loaded):
    keys = sorted(rows(loaded["before"]["dim_cliente"].select("cod_cliente_nk", "sk_dim_cliente")))
    assert keys == [(i, i) for i in range(1, 26)]
    states = dict(rows(loaded["before"]["dim_estado_contrato"].select("cod_estado", "sk_dim_estado_contrato")))
    assert states == {"ACTIVO": 1, "VENCIDO": 2, "SUSPENDIDO": 3}


def test_change_batch_metrics(loaded):
    m = loaded["third"].metrics
    assert (m["dim_cliente"]["inserted"], m["dim_contrato"]["inserted"], m["dim_siniestro"]["inserted"]) == (1, 1, 1)
    assert (m["fact_registro_contrato"]["inserted"], m["fact_registro_contrato"]["changed"]) == (1, 1)
    assert (m["fact_registro_siniestro"]["inserted"], m["fact_registro_siniestro"]["changed"]) == (1, 1)
    assert m["fact_evaluacion_servicio"]["inserted"] == 1


def both(loaded, kpi, query):
    """A KPI before and after the change, against SQL over the rows."""
    assert sorted(rows(kpi(loaded["again"])), key=str) == sorted(sql(BEFORE, query), key=str)
    assert sorted(rows(kpi(loaded["after"])), key=str) == sorted(sql(AFTER, query), key=str)


def test_response_days(loaded):
    both(loaded, kpis.response_days, """
        SELECT CAST(round(avg(date_diff('day', fecha_siniestro, fecha_respuesta)), 2) AS DECIMAL(18,2))
        FROM registro_siniestro WHERE fecha_respuesta IS NOT NULL""")


def test_contracts_by_state(loaded):
    both(loaded, kpis.contracts_by_state, """
        SELECT upper(estado_contrato[1]) || lower(estado_contrato[2:]), count(*) FROM registro_contrato GROUP BY ALL""")


def test_claim_rate(loaded):
    both(loaded, kpis.claim_rate, """
        WITH c AS (SELECT cod_producto, count(*) n FROM registro_contrato GROUP BY 1),
             s AS (SELECT cod_producto, count(*) n FROM registro_siniestro JOIN registro_contrato USING (nro_contrato) GROUP BY 1)
        SELECT nb_producto, coalesce(c.n, 0), coalesce(s.n, 0), CAST(round(coalesce(s.n, 0) / c.n, 2) AS DECIMAL(10,2))
        FROM producto LEFT JOIN c USING (cod_producto) LEFT JOIN s USING (cod_producto)""")
    rates = [r[3] for r in rows(kpis.claim_rate(loaded["again"])) if r[3] is not None]
    assert rates == sorted(rates, reverse=True)


def test_rating_recommend(loaded):
    both(loaded, kpis.rating_recommend, f"""
        SELECT nb_producto, CAST(round(avg(code), 2) AS DECIMAL(10,2)),
               CAST(round(100.0 * count(*) FILTER (friend = 'SI') / count(*), 1) AS DECIMAL(10,1))
        FROM {_KEPT} JOIN producto USING (cod_producto) GROUP BY 1""")


def test_goal_attainment(loaded):
    got = {r["anio"]: r["monto_real"] for r in kpis.goal_attainment(loaded["again"], product=3).collect()}
    expected = dict(sql(BEFORE, """
        SELECT y.anio, CAST(coalesce(sum(monto), 0) AS DECIMAL(18,2)) FROM range(2022, 2027) y(anio)
        LEFT JOIN registro_contrato ON year(fecha_inicio) = y.anio AND cod_producto = 3 GROUP BY 1"""))
    assert got == expected
    real = sql(AFTER, "SELECT sum(monto) FROM registro_contrato WHERE year(fecha_inicio) = 2026 AND cod_producto = 3")[0][0]
    one = rows(kpis.goal_attainment(loaded["after"], product=3, year=2026))
    goal = Decimal("3400.00")
    assert one == [("Product 3", 2026, goal, real, (100 * real / goal).quantize(Decimal("0.1"), ROUND_HALF_UP))]
    assert kpis.goal_attainment(loaded["after"]).count() == 50


def test_income_by_type(loaded):
    both(loaded, kpis.income_by_type, """
        SELECT nb_tipo_producto, CAST(sum(monto) AS DECIMAL(18,2)) FROM registro_contrato JOIN producto USING (cod_producto)
        JOIN tipo_producto USING (cod_tipo_producto) GROUP BY 1""")


def test_rejected_share(loaded):
    both(loaded, kpis.rejected_share, """
        SELECT count(*) FILTER (id_rechazo = 'SI'), count(*), CAST(round(100.0 * count(*) FILTER (id_rechazo = 'SI') / count(*), 1) AS DECIMAL(10,1))
        FROM registro_siniestro""")


def test_amount_by_branch(loaded):
    both(loaded, kpis.amount_by_branch, """
        SELECT nb_sucursal, CAST(sum(monto) AS DECIMAL(18,2)) FROM registro_contrato JOIN cliente USING (cod_cliente)
        JOIN sucursal USING (cod_sucursal) GROUP BY 1""")


def test_checks_after_the_change(loaded):
    from pyspark.sql import functions as F

    before, after = loaded["again"], loaded["after"]
    new_client = F.col("cod_cliente_nk") == 26
    assert kpis.client_present(before, new_client).count() == 0
    assert kpis.client_present(after, new_client).count() == 1
    assert rows(kpis.contract_detail(after, new_client)) == [
        ("Client 26", 61, "Product 3", "Branch 1", "Activo", 20260203, 20270203, Decimal("4100.50"), 1)]
    contract, product, client = AFTER["registro_contrato"][1][:3]
    first = (F.col("nro_contrato_nk") == contract) & (F.col("cod_producto_nk") == product) & (F.col("cod_cliente_nk") == client)
    assert rows(kpis.contract_state(after, first)) == [(contract, product, client, "Vencido")]
    claim = kpis.claim_detail(after, F.col("nro_siniestro_nk") == 31).collect()
    assert len(claim) == 1 and claim[0]["id_rechazo"] == "SI" and str(claim[0]["fecha_respuesta"]) == "2026-03-25"
    solved = (F.col("nro_siniestro_nk") == 10) & (F.col("nro_contrato_nk") == AFTER["registro_siniestro"][9][1])
    assert kpis.claim_resolution(before, solved).first()["fecha_respuesta"] is None
    assert str(kpis.claim_resolution(after, solved).first()["fecha_respuesta"]) == "2026-05-06"
    assert rows(kpis.rating_detail(after, new_client)) == [("Client 26", "Product 3", 2, "REGULAR", Decimal("0.00"))]


def test_before_after(loaded):
    pair = kpis.compare(kpis.contracts_by_state(loaded["again"]), kpis.contracts_by_state(loaded["after"]), ["descrip_estado"])
    states = [dict(rows(kpis.contracts_by_state(loaded[at]))) for at in ("again", "after")]
    assert sorted(rows(pair)) == sorted((name, states[0][name], states[1][name]) for name in states[0])
    single = kpis.compare(kpis.rejected_share(loaded["again"]), kpis.rejected_share(loaded["after"]), [])
    assert rows(single) == [(*rows(kpis.rejected_share(loaded["again"]))[0], *rows(kpis.rejected_share(loaded["after"]))[0])]
