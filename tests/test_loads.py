"""Edge cases of the fact loads, the KPI reports and the all-or-nothing publish."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixture_data import frame, goals, source, source_rows
from starloom.operators import quality as q
from starloom.plans import facts, kpis
from starloom.plans.warehouse_load import LoadAborted, refresh_goals, reset_scope, run_load
from starloom.schemas import source_rules, warehouse_rules
from starloom.sources.store import VersionMoved, WarehouseStore


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frames(spark, tables):
    return source(spark, tables)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    store = WarehouseStore(spark, str(tmp_path_factory.mktemp("base")))
    run_load(store, {**source(spark), "metas": goals(spark)}, with_metrics=False)
    return store


def without_contract(tables):
    """Ratings of a client and product that have no contract together."""
    pairs = {(r[2], r[1]) for r in tables["registro_contrato"]}
    return sum((r[0], r[2]) not in pairs for r in tables["recomienda"])


def fork(spark, base, folder):
    """A store of its own that starts from the base version."""
    store = WarehouseStore(spark, str(folder))
    load = store.open_load()
    load.written = dict(base.paths())
    load.publish()
    return store


def test_claim_fan_out_keeps_the_highest_line(spark, base):
    tables = source_rows()
    tables["registro_contrato"].append([14, 9, 20, "2024-01-01", "2024-12-31", "1.00", "ACTIVO"])
    src, dims = frames(spark, tables), base.tables()
    fact = facts.claim_fact_source(src, dims)
    assert fact.count() == 30
    client = dims["dim_cliente"].where("cod_cliente_nk = 20").first()["sk_dim_cliente"]
    product = dims["dim_producto"].where("cod_producto_nk = 9").first()["sk_dim_producto"]
    contract = dims["dim_contrato"].where("nro_contrato_nk = 14").first()["sk_dim_contrato"]
    assert rows(fact.where(F.col("sk_dim_contrato") == contract).select("sk_dim_cliente", "sk_dim_producto").distinct()) == [(client, product)]
    counted = fact.agg(F.sum(facts.SOURCE_ROWS)).first()[0]
    doubled = sum(claim[1] == 14 for claim in tables["registro_siniestro"])
    assert doubled and counted == 30 + doubled  # contract 14 has two lines now


def test_skewed_load_equals_plain_load(spark, base):
    src, dims = source(spark), base.tables()
    every = {k: [r[0] for r in src["registro_contrato"].select(F.xxhash64(*c)).distinct().collect()]
             for k, c in facts.HOT_KEY_SETS["registro_contrato"].items()}
    assert rows(facts.contract_fact_source(src, dims, every)) == rows(facts.contract_fact_source(src, dims))
    claims = {k: [r[0] for r in src["registro_siniestro"].select(F.xxhash64(*c)).distinct().collect()]
              for k, c in facts.HOT_KEY_SETS["registro_siniestro"].items()}
    assert rows(facts.claim_fact_source(src, dims, every, claims)) == rows(facts.claim_fact_source(src, dims))
    assert rows(facts.contract_fact_source(src, dims, unique_keys=True)) == rows(facts.contract_fact_source(src, dims))


def test_ratings_of_one_pair_and_null_recommendation(spark, base):
    tables = source_rows()
    product, client = tables["registro_contrato"][1][1:3]
    tables["recomienda"] += [[client, 5, product, None], [client, 2, product, "SI"]]
    fact = facts.rating_fact_source(frames(spark, tables), base.tables())
    wh = {**base.tables(), "fact_evaluacion_servicio": fact}
    assert rows(kpis.rating_detail(wh, F.col("nb_cliente") == f"Client {client}").where(f"nb_producto = 'Product {product}'")) == [
        (f"Client {client}", f"Product {product}", 5, "EXCELENTE", Decimal("0.00"))]
    assert facts.rejected_ratings(frames(spark, tables)).count() == without_contract(tables)


def test_lower_case_state_is_resolved_and_lower_case_rejection_is_not_counted(spark, base):
    tables = source_rows()
    tables["registro_contrato"][0][-1] = "activo"
    tables["registro_siniestro"][2][4] = "si"
    src, dims = frames(spark, tables), base.tables()
    assert facts.contract_fact_source(src, dims).where("sk_dim_estado_contrato IS NULL").count() == 0
    assert q.violations(src, [source_rules("registro_siniestro")]).count() == 0
    wh = {**dims, "fact_registro_siniestro": facts.claim_fact_source(src, dims)}
    assert kpis.rejected_share(wh).first()["rechazados"] == sum(r[4] == "SI" for r in tables["registro_siniestro"])


def test_deleted_contract_leaves_the_fact_but_not_the_dimension(spark, base, tmp_path):
    store = fork(spark, base, tmp_path)
    tables = source_rows()
    tables["registro_contrato"] = [r for r in tables["registro_contrato"] if r[0] != 20]
    tables["contrato"] = [r for r in tables["contrato"] if r[0] != 20]
    report = run_load(store, frames(spark, tables))
    assert report.metrics["fact_registro_contrato"]["deleted"] == 1
    assert store.tables()["fact_registro_contrato"].count() == 59
    assert store.tables()["dim_contrato"].count() == 60
    assert store.tables()["fact_metas"].count() == 50  # no staging given: goals untouched


def test_claim_of_a_contract_without_lines_is_kept_as_it_was(spark, base, tmp_path):
    store = fork(spark, base, tmp_path)
    tables = source_rows()
    tables["registro_contrato"] = [r for r in tables["registro_contrato"] if r[0] != 31]
    report = run_load(store, frames(spark, tables))
    assert store.tables()["fact_registro_siniestro"].count() == 30
    assert (report.metrics["fact_registro_siniestro"]["kept"], report.metrics["fact_registro_siniestro"]["deleted"]) == (1, 0)
    gone = {**tables, "registro_siniestro": [r for r in tables["registro_siniestro"] if r[0] != 11]}
    assert run_load(store, frames(spark, gone)).metrics["fact_registro_siniestro"]["deleted"] == 1
    assert store.tables()["fact_registro_siniestro"].count() == 29


def test_null_attribute_overwrites(spark, base, tmp_path):
    store = fork(spark, base, tmp_path)
    tables = source_rows()
    tables["cliente"][4][3] = None
    assert run_load(store, frames(spark, tables), with_metrics=False).metrics["dim_cliente"]["changed"] == 1
    assert store.tables()["dim_cliente"].where("cod_cliente_nk = 5").first()["telefono"] is None


@pytest.mark.parametrize("change, message", [
    (("registro_contrato", 0, 4, "2032-05-01"), "outside the calendar"),
    (("registro_contrato", 0, 1, 99), "sk_dim_producto unresolved"),
    (("registro_siniestro", 0, 0, 77), "sk_dim_siniestro unresolved"),
])
def test_a_broken_key_aborts_and_publishes_nothing(spark, base, tmp_path, change, message):
    store = fork(spark, base, tmp_path)
    table, row, column, value = change
    tables = source_rows()
    tables[table][row][column] = value
    before = {n: rows(store.tables()[n]) for n in ("dim_cliente", "fact_registro_contrato")}
    with pytest.raises(LoadAborted, match=message):
        run_load(store, frames(spark, tables), with_metrics=False)
    assert store.version() == 1
    assert before == {n: rows(store.tables()[n]) for n in before}


def test_goals_refresh_guards(spark, base, tmp_path):
    store = fork(spark, base, tmp_path / "a")
    refresh_goals(store, goals(spark).where("anio < 0"))
    assert store.version() == 1 and store.tables()["fact_metas"].count() == 50
    with pytest.raises(LoadAborted, match="sk_dim_producto"):
        refresh_goals(store, frame(spark, "metas", [[2026, 99, 1, 1, 1]]))
    with pytest.raises(LoadAborted, match="calendar"):
        refresh_goals(store, frame(spark, "metas", [[2032, 1, 1, 1, 1]]))
    report = refresh_goals(store, frame(spark, "metas", [[2026, 2, "10.00", 1, 1], [2027, 2, "20.00", 1, 1]]))
    assert report.metrics["fact_metas"] == {"inserted": 1, "matched": 1, "changed": 1, "deleted": 49, "kept": 0}
    empty = WarehouseStore(spark, str(tmp_path / "b"))
    with pytest.raises(LoadAborted, match="dim_producto is empty"):
        refresh_goals(empty, goals(spark))


def test_load_goals_guards(spark, base):
    dims = base.tables()
    nothing = goals(spark).where("anio < 0")
    assert facts.load_goals(nothing, dims, dims["fact_metas"]).count() == 50
    with pytest.raises(facts.MissingPrerequisite):
        facts.load_goals(goals(spark), {**dims, "dim_producto": dims["dim_producto"].limit(0)}, None)
    assert facts.load_goals(goals(spark), dims, None).count() == 50


def test_kpis_on_empty_facts(spark, base):
    wh = dict(base.tables())
    wh["fact_registro_contrato"] = wh["fact_registro_contrato"].limit(0)
    wh["fact_registro_siniestro"] = wh["fact_registro_siniestro"].limit(0)
    assert kpis.rejected_share(wh).first()[:] == (0, 0, None)
    assert kpis.response_days(wh).first()[0] is None
    rates = kpis.claim_rate(wh).collect()
    assert len(rates) == 10 and all(r["tasa_siniestralidad"] is None and r["contratos"] == 0 for r in rates)
    assert {r["monto_real"] for r in kpis.goal_attainment(wh).collect()} == {Decimal("0.00")}


def test_zero_goal_has_no_percentage(spark, base):
    wh = dict(base.tables())
    wh["fact_metas"] = wh["fact_metas"].withColumn("monto_meta_ingreso", F.lit(0).cast("decimal(18,2)"))
    assert kpis.goal_attainment(wh).where("pct_cumplimiento IS NOT NULL").count() == 0


def test_equal_names_merge(spark, base):
    wh = dict(base.tables())
    wh["dim_sucursal"] = wh["dim_sucursal"].withColumn("nb_sucursal", F.lit("same"))
    assert kpis.amount_by_branch(wh).count() == 1


def test_kpis_aggregate_before_they_join(spark, base):
    for report in (kpis.amount_by_branch, kpis.income_by_type, kpis.contracts_by_state):
        plan = report(base.tables())._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        join = next(i for i, line in enumerate(lines) if "Join" in line)
        assert any("Aggregate" in line for line in lines[join + 1:]), plan


def test_scoped_reset(spark, base):
    wh = base.tables()
    clients = spark.createDataFrame([(1,)], "cod_cliente_nk INT")
    contracts = spark.createDataFrame([(1,), (44,)], "nro_contrato_nk INT")
    claims = spark.createDataFrame([(2,), (10,), (24,), (25,)], "nro_siniestro_nk INT")
    after = reset_scope(wh, clients, contracts, claims)
    counts = {n: after[n].count() for n in ("dim_cliente", "dim_contrato", "dim_siniestro", "fact_registro_contrato",
                                            "fact_registro_siniestro", "fact_evaluacion_servicio")}
    assert counts == {"dim_cliente": 24, "dim_contrato": 58, "dim_siniestro": 26, "fact_registro_contrato": 58,
                      "fact_registro_siniestro": 26, "fact_evaluacion_servicio": wh["fact_evaluacion_servicio"].where("sk_dim_cliente <> 1").count()}


def test_fixture_breaks_no_rule(spark, base):
    src = source(spark)
    assert q.violations(src, [source_rules(t) for t in src]).count() == 0
    wh = {n: df for n, df in base.tables().items() if n != "stg_metas"}
    assert q.violations(wh, [warehouse_rules(t) for t in wh]).count() == 0


def test_source_rules_find_planted_errors(spark):
    tables = source_rows()
    tables["cliente"][0][6] = "x" * 101
    tables["cliente"][1][5] = "Q"
    tables["cliente"][2][2] = tables["cliente"][3][2]
    tables["producto"][0][3] = "6.00"
    tables["evaluacion_servicio"][0][1] = "BUENO"
    tables["registro_contrato"][0][4] = "2021-01-01"
    tables["registro_contrato"][1][2] = 999
    tables["registro_siniestro"].append(tables["registro_siniestro"][0])
    tables["tipo_producto"][0][1] = "OTROS"
    src = frames(spark, tables)
    found = q.summarise(q.violations(src, [source_rules(t) for t in src]))
    assert rows(found) == sorted([
        ("cliente", "length:email", 1, 1), ("cliente", "domain:sexo", 1, 1), ("cliente", "unique:ci_rif", 1, 2),
        ("producto", "range:calificacion", 1, 1), ("evaluacion_servicio", "pair:cod_evaluacion_servicio,nb_descripcion", 1, 1),
        ("registro_contrato", "order:fecha_inicio,fecha_fin", 1, 1), ("registro_contrato", "foreign_key:cod_cliente", 1, 1),
        ("registro_siniestro", "unique:nro_siniestro,nro_contrato", 1, 2), ("tipo_producto", "domain:nb_tipo_producto", 1, 1)], key=str)


def test_metrics_frame(spark, base, tmp_path):
    report = run_load(fork(spark, base, tmp_path), source(spark))
    table = {r["table_name"]: r for r in report.frame(spark).collect()}
    assert len(table) == 12
    assert table["fact_evaluacion_servicio"]["discarded"] == without_contract(source_rows())
    assert table["fact_registro_siniestro"]["matched"] == 30


def test_a_repeated_entity_changes_nothing(spark, base, tmp_path):
    tables = source_rows()
    for name in ("cliente", "sucursal", "producto", "contrato", "siniestro", "ciudad", "tipo_producto"):
        tables[name] += [list(row) for row in tables[name][:3]]
    tables["cliente"].append([4, "A lower name", *tables["cliente"][3][2:]])
    store = WarehouseStore(spark, str(tmp_path / "repeated"))
    report = run_load(store, {**frames(spark, tables), "metas": goals(spark)})
    got, expected = store.tables(), base.tables()
    for name in expected:
        if name != "stg_metas":
            assert rows(got[name].select(*expected[name].columns)) == rows(expected[name]), name
    assert report.metrics["fact_registro_contrato"]["matched"] == 0


def test_a_load_that_was_overtaken_does_not_publish(spark, base, tmp_path):
    store = fork(spark, base, tmp_path / "two")
    first, second = store.open_load(), store.open_load()
    for load in (first, second):
        load.write("dim_sucursal", base.tables()["dim_sucursal"])
    first.publish()
    with pytest.raises(VersionMoved):
        second.publish()
    assert store.paths()["dim_sucursal"] == first.written["dim_sucursal"]


def test_quarantine_sets_aside_what_would_abort(spark, base, tmp_path):
    tables = source_rows()
    line, claim = tables["registro_contrato"][0], tables["registro_siniestro"][0]
    line[6] = "ANULADO"  # no such state
    line[3] = "1800-01-01"  # nor such a day
    claim[2] = "1800-01-01"
    src = {**frames(spark, tables), "metas": goals(spark).unionByName(
        goals(spark).limit(1).withColumn("cod_producto", F.lit(999).cast("long")))}
    store = fork(spark, base, tmp_path)
    with pytest.raises(LoadAborted) as stop:
        run_load(store, src, with_metrics=False)
    assert stop.value.table == "fact_registro_contrato" and stop.value.counts == {
        "sk_dim_tiempo_fecha_inicio outside the calendar": 1, "sk_dim_estado_contrato unresolved": 1}
    before = store.tables()
    report = run_load(store, src, quarantine=True)
    after = store.tables()
    misses = after["quarantine_fact_registro_contrato"].collect()
    assert [tuple(m)[:3] for m in misses] == [(line[0], line[1], line[2])]
    assert set(misses[0]["failed"]) == set(stop.value.counts)
    found = rows(after["quarantine_fact_registro_siniestro"])
    assert found == [(claim[0], claim[1], ["sk_fecha_siniestro outside the calendar"])]
    assert [m["cod_producto"] for m in after["quarantine_fact_metas"].collect()] == [999]
    assert after["quarantine_fact_evaluacion_servicio"].count() == 0
    for fact, gone in (("fact_registro_contrato", 1), ("fact_metas", 0), ("fact_evaluacion_servicio", 0)):
        assert after[fact].count() == before[fact].count() - gone
    assert report.metrics["fact_registro_contrato"]["deleted"] == 1
    # The next sound load empties the quarantine and brings the rows back.
    run_load(store, {**source(spark), "metas": goals(spark)}, with_metrics=False, quarantine=True)
    healed = store.tables()
    assert all(healed[f"quarantine_{fact}"].count() == 0 for fact in ("fact_registro_contrato", "fact_registro_siniestro", "fact_metas"))
    for fact in ("fact_registro_contrato", "fact_registro_siniestro", "fact_metas"):
        assert rows(healed[fact]) == rows(before[fact])
