"""Change batches, parts of published tables, kept KPI parts and the one-scan key rules."""

import pytest
from pyspark.sql import functions as F

from fixture_data import changed_rows, changed_source, frame, goals, source, source_rows
from starloom.operators import quality as q
from starloom.plans import kpis
from starloom.plans.change_load import rewritten_parts, run_change_load
from starloom.plans.warehouse_load import LoadAborted, run_load
from starloom.schemas import PRIMARY_KEYS, source_rules, warehouse_rules
from starloom.sources.store import Layout, WarehouseStore, sweep

FACTS = ["fact_registro_contrato", "fact_registro_siniestro", "fact_evaluacion_servicio", "fact_metas"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    store = WarehouseStore(spark, str(tmp_path_factory.mktemp("change-base")))
    run_load(store, {**source(spark), "metas": goals(spark)}, register_buckets=4, keep_kpis=True, with_metrics=False)
    return store


def fork(spark, base, folder):
    store = WarehouseStore(spark, str(folder))
    load = store.open_load()
    load.adopt(base.paths())
    load.publish()
    return store


def batch(spark, after):
    """(changes, deletes) that turn the standard rows into ``after``."""
    before, changes, deletes = source_rows(), {}, {}
    for table, new in after.items():
        old = {tuple(map(str, r)) for r in before[table]}
        fresh = [r for r in new if tuple(map(str, r)) not in old]
        if fresh:
            changes[table] = frame(spark, table, fresh)
        key = [i for i, c in enumerate(source(spark)[table].columns) if c in PRIMARY_KEYS[table]]
        held = {tuple(str(r[i]) for i in key) for r in new}
        gone = [r for r in before[table] if tuple(str(r[i]) for i in key) not in held]
        if gone and table in ("registro_contrato", "registro_siniestro", "recomienda"):
            deletes[table] = frame(spark, table, gone).select(*PRIMARY_KEYS[table])
    return changes, deletes


def check_equal_to_full_load(spark, base, tmp_path, after):
    full, part = fork(spark, base, tmp_path / "full"), fork(spark, base, tmp_path / "part")
    run_load(full, source(spark, after), register_buckets=4, keep_kpis=True, with_metrics=False)
    report = run_change_load(part, *batch(spark, after))
    expected, got = full.tables(), part.tables()
    for name in expected:
        if name.startswith("idx_"):
            assert set(rows(expected[name])) <= set(rows(got[name]))
        elif not name.startswith("stg_"):
            assert rows(got[name].select(*expected[name].columns)) == rows(expected[name]), name
    return full, part, report


def test_the_change_batch_gives_the_state_of_a_full_load(spark, base, tmp_path):
    full, part, report = check_equal_to_full_load(spark, base, tmp_path, changed_rows())
    assert {k: report.metrics["fact_registro_contrato"][k] for k in ("inserted", "changed", "deleted")} == {"inserted": 1, "changed": 1, "deleted": 0}
    before, after = base.tables(), part.tables()
    written = [p for p in rewritten_parts(before, after) if p[0] == "fact_registro_contrato"]
    changed = [r for r in changed_rows()["registro_contrato"] if r not in source_rows()["registro_contrato"]]
    assert [year for _, year in written] == sorted({int(r[3][:4]) for r in changed})
    for kpi, (report_of, _) in kpis.KPIS.items():
        assert rows(kpis.from_kept(kpi, after)) == rows(report_of(after)) == rows(kpis.from_kept(kpi, full.tables())), kpi


def test_moved_clients_deleted_lines_and_kept_claims(spark, base, tmp_path):
    after = source_rows()
    after["cliente"][6][7] = 1 + after["cliente"][6][7] % 8  # another branch: all its contracts move
    gone = after["registro_siniestro"][0][1]
    after["registro_contrato"] = [r for r in after["registro_contrato"] if r[0] not in (gone, 5)]
    after["registro_siniestro"] = [r for r in after["registro_siniestro"] if r[0] != 9]
    after["registro_contrato"][30][3] = "2023-07-07"  # starts in another year
    after["recomienda"] = after["recomienda"][3:]
    check_equal_to_full_load(spark, base, tmp_path, after)


def test_a_change_batch_reads_the_buckets_it_touches(spark, base, tmp_path, monkeypatch):
    """Registers are opened by bucket, never as a whole."""
    from starloom.sources import store as module

    opened, whole = [], []
    only, every = module.PublishedTables.only, module.PublishedTables.__getitem__
    monkeypatch.setattr(module.PublishedTables, "only", lambda self, name, parts: opened.append((name, set(parts))) or only(self, name, parts))
    monkeypatch.setattr(module.PublishedTables, "__getitem__", lambda self, name: whole.append(name) or every(self, name))
    store = fork(spark, base, tmp_path)
    line = source_rows()["registro_contrato"][7]
    whole.clear()
    run_change_load(store, {"registro_contrato": frame(spark, "registro_contrato", [[*line[:5], "1.00", line[6]]])})
    registers = [parts for name, parts in opened if name == "reg_registro_contrato"]
    assert registers and len(registers[0]) == 1
    assert not [name for name in whole if name in ("fact_registro_contrato", "fact_evaluacion_servicio")]
    assert rewritten_parts(base.tables(), store.tables())[:1] == [("fact_registro_contrato", int(line[3][:4]))]


def test_a_reload_without_change_writes_no_part(spark, base, tmp_path):
    store = fork(spark, base, tmp_path)
    run_load(store, {**source(spark), "metas": goals(spark)}, register_buckets=4, with_metrics=False)
    assert rewritten_parts(base.tables(), store.tables()) == []
    assert all(store.paths()[n] == base.paths()[n] for n in base.paths() if n.startswith("dim_"))
    after = source_rows()
    after["registro_contrato"][0][5] = "77.00"
    run_load(store, source(spark, after), with_metrics=False)
    year = int(after["registro_contrato"][0][3][:4])
    assert rewritten_parts(base.tables(), store.tables()) == [("fact_registro_contrato", year)]


def test_what_a_change_batch_refuses(spark, base, tmp_path):
    store = fork(spark, base, tmp_path / "a")
    with pytest.raises(ValueError, match="metas"):
        run_change_load(store, {"metas": goals(spark)})
    with pytest.raises(LoadAborted, match="needs all of"):
        run_change_load(store, {"producto": source(spark)["producto"].limit(1)})
    with pytest.raises(LoadAborted, match="sk_dim_producto unresolved"):
        run_change_load(store, {"registro_contrato": frame(spark, "registro_contrato", [[1, 99, 1, "2024-01-01", "2024-02-01", "1.00", "ACTIVO"]])})
    assert run_change_load(store, {"cliente": source(spark)["cliente"].limit(0)}).version == store.version() == 1
    with pytest.raises(LoadAborted, match="keeps no registers"):
        run_change_load(WarehouseStore(spark, str(tmp_path / "b")), {})


def test_a_year_reads_its_folder_only(spark, base):
    wh = base.tables()
    year = int(source_rows()["registro_contrato"][0][3][:4])
    plan = kpis.goal_attainment(wh, year=year)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(parte_anio" in plan
    everywhere = kpis.goal_attainment(dict(wh)).where(F.col("anio") == year)
    assert rows(kpis.goal_attainment(wh, year=year)) == rows(everywhere)


def test_swept_folders(spark, base, tmp_path):
    store = fork(spark, base, tmp_path)
    lost = store.open_load()
    lost.write("dim_sucursal", base.tables()["dim_sucursal"])
    lost.write_changed("fact_metas", base.tables()["fact_metas"].withColumn("meta_renovacion", F.lit(1)), Layout.by_year("sk_dim_fecha_inicio_meta"))
    kept = store.open_load()
    kept.write("dim_sucursal", base.tables()["dim_sucursal"].limit(3))
    kept.publish()
    assert sweep(store, 3600) == []
    removed = sweep(store, 0)
    assert len(removed) == 1 + 5 and all(lost.tag in path for path in removed)
    assert store.tables()["dim_sucursal"].count() == 3 and store.tables()["fact_metas"].count() == 50


def test_key_rules_in_one_scan(spark, base):
    tables = source_rows()
    tables["cliente"][2][2] = tables["cliente"][3][2]
    tables["registro_contrato"][1][2] = 999
    tables["registro_contrato"][4][2] = None
    tables["registro_siniestro"].append(tables["registro_siniestro"][0])
    tables["cliente"][1][5] = "Q"
    src = source(spark, tables)
    declared = [source_rules(t) for t in src]
    found = q.quality_summary(src, declared)
    assert rows(found) == rows(q.summarise(q.violations(src, declared))) and found.count() >= 5
    scans = found._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans <= 2 * len(src)  # the adaptive plan is printed with its first form
    wh = {n: df for n, df in base.tables().items() if n.startswith(("dim_", "fact_"))}
    references = q.reference_summary(wh, [warehouse_rules(t) for t in wh])
    assert references.count() == 21 and references.where("n_missing_rows > 0").count() == 0
    wh["dim_producto"] = wh["dim_producto"].where("sk_dim_producto <> 1")
    missing = rows(q.reference_summary(wh, [warehouse_rules(t) for t in wh]).where("n_missing_keys > 0").select("table_name", "rule", "n_missing_keys"))
    assert missing == sorted((t, "foreign_key:sk_dim_producto", 1) for t in FACTS if wh[t].where("sk_dim_producto = 1").count())
