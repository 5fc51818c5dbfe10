"""The goals sheet, its checks, and the snapshot watch."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fixture_data import goals, source
from starloom.operators.quality import QualityError
from starloom.operators.calendar import DEFAULT_FIRST_DAY, DEFAULT_LAST_DAY
from starloom.plans.warehouse_load import refresh_goals, run_load
from starloom.sources.goals import checked_goals, goal_violations, normalise_goals, number_goals, read_goals, stage, typed_goals
from starloom.sources.store import WarehouseStore
from starloom.sources.tables import numbered, read_jdbc, read_source, read_table
from starloom.streaming.snapshots import (
    announced_snapshots, bound_snapshots, dropped_files, full_refresh, goals_only, handle_batch, handle_sources, land_snapshot,
    quarantined, watch, watch_sources,
)

HEADER = "row_no STRING, anio STRING, cod_producto STRING, monto_meta_ingreso STRING, meta_renovacion STRING, meta_asegurados STRING"


def sheet(spark, rows):
    return spark.createDataFrame(rows, HEADER)


def rules(df):
    return sorted((r["rule"], r["row_key"]) for r in df.collect())


def test_headers_blank_rows_and_extra_columns(spark):
    raw = spark.createDataFrame(
        [("2024", "1", "10.5", "3", "4", "x"), (None, None, None, None, None, None), (" ", "", None, None, None, None)],
        "` Anio ` STRING, COD_PRODUCTO STRING, `monto_meta_ingreso ` STRING, Meta_Renovacion STRING, META_ASEGURADOS STRING, comment STRING")
    good = normalise_goals(raw)
    assert good.columns == ["row_no", "anio", "cod_producto", "monto_meta_ingreso", "meta_renovacion", "meta_asegurados"]
    assert [str(v) for v in typed_goals(good).first()] == ["2024", "1", "10.50", "3", "4"]
    assert good.count() == 1
    assert "fecha_carga" in stage(typed_goals(good)).columns


@pytest.mark.parametrize("row, rule", [
    (("2", "2024", "1", None, "1", "1"), "null:monto_meta_ingreso"),
    (("2", "abc", "1", "1", "1", "1"), "type:anio"),
    (("2", "2024.7", "1", "1", "1", "1"), "type:anio"),
    (("2", "1999", "1", "1", "1", "1"), "range:anio"),
    (("2", "2101", "1", "1", "1", "1"), "range:anio"),
    (("2", "2024", "1", "-1", "1", "1"), "negative:monto_meta_ingreso"),
    (("2", "2024", "1", "1", "-1", "1"), "negative:meta_renovacion"),
    (("2", "2024", "1", "1", "1", "-5"), "negative:meta_asegurados"),
])
def test_one_rule_each(spark, row, rule):
    assert rules(goal_violations(sheet(spark, [row]))) == [(rule, f"2,{row[1]},{row[2]}")]


def test_duplicates_products_and_calendar(spark):
    rows = [("2", "2024", "1", "1", "1", "1"), ("3", "2024", "1", "2", "1", "1"), ("4", "2032", "1", "1", "1", "1"), ("5", "2024", "99", "1", "1", "1")]
    products = spark.createDataFrame([(1,)], "cod_producto_nk INT")
    calendar = spark.createDataFrame([(20240101,), (20241231,)], "sk_dim_tiempo INT")
    assert rules(goal_violations(sheet(spark, rows), products, calendar)) == [
        ("calendar:end", "2032"), ("calendar:start", "2032"), ("duplicate:anio,cod_producto", "2024,1"), ("product:cod_producto", "2024,99")]


def test_headline_follows_the_check_order(spark):
    rows = [("2", "1999", "1", "-1", "1", "1"), ("3", "x", "1", "1", "1", "1"), ("4", "2024", None, "1", "1", "1")]
    good, found, error = checked_goals(sheet(spark, rows))
    assert good is None and error.rule == "null" and found.count() == 4
    _, _, error = checked_goals(sheet(spark, rows[:2]))
    assert error.rule == "type"
    _, _, error = checked_goals(sheet(spark, rows[:1]))
    assert error.rule == "range"
    _, _, error = checked_goals(sheet(spark, []))
    assert error.rule == "empty"
    _, _, error = checked_goals(sheet(spark, rows).drop("anio"))
    assert error.rule == "columns"
    with pytest.raises(QualityError):
        normalise_goals(sheet(spark, rows).drop("anio"))
    good, found, error = checked_goals(sheet(spark, [("2", "2024", "1", "1", "1", "1")]))
    assert good.count() == 1 and found is None and error is None


def test_typed_sources(spark, tmp_path):
    src = source(spark)
    for fmt in ("parquet", "orc", "json", "csv"):
        path = str(tmp_path / fmt)
        writer = src["registro_siniestro"].write
        (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
        back = read_table(spark, "registro_siniestro", path, fmt)
        assert back.schema == src["registro_siniestro"].schema
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, src["registro_siniestro"].collect()), key=str)
    for name, df in src.items():
        df.write.parquet(str(tmp_path / "all" / name))
    assert set(read_source(spark, str(tmp_path / "all"))) == set(src)
    with pytest.raises(ValueError):
        read_table(spark, "pais", "x", "xml")
    with pytest.raises(Exception, match="(?i)driver"):
        read_jdbc(spark, "pais", "jdbc:none://x", "pais", "cod_pais", 1, 4, 2)


# --- watch -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def loaded_paths(spark, tmp_path_factory):
    store = WarehouseStore(spark, str(tmp_path_factory.mktemp("base")))
    run_load(store, source(spark), with_metrics=False)
    return store.paths()


@pytest.fixture
def watched(spark, loaded_paths, tmp_path):
    """A store that starts from the loaded tables, a landing folder and a checkpoint folder."""
    store = WarehouseStore(spark, str(tmp_path / "wh"))
    load = store.open_load()
    load.written = dict(loaded_paths)
    load.publish()
    return store, str(tmp_path / "landing"), str(tmp_path / "state")


def run(store, stream, state, **options):
    query = watch(store, stream, state, interval=None, **options)
    query.awaitTermination()


def good_sheet(spark, factor=1):
    return goals(spark).drop("fecha_carga").withColumn("monto_meta_ingreso", F.col("monto_meta_ingreso") * factor)


def total(store):
    return int(store.tables()["fact_metas"].agg(F.sum("monto_meta_ingreso")).first()[0])


def statuses(store):
    return [r["status"] for r in store.log().where("stream IS NOT NULL").select("batch_id", "status").distinct().orderBy("batch_id").collect()]


def test_watch_loads_skips_quarantines_and_recovers(spark, watched):
    store, landing, state = watched
    base = int(good_sheet(spark).agg(F.sum("monto_meta_ingreso")).first()[0])
    land_snapshot(good_sheet(spark), landing, "s1")
    run(store, announced_snapshots(spark, landing), state)
    assert total(store) == base and store.version() == 2

    land_snapshot(good_sheet(spark), landing, "s2")  # same content under a new name
    run(store, announced_snapshots(spark, landing), state)
    assert store.version() == 2

    land_snapshot(good_sheet(spark).withColumn("anio", F.lit(1999)), landing, "s3")
    run(store, announced_snapshots(spark, landing), state)
    land_snapshot(good_sheet(spark).withColumn("anio", F.lit(1999)), landing, "s3-again")  # not tried twice
    run(store, announced_snapshots(spark, landing), state)
    assert store.version() == 2 and total(store) == base
    assert {r["snapshot"] for r in quarantined(store).select("snapshot").distinct().collect()} == {"s3"}

    land_snapshot(good_sheet(spark, 2), landing, "s4")
    run(store, announced_snapshots(spark, landing), state)
    assert total(store) == 2 * base and store.version() == 3
    assert store.tables()["stg_metas"].count() == 50
    assert statuses(store) == ["published", "rejected", "published"]


def test_only_the_newest_snapshot_of_a_batch_counts(spark, watched):
    store, landing, state = watched
    folder, seen = os.path.join(landing, "announced"), set()
    for i in (1, 3, 2):  # the sheet landed in the middle carries the newest time
        land_snapshot(good_sheet(spark, i), landing, f"s{i}")
        new = {f for f in os.listdir(folder) if f.endswith(".json")} - seen
        for name in new:
            os.utime(os.path.join(folder, name), (1_700_000_000 + i, 1_700_000_000 + i))
        seen |= new
    run(store, announced_snapshots(spark, landing), state)
    assert store.version() == 2
    assert total(store) == 3 * int(good_sheet(spark).agg(F.sum("monto_meta_ingreso")).first()[0])


def test_a_replayed_batch_changes_nothing(spark, watched):
    store, landing, state = watched
    path = land_snapshot(good_sheet(spark), landing, "s1")
    batch = spark.createDataFrame([("s1", path)], "snapshot STRING, path STRING").withColumn("landed_at", F.current_timestamp())
    assert handle_batch(store, "a", batch, 0, goals_only(store)) == "loaded"
    assert handle_batch(store, "a", batch, 0, goals_only(store)) == "replayed"
    assert handle_batch(store, "a", batch, 1, goals_only(store)) == "unchanged"
    assert handle_batch(store, "b", batch.limit(0), 0, goals_only(store)) == "nothing"
    assert store.version() == 2


def test_infrastructure_errors_propagate_and_the_batch_is_retried(spark, watched):
    store, landing, state = watched
    land_snapshot(good_sheet(spark), landing, "s1")

    def broken(staged, origin):
        raise OSError("disk gone")

    with pytest.raises(StreamingQueryException):
        run(store, announced_snapshots(spark, landing), state, refresh=broken)
    assert store.version() == 1 and store.last_fingerprint(state) is None
    run(store, announced_snapshots(spark, landing), state)
    assert store.version() == 2


def test_dropped_csv_files_and_full_refresh(spark, watched, tmp_path):
    store, _, state = watched
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "goals-1.csv").write_text(
        "row_no, Anio ,COD_PRODUCTO,monto_meta_ingreso,meta_renovacion,meta_asegurados,note\n2,2026,2,2400.00,1,1,x\n3,,,,,,\n")
    refresh = full_refresh(store, source(spark), with_metrics=False)
    run(store, dropped_files(spark, str(folder)), state, refresh=refresh)
    assert store.tables()["fact_metas"].count() == 1 and store.version() == 2
    (folder / "goals-2.csv").write_text("anio,cod_producto\n2026,2\n")
    run(store, dropped_files(spark, str(folder)), state, refresh=refresh)
    assert store.version() == 2
    assert [r["rule"] for r in quarantined(store).collect()] == ["columns"]


def test_read_goals_keeps_text(spark, tmp_path):
    path = str(tmp_path / "p")
    goals(spark).drop("fecha_carga").write.parquet(path)
    assert {t for _, t in read_goals(spark, path, "parquet").dtypes} == {"string"}


def test_refresh_needs_dimensions(spark, tmp_path):
    with pytest.raises(Exception, match="dim_producto"):
        refresh_goals(WarehouseStore(spark, str(tmp_path)), goals(spark))


def test_whole_numbers_may_have_a_point(spark):
    good = sheet(spark, [("1", "2024.0", "7", "10", "3.000", "4E0"), ("2", "2.024E3", "8000000000", "1", "1", "1")])
    typed = [tuple(r) for r in typed_goals(normalise_goals(good)).collect()]
    assert [(r[0], r[1], r[3], r[4]) for r in typed] == [(2024, 7, 3, 4), (2024, 8_000_000_000, 1, 1)]
    products = spark.createDataFrame([(7,), (8_000_000_000,)], "cod_producto_nk LONG")
    assert goal_violations(normalise_goals(good), products).count() == 0
    bad = sheet(spark, [("1", "2024.5", "1", "1", "1", "NaN")])
    assert {r["rule"] for r in goal_violations(normalise_goals(bad)).collect()} == {"type:anio", "type:meta_asegurados"}


def test_damaged_json_and_missing_columns_are_errors(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"cod_pais": 1, "nb_pais": "A"}\n{"cod_pais": "x7", "nb_pais": "B"}\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_table(spark, "pais", str(tmp_path / "j"), "json").collect()
    spark.createDataFrame([(1,)], "cod_pais INT").write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError, match="nb_pais"):
        read_table(spark, "pais", str(tmp_path / "p"))
    (tmp_path / "c.csv").write_text("nb_pais,cod_pais\nA,1\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_table(spark, "pais", str(tmp_path / "c.csv"), "csv").collect()
    spark.createDataFrame([(2**40, "far")], "cod_pais LONG, nb_pais STRING").write.parquet(str(tmp_path / "l"))
    assert read_table(spark, "pais", str(tmp_path / "l")).first()["cod_pais"] == 2**40


def test_streams_do_not_share_their_history(spark, tmp_path):
    store = WarehouseStore(spark, str(tmp_path / "s"))
    store.reject("one", 0, "3:abc", "bad")
    assert store.last_fingerprint("one") == "3:abc" and store.last_fingerprint("two") is None


# --- row numbers -------------------------------------------------------------------------------------------


def test_rows_are_numbered_in_file_order_over_blocks_and_files(spark, tmp_path):
    folder = tmp_path / "sheet"
    folder.mkdir()
    expected = {}
    for part, rows in (("part-0.csv", 700), ("part-1.csv", 0), ("part-2.csv", 1300)):
        cells = [f"{part}-{i}" for i in range(rows)]
        (folder / part).write_text("\n".join(["a,b", *[f"{c},{'x' * (i % 7)}" for i, c in enumerate(cells)]]) + "\n")
        for c in cells:
            expected[c] = len(expected) + 2
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        scan = spark.read.option("header", True).csv(str(folder))
        assert scan.rdd.getNumPartitions() > 8
        got = numbered(scan, first=2)
        assert got.columns == ["a", "b", "row_no"]
        assert {r["a"]: r["row_no"] for r in got.collect()} == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_sheet_names_the_rows_of_its_errors(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(" Anio ,cod_producto,monto_meta_ingreso,meta_renovacion,meta_asegurados\n"
                    "2024,1,1,1,1\n,,,,\n2024,2,,1,1\n2024,3,1,-1,1\n")
    raw = number_goals(read_goals(spark, str(path)))
    _, found, error = checked_goals(raw)
    assert rules(found) == [("negative:meta_renovacion", "5,2024,3"), ("null:monto_meta_ingreso", "4,2024,2")]
    assert "4,2024,2" in str(error)
    own = sheet(spark, [("70", "2024", "1", None, "1", "1")])
    assert rules(checked_goals(number_goals(own))[1]) == [("null:monto_meta_ingreso", "70,2024,1")]


# --- watch over all tables -----------------------------------------------------------------------------------


def run_all(spark, store, landing, state, **options):
    watch_sources(store, announced_snapshots(spark, landing), state, source(spark), DEFAULT_FIRST_DAY, DEFAULT_LAST_DAY,
                  interval=None, with_metrics=False, **options).awaitTermination()


def bound_names(store):
    return {s: e["snapshot"] for s, e in bound_snapshots(store).items()}


def test_one_batch_binds_the_newest_snapshot_of_every_table(spark, watched):
    store, landing, state = watched
    clients, base = source(spark)["cliente"], int(good_sheet(spark).agg(F.sum("monto_meta_ingreso")).first()[0])
    land_snapshot(clients.withColumn("telefono", F.lit("old")), landing, "c1", "cliente")
    land_snapshot(good_sheet(spark, 3), landing, "g1")
    land_snapshot(clients.withColumn("telefono", F.lit("new")), landing, "c2", "cliente")
    run_all(spark, store, landing, state)
    assert store.version() == 2 and total(store) == 3 * base
    assert bound_names(store) == {"cliente": "c2", "metas": "g1"}
    phones = lambda: {r["telefono"] for r in store.tables()["dim_cliente"].select("telefono").distinct().collect()}
    assert phones() == {"new"}

    land_snapshot(good_sheet(spark, -1), landing, "g2")  # refused; the clients of the batch are loaded
    land_snapshot(clients.withColumn("telefono", F.lit("newer")), landing, "c3", "cliente")
    land_snapshot(clients.drop("telefono"), landing, "s1", "sucursal")
    land_snapshot(clients, landing, "x1", "nothing")
    run_all(spark, store, landing, state)
    assert store.version() == 3 and total(store) == 3 * base and phones() == {"newer"}
    assert bound_names(store) == {"cliente": "c3", "metas": "g1"}
    kinds = {(r["snapshot"], r["rule"].split(":")[0]) for r in quarantined(store).collect()}
    assert kinds == {("g2", "negative"), ("s1", "columns"), ("x1", "source")}

    land_snapshot(good_sheet(spark, 3), landing, "g3")  # what is bound already, under a new name
    run_all(spark, store, landing, state)
    assert store.version() == 3


def test_tables_that_need_each_other_may_land_in_any_order(spark, watched):
    store, landing, state = watched
    src = source(spark)
    far = lambda df: df.withColumn("cod_producto", F.lit(9_001).cast(df.schema["cod_producto"].dataType))
    land_snapshot(far(src["registro_contrato"]), landing, "l1", "registro_contrato")
    run_all(spark, store, landing, state)
    assert store.version() == 1 and bound_snapshots(store) == {} and statuses(store) == ["rejected"]
    assert {r["rule"] for r in quarantined(store).collect()} == {"sk_dim_producto unresolved"}
    land_snapshot(src["producto"].unionByName(far(src["producto"].limit(1))), landing, "p1", "producto")
    run_all(spark, store, landing, state)
    assert store.version() == 2 and bound_names(store) == {"producto": "p1", "registro_contrato": "l1"}
    assert store.tables()["fact_registro_contrato"].select("sk_dim_producto").distinct().count() == 1


def test_a_load_may_leave_a_fact_without_rows(spark, watched):
    store, _, _ = watched
    lines = source(spark)["registro_contrato"]
    unknown = lines.withColumn("cod_cliente", F.lit(9_001).cast(lines.schema["cod_cliente"].dataType))
    run_load(store, {**source(spark), "registro_contrato": unknown}, with_metrics=False)
    assert store.tables()["fact_registro_contrato"].count() == 0


def test_a_replayed_batch_of_tables_changes_nothing(spark, watched):
    store, landing, _ = watched
    path = land_snapshot(source(spark)["cliente"], landing, "c1", "cliente")
    batch = spark.createDataFrame([("c1", path, "cliente")], "snapshot STRING, path STRING, source STRING").withColumn(
        "landed_at", F.current_timestamp())
    args = (source(spark), DEFAULT_FIRST_DAY, DEFAULT_LAST_DAY)
    again = lambda n, b=batch: handle_sources(store, "a", b, n, *args, with_metrics=False)
    assert [again(0), again(0), again(1), again(2, batch.limit(0))] == ["loaded", "replayed", "unchanged", "nothing"]
    assert store.version() == 2
    missing = batch.withColumn("path", F.lit(f"{landing}/payload/cliente/gone"))
    with pytest.raises(Exception, match="(?i)path"):
        again(3, missing)
    assert store.version() == 2 and store.last_batch("a") == 0


def test_a_full_load_stamps_its_goals(spark, loaded_paths, tmp_path):
    store = WarehouseStore(spark, str(tmp_path / "stamp"))
    load = store.open_load()
    load.written = dict(loaded_paths)
    load.publish()
    run_load(store, {**source(spark), "metas": goals(spark).drop("fecha_carga")}, with_metrics=False)
    stamps = store.tables()["stg_metas"].select("fecha_carga").distinct().collect()
    assert len(stamps) == 1 and stamps[0][0] is not None
