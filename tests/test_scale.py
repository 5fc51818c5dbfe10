"""What lets loads and reports grow: how work is dealt out, what is broadcast, and what stays on disk."""

from collections import Counter

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixture_data import changed_rows, changed_source, goals, source
from starloom.driver import queries
from starloom.driver.bindings import Roles
from starloom.plans import change_load, kpis
from starloom.plans.change_load import run_change_load
from starloom.plans.warehouse_load import run_load
from starloom.schemas import PRIMARY_KEYS
from starloom.session import lasting_tables, materialise, passing_tables, shared_dir
from starloom.sources.store import WarehouseStore

_REPORT = "nombre STRING, n LONG, tasa DECIMAL(10,2)"


def _report(spark, rows):
    return spark.createDataFrame(rows, _REPORT)


def _sides(spark):
    """A large group, repeated rows, groups of one side only, and no name at all."""
    old = [("hot", i % 90, None) for i in range(200)] + [("twice", 1, None)] * 3 + [("old", 2, None), (None, 3, None), (None, 3, None)]
    new = [("hot", i, None) for i in range(150)] + [("twice", 1, None)] * 2 + [("new", 5, None), (None, 3, None)]
    return _report(spark, old), _report(spark, new), old, new


def test_compare_pairs_every_row_of_a_group(spark, monkeypatch):
    monkeypatch.setattr(kpis, "BLOCK_ROWS", 16, raising=False)
    before, after, old, new = _sides(spark)
    expected = Counter((g, n, t, m, u) for g, n, t in old for h, m, u in new if g is not None and g == h)
    expected += Counter((g, n, t, None, None) for g, n, t in old if g in (None, "old"))
    expected += Counter((g, None, None, m, u) for g, m, u in new if g in (None, "new"))
    found = kpis.compare(before, after, ["nombre"])
    assert found.columns == ["nombre", "n_antes", "tasa_antes", "n_despues", "tasa_despues"]
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_compare_deals_a_large_group_over_tasks(spark, monkeypatch):
    """All pairs of one name were made by one task."""
    monkeypatch.setattr(kpis, "BLOCK_ROWS", 16, raising=False)
    monkeypatch.setattr(kpis, "TASK_PAIRS", 1_000, raising=False)
    before, after, *_ = _sides(spark)
    hot = kpis.compare(before, after, ["nombre"]).where("nombre = 'hot'")
    made = [r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(made) == 200 * 150 and max(made) < 0.4 * sum(made)


def test_compare_without_rows_on_a_side(spark):
    before, after, old, _ = _sides(spark)
    gone = kpis.compare(before, after.limit(0), ["nombre"]).collect()
    assert Counter(tuple(r) for r in gone) == Counter((*r, None, None) for r in old)


def test_the_goals_sheet_broadcasts_no_products(spark, tmp_path):
    """Files of a few MB hold millions of products, which a broadcast would gather on the driver."""
    part = spark.range(40).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("Brand#"), F.col("id") % 4).alias("p_brand"), F.lit(10.5).alias("p_retailprice"),
        F.lit(3).alias("p_size"))
    part.union(part.limit(1)).write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT timestamp'1996-03-01' AS o_orderdate UNION ALL SELECT timestamp'1997-03-01'").write.parquet(f"{tmp_path}/orders.parquet")
    sheet = queries._text_goals(Roles(spark, str(tmp_path)))
    assert sheet.count() == 2 * 39 + 2 * 4  # two years; the repeated product meets itself
    assert "Broadcast" not in sheet._jdf.queryExecution().executedPlan().toString()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _scratch(spark):
    return {p.name for p in (Path(shared_dir(spark).removeprefix("file:")) / "starloom" / spark.sparkContext.applicationId).glob("*")}


def _values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_passing_tables_go_and_lasting_ones_stay(spark):
    before = spark.conf.get(_CLEANUP)
    with passing_tables(spark):
        outer = materialise(spark.range(3), "outer")
        with passing_tables(spark):
            materialise(spark.range(3), "inner")
            with lasting_tables():
                kept = materialise(spark.range(5), "kept")
        assert spark.conf.get(_CLEANUP) == "true"
        assert outer.count() == 3 and not [n for n in _scratch(spark) if n.startswith("inner-")]
    assert kept.count() == 5 and not [n for n in _scratch(spark) if n.startswith("outer-")]
    assert spark.conf.get(_CLEANUP) == before
    with pytest.raises(ZeroDivisionError), passing_tables(spark):
        materialise(spark.range(3), "broken")
        1 / 0
    assert not [n for n in _scratch(spark) if n.startswith("broken-")] and spark.conf.get(_CLEANUP) == before


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """A loaded store, and the scratch tables that its load left."""
    held = _scratch(spark)
    store = WarehouseStore(spark, str(tmp_path_factory.mktemp("scale-base")))
    run_load(store, {**source(spark), "metas": goals(spark)}, register_buckets=4, keep_kpis=True, with_metrics=False)
    return store, _scratch(spark) - held


def _changed(spark, base, folder):
    store = WarehouseStore(spark, str(folder))
    load = store.open_load()
    load.adopt(base.paths())
    load.publish()
    after = changed_source(spark)
    changes = {t: after[t] for t in changed_rows() if t in ("cliente", "contrato", "siniestro", "registro_contrato", "registro_siniestro")}
    deletes = {"recomienda": source(spark)["recomienda"].limit(5).select(*PRIMARY_KEYS["recomienda"])}
    run_change_load(store, changes, deletes)
    return {t: _values(df) for t, df in store.tables().items() if not t.startswith("stg_")}


def test_loads_leave_only_published_tables(spark, base, tmp_path, monkeypatch):
    """Sorted keys, merges and rows of a batch lay on disk until the application ended.  Written by many queries (each year
    and bucket by its own) the tables are the same."""
    store, left = base
    held = _scratch(spark)
    found = _changed(spark, store, tmp_path / "all")
    assert not left and _scratch(spark) == held
    monkeypatch.setattr(change_load, "WRITE_ROWS", 1, raising=False)
    assert _changed(spark, store, tmp_path / "each") == found


def test_parts_are_emptied_before_others_appear(spark, tmp_path):
    store = WarehouseStore(spark, str(tmp_path))
    first = store.open_load()
    layout = change_load.Layout.by_year("dia")
    first.write_changed("t", spark.createDataFrame([(20200101, 1)], "dia INT, v INT"), layout)
    first.publish()
    load = store.open_load()
    load.replace_parts("t", spark.createDataFrame([], "dia INT, v INT"), [2020])
    load.replace_parts("t", spark.createDataFrame([(20210101, 2)], "dia INT, v INT"), [2021])
    load.replace_parts("t", spark.createDataFrame([(20220101, 3)], "dia INT, v INT"), [2022])
    load.publish()
    assert _values(store.tables()["t"]) == [(20210101, 2), (20220101, 3)]
    assert sorted(store.tables().parts("t")) == [2021, 2022]
