"""Operators against brute force and stated edge cases."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions.dates import key_year, register_sql_functions, smart_key, year_end_key, year_start_key
from starloom.functions.digests import fingerprint_value, row_hash
from starloom.operators import quality as q
from starloom.operators.calendar import calendar_rows, date_series, extend_calendar
from starloom.operators.keys import assign_surrogate_keys, last_wins, max_key
from starloom.operators.lookup import (
    LookupMiss, find_hot_keys, lookup, miss_counts, require_resolved, split_resolved,
)
from starloom.operators.merge import (
    apply_changes, apply_updates, delete_by_key, insert_only, is_empty, merge_fact, merge_metrics, scd1_upsert, sync_delete,
)
from starloom.operators.totals import control_totals

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- dates and calendar ------------------------------------------------------------------------------------


def test_default_calendar(spark):
    days = extend_calendar(spark)
    assert days.count() == 5113
    row = days.where("sk_dim_tiempo = 20270101").first().asDict()
    assert row == {
        "sk_dim_tiempo": 20270101, "cod_annio": 2027, "cod_mes": 1, "cod_dia_annio": 1, "cod_dia_mes": 1, "cod_dia_semana": 6,
        "cod_semana": 53, "desc_dia_semana": "Viernes", "desc_dia_semana_corta": "Vie", "desc_mes": "Enero", "desc_mes_corta": "Ene",
        "desc_trimestre": "Q1", "desc_semestre": "S1", "fecha_completa": dt.date(2027, 1, 1)}
    assert days.where("sk_dim_tiempo = 20240707").first()["cod_dia_semana"] == 1  # a Sunday
    assert days.where("desc_semestre = 'S2' and cod_mes <= 6").count() == 0


def test_calendar_is_insert_only(spark):
    first = calendar_rows(date_series(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 10))).withColumn("desc_mes", F.lit("kept"))
    out = extend_calendar(spark, first, dt.date(2023, 12, 31), dt.date(2024, 1, 12))
    assert out.count() == 13
    assert out.where("desc_mes = 'kept'").count() == 10


def test_smart_keys(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE '2024-02-29'), (NULL) t(d)")
    assert rows(df.select(smart_key(F.col("d")))) == [(20240229,), (None,)]
    years = spark.createDataFrame([(2026,)], "y INT")
    assert rows(years.select(year_start_key(F.col("y")), year_end_key(F.col("y")))) == [(20260101, 20261231)]
    assert rows(spark.createDataFrame([(20260711,)], "k LONG").select(key_year(F.col("k")))) == [(2026,)]
    register_sql_functions(spark)
    assert spark.sql("SELECT fn_sk_tiempo(DATE '2024-02-29'), fn_sk_tiempo(NULL)").first()[:] == (20240229, None)


# --- surrogate keys and last wins --------------------------------------------------------------------------


def test_surrogate_keys_equal_a_global_row_number(spark):
    values = list(range(0, 40_000, 7))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "nk INT").repartition(16)
    keyed = assign_surrogate_keys(df, ["nk"], "sk", seed=100)
    assert rows(keyed.select("nk", "sk")) == sorted(
        [(v, 101 + i) for i, v in enumerate(sorted(values))], key=str)


def test_surrogate_keys_of_nothing(spark):
    assert assign_surrogate_keys(spark.createDataFrame([], "nk INT"), ["nk"], "sk").count() == 0


def test_sentinels_do_not_seed(spark):
    assert max_key(spark.createDataFrame([(0,), (-1,)], "sk INT"), "sk") == 0
    assert max_key(spark.createDataFrame([(0,), (7,), (-1,)], "sk INT"), "sk") == 7
    target = spark.createDataFrame([(-1, -1, "none"), (4, 10, "a")], "sk LONG, nk INT, v STRING")
    source = spark.createDataFrame([(10, "b"), (20, "c"), (15, "d")], "nk INT, v STRING")
    assert rows(scd1_upsert(target, source, "nk", "sk", ["v"]).state) == [(-1, -1, "none"), (4, 10, "b"), (5, 15, "d"), (6, 20, "c")]


def test_last_wins_takes_the_highest_with_total_order(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 5, "b"), (1, 5, "c"), (2, None, "d"), (2, 0, "e")], "k INT, o INT, v STRING")
    assert rows(last_wins(df, ["k"], ["o"])) == [(1, 5, "c"), (2, 0, "e")]


def test_last_wins_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = last_wins(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # one below the exchange, one above


# --- lookups -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows carry key 7, a few keys have no match, some are NULL."""
    left = spark.range(9000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 1000).cast("int").alias("k"))
    right = spark.range(900).select(F.col("id").alias("nk"), (F.col("id") * 10).alias("sk"))
    return left.persist(), right


@pytest.mark.parametrize("how", ["left", "inner", "semi", "anti"])
def test_hot_lookup_equals_plain_lookup(spark, skewed, how):
    left, right = skewed
    hot = find_hot_keys(left, {"k": ["k"]})["k"]
    assert len(hot) >= 1
    plain = lookup(left, right, {"k": "nk"}, ["sk"], how)
    salted = lookup(left, right, {"k": "nk"}, ["sk"], how, hot=hot, spread_by=["row"])
    assert plain.columns == salted.columns
    assert rows(plain) == rows(salted)


def test_hot_keys_are_found_and_bounded(spark, skewed):
    left, _ = skewed
    hot = find_hot_keys(left, {"k": ["k"], "row": ["row"]})
    seven = spark.createDataFrame([(7,)], "k INT").select(F.xxhash64("k")).first()[0]
    assert seven in hot["k"] and len(hot["k"]) <= 100
    assert hot["row"] == []


def test_hot_rows_spread_over_tasks(spark, skewed):
    left, right = skewed
    hot = find_hot_keys(left, {"k": ["k"]})["k"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(left, right, {"k": "nk"}, ["sk"], hot=hot, spread_by=["row"])
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = [r[1] for r in lookup(left, right, {"k": "nk"}, ["sk"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(plain) > 9000 / 3
    assert max(sizes) < 9000 / 4


def test_lookup_misses(spark, skewed):
    left, right = skewed
    keyed = lookup(left, right, {"k": "nk"}, ["sk"])
    counts = miss_counts(keyed, ["sk"]).first()
    missing = keyed.where("sk IS NULL").count()
    assert (counts["n_rows"], counts["missing_sk"]) == (9000, missing) and missing > 0
    with pytest.raises(LookupMiss):
        require_resolved(keyed, ["sk"], "test")
    good, bad = split_resolved(keyed, ["sk"])
    assert good.count() + bad.count() == 9000 and bad.count() == missing
    assert require_resolved(good, ["sk"], "test") is good


def test_hot_share_follows_the_partitions(spark):
    # A key with half a per cent of the rows: nothing at eight partitions, half a partition at a hundred.
    left = spark.range(20_000).select(F.when(F.col("id") % 200 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert find_hot_keys(left, {"k": ["k"]})["k"] == []
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        assert len(find_hot_keys(left, {"k": ["k"]})["k"]) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


# --- merges ------------------------------------------------------------------------------------------------

dimension = st.dictionaries(st.integers(1, 12), st.one_of(st.none(), st.integers(0, 3)), max_size=10)


@SLOW
@given(old=dimension, new=dimension)
def test_scd1_properties(spark, old, new):
    target = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(sorted(old.items()), 1)], "sk LONG, nk INT, v INT")
    source = spark.createDataFrame(list(new.items()), "nk INT, v INT")
    result = scd1_upsert(target, source, "nk", "sk", ["v"])
    state = {r["nk"]: (r["sk"], r["v"]) for r in result.state.collect()}
    assert set(state) == set(old) | set(new)
    assert sorted(sk for sk, _ in state.values()) == list(range(1, len(state) + 1))
    assert all(state[k][1] == v for k, v in new.items())
    assert all(state[k][1] == v for k, v in old.items() if k not in new)
    added = [state[k][0] for k in sorted(set(new) - set(old))]
    assert added == sorted(added)
    m = result.metrics
    assert m["inserted"] + m["matched"] == len(new) and m["kept"] == len(set(old) - set(new))
    assert m["changed"] == sum(1 for k in set(old) & set(new) if old[k] != new[k])
    again = scd1_upsert(result.state, source, "nk", "sk", ["v"])
    assert (again.metrics["inserted"], again.metrics["changed"]) == (0, 0)
    assert rows(again.state) == rows(result.state)


fact = st.dictionaries(st.tuples(st.integers(1, 4), st.integers(1, 4)), st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 2))), max_size=10)


def _fact(spark, d):
    return spark.createDataFrame([(*k, *v) for k, v in d.items()], "a INT, b INT, x INT, y INT")


@SLOW
@given(old=fact, new=fact, live=st.sets(st.tuples(st.integers(1, 4), st.integers(1, 4)), max_size=6))
def test_fact_merge_properties(spark, old, new, live):
    target, source = _fact(spark, old), _fact(spark, new)
    as_dict = lambda df: {(r["a"], r["b"]): (r["x"], r["y"]) for r in df.collect()}
    assert as_dict(merge_fact(target, source, ["a", "b"])) == new
    partial = as_dict(merge_fact(target, source, ["a", "b"], overwrite=["x"], sync=False))
    expected = {**old, **{k: ((v[0], old[k][1]) if k in old else v) for k, v in new.items()}}
    assert partial == expected
    keep = spark.createDataFrame([*live], "a INT, b INT")
    kept = {k: v for k, v in old.items() if k in live and k not in new}
    assert as_dict(merge_fact(target, source, ["a", "b"], retain_keys=keep)) == {**kept, **new}
    m = merge_metrics(target, source, ["a", "b"], retain_keys=keep).first().asDict()
    both = set(old) & set(new)
    assert m == {"inserted": len(new) - len(both), "matched": len(both), "changed": sum(old[k] != new[k] for k in both),
                 "deleted": len(set(old) - set(new) - live), "kept": len(kept)}


def test_merge_metrics_without_sync_or_target(spark):
    target, source = _fact(spark, {(1, 1): (0, 0), (2, 2): (0, 0)}), _fact(spark, {(1, 1): (0, 1)})
    assert merge_metrics(target, source, ["a", "b"], sync=False).first()[:] == (0, 1, 1, 0, 1)
    assert merge_metrics(None, source, ["a", "b"]).first()[:] == (1, 0, 0, 0, 0)


def test_null_flags_take_part_in_row_hashes(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "a INT, b INT")
    assert df.select(row_hash(["a", "b"])).distinct().count() == 2


def test_empty_guard_and_sync(spark):
    target, nothing = _fact(spark, {(1, 1): (0, 0)}), _fact(spark, {})
    assert merge_fact(target, nothing, ["a", "b"], guard_empty=True).count() == 1
    assert merge_fact(target, nothing, ["a", "b"]).count() == 0
    assert merge_fact(None, target, ["a", "b"]).count() == 1
    assert is_empty(nothing) and not is_empty(target)
    assert sync_delete(target, nothing, ["a", "b"]).count() == 0
    assert delete_by_key(target, target, ["a"]).count() == 0


def test_insert_only_leaves_existing_rows(spark):
    target = spark.createDataFrame([(5, "A", "old")], "sk LONG, code STRING, label STRING")
    domain = spark.createDataFrame([(1, "Z", "z"), (2, "A", "new"), (3, "B", "b")], "pos INT, code STRING, label STRING")
    result = insert_only(target, domain, "code", "sk", ["pos"])
    assert rows(result.state) == [(5, "A", "old"), (6, "Z", "z"), (7, "B", "b")]
    assert result.metrics["inserted"] == 2


def test_change_batches(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k INT, s STRING, n INT")
    batch = spark.createDataFrame([(2, "B", None), (3, "c", 3)], "k INT, s STRING, n INT")
    assert rows(apply_changes(base, batch, ["k"])) == [(1, "a", 1), (2, "B", None), (3, "c", 3)]
    assert rows(apply_updates(base, batch, ["k"], ["n"])) == [(1, "a", 1), (2, "b", None)]


def test_control_totals(spark):
    empty = spark.createDataFrame([], "v DECIMAL(18,2)")
    assert [float(x) for x in control_totals(empty, "v").first()] == [0.0, 0.0]


def test_fingerprint_ignores_order_but_not_content(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k INT, v STRING")
    assert fingerprint_value(a) == fingerprint_value(a.orderBy(F.desc("k")).repartition(3))
    assert fingerprint_value(a) != fingerprint_value(a.distinct())
    assert fingerprint_value(a) != fingerprint_value(a.fillna("", ["v"]))
    assert fingerprint_value(a) == fingerprint_value(a.select(*reversed(a.columns)))
    swapped = a.select(*[F.col(c).alias(d) for c, d in zip(a.columns, reversed(a.columns))])
    assert fingerprint_value(a) != fingerprint_value(swapped)
    assert fingerprint_value(a.limit(0)) != fingerprint_value(swapped.limit(0).withColumnRenamed("v", "w"))
    split = lambda *row: fingerprint_value(spark.createDataFrame([row], "p STRING, q STRING"))
    assert len({split("a|", "b"), split("a", "|b"), split("a", None), split("a", "N"), split(None, "a")}) == 5


# --- quality rules -----------------------------------------------------------------------------------------


def test_row_rules_pass_nulls_and_report_each_break(spark):
    df = spark.createDataFrame(
        [(1, "si", 3, "2024-01-02", "2024-01-01", 1, "malo"), (2, "x", 9, None, "2024-01-01", 2, "MALO"), (3, None, None, "2024-01-01", "2024-01-01", None, "z")],
        "k INT, d STRING, r INT, hi STRING, lo STRING, code INT, label STRING").withColumn("hi", F.to_date("hi")).withColumn("lo", F.to_date("lo"))
    rules = [q.domain("d", ["SI", "NO"]), q.between("r", 1, 5), q.not_before("lo", "hi"), q.pair_domain("code", "label", {1: "MALO", 2: "REGULAR"}),
             q.max_length("label", 3), q.not_null("r"), q.domain("d", ["SI"], upper=False), q.predicate("odd", F.col("k") % 2 == 1, ["k"])]
    found = rows(q.row_violations(df, "t", ["k"], rules).select("rule", "row_key", "detail"))
    assert found == sorted([
        ("domain:d", "2", "x"), ("range:r", "2", "9"), ("order:hi,lo", "1", "2024-01-02,2024-01-01"), ("pair:code,label", "2", "2,MALO"), ("pair:code,label", "3", "NULL,z"),
        ("length:label", "1", "4"), ("length:label", "2", "4"), ("not_null:r", "3", "NULL"),
        ("domain:d", "1", "si"), ("domain:d", "2", "x"), ("odd", "2", "2")], key=str)


def test_key_rules(spark):
    child = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 9), (4, 9)], "k INT, p INT")
    parent = spark.createDataFrame([(1,)], "p INT")
    spec = q.TableRules("child", ["k"], [q.unique("k"), q.foreign_key(["p"], "parent", ["p"])])
    found = q.violations({"child": child, "parent": parent}, [spec])
    assert rows(found.select("rule", "row_key", "n_rows")) == [("foreign_key:p", "9", 2), ("unique:k", "1", 2)]
    assert rows(q.summarise(found)) == [("child", "foreign_key:p", 1, 2), ("child", "unique:k", 1, 2)]
    with pytest.raises(ValueError):
        q.violations({}, [spec])
