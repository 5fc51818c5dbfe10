"""The ordered, all-or-nothing load: eight dimensions, four facts, one publish.

Nothing a reader can see changes before ``publish``.  Each fact is checked while it is being written: an
observation counts NULL keys and dates without a calendar day in the same pass, and any count above zero aborts
the load.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.calendar import DEFAULT_FIRST_DAY, DEFAULT_LAST_DAY, extend_calendar
from starloom.operators.lookup import find_hot_keys
from starloom.operators.merge import is_empty, merge_metrics, retained_rows
from starloom.plans import dimensions, facts
from starloom.plans.kpis import kpi_parts
from starloom.schemas import DIMENSIONS, FACT_DATES, FACT_KEYS, FACT_NATURALS, FACT_REQUIRED, FACT_YEARS, REGISTER_KEYS
from starloom.session import materialise, passing_tables
from starloom.sources.goals import LOADED_AT, stage
from starloom.sources.store import Change, Layout, Load, Origin, WarehouseStore

METRICS_SCHEMA = (
    "table_name STRING, inserted LONG, matched LONG, changed LONG, deleted LONG, kept LONG, discarded LONG, source_rows LONG"
)


class LoadAborted(RuntimeError):
    """The load was given up; the published version is unchanged.  ``table`` and ``counts`` tell what a fact's checks found."""

    def __init__(self, message: str, table: str | None = None, counts: Mapping[str, int] | None = None):
        super().__init__(message)
        self.table, self.counts = table, dict(counts or {})


@dataclass
class LoadReport:
    version: int
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)

    def frame(self, spark: SparkSession) -> DataFrame:
        columns = [c.split()[0] for c in METRICS_SCHEMA.split(", ")][1:]
        rows = [(name, *[m.get(c) for c in columns]) for name, m in sorted(self.metrics.items())]
        return spark.createDataFrame(rows, METRICS_SCHEMA)


def _run(jobs: Mapping[str, Callable[[], object]], workers: int) -> dict[str, object]:
    """Run independent table loads side by side; Spark interleaves their stages."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        pending = {name: pool.submit(copy_context().run, job) for name, job in jobs.items()}
        return {name: p.result() for name, p in pending.items()}


def _flagged(df: DataFrame, name: str, calendar: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """A fact source with marks of its calendar days, and what no row of it may be, by the name of the check."""
    days = calendar.select("sk_dim_tiempo")
    flagged, checks = df, {}
    for i, column in enumerate(FACT_DATES[name]):
        known = days.select(F.col("sk_dim_tiempo").alias(column), F.lit(True).alias(f"_day{i}"))
        flagged = flagged.join(known, column, "left")
        outside = F.col(column).isNotNull() & F.col(f"_day{i}").isNull()
        checks[f"{column} outside the calendar"] = outside
    return flagged, checks | {f"{c} unresolved": F.col(c).isNull() for c in FACT_REQUIRED[name]}


def set_aside(load: Load, name: str, source: DataFrame, calendar: DataFrame) -> DataFrame:
    """The rows of a fact source (with natural keys) that can be loaded.  The others are written to ``quarantine_<name>``
    with their natural keys and the checks they fail, and get published with the fact.

    The joins run once: their rows are written down with the failed checks, and both tables are read from there.
    """
    flagged, checks = _flagged(source, name, calendar)
    failed = F.array_compact(F.array(*[F.when(broken, F.lit(check)) for check, broken in checks.items()]))
    columns = [c for c in source.columns if not c.startswith("nk_")]
    naturals = [f"nk_{c}" for c in FACT_NATURALS[name]]
    marked = materialise(flagged.select(*columns, *naturals, failed.alias("failed")), f"{name}-marked")
    misses = marked.where(F.size("failed") > 0)
    load.write(f"quarantine_{name}", misses.select(*[F.col(f"nk_{c}").alias(c) for c in FACT_NATURALS[name]], "failed"))
    return marked.where(F.size("failed") == 0).select(*columns)


def observed_fact(df: DataFrame, name: str, calendar: DataFrame) -> tuple[DataFrame, Observation]:
    """A fact source that counts, in the pass that uses it, its unresolved keys, dates outside the calendar, source rows and
    rows that no source row stands for."""
    counted = df if facts.SOURCE_ROWS in df.columns else df.withColumn(facts.SOURCE_ROWS, F.lit(1).cast("long"))
    flagged, checks = _flagged(counted, name, calendar)
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    stands = F.col(facts.SOURCE_ROWS)
    totals = [F.count(F.lit(1)).alias("_rows"), F.coalesce(F.sum(stands), F.lit(0)).alias("_source"), F.count_if(stands == 0).alias("_kept")]
    counts = [F.count_if(broken).alias(check) for check, broken in checks.items()]
    return facts.ordered(flagged.observe(seen, *counts, *totals), name), seen


def require_checked(name: str, seen: Observation) -> dict[str, int]:
    """The totals of an observed fact; raises if a check counted anything."""
    found = dict(seen.get)
    totals = {k: int(found.pop(k) or 0) for k in ("_rows", "_source", "_kept")}
    broken = {k: v for k, v in found.items() if v}
    if broken:
        raise LoadAborted(f"{name}: {broken}", name, broken)
    return totals


def _checked_write(load: Load, name: str, df: DataFrame, calendar: DataFrame, unique: bool) -> tuple[Change, dict[str, int]]:
    """Write the parts of a fact that differ; checks and counts are taken in the same pass.  Keys are checked for repeats
    only if nothing has made them ``unique``."""
    observed, seen = observed_fact(df, name, calendar)
    change = load.write_changed(name, facts.ordered(df, name), Layout.by_year(FACT_YEARS[name]), observed)
    if not change.written and not change.untouched and is_empty(load.table(name)):
        # No row, nothing to count: adaptive execution takes the observation out of a plan that it finds empty.
        return change, dict.fromkeys(("_rows", "_source", "_kept"), 0)
    totals = require_checked(name, seen)
    if not unique:
        keys = load.table(name).groupBy(*FACT_KEYS[name]).count().where("count > 1")  # the written key columns alone
        if not is_empty(keys):
            repeated = {"repeated fact keys": keys.count()}
            raise LoadAborted(f"{name}: {repeated}", name, repeated)
    return change, totals


def _fact_metrics(load: Load, name: str, change: Change, totals: dict[str, int]) -> dict[str, int]:
    """Counts of a fact load.  Old and new rows are compared in the parts that changed only, by key and row hash; the rows
    of all others match.  ``matched`` counts source rows, so a second row with the key of the first is a match."""
    if name not in load.previous:
        moved = {"inserted": totals["_rows"], "changed": 0, "deleted": 0}
    elif not change.written and not change.gone:
        moved = {"inserted": 0, "changed": 0, "deleted": 0}
    else:
        before, after = load.before, load.state()
        old, new = before[name], after[name]
        if before.layout(name) is not None and before.layout(name) == after.layout(name):
            touched = change.written | change.gone
            old = before.only(name, touched & set(before.parts(name)))
            new = after.only(name, touched & set(after.parts(name)))
        moved = merge_metrics(old, new, FACT_KEYS[name]).first().asDict()
    return {"inserted": moved["inserted"], "matched": totals["_source"] - moved["inserted"], "changed": moved["changed"],
            "deleted": moved["deleted"], "kept": totals["_kept"], "source_rows": totals["_source"]}


def measure_hot_keys(src: Mapping[str, DataFrame]) -> dict[str, dict[str, list[int]]]:
    """Hot keys of the big source tables: one narrow scan each."""
    return {table: find_hot_keys(src[table], sets) for table, sets in facts.HOT_KEY_SETS.items() if table in src}


def load_dimensions(
    spark: SparkSession, src: Mapping[str, DataFrame], load: Load, before: Mapping[str, DataFrame],
    first_day: dt.date, last_day: dt.date, metrics: dict[str, dict[str, int]], workers: int, measure_hot: bool = True,
) -> tuple[dict[str, DataFrame], dict[str, dict[str, list[int]]]]:
    """Write the eight dimensions and, alongside, measure the hot keys that the fact joins will meet."""
    def keyed(name: str) -> DataFrame:
        with passing_tables(spark):
            return store_dimension(name)

    def store_dimension(name: str) -> DataFrame:
        target = before.get(name)
        if name == "dim_tiempo":
            kept = target.count() if target is not None else 0
            state = extend_calendar(spark, target, first_day, last_day)
            inserted = state.count() - kept  # a few thousand days
            metrics[name] = {"inserted": inserted, "kept": kept}
            return load.write(name, state) if inserted or target is None else target
        if name == "dim_estado_contrato":
            result = dimensions.load_states(spark, target)
        else:
            result = dimensions.load_dimension(name, src, target)
        metrics[name] = dict(result.metrics)
        if target is not None and not result.metrics["inserted"] and not result.metrics["changed"]:
            return target  # nothing to write
        return load.write(name, result.state)

    jobs: dict[str, Callable[[], object]] = {"hot": lambda: measure_hot_keys(src) if measure_hot else {}}
    jobs.update({name: (lambda n=name: keyed(n)) for name in [*reversed(DIMENSIONS), "dim_tiempo"]})
    done = _run(jobs, workers)
    hot = done.pop("hot")
    return done, hot


def load_facts(
    src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], load: Load, before: Mapping[str, DataFrame],
    hot: Mapping[str, Mapping[str, list[int]]], metrics: dict[str, dict[str, int]], with_metrics: bool,
    unique_keys: bool = False, quarantine: bool = False,
) -> dict[str, DataFrame]:
    calendar = dims["dim_tiempo"]

    def write(name: str, source: DataFrame, retain: DataFrame | None = None, unique: bool = True) -> DataFrame:
        with passing_tables(load.store.spark):
            return store_fact(name, source, retain, unique)

    def store_fact(name: str, source: DataFrame, retain: DataFrame | None, unique: bool) -> DataFrame:
        if quarantine:
            source = set_aside(load, name, source, calendar)
        state, previous = source, before.get(name)
        if retain is not None:  # read three times below: by the state, its anti join and the writes
            source = materialise(source, name)
            rest = retained_rows(previous, source, FACT_KEYS[name], retain)
            state = source.unionByName(rest.withColumn(facts.SOURCE_ROWS, F.lit(0).cast("long")))
        change, totals = _checked_write(load, name, state, calendar, unique)
        if with_metrics:
            metrics[name] = _fact_metrics(load, name, change, totals)
        return load.table(name)

    def goals() -> DataFrame | None:
        previous, staged = before.get("fact_metas"), src.get("metas")
        if staged is None or is_empty(staged):
            metrics["fact_metas"] = {"inserted": 0, "matched": 0, "changed": 0, "deleted": 0}
            return previous
        if is_empty(dims["dim_producto"]):
            raise facts.MissingPrerequisite("dim_producto is empty; load the dimensions before the goals")
        return write("fact_metas", facts.goal_fact_source(staged, dims, quarantine), unique=False)

    def claims() -> DataFrame:
        retain = facts.live_claim_keys(src, dims) if "fact_registro_siniestro" in before else None
        source = facts.claim_fact_source(src, dims, hot.get("registro_contrato"), hot.get("registro_siniestro"), unique_keys, quarantine)
        return write("fact_registro_siniestro", source, retain, not unique_keys)

    def ratings() -> DataFrame:
        written = write("fact_evaluacion_servicio", facts.rating_fact_source(src, dims, hot.get("recomienda"), quarantine))
        if with_metrics:
            entry = metrics["fact_evaluacion_servicio"]
            entry["discarded"] = src["recomienda"].count() - entry["source_rows"]
        return written

    jobs = {
        "fact_registro_contrato": lambda: write(
            "fact_registro_contrato", facts.contract_fact_source(
                src, dims, hot.get("registro_contrato"), unique_keys, quarantine), unique=not unique_keys),
        "fact_registro_siniestro": claims,
        "fact_evaluacion_servicio": ratings,
        "fact_metas": goals,
    }
    # One after the other: the shuffle files of a fact lie on disk until it is written, and its stages fill the executors.
    done = {name: job() for name, job in jobs.items()}
    return {name: df for name, df in done.items() if df is not None}


def keep_registers(load: Load, src: Mapping[str, DataFrame], buckets: int) -> None:
    """Keep what a change batch needs of the source: clients, lines, claims and ratings by key bucket, and which contracts
    each client has lines of.  A register that did not change is not written."""
    lines = src["registro_contrato"]
    tables = {
        "reg_cliente": src["cliente"].select("cod_cliente", "cod_sucursal"),
        "reg_registro_contrato": lines,
        "reg_registro_siniestro": src["registro_siniestro"],
        "reg_recomienda": src["recomienda"],
        "idx_cliente_contrato": lines.select("cod_cliente", "nro_contrato").distinct(),
    }
    for name, df in tables.items():
        load.write_changed(name, df, Layout.by_bucket(REGISTER_KEYS[name], buckets))


def run_load(
    store: WarehouseStore,
    src: Mapping[str, DataFrame],
    first_day: dt.date = DEFAULT_FIRST_DAY,
    last_day: dt.date = DEFAULT_LAST_DAY,
    workers: int = 6,
    with_metrics: bool = True,
    balance_hot_keys: bool = True,
    trust_primary_keys: bool = False,
    origin: Origin | None = None,
    register_buckets: int | None = None,
    keep_kpis: bool = False,
    quarantine: bool = False,
    beside: Mapping[str, DataFrame] | None = None,
) -> LoadReport:
    """Load every dimension and fact from ``src`` on top of the published version, then publish.

    Facts are laid out by year; a reload writes the years that differ, and only dimensions with new or changed rows.
    ``trust_primary_keys`` says that the source enforces its primary keys; the contract and claim loads then skip
    the full-width shuffle that would reduce repeated keys.  ``register_buckets`` keeps the registers in the store, cut
    into so many key buckets, so that ``change_load`` can load a change batch; ``keep_kpis`` keeps the additive parts of
    the KPIs for it to update.  With ``quarantine`` fact rows with unresolved keys or dates outside the calendar do not abort
    the load: they stay out of the fact and are published beside it, in ``quarantine_<fact>`` (natural keys, failed checks),
    which every such load replaces.  A fact row whose source row is set aside goes, like one without a source row.
    Goals without a load time get this one's.  ``beside`` are further tables that the same commit publishes.
    """
    spark = store.spark
    load = store.open_load()
    before = load.before
    metrics: dict[str, dict[str, int]] = {}
    try:
        with passing_tables(spark):
            if src.get("metas") is not None:
                staged = src["metas"] if LOADED_AT in src["metas"].columns else stage(src["metas"])
                src = {**src, "metas": load.write("stg_metas", staged)}
            for name, df in (beside or {}).items():
                load.write(name, df)
            src = dimensions.unique_entities(src)
            dims, hot = load_dimensions(
                spark, src, load, before, first_day, last_day, metrics, workers, measure_hot=balance_hot_keys)
            load_facts(src, dims, load, before, hot, metrics, with_metrics, trust_primary_keys, quarantine)
            if register_buckets:
                keep_registers(load, src, register_buckets)
            if keep_kpis:
                for name, parts in kpi_parts(load.state()).items():
                    load.write(name, parts)
    except Exception as error:
        found = (error.table, error.counts) if isinstance(error, LoadAborted) else ()
        raise LoadAborted(f"load aborted, nothing published: {error}", *found) from error
    return LoadReport(load.publish(origin), metrics)


def refresh_goals(
    store: WarehouseStore, staged: DataFrame, origin: Origin | None = None
) -> LoadReport:
    """Load only the goals: staging and goal fact are published together."""
    load = store.open_load()
    before = load.before
    metrics: dict[str, dict[str, int]] = {}
    try:
        with passing_tables(store.spark):
            if "dim_producto" not in before or is_empty(before["dim_producto"]):
                raise facts.MissingPrerequisite("dim_producto is empty; load the dimensions before the goals")
            staged = load.write("stg_metas", staged)
            if is_empty(staged):
                return LoadReport(store.version(), {"fact_metas": {"inserted": 0, "matched": 0, "changed": 0, "deleted": 0}})
            source = facts.goal_fact_source(staged, before)
            change, totals = _checked_write(load, "fact_metas", source, before["dim_tiempo"], unique=False)
            found = _fact_metrics(load, "fact_metas", change, totals)
            metrics["fact_metas"] = {k: v for k, v in found.items() if k != "source_rows"}
    except Exception as error:
        raise LoadAborted(f"goals not loaded, nothing published: {error}") from error
    return LoadReport(load.publish(origin), metrics)


def reset_scope(wh: Mapping[str, DataFrame], clients: DataFrame, contracts: DataFrame, claims: DataFrame) -> dict[str, DataFrame]:
    """Remove the given clients, contracts and claims from dimensions and facts.

    The key frames name natural keys (``cod_cliente_nk``, ``nro_contrato_nk``, ``nro_siniestro_nk``).  Facts are
    cleared by surrogate key before the dimension rows go: ratings and contracts by client, claims by claim.
    """
    c = wh["dim_cliente"].join(clients, "cod_cliente_nk", "left_semi").select("sk_dim_cliente")
    s = wh["dim_siniestro"].join(claims, "nro_siniestro_nk", "left_semi").select("sk_dim_siniestro")
    out = dict(wh)
    out["fact_evaluacion_servicio"] = wh["fact_evaluacion_servicio"].join(c, "sk_dim_cliente", "left_anti")
    out["fact_registro_contrato"] = wh["fact_registro_contrato"].join(c, "sk_dim_cliente", "left_anti")
    out["fact_registro_siniestro"] = wh["fact_registro_siniestro"].join(s, "sk_dim_siniestro", "left_anti")
    out["dim_cliente"] = wh["dim_cliente"].join(clients, "cod_cliente_nk", "left_anti")
    out["dim_contrato"] = wh["dim_contrato"].join(contracts, "nro_contrato_nk", "left_anti")
    out["dim_siniestro"] = wh["dim_siniestro"].join(claims, "nro_siniestro_nk", "left_anti")
    return out
