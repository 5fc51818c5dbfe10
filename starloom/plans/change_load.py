"""Loading a change batch: only what its rows touch is read, recomputed and written.

The store keeps the registers, cut into key buckets (``run_load(register_buckets=…)``).  The keys of the batch spread:
changed clients reach the contracts they have lines of, changed lines their contract, contracts their claims, and all of
them the ratings of their clients.  The buckets of these keys are read, the facts of these contracts and clients are
computed by the plans of the full load, and they replace the facts of the same contracts and clients in the years where
either lies.  All other buckets and years stay as they are.  The result is the state that a full load of the changed
source would publish.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import last_wins
from starloom.operators.merge import apply_changes, is_empty, merge_metrics, retained_rows
from starloom.plans import dimensions, facts
from starloom.plans.kpis import KPI_PARTS, kept_name, updated_parts
from starloom.plans.warehouse_load import LoadAborted, LoadReport, observed_fact, require_checked
from starloom.schemas import FACT_KEYS, FACT_YEARS, PRIMARY_KEYS
from starloom.session import materialise, passing_tables
from starloom.sources.store import Layout, Load, Origin, PublishedTables, WarehouseStore, part_digests

# Source tables that a dimension is made from.  Clients, contracts and claims may come as single rows; the others are small
# and come whole, all of one line together.
DIMENSION_SOURCES = {
    "dim_cliente": ["cliente"], "dim_contrato": ["contrato"], "dim_siniestro": ["siniestro"],
    "dim_producto": ["producto", "tipo_producto"], "dim_evaluacion_servicio": ["evaluacion_servicio"],
    "dim_sucursal": ["sucursal", "ciudad", "pais"],
}
REGISTERS = ["registro_contrato", "registro_siniestro", "recomienda"]
WRITE_ROWS = 8_000_000  # old rows of parts that one query replaces, if it replaces more than one


@dataclass
class Touched:
    """Rows of one fact that the batch takes away and puts in, and the years where they lie."""

    removed: DataFrame
    added: DataFrame
    years: list[int]


def _values(df: DataFrame, expression) -> list[int]:
    """Parts: as many values as buckets or years."""
    return sorted(r[0] for r in df.select(expression.alias("p")).distinct().collect() if r[0] is not None)


def _part_rows(tables: PublishedTables, name: str, keys: DataFrame) -> DataFrame:
    """Rows of a kept register whose key is in ``keys``; only the buckets of these keys are read."""
    layout = tables.layout(name)
    if layout is None:  # a register without rows
        return tables[name]
    held = set(_values(keys, layout.part())) & set(tables.parts(name))
    return tables.only(name, held).join(keys, keys.columns, "left_semi")


class ChangeBatch:
    """A batch over kept registers: ``rows`` holds new and changed rows by source table, whole rows with their key;
    ``deletes`` holds keys of register rows that are gone."""

    def __init__(self, load: Load, rows: Mapping[str, DataFrame], deletes: Mapping[str, DataFrame]):
        self.load, self.before = load, load.before
        self.rows = {name: last_wins(df.dropna(subset=PRIMARY_KEYS[name]), PRIMARY_KEYS[name], [])
                     if name not in ("recomienda", "metas") else df for name, df in rows.items()}
        self.deletes = dict(deletes)
        self.calendar = self.before["dim_tiempo"]

    def _changed_keys(self, register: str) -> DataFrame | None:
        keys = [df.select(*PRIMARY_KEYS[register]) for df in (self.rows.get(register), self.deletes.get(register)) if df is not None]
        return None if not keys else (keys[0] if len(keys) == 1 else keys[0].unionByName(keys[1]))

    def _union(self, column: str, *frames: DataFrame | None) -> DataFrame:
        given = [f.select(F.col(column).cast("long").alias(column)) for f in frames if f is not None]
        if not given:
            return self.load.store.spark.createDataFrame([], f"{column} LONG")
        out = given[0]
        for f in given[1:]:
            out = out.unionByName(f)
        return materialise(out.dropna().distinct(), f"batch-{column}")

    def _now(self, register: str, old: DataFrame, keys: DataFrame) -> DataFrame:
        """Old rows with the batch applied; of the batch only the rows with one of ``keys``."""
        primary = PRIMARY_KEYS[register]
        gone, fresh = self.deletes.get(register), self.rows.get(register)
        now = old if gone is None else old.join(gone.select(*primary), primary, "left_anti")
        if fresh is None:
            return now
        return apply_changes(now, fresh.join(keys, keys.columns, "left_semi"), primary)

    def spread(self) -> None:
        """The keys that the batch reaches, and the contract lines of these keys before and after it."""
        lines, claims, ratings = (self._changed_keys(r) for r in REGISTERS)
        clients = self.rows.get("cliente")
        changed_clients = self._union("cod_cliente", clients)
        index = _part_rows(self.before, "idx_cliente_contrato", changed_clients)
        contracts = self._union("nro_contrato", lines, index)
        old_lines = materialise(_part_rows(self.before, "reg_registro_contrato", contracts), "batch-lines")
        new_lines = materialise(self._now("registro_contrato", old_lines, contracts), "batch-new-lines")

        self.contracts, self.old_lines, self.new_lines = contracts, old_lines, new_lines
        self.claim_contracts = self._union("nro_contrato", contracts, claims)
        # Lines of contracts that only a changed claim reaches are as they were.
        others = self.claim_contracts.join(contracts, "nro_contrato", "left_anti")
        self.claim_lines = new_lines.unionByName(_part_rows(self.before, "reg_registro_contrato", others))
        self.clients = self._union("cod_cliente", old_lines, new_lines, ratings, changed_clients)

        reached = self._union("cod_cliente", self.claim_lines, new_lines)
        branches = _part_rows(self.before, "reg_cliente", reached)
        if clients is not None:
            branches = apply_changes(branches, clients.select(*branches.columns), ["cod_cliente"])
        self.client_branches = materialise(branches, "batch-branches")

    def load_dimensions(self, metrics: dict[str, dict[str, int]]) -> dict[str, DataFrame]:
        """Type-1 upserts of the changed entities; a dimension without any stays."""
        dims = {name: self.before[name] for name in self.before if name.startswith("dim_")}
        for name, sources in DIMENSION_SOURCES.items():
            given = [s for s in sources if s in self.rows]
            if not given:
                continue
            if given != sources:
                raise ValueError(f"{name} needs all of {sources} in the batch")
            with passing_tables(self.load.store.spark):
                result = dimensions.load_dimension(name, self.rows, self.before[name])
                metrics[name] = dict(result.metrics)
                if result.metrics["inserted"] or result.metrics["changed"]:
                    dims[name] = self.load.write(name, result.state)
        return dims

    def touched_contracts(self, dims: Mapping[str, DataFrame]) -> Touched:
        keys = self._surrogates(dims, "dim_contrato", self.contracts)
        source = facts.contract_fact_source({"registro_contrato": self.new_lines, "cliente": self.client_branches}, dims)
        return self._touched("fact_registro_contrato", source, keys, _values(self.old_lines, F.year("fecha_inicio")))

    def touched_claims(self, dims: Mapping[str, DataFrame]) -> Touched:
        keys = self._surrogates(dims, "dim_contrato", self.claim_contracts)
        old_claims = _part_rows(self.before, "reg_registro_siniestro", self.claim_contracts)
        claims = materialise(self._now("registro_siniestro", old_claims, self.claim_contracts), "batch-new-claims")
        src = {"registro_contrato": self.claim_lines, "registro_siniestro": claims, "cliente": self.client_branches}
        # A kept claim may have an older date than its register row, so the years are those of its fact rows.
        fact = self.before["fact_registro_siniestro"]
        old = fact.select(*keys.columns, FACT_YEARS["fact_registro_siniestro"]).join(keys, keys.columns, "left_semi")
        years = _values(old, F.expr("sk_fecha_siniestro div 10000"))
        return self._touched("fact_registro_siniestro", facts.claim_fact_source(src, dims), keys, years, facts.live_claim_keys(src, dims))

    def touched_ratings(self, dims: Mapping[str, DataFrame]) -> Touched:
        keys = self._surrogates(dims, "dim_cliente", self.clients)
        known = self._union(
            "nro_contrato", _part_rows(self.before, "idx_cliente_contrato", self.clients),
            self.new_lines.join(self.clients, "cod_cliente", "left_semi"))
        old = materialise(_part_rows(self.before, "reg_registro_contrato", known), "batch-client-lines")
        old_lines = old.join(self.clients, "cod_cliente", "left_semi")
        lines = self._now("registro_contrato", old, known).join(self.clients, "cod_cliente", "left_semi")
        ratings = self._now("recomienda", _part_rows(self.before, "reg_recomienda", self.clients), self.clients)
        source = facts.rating_fact_source({"recomienda": ratings, "registro_contrato": lines}, dims)
        return self._touched("fact_evaluacion_servicio", source, keys, _values(old_lines, F.year("fecha_fin")))

    def load_facts(self, dims: Mapping[str, DataFrame], metrics: dict[str, dict[str, int]]) -> None:
        """One fact after the other: what it needed goes before the next begins.  Kept parts of the KPIs follow each."""
        kept = all(kept_name(kpi, part) in self.load.previous for kpi, parts in KPI_PARTS.items() for part in parts)
        for name, touched_rows in (("fact_registro_contrato", self.touched_contracts), ("fact_registro_siniestro", self.touched_claims),
                                   ("fact_evaluacion_servicio", self.touched_ratings)):
            with passing_tables(self.load.store.spark):
                touched = touched_rows(dims)
                metrics[name] = self.write_fact(name, touched)
                if kept:
                    for part, rows in updated_parts(self.before, {name: touched.added}, {name: touched.removed}).items():
                        self.load.write(part, rows)

    def _surrogates(self, dims: Mapping[str, DataFrame], dim: str, keys: DataFrame) -> DataFrame:
        natural, key = {"dim_contrato": ("nro_contrato", "sk_dim_contrato"), "dim_cliente": ("cod_cliente", "sk_dim_cliente")}[dim]
        found = dims[dim].join(keys.withColumnRenamed(natural, f"{natural}_nk"), f"{natural}_nk", "left_semi")
        return materialise(found.select(key), f"batch-{key}")

    def _touched(self, name: str, source: DataFrame, keys: DataFrame, old_years: Sequence[int], live: DataFrame | None = None) -> Touched:
        """Check the new rows of a fact and find the old ones they replace."""
        observed, seen = observed_fact(source, name, self.calendar)
        added = materialise(observed, f"batch-{name}")
        if not is_empty(added):  # the plan of an empty one may have lost its observation
            require_checked(name, seen)
        layout = self.before.layout(name)
        if layout is None:  # the fact was empty
            removed = self.before[name].limit(0)
        else:
            held = [y for y in old_years if y in self.before.parts(name)]
            removed = self.before.only(name, held).join(keys, keys.columns, "left_semi")
        removed = materialise(removed, f"batch-old-{name}")
        if live is not None:
            kept = retained_rows(removed, added, FACT_KEYS[name], live).select(*added.columns)
            added = added.unionByName(materialise(kept, f"batch-kept-{name}"))
        years = _values(added.select(FACT_YEARS[name]).union(removed.select(FACT_YEARS[name])), F.expr(f"{FACT_YEARS[name]} div 10000"))
        return Touched(removed, added, years)

    def write_fact(self, name: str, touched: Touched) -> dict[str, int]:
        """Replace the touched rows; years in which nothing differs are not written."""
        moved = merge_metrics(touched.removed, touched.added, FACT_KEYS[name]).first().asDict()
        if moved["inserted"] or moved["changed"] or moved["deleted"]:
            if self.before.layout(name) is None:
                self.load.write(name, touched.added)
            else:
                year = F.expr(f"{FACT_YEARS[name]} div 10000")
                for differ in self._at_once(name, self._differing_years(name, touched)):
                    held = [y for y in differ if y in self.before.parts(name)]
                    gone = touched.removed.where(year.isin(differ)).select(*FACT_KEYS[name])
                    rest = self.before.only(name, held).join(gone, FACT_KEYS[name], "left_anti")
                    self.load.replace_parts(name, rest.unionByName(touched.added.where(year.isin(differ))), differ)
        return {k: moved[k] for k in ("inserted", "matched", "changed", "deleted")}

    def _differing_years(self, name: str, touched: Touched) -> list[int]:
        """Years in which rows, or their number, differ: by the digests that tell the store's parts apart."""
        layout = Layout.by_year(FACT_YEARS[name])
        alike = [F.col(c).cast(kind).alias(c) for c, kind in touched.added.dtypes]
        added, removed = (part_digests(df.select(*alike), layout) for df in (touched.added, touched.removed))
        return sorted(y for y in added.keys() | removed.keys() if added.get(y) != removed.get(y))

    def _at_once(self, name: str, parts: Sequence[int]) -> list[list[int]]:
        """Parts to be written by one query: its shuffle files hold their rows until it ends."""
        held, groups, rows = self.before.parts(name), [], 0
        for p in parts:
            n = held[p].n_rows if p in held else 0
            if not groups or rows + n > WRITE_ROWS:
                groups.append([])
                rows = 0
            groups[-1].append(p)
            rows += n
        return groups

    def write_registers(self) -> None:
        """Apply the batch to the kept registers, bucket by bucket."""
        changes = {"reg_registro_contrato": "registro_contrato", "reg_registro_siniestro": "registro_siniestro", "reg_recomienda": "recomienda",
                   "reg_cliente": "cliente"}
        for name, table in changes.items():
            fresh, gone = self.rows.get(table), self.deletes.get(table)
            if fresh is None and gone is None:
                continue
            columns, primary = self.before[name].columns, PRIMARY_KEYS[table]

            def changed(old: DataFrame, fresh: DataFrame | None, gone: DataFrame | None, primary=primary, columns=columns) -> DataFrame:
                if gone is not None:
                    old = old.join(gone.select(*primary), primary, "left_anti")
                return old if fresh is None else apply_changes(old, fresh.select(*columns), primary)

            self._replace(name, changed, fresh, gone)
        if "registro_contrato" in self.rows:  # pairs that are gone stay in the index; they lead to no line
            pairs = self.rows["registro_contrato"].select("cod_cliente", "nro_contrato").distinct()
            self._replace("idx_cliente_contrato", lambda old, new: old.union(new.select(*old.columns)).distinct(), pairs)

    def _replace(self, name: str, changed: Callable[..., DataFrame], *batch: DataFrame | None) -> None:
        """Write the buckets of a register that the rows in ``batch`` lie in; ``changed`` gets old rows and those in ``batch``."""
        layout = self.before.layout(name)
        if layout is None:
            self.load.write(name, changed(self.before[name], *batch))
            return
        touched = sorted({p for df in batch if df is not None for p in _values(df, layout.part())})
        for parts in self._at_once(name, touched):
            old = self.before.only(name, set(parts) & set(self.before.parts(name)))
            here = [None if df is None else df.where(layout.part().isin(parts)) for df in batch]
            self.load.replace_parts(name, changed(old, *here), parts)


def run_change_load(
    store: WarehouseStore, changes: Mapping[str, DataFrame], deletes: Mapping[str, DataFrame] | None = None, origin: Origin | None = None,
) -> LoadReport:
    """Load a change batch on top of the published version, then publish.

    ``changes`` holds whole new or changed rows by source table; ``deletes`` holds keys of register rows that are gone.
    Clients, contracts, claims and register rows may be single rows, the small tables come whole (``DIMENSION_SOURCES``);
    goals have a load of their own.  The registers must be kept in the store.  A batch without rows publishes nothing.
    """
    load = store.open_load()
    if "reg_registro_contrato" not in load.previous:
        raise LoadAborted("the store keeps no registers; run_load(register_buckets=…) writes them")
    unknown = (set(changes) | set(deletes or {})) - {*REGISTERS, *(s for sources in DIMENSION_SOURCES.values() for s in sources)}
    if unknown or set(deletes or {}) - set(REGISTERS):
        raise ValueError(f"not part of a change batch: {sorted(unknown) or sorted(set(deletes or {}) - set(REGISTERS))}")
    metrics: dict[str, dict[str, int]] = {}
    with passing_tables(store.spark):
        rows = {name: materialise(df, f"batch-{name}") for name, df in changes.items()}
        gone = {name: materialise(df, f"batch-gone-{name}") for name, df in (deletes or {}).items()}
        rows = {name: df for name, df in rows.items() if not is_empty(df)}
        gone = {name: df for name, df in gone.items() if not is_empty(df)}
        if not rows and not gone:
            return LoadReport(store.version(), {})
        try:
            batch = ChangeBatch(load, rows, gone)
            dims = batch.load_dimensions(metrics)
            batch.spread()
            batch.load_facts(dims, metrics)
            batch.write_registers()
        except Exception as error:
            raise LoadAborted(f"change batch not loaded, nothing published: {error}") from error
    return LoadReport(load.publish(origin), metrics)


def rewritten_parts(before: PublishedTables, after: PublishedTables) -> list[tuple[str, int]]:
    """(table, part) of every part that one version has and the other has not, or in another folder."""
    out = []
    for name in sorted(set(before) | set(after)):
        old = before.parts(name) if name in before else {}
        new = after.parts(name) if name in after else {}
        out += [(name, p) for p in sorted(set(old) | set(new)) if (p in old and old[p].path) != (p in new and new[p].path)]
    return out
