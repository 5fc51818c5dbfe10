"""Declarative data-quality rules, each compiled to a Spark job that returns violations.

Row rules (not-null, domain, range, pair, length, free predicates) of one table share a single scan.  Key rules
(unique, foreign key) aggregate to distinct keys before anything is joined, so a hot key costs one row per map
task.  The result is always ``rule, table_name, row_key, detail, n_rows``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """Input rejected; ``rule`` is the first broken rule in the declared order."""

    def __init__(self, rule: str, message: str):
        super().__init__(f"{rule}: {message}")
        self.rule = rule


@dataclass(frozen=True)
class RowRule:
    """``ok`` must hold for every row; as with a CHECK constraint, a NULL outcome passes."""

    name: str
    ok: Column
    detail: Column

    def broken(self) -> Column:
        return ~F.coalesce(self.ok, F.lit(True))


@dataclass(frozen=True)
class UniqueRule:
    name: str
    columns: Sequence[str]


@dataclass(frozen=True)
class ForeignKeyRule:
    name: str
    columns: Sequence[str]
    parent: str
    parent_columns: Sequence[str]


@dataclass(frozen=True)
class TableRules:
    """Rules of one table; ``key`` identifies a row in the report."""

    table: str
    key: Sequence[str]
    rules: Sequence[RowRule | UniqueRule | ForeignKeyRule] = field(default_factory=list)


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("NULL"))


def _joined(columns: Sequence[str]) -> Column:
    return F.concat_ws(",", *[_text(c) for c in columns])


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null:{column}", F.col(column).isNotNull(), F.lit("NULL"))


def domain(column: str, values: Sequence[str], upper: bool = True) -> RowRule:
    """IN-list, by default on the upper-cased value."""
    value = F.upper(F.col(column)) if upper else F.col(column)
    return RowRule(f"domain:{column}", value.isin(list(values)), _text(column))


def between(column: str, low, high) -> RowRule:
    return RowRule(f"range:{column}", F.col(column).between(low, high), _text(column))


def pair_domain(code: str, label: str, pairs: Mapping[int, str]) -> RowRule:
    """Code and upper-cased label must be one of the declared pairs."""
    ok = reduce(lambda a, b: a | b, [(F.col(code) == c) & (F.upper(F.col(label)) == t) for c, t in pairs.items()])
    return RowRule(f"pair:{code},{label}", ok, _joined([code, label]))


def max_length(column: str, limit: int) -> RowRule:
    return RowRule(f"length:{column}", F.length(F.col(column)) <= limit, F.length(F.col(column)).cast("string"))


def not_before(later: str, earlier: str) -> RowRule:
    """Date order; a missing end passes."""
    return RowRule(f"order:{earlier},{later}", F.col(later) >= F.col(earlier), _joined([earlier, later]))


def predicate(name: str, ok: Column, columns: Sequence[str]) -> RowRule:
    return RowRule(name, ok, _joined(columns))


def unique(*columns: str) -> UniqueRule:
    return UniqueRule(f"unique:{','.join(columns)}", columns)


def foreign_key(columns: Sequence[str], parent: str, parent_columns: Sequence[str]) -> ForeignKeyRule:
    return ForeignKeyRule(f"foreign_key:{','.join(columns)}", list(columns), parent, list(parent_columns))


def _report(df: DataFrame, table: str, rule: Column, key: Column, detail: Column, n: Column) -> DataFrame:
    return df.select(
        rule.alias("rule"), F.lit(table).alias("table_name"), key.alias("row_key"), detail.alias("detail"),
        n.cast("long").alias("n_rows"),
    )


def row_violations(df: DataFrame, table: str, key: Sequence[str], rules: Sequence[RowRule]) -> DataFrame:
    """All row rules in one scan: each row explodes to the rules it breaks."""
    found = F.array_compact(
        F.array(*[F.when(r.broken(), F.struct(F.lit(r.name).alias("rule"), r.detail.alias("detail"))) for r in rules])
    )
    broken = df.select(_joined(key).alias("row_key"), F.explode(found).alias("v"))
    return _report(broken, table, F.col("v.rule"), F.col("row_key"), F.col("v.detail"), F.lit(1))


def unique_violations(df: DataFrame, table: str, rule: UniqueRule) -> DataFrame:
    """Each repeated key with its number of rows; keys with a NULL part are not compared."""
    cols = list(rule.columns)
    counted = df.dropna(how="any", subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _report(counted, table, F.lit(rule.name), _joined(cols), F.lit("duplicate"), F.col("n"))


def foreign_key_violations(df: DataFrame, table: str, rule: ForeignKeyRule, parent: DataFrame) -> DataFrame:
    """Each key without a parent and the number of rows that carry it; NULL keys pass.

    Keys are aggregated first: the anti join sees every distinct key once, whatever its share of the rows.
    """
    cols = list(rule.columns)
    keys = df.dropna(how="any", subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(rule.parent_columns, cols)])
    missing = keys.join(known, cols, "left_anti")
    return _report(missing, table, F.lit(rule.name), _joined(cols), F.lit(f"no {rule.parent}"), F.col("n"))


def _key_records(df: DataFrame, table: str, declared: Sequence[TableRules], with_rows: bool) -> DataFrame | None:
    """One scan of a table as records (rule table, rule, key, n, here): a key of each of its unique and foreign-key rules, a
    key that it offers as the parent of another table's rule (``here``), and, with ``with_rows``, each row rule it breaks.
    Keys with a NULL part give none."""
    records: list[Column] = []

    def record(owner: str, rule: str, columns: Sequence[str], n: int, here: bool) -> Column:
        parts = F.array(*[F.col(c).cast("string") for c in columns])
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        made = F.struct(F.lit(owner).alias("owner"), F.lit(rule).alias("rule"), parts.alias("key"),
                        F.lit(n).cast("long").alias("n"), F.lit(here).alias("here"))
        return F.when(known, made)

    for spec in declared:
        for rule in spec.rules:
            if isinstance(rule, (UniqueRule, ForeignKeyRule)) and spec.table == table:
                records.append(record(table, rule.name, rule.columns, 1, False))
            if isinstance(rule, ForeignKeyRule) and rule.parent == table:
                records.append(record(spec.table, rule.name, rule.parent_columns, 0, True))
            if with_rows and isinstance(rule, RowRule) and spec.table == table:
                broken = F.struct(
                    F.lit(table).alias("owner"), F.lit(rule.name).alias("rule"), F.array().cast("array<string>").alias("key"),
                    F.lit(1).cast("long").alias("n"), F.lit(False).alias("here"))
                records.append(F.when(rule.broken(), broken))
    if not records:
        return None
    return df.select(F.explode(F.array_compact(F.array(*records))).alias("r")).select("r.*")


def counted_keys(tables: Mapping[str, DataFrame], declared: Sequence[TableRules], with_rows: bool = False) -> DataFrame:
    """(owner, rule, key, n, here) of every key of every key rule: the rows that carry it and whether its parent has it.

    Every table is scanned once, whatever the number of its rules, and one aggregation, partial before its one shuffle,
    serves uniqueness and references alike: children and parents of a key meet in it.
    """
    used = [s for s in declared if s.table in tables]
    used = [TableRules(s.table, s.key, [r for r in s.rules if not isinstance(r, ForeignKeyRule) or r.parent in tables]) for s in used]
    parts = [p for name, df in tables.items() if (p := _key_records(df, name, used, with_rows)) is not None]
    if not parts:
        raise ValueError("no declared rule applies to the given tables")
    records = reduce(DataFrame.unionByName, parts)
    return records.groupBy("owner", "rule", "key").agg(F.sum("n").alias("n"), F.max("here").alias("here"))


def _kind(name: str) -> Column:
    return F.col("rule").startswith(f"{name}:")


def quality_summary(tables: Mapping[str, DataFrame], declared: Sequence[TableRules]) -> DataFrame:
    """``summarise(violations(…))`` in one scan per table and one aggregation by key."""
    found = counted_keys(tables, declared, with_rows=True)
    row_rule = F.size("key") == 0
    bad = row_rule | (_kind("unique") & (F.col("n") > 1)) | (_kind("foreign_key") & (F.col("n") > 0) & ~F.col("here"))
    return found.where(bad).groupBy(F.col("owner").alias("table_name"), "rule").agg(
        F.sum(F.when(row_rule, F.col("n")).otherwise(1)).alias("n_violations"), F.sum("n").alias("n_rows"))


def reference_summary(tables: Mapping[str, DataFrame], declared: Sequence[TableRules]) -> DataFrame:
    """Per foreign key its different keys and rows, and how many of both have no parent."""
    only = [TableRules(s.table, s.key, [r for r in s.rules if isinstance(r, ForeignKeyRule)]) for s in declared]
    found = counted_keys(tables, only).where("n > 0")
    missing = F.when(~F.col("here"), F.col("n")).otherwise(0)
    return found.groupBy(F.col("owner").alias("table_name"), "rule").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"), F.count_if(~F.col("here")).alias("n_missing_keys"),
        F.sum(missing).alias("n_missing_rows"))


def violations(tables: Mapping[str, DataFrame], declared: Sequence[TableRules]) -> DataFrame:
    """Union of the violations of every declared rule whose table is given."""
    parts: list[DataFrame] = []
    for spec in declared:
        if spec.table not in tables:
            continue
        df = tables[spec.table]
        row_rules = [r for r in spec.rules if isinstance(r, RowRule)]
        if row_rules:
            parts.append(row_violations(df, spec.table, spec.key, row_rules))
        for rule in spec.rules:
            if isinstance(rule, UniqueRule):
                parts.append(unique_violations(df, spec.table, rule))
            elif isinstance(rule, ForeignKeyRule) and rule.parent in tables:
                parts.append(foreign_key_violations(df, spec.table, rule, tables[rule.parent]))
    if not parts:
        raise ValueError("no declared rule applies to the given tables")
    return reduce(DataFrame.unionByName, parts)


def summarise(found: DataFrame) -> DataFrame:
    """Violations and affected rows per table and rule."""
    return found.groupBy("table_name", "rule").agg(
        F.count(F.lit(1)).alias("n_violations"), F.sum("n_rows").alias("n_rows")
    )
