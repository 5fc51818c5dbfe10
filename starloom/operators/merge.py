"""Dimension and fact merges on immutable tables: a merge returns the new state as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.digests import row_hash
from starloom.operators.keys import assign_surrogate_keys, max_key
from starloom.session import materialise


@dataclass(frozen=True)
class MergeResult:
    """New state of a table and what the merge did."""

    state: DataFrame
    metrics: dict[str, int]


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def _differs(left: str, right: str, columns: Sequence[str]) -> Column:
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return changed


def classify(target: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """One full outer join that tells inserts, matches and target-only rows apart.

    Columns: the keys, ``op`` (insert, match, target_only), ``changed`` and both rows as structs ``_t`` and
    ``_s``.  A struct is NULL only when its side is absent, so a NULL attribute is never taken for absence.
    """
    t = target.select(*keys, F.struct(*target.columns).alias("_t"))
    s = source.select(*keys, F.struct(*source.columns).alias("_s"))
    op = F.when(F.col("_t").isNull(), "insert").when(F.col("_s").isNull(), "target_only").otherwise("match")
    joined = t.join(s, list(keys), "full_outer").withColumn("op", op)
    return joined.withColumn("changed", (F.col("op") == "match") & _differs("_t", "_s", compare))


def scd1_upsert(
    target: DataFrame | None, source: DataFrame, natural_key: str, key: str, attributes: Sequence[str]
) -> MergeResult:
    """Type-1 upsert: every attribute overwritten on a match, new rows keyed, nothing deleted.

    The classified join is written once; state, counts and the key seed are read from it.
    """
    columns = [key, natural_key, *attributes]
    source = source.select(natural_key, *attributes)
    if target is None:
        keyed = assign_surrogate_keys(source, [natural_key], key)
        return MergeResult(keyed.select(*columns), {"inserted": keyed.count(), "matched": 0, "changed": 0, "kept": 0})

    rows = materialise(classify(target.select(*columns), source, [natural_key], attributes), f"merge-{key}")
    stats = rows.agg(
        F.count_if(F.col("op") == "insert").alias("inserted"),
        F.count_if(F.col("op") == "match").alias("matched"),
        F.count_if(F.col("changed")).alias("changed"),
        F.count_if(F.col("op") == "target_only").alias("kept"),
        F.coalesce(F.max(F.when(F.col(f"_t.{key}") > 0, F.col(f"_t.{key}"))), F.lit(0)).cast("long").alias("seed"),
    ).first().asDict()
    seed = stats.pop("seed")

    matched = F.col("op") == "match"
    existing = rows.where("op <> 'insert'").select(
        F.col(f"_t.{key}").cast("long").alias(key),
        natural_key,
        *[F.when(matched, F.col(f"_s.{a}")).otherwise(F.col(f"_t.{a}")).alias(a) for a in attributes],
    )
    if stats["inserted"] == 0:
        return MergeResult(existing, stats)
    new = rows.where("op = 'insert'").select("_s.*")
    keyed = assign_surrogate_keys(new, [natural_key], key, seed)
    return MergeResult(existing.unionByName(keyed.select(*columns)), stats)


def insert_only(
    target: DataFrame | None, source: DataFrame, natural_key: str, key: str, order_by: Sequence[str]
) -> MergeResult:
    """Fixed-domain load: rows whose natural key is unknown are keyed and added, the rest is left alone."""
    columns = [key] + [c for c in source.columns if c not in order_by or c == natural_key]
    new = source
    if target is not None:
        new = source.join(target.select(natural_key), natural_key, "left_anti")
    keyed = assign_surrogate_keys(new, order_by, key, max_key(target, key)).select(*columns)
    inserted = keyed.count()
    if target is None:
        return MergeResult(keyed, {"inserted": inserted, "matched": 0, "changed": 0, "kept": 0})
    state = target.select(F.col(key).cast("long").alias(key), *columns[1:]).unionByName(keyed)
    return MergeResult(state, {"inserted": inserted, "matched": 0, "changed": 0, "kept": target.count()})


def merge_fact(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    overwrite: Sequence[str] | None = None,
    sync: bool = True,
    retain_keys: DataFrame | None = None,
    guard_empty: bool = False,
) -> DataFrame:
    """New state of a fact after upsert and, with ``sync``, deletion of keys gone from the source.

    ``overwrite`` lists the columns replaced on a match (default: all but the keys).  When a match replaces
    everything and the sync keeps source keys only, the new state *is* the source, and the target is not even
    read.  ``retain_keys`` names further keys that the sync must not delete.  ``guard_empty`` leaves the target
    untouched when the source has no rows.
    """
    if target is None:
        return source
    if guard_empty and is_empty(source):
        return target
    keys = list(keys)
    source = source.select(*target.columns)
    kept_columns = [] if overwrite is None else [c for c in target.columns if c not in keys and c not in overwrite]
    state = source
    if kept_columns:
        old = target.select(*keys, F.lit(True).alias("_old"), *[F.col(c).alias(f"_old_{c}") for c in kept_columns])
        joined = source.join(old, keys, "left")
        state = joined.select(
            *[F.when(F.col("_old"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in kept_columns else F.col(c)
              for c in target.columns]
        )
    if sync and retain_keys is None:
        return state
    rest = retained_rows(target, source, keys, retain_keys if sync else None)
    return state.unionByName(rest.select(*target.columns))


def retained_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], retain_keys: DataFrame | None) -> DataFrame:
    """Rows of ``target`` whose key the source lacks, all of them or those that ``retain_keys`` names."""
    rest = target.join(source.select(*keys), list(keys), "left_anti")
    return rest if retain_keys is None else rest.join(retain_keys.select(*keys), list(keys), "left_semi")


def sync_delete(target: DataFrame, live_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key still exists in ``live_keys``."""
    return target.join(live_keys.select(*keys), list(keys), "left_semi")


def merge_metrics(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    retain_keys: DataFrame | None = None,
    sync: bool = True,
) -> DataFrame:
    """One row: inserted, matched, changed, deleted, kept.

    Only the keys and a 64-bit row hash take part in the join, so the shuffle stays narrow however wide the
    rows are.
    """
    keys = list(keys)
    compare = list(compare if compare is not None else [c for c in source.columns if c not in keys])
    s = source.select(*keys, row_hash(compare).alias("_s"))
    if target is None:
        zero = F.lit(0).cast("long")
        return s.agg(F.count(F.lit(1)).alias("inserted"), zero.alias("matched"), zero.alias("changed"),
                     zero.alias("deleted"), zero.alias("kept"))
    t = target.select(*keys, row_hash(compare).alias("_t"))
    joined = t.join(s, keys, "full_outer")
    if retain_keys is not None and sync:
        joined = joined.join(retain_keys.select(*keys).withColumn("_live", F.lit(True)), keys, "left")
    else:
        joined = joined.withColumn("_live", F.lit(None if sync else True).cast("boolean"))
    gone = F.col("_s").isNull()
    both = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    return joined.agg(
        F.count_if(F.col("_t").isNull()).alias("inserted"),
        F.count_if(both).alias("matched"),
        F.count_if(both & (F.col("_s") != F.col("_t"))).alias("changed"),
        F.count_if(gone & F.col("_live").isNull()).alias("deleted"),
        F.count_if(gone & F.col("_live").isNotNull()).alias("kept"),
    )


def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace or add whole rows by key."""
    return base.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes.select(*base.columns))


def apply_updates(base: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set only ``columns`` of the rows named by ``updates``; a NULL in the update is a value, not an absence."""
    new = updates.select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(new, list(keys), "left")
    return joined.select(
        *[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
          for c in base.columns]
    )


def delete_by_key(base: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` whose key is not in ``doomed``."""
    return base.join(doomed.select(*keys), list(keys), "left_anti")
