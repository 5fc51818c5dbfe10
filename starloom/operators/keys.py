"""Surrogate keys and last-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id() keeps the partition above bit 33 and the row below it


def max_key(df: DataFrame | None, key: str) -> int:
    """Largest positive key, 0 when there is none; keys <= 0 are sentinels and never seed a sequence."""
    if df is None:
        return 0
    return df.agg(F.coalesce(F.max(F.when(F.col(key) > 0, F.col(key))), F.lit(0)).cast("long")).first()[0]


def assign_surrogate_keys(df: DataFrame, order_by: Sequence[str], key: str, seed: int = 0) -> DataFrame:
    """Number the rows seed+1, seed+2, … in the order of ``order_by``, without gaps.

    Equals ``seed + row_number() OVER (ORDER BY …)`` but never puts the rows on one task: a distributed sort
    gives every row its partition and its position inside it, the positions are written down once, and only
    the per-partition row counts (one row per partition) meet in a prefix sum.  ``order_by`` should be unique.
    """
    placed = df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed, f"keys-{key}")
    part = F.shiftright("_at", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    position = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    keyed = numbered.withColumn(key, F.lit(seed).cast("long") + F.col("_before") + position + 1)
    return keyed.select(key, *df.columns)


def last_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the highest one in ``order_by``, with every other column as a tie-break.

    Spark turns ``row_number() = 1`` into a per-task group limit ahead of the shuffle, so a hot key sends one
    row per map task instead of all of its rows.
    """
    stated = [c if isinstance(c, str) else None for c in order_by]
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order_by]
    rest = [c for c in df.columns if c not in keys and c not in stated]
    order += [F.col(c).desc_nulls_last() for c in rest]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def last_wins_counted(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], count: str) -> DataFrame:
    """The row of ``last_wins`` per key, with the number of rows that had the key in ``count``.

    The highest row is the greatest struct of the ordering and all other columns, so rows are counted and compared in one
    aggregation that is partial before its shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    best = F.max(F.struct(*order_by, *rest)).alias("_best")
    found = df.groupBy(*keys).agg(best, F.count(F.lit(1)).alias(count))
    return found.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns], count)
