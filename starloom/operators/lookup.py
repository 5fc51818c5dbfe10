"""Key lookups and enrichment joins that survive a hot key.

Every join here is an equi-join against a side that is unique on the key (a dimension, a header table or a
pre-aggregated frame).  Left alone, Catalyst and AQE choose broadcast or sort-merge by measured size.  When a
key is known to be hot (``find_hot_keys``), its rows are joined by broadcasting the matching rows of the
unique side, at most one per hot key, and are spread over salt values so that they never share a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_PARTITIONS = 0.5  # a key is hot from this share of a mean shuffle partition's rows on
SALTS_PER_PARTITION = 4


class LookupMiss(ValueError):
    """A required key could not be resolved."""


def shuffle_partitions(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def find_hot_keys(
    df: DataFrame, key_sets: Mapping[str, Sequence[str]], share: float | None = None, tracked: int | None = None
) -> dict[str, list[int]]:
    """Hashes of the keys that hold at least ``share`` of the rows, for several keys in one narrow scan.

    By default the share is measured by what a task gets: half the rows of a mean shuffle partition.  It falls as the
    session's partitions grow, so that no key fills a task of its own at any size.  A frequent-items sketch, sized for
    the share, is merged across tasks, so no key is shuffled and at most ``1/share`` values per key set reach the
    driver.  The sketch cannot miss a key above its error bound, and a false positive costs nothing: hotness changes
    the join strategy, never the result.
    """
    if share is None:
        share = min(1.0, HOT_PARTITIONS / shuffle_partitions(df.sparkSession))
    k = math.ceil(1 / share)
    tracked = tracked or min(1_000_000, max(4_096, 16 * k))
    sketches = [
        F.expr(f"approx_top_k(xxhash64({', '.join(cols)}), {k}, {tracked})").alias(name)
        for name, cols in key_sets.items()
    ]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *sketches).first()
    floor = max(row["_n"] * share, 1)
    return {name: [i["item"] for i in (row[name] or []) if i["count"] >= floor] for name in key_sets}


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    columns: Iterable[str] = (),
    how: str = "left",
    hot: Sequence[int] = (),
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``columns`` of ``right`` (unique on its key) to ``left``.

    ``on`` maps left key columns to right key columns.  ``how`` is left, inner, semi or anti.  ``hot`` holds the
    hashes from ``find_hot_keys``; ``spread_by`` names the columns of ``left`` that tell rows of one hot key apart.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    keys = list(pairs)
    columns = [] if how in ("semi", "anti") else list(columns)
    typed = [F.col(r).cast(left.schema[k].dataType).alias(k) for k, r in pairs.items()]
    side = right.select(*typed, *columns)
    if not hot:
        native = {"semi": "left_semi", "anti": "left_anti"}.get(how, how)
        return left.join(side, keys, native).select(*left.columns, *columns)

    is_hot = F.xxhash64(*keys).isin(list(hot))
    few = side.where(is_hot).select(
        *keys, F.lit(True).alias("_few_hit"), *[F.col(c).alias(f"_few_{c}") for c in columns]
    )
    # Always 0, but written so that the optimiser keeps it as a join key: a literal would be folded into a filter and
    # the shuffle would fall back to the bare key.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    many = side.select(*keys, zero.alias("_salt"), F.lit(True).alias("_hit"), *columns)
    spread = list(spread_by or left.columns)
    salts = SALTS_PER_PARTITION * shuffle_partitions(left.sparkSession)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int") + 1).otherwise(0)
    joined = (
        left.withColumn("_salt", salt)
        .join(F.broadcast(few), keys, "left")
        .join(many, [*keys, "_salt"], "left")
        .withColumn("_found", F.coalesce("_few_hit", "_hit", F.lit(False)))
    )
    if how in ("inner", "semi"):
        joined = joined.where("_found")
    elif how == "anti":
        joined = joined.where("NOT _found")
    picked = [F.when(F.col("_few_hit"), F.col(f"_few_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    return joined.select(*left.columns, *picked)


def miss_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of unresolved (NULL) values per key column, in one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(k).isNull()).alias(f"missing_{k}") for k in keys]
    )


def require_resolved(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Return ``df``, or raise when any key column holds a NULL."""
    counts = miss_counts(df, keys).first().asDict()
    bad = {k: counts[f"missing_{k}"] for k in keys if counts[f"missing_{k}"]}
    if bad:
        raise LookupMiss(f"{what}: unresolved keys {bad}")
    return df


def split_resolved(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Quarantine mode: (rows with every key resolved, rows with a miss)."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.where(~missing), df.where(missing)
