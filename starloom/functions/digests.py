"""Content digests of rows and tables."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row.  NULL flags take part, because ``xxhash64`` itself skips NULL inputs."""
    parts = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(*parts)


LIMBS = 4  # of 64 bits


def row_text(columns: Sequence[str]) -> Column:
    """A row as text that no other row has: name and value of every column, in the order of the names, each with its
    length in front; a NULL is the bare mark N."""
    parts = []
    for name in sorted(columns):
        value = F.col(f"`{name}`").cast("string")
        known = F.concat(F.length(value).cast("string"), F.lit(":"), value)
        parts.append(F.concat(F.lit(f"{len(name)}:{name}="), F.coalesce(known, F.lit("N"))))
    return F.concat_ws(";", *parts)


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (``n_rows``, ``fingerprint``) that depends on names and values but not on the order of rows or columns.

    All 256 bits of each row's SHA-256 count: they are summed as four numbers.  The sums are decimal, so they cannot
    overflow however many rows there are, and repeated rows count (an exclusive-or would cancel them out).  Partial
    sums are combined map-side.
    """
    columns = list(columns or df.columns)
    marked = df.select(F.sha2(row_text(columns), 256).alias("_digest"))
    limb = lambda i: F.conv(F.substring("_digest", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")
    sums = [F.coalesce(F.sum(limb(i)), F.lit(0)).cast("string") for i in range(LIMBS)]
    return marked.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", *sums).alias("fingerprint"))


def fingerprint_value(df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """The fingerprint as one string, ``rows:digest:names``; the names tell empty sheets with other headers apart."""
    row = table_fingerprint(df, columns).first()
    names = hashlib.sha256(repr(sorted(columns or df.columns)).encode()).hexdigest()[:16]
    return f"{row['n_rows']}:{row['fingerprint']}:{names}"
