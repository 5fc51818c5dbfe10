"""Control totals after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def control_totals(df: DataFrame, amount: str) -> DataFrame:
    """Row count and sum of ``amount``; the sum of no rows is 0."""
    total = F.coalesce(F.sum(F.col(amount).cast("decimal(18,2)")), F.lit(0)).cast("decimal(28,2)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), total.alias("total"))
