"""Date keys: a date is its own surrogate key in the form yyyymmdd."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def smart_key(date: Column) -> Column:
    """yyyymmdd as an int; NULL stays NULL."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def year_start_key(year: Column) -> Column:
    """Key of January 1st."""
    return (year * 10000 + 101).cast("int")


def year_end_key(year: Column) -> Column:
    """Key of December 31st."""
    return (year * 10000 + 1231).cast("int")


def key_year(key: Column) -> Column:
    """Year of a smart key by integer division, so no join to the calendar is needed."""
    return F.call_function("div", key, F.lit(10000)).cast("int")


def register_sql_functions(spark: SparkSession) -> None:
    """Offer the key function to ``spark.sql`` users as ``fn_sk_tiempo(date)``."""
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION fn_sk_tiempo(p_fecha DATE) RETURNS INT
        RETURN year(p_fecha) * 10000 + month(p_fecha) * 100 + day(p_fecha)
        """
    )
