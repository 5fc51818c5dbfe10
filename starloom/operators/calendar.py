"""The calendar dimension, generated from a date range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import smart_key

# The range and the name lists of the calendar dimension.
DEFAULT_FIRST_DAY = dt.date(2018, 1, 1)
DEFAULT_LAST_DAY = dt.date(2031, 12, 31)
DAY_NAMES = ["Domingo", "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado"]
DAY_SHORT_NAMES = ["Dom", "Lun", "Mar", "Mie", "Jue", "Vie", "Sab"]
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
MONTH_SHORT_NAMES = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]


def date_series(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = (last - first).days + 1
    return spark.range(max(days, 0)).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("fecha_completa"))


def _named(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def calendar_rows(dates: DataFrame, column: str = "fecha_completa") -> DataFrame:
    """Calendar attributes for every date of ``column``; the week is ISO, day 1 of the week is Sunday."""
    day = F.col(column)
    month = F.month(day)
    weekday = F.dayofweek(day)
    return dates.select(
        smart_key(day).alias("sk_dim_tiempo"),
        F.year(day).alias("cod_annio"),
        month.alias("cod_mes"),
        F.dayofyear(day).alias("cod_dia_annio"),
        F.dayofmonth(day).alias("cod_dia_mes"),
        weekday.alias("cod_dia_semana"),
        F.weekofyear(day).alias("cod_semana"),
        _named(DAY_NAMES, weekday).alias("desc_dia_semana"),
        _named(DAY_SHORT_NAMES, weekday).alias("desc_dia_semana_corta"),
        _named(MONTH_NAMES, month).alias("desc_mes"),
        _named(MONTH_SHORT_NAMES, month).alias("desc_mes_corta"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("desc_trimestre"),
        F.when(month <= 6, "S1").otherwise("S2").alias("desc_semestre"),
        day.alias("fecha_completa"),
    )


def extend_calendar(
    spark: SparkSession,
    existing: DataFrame | None = None,
    first: dt.date = DEFAULT_FIRST_DAY,
    last: dt.date = DEFAULT_LAST_DAY,
) -> DataFrame:
    """Existing days untouched plus the missing days of the range; a day is known by its date, not its key."""
    days = date_series(spark, first, last)
    if existing is None:
        return calendar_rows(days)
    missing = days.join(existing.select("fecha_completa"), "fecha_completa", "left_anti")
    return existing.unionByName(calendar_rows(missing))


def year_range(df: DataFrame, columns: list[str]) -> tuple[dt.date, dt.date]:
    """Whole years that cover every date of the columns: one aggregate row, no data collected."""
    first = F.least(*[F.min(F.col(c)) for c in columns]) if len(columns) > 1 else F.min(columns[0])
    last = F.greatest(*[F.max(F.col(c)) for c in columns]) if len(columns) > 1 else F.max(columns[0])
    row = df.agg(F.year(first).alias("lo"), F.year(last).alias("hi")).first()
    return dt.date(row["lo"], 1, 1), dt.date(row["hi"], 12, 31)
