"""The goals sheet: landed as text, normalised, checked, then typed and staged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import quality as q
from starloom.operators.merge import is_empty
from starloom.sources.tables import numbered

# Required columns and admitted years of the goals sheet.
GOAL_COLUMNS = ["anio", "cod_producto", "monto_meta_ingreso", "meta_renovacion", "meta_asegurados"]
GOAL_KEY = ["anio", "cod_producto"]
FIRST_YEAR, LAST_YEAR = 2000, 2100
GOAL_TYPES = {
    "anio": "int", "cod_producto": "long", "monto_meta_ingreso": "decimal(18,2)", "meta_renovacion": "int",
    "meta_asegurados": "int",
}
HEADER_ROWS = 1
LOADED_AT = "fecha_carga"
CHECK_ORDER = ["columns", "empty", "null", "type", "range", "negative", "duplicate", "product", "calendar"]


def read_goals(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    """Landed sheet as strings.  A ``row_no`` column, when present, is used in messages."""
    if fmt == "csv":
        return spark.read.option("header", True).options(**options).csv(path)
    raw = spark.read.options(**options).format(fmt).load(path)
    return raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])


def number_goals(raw: DataFrame) -> DataFrame:
    """A read sheet with the row numbers that its errors name: the header is row 1, and the files of a sheet in several
    count on in name order.  A ``row_no`` column of the sheet's own is kept instead."""
    if "row_no" in [c.strip().lower() for c in raw.columns]:
        return raw
    return numbered(raw, first=HEADER_ROWS + 1)


def normalise_goals(raw: DataFrame) -> DataFrame:
    """Headers trimmed and lower-cased, rows without any value dropped, other columns ignored.

    Raises ``QualityError`` when a required column is missing.
    """
    df = raw.toDF(*[c.strip().lower() for c in raw.columns])
    missing = [c for c in GOAL_COLUMNS if c not in df.columns]
    if missing:
        raise q.QualityError("columns", f"missing {missing}")
    data_columns = [c for c in df.columns if c != "row_no"]
    blank = [F.when(F.trim(F.col(f"`{c}`").cast("string")) != "", F.col(f"`{c}`")).alias(c) for c in data_columns]
    kept = [F.col("row_no").cast("string").alias("row_no")] if "row_no" in df.columns else [F.lit(None).cast("string").alias("row_no")]
    return df.select(*kept, *blank).dropna(how="all", subset=data_columns).select("row_no", *GOAL_COLUMNS)


def _typed(column: str):
    """The value of a text, NULL if it has none of the type.  Whole numbers may be written 2024.0 or 2.024E3; fractions
    are refused, not cut."""
    kind = GOAL_TYPES[column]
    if kind.startswith("decimal"):
        return F.expr(f"try_cast(trim({column}) AS {kind})")
    number = f"try_cast(trim({column}) AS decimal(38,10))"
    return F.expr(f"CASE WHEN {number} = floor({number}) THEN try_cast(floor({number}) AS {kind}) END")


def goal_violations(goals: DataFrame, products: DataFrame | None = None, calendar: DataFrame | None = None) -> DataFrame:
    """Every violation of a normalised sheet: null, type, range, negative, duplicate and, when the dimensions
    are given, unknown product and year outside the calendar."""
    typed = goals.select("row_no", *GOAL_COLUMNS, *[_typed(c).alias(f"t_{c}") for c in GOAL_COLUMNS])
    rules = [q.RowRule(f"null:{c}", F.col(c).isNotNull(), F.lit("NULL")) for c in GOAL_COLUMNS]
    rules += [
        q.RowRule(f"type:{c}", F.col(c).isNull() | F.col(f"t_{c}").isNotNull(), F.col(c)) for c in GOAL_COLUMNS
    ]
    rules.append(q.RowRule("range:anio", F.col("t_anio").between(FIRST_YEAR, LAST_YEAR), F.col("anio")))
    rules += [q.RowRule(f"negative:{c}", F.col(f"t_{c}") >= 0, F.col(c)) for c in GOAL_COLUMNS[2:]]
    found = q.row_violations(typed, "metas", ["row_no", *GOAL_KEY], rules)

    keys = typed.select(*[F.col(f"t_{c}").alias(c) for c in GOAL_KEY])
    found = found.unionByName(q.unique_violations(keys, "metas", q.UniqueRule("duplicate:anio,cod_producto", GOAL_KEY)))
    if products is not None:
        counted = keys.dropna().groupBy(*GOAL_KEY).agg(F.count(F.lit(1)).alias("n"))
        known = products.select(F.col("cod_producto_nk").cast("long").alias("cod_producto"))
        unknown = counted.join(known, "cod_producto", "left_anti")
        found = found.unionByName(unknown.select(
            F.lit("product:cod_producto").alias("rule"), F.lit("metas").alias("table_name"),
            F.concat_ws(",", "anio", "cod_producto").alias("row_key"), F.lit("no dim_producto").alias("detail"),
            F.col("n").alias("n_rows"),
        ))
    if calendar is not None:
        years = keys.dropna(subset=["anio"]).groupBy("anio").agg(F.count(F.lit(1)).alias("n"))
        days = calendar.select("sk_dim_tiempo")
        for edge, offset in (("start", 101), ("end", 1231)):
            edges = years.withColumn("sk_dim_tiempo", (F.col("anio") * 10000 + offset).cast("int"))
            found = found.unionByName(edges.join(days, "sk_dim_tiempo", "left_anti").select(
                F.lit(f"calendar:{edge}").alias("rule"), F.lit("metas").alias("table_name"),
                F.col("anio").cast("string").alias("row_key"),
                F.concat(F.lit("no day "), F.col("sk_dim_tiempo").cast("string")).alias("detail"),
                F.col("n").alias("n_rows"),
            ))
    return found


def headline(found: DataFrame) -> q.QualityError | None:
    """The first broken rule in the check order, as an error to raise; None when nothing is broken."""
    kinds = found.groupBy(F.substring_index("rule", ":", 1).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("rule", "row_key", "detail")).alias("example")
    ).collect()  # one row per kind of rule, nine at most
    if not kinds:
        return None
    first = min(kinds, key=lambda r: CHECK_ORDER.index(r["kind"]))
    example = first["example"]
    return q.QualityError(first["kind"], f"{first['n']} violation(s), e.g. {example['rule']} at [{example['row_key']}] = {example['detail']}")


def typed_goals(goals: DataFrame) -> DataFrame:
    """Checked text as typed staging columns."""
    return goals.select(*[_typed(c).alias(c) for c in GOAL_COLUMNS])


def checked_goals(
    raw: DataFrame, products: DataFrame | None = None, calendar: DataFrame | None = None
) -> tuple[DataFrame | None, DataFrame | None, q.QualityError | None]:
    """(typed goals, None, None) for a good sheet, (None, violations, headline error) for a bad one."""
    try:
        goals = normalise_goals(raw)
    except q.QualityError as error:
        return None, None, error
    if is_empty(goals):
        return None, None, q.QualityError("empty", "the sheet has no rows; an empty sheet is not loaded")
    found = goal_violations(goals, products, calendar)
    error = headline(found)
    return (None, found, error) if error else (typed_goals(goals), None, None)


def stage(goals: DataFrame) -> DataFrame:
    """Typed goals stamped with the load time."""
    return goals.withColumn(LOADED_AT, F.current_timestamp())
