"""A small warehouse source made up by rule; expected results are worked out by SQL over the same rows."""

import datetime as dt
import tempfile

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from starloom.schemas import PRODUCT_TYPES, RATING_LABELS, fit_schema


def _contract_lines():
    """Sixty contracts: product and client by different strides, so that some pairs repeat."""
    states = ["ACTIVO", "VENCIDO", "ACTIVO", "SUSPENDIDO", "ACTIVO"]
    for i in range(1, 61):
        start = dt.date(2022, 1, 1) + dt.timedelta(days=97 * i % 1500)
        end = start + dt.timedelta(days=365 * (1 + i % 2))
        amount = 100 + 137 * i % 2900 + (i % 4) / 4
        yield [i, 1 + 7 * i % 10, 1 + 11 * i % 25, start.isoformat(), end.isoformat(), f"{amount:.2f}", states[i % 5]]


def _claims(lines):
    """Thirty claims; every sixth is open (numbers 4, 10, …), every seventh of the others rejected."""
    for i in range(1, 31):
        contract = 1 + 13 * i % 60
        day = dt.date.fromisoformat(lines[contract - 1][3]) + dt.timedelta(days=30 + 17 * i % 200)
        asked = 200 + 61 * i
        if i % 6 == 4:
            yield [i, contract, day.isoformat(), None, "NO", None, f"{asked:.2f}"]
        else:
            closed = day + dt.timedelta(days=5 * i % 23)
            given = 0 if i % 7 == 0 else asked * 0.9
            yield [i, contract, day.isoformat(), closed.isoformat(), "SI" if i % 7 == 0 else "NO", f"{given:.2f}", f"{asked:.2f}"]


def _ratings(lines):
    """Thirty-five ratings: even ones of products that the client has a contract for, odd ones by stride."""
    seen = set()
    for i in range(1, 36):
        client, product = (lines[i][2], lines[i][1]) if i % 2 == 0 else (1 + 7 * i % 25, 1 + 3 * i % 10)
        rating = 1 + 3 * i % 5
        if (client, product, rating) not in seen:
            seen.add((client, product, rating))
            yield [client, rating, product, "SI" if rating >= 3 else "NO"]


def source_rows():
    """Rows of the twelve source tables."""
    lines = list(_contract_lines())
    rows = {
        "pais": [[i, f"Country {i}"] for i in range(1, 5)],
        "ciudad": [[i, f"City {i}", c] for i, c in enumerate([1, 2, 3, 4, 1, 2, 3], 1)],
        "sucursal": [[i, f"Branch {i}", 1 + i % 7] for i in range(1, 9)],
        "tipo_producto": [[i, n] for i, n in enumerate(PRODUCT_TYPES, 1)],
        "producto": [[i, f"Product {i}", f"Cover {i}", 1 + i % 5, 1 + i % 4] for i in range(1, 11)],
        "cliente": [
            [i, f"Client {i}", f"ID-{i:05d}", f"555-{i:04d}", f"Street {i}", "MF"[i % 2], f"client{i}@example.org", 1 + i % 8]
            for i in range(1, 26)
        ],
        "evaluacion_servicio": [list(pair) for pair in sorted(RATING_LABELS.items())],
        "registro_contrato": lines,
        "registro_siniestro": list(_claims(lines)),
        "recomienda": list(_ratings(lines)),
    }
    rows["contrato"] = [[i, f"Contract {i}"] for i in range(1, len(rows["registro_contrato"]) + 1)]
    rows["siniestro"] = [[i, f"Claim {i}"] for i in range(1, len(rows["registro_siniestro"]) + 1)]
    return rows


def frame(spark, table, rows):
    """Rows of one source table as a typed DataFrame."""
    from starloom.schemas import SOURCE_COLUMNS

    columns = [c for c in SOURCE_COLUMNS[table] if c != "fecha_carga"]
    text = [[None if c is None else str(c) for c in row] for row in rows]
    df = spark.createDataFrame(text, ", ".join(f"{c} STRING" for c in columns))
    if table == "metas":
        df = df.withColumn("fecha_carga", F.current_timestamp())
    return fit_schema(df, table)


_landed = {}


def _stored(spark, table, rows):
    """A source table as Parquet, written once per content."""
    key = (spark.sparkContext.applicationId, table, repr(rows))
    if key not in _landed:
        _landed[key] = tempfile.mkdtemp(prefix="starloom-fixture-") + "/t"
        frame(spark, table, rows).coalesce(1).write.parquet(_landed[key])
    return spark.read.parquet(_landed[key])


def source(spark, tables=None):
    """The source tables, with their standard rows or with the given ones."""
    return {table: _stored(spark, table, rows) for table, rows in (tables or source_rows()).items()}


def goals(spark):
    """Fifty goals: ten products, 2022 to 2026, made up by rule."""
    rows = [[y, p, 1000 * p + 100 * (y - 2022), p, 2 * p] for y in range(2022, 2027) for p in range(1, 11)]
    return frame(spark, "metas", rows)


def changed_rows():
    """The source after a change batch: one new client, contract, claim and rating, one expired contract, one resolved
    claim."""
    rows = source_rows()
    rows["cliente"].append([26, "Client 26", "ID-00026", "555-0026", "Street 26", "M", "client26@example.org", 1])
    rows["contrato"].append([61, "Contract 61"])
    rows["registro_contrato"].append([61, 3, 26, "2026-02-03", "2027-02-03", "4100.50", "ACTIVO"])
    rows["registro_contrato"][1][-1] = "VENCIDO"
    rows["siniestro"].append([31, "Claim 31"])
    rows["registro_siniestro"].append([31, 61, "2026-03-04", "2026-03-25", "SI", "0.00", "900.00"])
    rows["registro_siniestro"][9][3:6] = ["2026-05-06", "NO", "700.00"]
    rows["recomienda"].append([26, 2, 3, "NO"])
    return rows


def changed_source(spark):
    return source(spark, changed_rows())


def sql(rows, query):
    """A query over fixture rows, answered by an engine that shares nothing with the library."""
    from starloom.schemas import SOURCE_COLUMNS

    with duckdb.connect() as db:
        for table, data in rows.items():
            names = [c for c in SOURCE_COLUMNS[table] if c != "fecha_carga"]
            text = pd.DataFrame([[None if c is None else str(c) for c in row] for row in data], columns=names, dtype="object")
            kinds = ", ".join(f"CAST({c} AS {SOURCE_COLUMNS[table][c]}) AS {c}" for c in names)
            db.register(f"text_{table}", text)
            db.execute(f"CREATE TABLE {table} AS SELECT {kinds} FROM text_{table}")
        return db.execute(query).fetchall()
