"""Compares a query's rows with those of its SQL in DuckDB, ignoring order."""

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(int(value)) if value == int(value) else str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


# Spark type names and DuckDB's names of the same types.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def compare(connection, frame, sql: str) -> str:
    """Empty if both agree, else the first difference."""
    found = connection.execute(sql)
    expected_names = [d[0] for d in found.description]
    expected = _rows(expected_names, found.fetchall())
    actual = _rows(frame.columns, frame.collect())
    if sorted(frame.columns) != sorted(expected_names):
        return f"columns {sorted(frame.columns)} != {sorted(expected_names)}"
    spark_types = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    sql_types = {d[0]: str(d[1]) for d in found.description}
    if spark_types != sql_types:
        return f"types {sorted(set(spark_types.items()) ^ set(sql_types.items()))}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, b in zip(actual, expected):
        if a != b:
            return f"{a} != {b}"
    return ""
