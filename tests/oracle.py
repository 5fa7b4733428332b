"""Side-by-side comparison of a registered query with its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

_KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int", "hugeint": "int",
    "float": "float", "double": "float", "string": "text", "varchar": "text", "boolean": "bool", "date": "date",
    "timestamp": "time", "timestamp_ntz": "time",
}


def kind(name: str) -> str:
    name = name.lower()
    return "decimal" if name.startswith("decimal") else _KINDS.get(name, name)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (int, float, decimal.Decimal)):
        if isinstance(value, float) and math.isnan(value):
            return ("nan",)
        return ("number", repr(float(value)))
    if isinstance(value, dt.datetime):
        return ("time", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def differences(frame: DataFrame, sql: str, db: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs between the two results; empty if they agree."""
    found = db.execute(sql)
    sql_types = {d[0]: kind(str(d[1])) for d in found.description}
    spark_types = {n: kind(t) for n, t in frame.dtypes}
    problems = []
    if sql_types != spark_types:
        problems.append(f"types differ: spark {spark_types} sql {sql_types}")
    if set(sql_types) != set(spark_types):
        return problems
    theirs = rows_of([d[0] for d in found.description], found.fetchall())
    ours = rows_of(frame.columns, frame.collect())
    if len(ours) != len(theirs):
        problems.append(f"rows differ: spark {len(ours)} sql {len(theirs)}")
    if ours != theirs:
        missing, extra = set(theirs) - set(ours), set(ours) - set(theirs)
        problems.append(f"values differ: only sql {sorted(missing)[:2]} only spark {sorted(extra)[:2]}")
    return problems
