"""Order-insensitive comparison of a Spark result with DuckDB on the same parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(v) for v in row) for row in df.select(*names).collect())


def duck_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def type_mismatches(df, connection, sql: str) -> list[str]:
    """Columns whose Spark type is not the DuckDB type of the oracle."""
    described = connection.execute(f"describe {sql}").fetchall()
    duck = {row[0]: row[1] for row in described}
    out = []
    for name, kind in df.dtypes:
        wanted = KINDS.get(kind, kind.upper().replace("DECIMAL(", "DECIMAL("))
        if wanted.replace(" ", "") != duck.get(name, "").replace(" ", ""):
            out.append(f"{name}: {kind} vs {duck.get(name)}")
    return out
