"""Compare one registered query with its SQL: columns, types, and all rows."""

from __future__ import annotations

import datetime as dt
import decimal

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(value)  # both sides round; what is left has to be equal
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


def compare(df, con, statement):
    """None when equal, otherwise a short description of the first difference."""
    result = con.execute(statement)
    columns = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    expected = normal(columns, result.fetchall())
    got = normal(df.columns, [tuple(row) for row in df.collect()])
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    for name, kind in df.dtypes:
        wanted = KINDS.get(kind, kind.upper())
        if types[name].replace(" ", "") != wanted:
            return f"type of {name}: {kind} != {types[name]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows != {len(expected[1])}"
    for a, b in zip(got[1], expected[1]):
        if a != b:
            return f"row {a} != {b}"
    return None
