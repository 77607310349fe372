"""Run a registered query and its SQL and compare them value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def type_differences(df, description) -> list[str]:
    """Columns whose types differ on the two sides."""
    want = {d[0]: str(d[1]) for d in description}
    return [
        f"{name}: {kind} and {want.get(name)}"
        for name, kind in df.dtypes
        if TYPES.get(kind, kind) != want.get(name)
    ]


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    types = type_differences(df, result.description)
    if types:
        return f"types: {types}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{sum(x != y for x, y in zip(got, want))} rows differ, first {a} and {b}"
    return None
