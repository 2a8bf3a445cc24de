"""Compare a Spark result with its SQL oracle: names, row count and every value."""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 4) + 0.0
    return value


def _multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(row[i]) for i in order) for row in rows)


# SQL type families that must agree between the engines.
_SPARK = {
    "bigint": "int", "int": "int", "double": "float", "string": "text", "boolean": "bool", "date": "date",
    "timestamp_ntz": "ts",
}


def _duck_family(kind) -> str:
    name = re.sub(r"\(.*", "", str(kind)).upper()
    return {
        "BIGINT": "int", "INTEGER": "int", "DOUBLE": "float", "VARCHAR": "text", "BOOLEAN": "bool",
        "DATE": "date", "TIMESTAMP": "ts",
    }.get(name, name)


def differences(df, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: _duck_family(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = {name: _SPARK.get(kind, kind) for name, kind in df.dtypes}
    if ours != kinds:
        return f"types differ: { {n: (ours[n], kinds[n]) for n in names if ours[n] != kinds[n]} }"
    rows = [tuple(r) for r in df.collect()]
    got, want = _multiset(df.columns, rows), _multiset(names, expected)
    if got != want:
        extra, lost = list((got - want).items())[:3], list((want - got).items())[:3]
        return (
            f"rows {len(rows)} != {len(expected)}; differing {sum((got - want).values())}\n"
            f"  only ours: {extra}\n  only theirs: {lost}"
        )
    return None
