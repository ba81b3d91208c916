"""Compare a registered query with its SQL, values and types."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> SQL type of the same column.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return value + 0.0  # -0.0 -> 0.0
    return value


def compare(spark, con, build, sql: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = build(spark, sf_dir)
    columns = sorted(df.columns)
    want_types = {
        row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()
    }
    if sorted(want_types) != columns:
        return f"columns {columns} against {sorted(want_types)}"
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != want_types[name]:
            return f"type of {name}: {kind} against {want_types[name]}"
    got = [tuple(_plain(row[c]) for c in columns) for row in df.collect()]
    picked = ", ".join(f'"{c}"' for c in columns)
    want = [tuple(map(_plain, r)) for r in con.execute(f"SELECT {picked} FROM ({sql})").fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    got.sort(key=_key)
    want.sort(key=_key)
    for a, b in zip(got, want):
        if a != b:
            return f"row {a} against {b}"
    return None
