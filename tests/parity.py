"""Compare registered queries with their DuckDB SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return db


def _plain(v) -> str:
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def kind(name: str) -> str:
    name = name.lower()
    return {"int": "integer", "string": "varchar", "hugeint": "bigint?", "long": "bigint", "timestamp_ntz": "timestamp"}.get(name, name)


def compare(df, db, sql: str) -> str:
    """Empty when both sides have the same columns, types and rows, else what differs."""
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = db.execute(sql)
    described = [(d[0], kind(str(d[1]))) for d in found.description]
    right = rows_of([d[0] for d in described], found.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} and {right[0]}"
    types, other = dict((c, kind(t)) for c, t in df.dtypes), dict(described)
    odd = [(c, types[c], other[c]) for c in left[0] if types[c] != other[c]]
    if left[1] != right[1]:
        missing = [r for r in left[1] if r not in set(right[1])][:2]
        extra = [r for r in right[1] if r not in set(left[1])][:2]
        return f"rows {len(left[1])} and {len(right[1])}: only Spark {missing}, only SQL {extra}"
    return f"types {odd}" if odd else ""
