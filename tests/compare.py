"""Runs queries in Spark and their SQL in DuckDB over the same tables and compares rows."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def canonical(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, bool) or v is None or isinstance(v, str):
            return v
        if isinstance(v, (list, tuple)):
            return tuple(map(value, v))
        v = float(v)
        return None if math.isnan(v) else v + 0.0

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def differences(spark, query, sql: str, sf_dir: str) -> str:
    """An empty text if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    names, rows = oracle(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = canonical(df.columns, [tuple(r) for r in df.collect()]), canonical(names, rows)
    if a == b:
        return ""
    first = next(((x, y) for x, y in zip(a, b) if x != y), (a[len(b) :][:1], b[len(a) :][:1]))
    return f"{len(a)} and {len(b)} rows; first difference {first}"
