"""Runs a registered query and its SQL on the same files and compares the rows."""

from __future__ import annotations

import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    if hasattr(value, "isoformat"):
        if getattr(value, "tzinfo", None):
            value = value.replace(tzinfo=None)
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when equal, else a description of the first difference."""
    frame = query(spark, sf_dir)
    spark_rows = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(names)}"
    sql_rows = rows_of(names, result.fetchall())
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows vs {len(sql_rows)}"
    bad = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0][0]} vs {bad[0][1]}"
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    off = [(n, t, kinds[n]) for n, t in frame.dtypes if t in types and types[t] != kinds[n]]
    return f"types {off}" if off else None
