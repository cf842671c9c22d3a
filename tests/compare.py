"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from chirp.plans.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v, places: int = 9):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, places)
    if isinstance(v, decimal.Decimal):
        return round(float(v), places)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, places) for x in v)
    if hasattr(v, "item"):
        return norm(v.item(), places)
    return v


def rows_of(names, rows, places=9):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i], places) for i in order) for r in rows]
    return sorted([n for n in (names[i] for i in order)]), sorted(out, key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
                 "smallint": "SMALLINT", "date": "DATE"}


def compare(spark_df, con, sql: str, places: int = 9):
    """Returns (ok, message): same column names, compatible types, same rows
    (order-insensitive, floats rounded)."""
    s_names = spark_df.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in spark_df.schema.fields}
    rel = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    if s_names and set(s_names) == set(d_types) and s_types != d_types:
        diff = {k: (s_types[k], d_types[k]) for k in s_types if s_types[k] != d_types[k]}
        return False, f"types differ: {diff}"
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sn, sr = rows_of(s_names, s_rows, places)
    dn, dr = rows_of(d_names, d_rows, places)
    if sn != dn:
        return False, f"columns differ: spark={sn} duckdb={dn}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duckdb={len(dr)}"
    if sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ, e.g. {bad}"
    return True, f"{len(sr)} rows match"
