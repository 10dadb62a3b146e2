"""Differential check of a Spark query against its DuckDB oracle.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows (columns sorted by name, rows sorted).  Doubles must agree
exactly.
"""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute(f"SET TimeZone = '{os.environ.get('LEDGERLENS_DUCK_TZ', 'UTC')}'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(float(v)))
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, int):
        return (1, repr(float(v)) if abs(v) < 2**53 else str(v))
    if hasattr(v, "isoformat"):
        s = v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
        return (1, s)
    return (1, str(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), sorted(columns)


SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def type_mismatches(spark_df, con, sql: str):
    s_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for name, st in s_types.items():
        want = SPARK_TO_DUCK.get(st, st.upper())
        got = d_types.get(name)
        if got is not None and got != want:
            out.append(f"{name}: spark {st} vs duck {got}")
    return out


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s_sorted, s_names = rows_of(s_cols, s_rows)
    d_sorted, d_names = rows_of(d_cols, d_rows)
    problems = []
    if s_names != d_names:
        problems.append(f"columns differ: spark={s_names} duck={d_names}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differs: spark={len(s_rows)} duck={len(d_rows)}")
    problems += [f"type {m}" for m in type_mismatches(spark_df, con, sql)]
    if not problems and s_sorted != d_sorted:
        diffs = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
        problems.append(f"values differ, first diffs: {diffs}")
    return problems, len(s_rows)
