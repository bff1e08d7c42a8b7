"""Runs a registered query and its SQL, and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.sql(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    theirs = _rows(relation.columns, relation.fetchall())
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE", "boolean": "BOOLEAN"}
    wanted = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    for name, kind in df.dtypes:
        if kinds[kind] != wanted[name]:
            return f"{name}: {kind} != {wanted[name]}"
    if ours != theirs:
        diff = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        return f"{len(ours)} rows != {len(theirs)} rows; first differences {diff}"
    return None
