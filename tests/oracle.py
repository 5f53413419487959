"""Compares a bound query with its SQL on DuckDB: columns, types, rows and values."""

from __future__ import annotations

import glob
import os
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value)  # keeps the sign of zero
    if isinstance(value, Decimal):
        raise TypeError("decimals compare unevenly; cast to double")
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
}


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """A description of the first difference, or None."""
    described = con.execute(f"describe {sql}").fetchall()
    want_types = {r[0]: r[1] for r in described}
    got_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if sorted(want_types) != sorted(got_types):
        return f"columns {sorted(got_types)} != {sorted(want_types)}"
    diff = {n: (got_types[n], want_types[n]) for n in got_types if got_types[n] != want_types[n]}
    if diff:
        return f"types {diff}"
    want = _rows(con.execute(sql).fetchall(), [r[0] for r in described])
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    if len(want) != len(got):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(want)} rows differ, first: {bad[0][0]} != {bad[0][1]}"
    return None if want else "no rows"
