"""Compare a registered Spark query with its SQL on DuckDB."""

from __future__ import annotations

import math

import duckdb

from stockloom.sources.adapters import PARQUET_TABLES


def connect(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in PARQUET_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "\0"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


# SQL type names of both engines, by family
FAMILY = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
          "timestamp_ntz": "TIMESTAMP"}


def differences(df, con, sql: str) -> list[str]:
    cur = con.execute(sql)
    columns, types = [d[0] for d in cur.description], [str(d[1]) for d in cur.description]
    want = _rows(cur.fetchall(), columns)
    got = _rows(df.collect(), df.columns)
    out = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    spark_types = {n: FAMILY.get(t, t) for n, t in df.dtypes}
    for name, kind in zip(columns, types):
        if spark_types[name] != kind:
            out.append(f"type of {name}: {spark_types[name]} != {kind}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        out.append(f"values differ in {sorted(columns)}")
        missing = sorted(set(want) - set(got))[:2]
        extra = sorted(set(got) - set(want))[:2]
        out += [f"  only SQL   {r}" for r in missing] + [f"  only Spark {r}" for r in extra]
    return out
