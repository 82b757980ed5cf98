"""Query registry: each entry pairs a Spark plan with the SQL it must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.catalog.views import VIEWS
from stockloom.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Warehouse], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a plan builder under ``name`` with its checking SQL."""
    def add(build: Callable[[Warehouse], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, build, sql)
        return build
    return add


def result_types(df: DataFrame) -> DataFrame:
    """Report types: decimals as double, integers as bigint."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("decimal", "float"):
            c = c.cast("double").alias(f.name)
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint").alias(f.name)
        out.append(c)
    return df.select(*out)


def run(q: Query, spark: SparkSession, data_dir: str) -> DataFrame:
    return result_types(q.build(Warehouse(spark, data_dir)))


def _needed(sql: str, seen: list[str]) -> None:
    for name in dict.fromkeys(re.findall(r"\b\w+\b", sql)):
        if name in VIEWS and name not in seen:
            _needed(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)


def full_sql(sql: str) -> str:
    """The SQL with every view it uses written out as a common table expression."""
    names: list[str] = []
    _needed(sql, names)
    if not names:
        return sql.strip()
    parts = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    body = sql.strip()
    if re.match(r"(?i)with\s", body):
        return f"WITH {parts},\n{body[4:].lstrip()}"
    return f"WITH {parts}\n{body}"
