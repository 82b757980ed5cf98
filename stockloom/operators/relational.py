"""Small relational building blocks used by reports and plans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"


def trailing(df: DataFrame, column: str, as_of: dt.date, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` and later."""
    return df.filter(F.col(column) >= F.lit(as_of - dt.timedelta(days=days)))


def text_match(pattern: str, *columns: str, regex: bool = True) -> Column:
    """Case-insensitive match in any column; NULL never matches."""
    hits = [F.col(c).rlike(f"(?i){pattern}") if regex else F.contains(F.lower(F.col(c)), F.lit(pattern.lower()))
            for c in columns]
    out = F.coalesce(hits[0], F.lit(False))
    for h in hits[1:]:
        out = out | F.coalesce(h, F.lit(False))
    return out


def choose(df: DataFrame, **picks: str | None) -> DataFrame:
    """Equality filters; ``All`` or None leaves a column unfiltered."""
    for column, value in picks.items():
        if value not in (None, ALL):
            df = df.filter(F.col(column) == value)
    return df


def report_filter(df: DataFrame, date_column: str | None = None, start: dt.date | None = None, end: dt.date | None = None,
                  **picks: str | Sequence[str] | None) -> DataFrame:
    """Date range plus one value or a list of values per column."""
    if date_column and start:
        df = df.filter(F.col(date_column) >= F.lit(start))
    if date_column and end:
        df = df.filter(F.col(date_column) <= F.lit(end))
    for column, value in picks.items():
        if value is None or value == ALL:
            continue
        df = df.filter(F.col(column) == value) if isinstance(value, str) else df.filter(F.col(column).isin(*value))
    return df


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def page_after(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """Next page by key: everything up to ``after`` is filtered out before sorting."""
    rows = df if after is None else df.filter(F.col(key) > after)
    return rows.orderBy(key).limit(size)


def one_row(spark, **scalars: DataFrame) -> DataFrame:
    """Several one-value frames side by side, each read once as a scalar subquery."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in scalars.items()])


def histogram(df: DataFrame, value: str, bins: int, *, out: str = "bin") -> DataFrame:
    """Equal-width bins from the smallest to the largest value; the last bin is closed."""
    v = F.col(value).cast("double")
    ends = df.agg(F.struct(F.min(v).alias("low"), F.max(v).alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    width = (high - low) / F.lit(float(bins))
    number = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - low) / F.when(width == 0, F.lit(1.0)).otherwise(width)), F.lit(bins - 1)))
    return (df.filter(v.isNotNull()).select(number.cast("int").alias(out)).groupBy(out)
            .agg(F.count(F.lit(1)).alias("row_count")))


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is missing from the parent; a NULL key counts as missing."""
    known = parent.select(F.col(parent_key).alias("_k"))
    return df.join(known, F.col(key) == F.col("_k"), "left_anti")
