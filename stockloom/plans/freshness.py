"""Age of the fact tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom import schemas as S


class NewestParts:
    """The facts of a store, each cut to its newest partition, which holds its newest date."""

    def __init__(self, store):
        self.store = store

    def __getattr__(self, fact: str) -> DataFrame:
        table = f"core.{fact}"
        held = self.store.parts(table)
        return self.store.read_parts(table, {max(held)}) if held else self.store.read(table)


def newest_dates(facts) -> DataFrame:
    """Newest event date per fact; ``facts`` has each fact as an attribute."""
    out = None
    for table, column in S.FACT_DATE.items():
        domain, kind = S.FACT_DOMAIN[table]
        row = getattr(facts, table).agg(F.max(column).alias("last_updated")).select(
            F.lit(domain).alias("data_domain"), F.lit(f"core.{table}").alias("table_name"),
            F.lit(S.STALE_AFTER_DAYS[kind]).alias("stale_after"), "last_updated")
        out = row if out is None else out.unionByName(row)
    return out


def freshness(dates: DataFrame, batch_id: int, checked_at: dt.datetime) -> DataFrame:
    """One row per table: fresh, stale after its threshold, unknown without data."""
    age = F.datediff(F.lit(checked_at.date()), "last_updated")
    status = F.when(F.col("last_updated").isNull(), "unknown").when(age > F.col("stale_after"), "stale").otherwise("fresh")
    return dates.select("data_domain", "table_name", F.lit(batch_id).cast("bigint").alias("last_success_batch_id"),
                        F.col("last_updated").alias("last_data_date"), F.lit(checked_at).alias("last_checked_ts"),
                        status.alias("freshness_status"))


def upsert_freshness(current: DataFrame, update: DataFrame) -> DataFrame:
    """Latest row per table; tables the update lacks keep theirs."""
    key = ["data_domain", "table_name"]
    return current.join(update.select(*key), key, "left_anti").unionByName(update)
