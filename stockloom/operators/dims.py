"""Dimensions: surrogate keys, unknown members, type-1 upserts, the date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockloom.functions import dates as D, keys, measures as M

UNKNOWN_ID = 0
UNKNOWN_CODE = "UNKNOWN"

# dimension -> (code column, id column, name column, unknown name)
DIMENSIONS = {
    "dim_item": ("source_item_code", "dim_item_id", "item_name", "Unknown Item"),
    "dim_warehouse": ("source_warehouse_code", "dim_warehouse_id", "warehouse_name", "Unknown Warehouse"),
    "dim_vendor": ("source_vendor_code", "dim_vendor_id", "vendor_name", "Unknown Vendor"),
}

# Attributes a batch may lack: keep what the dimension already holds.
KEEP_WHEN_MISSING = {"abc_class", "parent_warehouse_code"}


def dimension_keys(df: DataFrame, code: str, dim: str) -> DataFrame:
    """Narrow (code, id) pairs of a master table, for fact lookups."""
    code_col, id_col, _, _ = DIMENSIONS[dim]
    return df.select(F.col(code).alias(code_col), keys.surrogate_id(code).alias(id_col))


def lookup(facts: DataFrame, dim_keys: DataFrame, dim: str) -> DataFrame:
    """Replace the business code by the dimension id; unmatched codes become the unknown member.

    No broadcast hint: the planner compares the dimension's size with its
    threshold, and otherwise sort-merges with runtime skew splitting.
    """
    code_col, id_col, _, _ = DIMENSIONS[dim]
    pairs = dim_keys.select(F.col(code_col).alias("_code"), F.col(id_col).alias("_id"))
    return (facts.join(pairs, F.col(code_col) == F.col("_code"), "left")
            .withColumn(id_col, F.coalesce("_id", F.lit(UNKNOWN_ID).cast("bigint")))
            .drop("_code", "_id"))


def sequential_ids(codes: DataFrame, code: str, id_col: str, after: int = 0) -> DataFrame:
    """Gap-free ids ``after+1 ...`` for new codes, numbered in parallel.

    Codes are spread over 4096 hash buckets; each bucket is numbered on its own
    and shifted by the sizes of the buckets before it, so only the 4096 bucket
    counts ever meet in one task.
    """
    spread = codes.withColumn("_b", F.substring(F.md5(F.col(code)), 1, 3))
    sizes = spread.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    shift = sizes.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_shift"))
    number = F.row_number().over(Window.partitionBy("_b").orderBy(code))
    return (spread.withColumn("_rn", number).join(shift, "_b")
            .withColumn(id_col, F.lit(after).cast("bigint") + F.col("_shift") + F.col("_rn")).drop("_b", "_rn", "_shift"))


def _staged_item(item_master: DataFrame) -> DataFrame:
    kind = M.label(F.lower(F.trim(F.coalesce("item_type", F.lit("")))), M.SUPPLY_TYPE, "")
    kind = F.when(kind != "", kind).otherwise(F.lower(F.coalesce("item_type", F.lit(""))))
    out = (item_master.withColumn("is_active", F.coalesce("is_active", F.lit(True)))
           .withColumn("is_drug", kind == "drug").withColumn("is_supply", kind == "supply"))
    return out if "abc_class" in out.columns else out.withColumn("abc_class", F.lit(None).cast("string"))


def _staged_warehouse(master: DataFrame) -> DataFrame:
    out = master.withColumn("is_active", F.coalesce("is_active", F.lit(True)))
    if "parent_warehouse_code" not in out.columns:
        out = out.withColumn("parent_warehouse_code", F.lit(None).cast("string"))
    return out


def _staged_vendor(master: DataFrame) -> DataFrame:
    return master.withColumn("is_active", F.coalesce("is_active", F.lit(True)))


PREPARE = {"dim_item": _staged_item, "dim_warehouse": _staged_warehouse, "dim_vendor": _staged_vendor}

STAGE_EXTRAS = ("etl_batch_id", "extracted_ts", "source_pk_hash", "source_updated_ts")


def upsert_dimension(existing: DataFrame | None, staged: DataFrame, dim: str, seen_at: dt.datetime) -> DataFrame:
    """Type-1 merge by business code: new attributes win, the first sighting is kept."""
    code, id_col, _, _ = DIMENSIONS[dim]
    batch = PREPARE[dim](staged).drop(*STAGE_EXTRAS)
    now = F.lit(seen_at)
    attrs = [c for c in batch.columns if c != code]
    if existing is None:
        return batch.select(keys.surrogate_id(code).alias(id_col), code, *attrs, now.alias("first_seen_ts"),
                            now.alias("last_seen_ts"), F.lit(True).alias("current_record_flag"))
    new, old = batch.alias("n"), existing.alias("o")
    hit = F.col(f"n.{code}").isNotNull()

    def merged(c: str):
        if c in KEEP_WHEN_MISSING:
            return F.coalesce(f"n.{c}", f"o.{c}").alias(c)
        return F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return old.join(new, F.col(f"o.{code}") == F.col(f"n.{code}"), "full_outer").select(
        F.coalesce(f"o.{id_col}", keys.surrogate_id(F.col(f"n.{code}"))).alias(id_col),
        F.coalesce(f"o.{code}", f"n.{code}").alias(code),
        *[merged(c) for c in attrs],
        F.coalesce("o.first_seen_ts", now).alias("first_seen_ts"),
        F.when(hit, now).otherwise(F.col("o.last_seen_ts")).alias("last_seen_ts"),
        F.when(hit, F.lit(True)).otherwise(F.col("o.current_record_flag")).alias("current_record_flag"))


def with_unknown(dim_rows: DataFrame, dim: str) -> DataFrame:
    """Add the seeded member that unmatched fact rows point to."""
    code, id_col, name, unknown_name = DIMENSIONS[dim]
    fixed = {id_col: F.lit(UNKNOWN_ID).cast("bigint"), code: F.lit(UNKNOWN_CODE), name: F.lit(unknown_name)}
    flags = {"is_active", "is_drug", "is_supply"}
    row = dim_rows.sparkSession.range(1).select(*[
        fixed.get(f.name, F.lit(False) if f.name in flags else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in dim_rows.schema.fields])
    return dim_rows.unionByName(row)


def colliding_ids(dim_rows: DataFrame, dim: str) -> DataFrame:
    """Ids held by several rows, of several codes or of one; must be empty before a dimension is written."""
    code, id_col, _, _ = DIMENSIONS[dim]
    return dim_rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(code).alias("codes")).filter("row_count > 1")


def date_dimension(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("full_date"))
    return date_attributes(days)


def date_attributes(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    quarter_start = F.trunc(d, "quarter")
    return days.select(
        keys.date_key(d).alias("date_id"), d,
        F.dayofmonth(d).alias("day_of_month"), F.month(d).alias("month_no"),
        F.date_format(d, "MMMM").alias("month_name_en"),
        F.quarter(d).alias("quarter_no"), F.year(d).alias("year_no"), F.weekofyear(d).alias("week_no"),
        F.date_format(d, "EEEE").alias("day_name_en"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.trunc(d, "month").alias("month_start_date"), F.last_day(d).alias("month_end_date"),
        quarter_start.alias("quarter_start_date"),
        F.last_day(F.add_months(quarter_start, 2)).alias("quarter_end_date"),
        F.trunc(d, "year").alias("year_start_date"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("year_end_date"),
        D.fiscal_year(d).alias("fiscal_year"),
        (d == F.trunc(d, "month")).alias("is_month_start"), (d == F.last_day(d)).alias("is_month_end"),
        (d == quarter_start).alias("is_quarter_start"), (d == F.trunc(d, "year")).alias("is_year_start"))
