"""Facts: staged rows to conformed fact rows, and the keyed reload rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.functions import keys, measures as M
from stockloom.operators.dims import lookup


def stock_snapshot(staged: DataFrame, item_keys: DataFrame, warehouse_keys: DataFrame) -> DataFrame:
    rows = lookup(lookup(staged, item_keys, "dim_item"), warehouse_keys, "dim_warehouse")
    return rows.select(
        "snapshot_date", keys.date_key("snapshot_date").alias("snapshot_date_id"), "dim_item_id", "dim_warehouse_id",
        "qty_on_hand", "avg_unit_cost", "stock_value", M.stock_status(F.col("qty_on_hand")).alias("stock_status"))


def stock_lot_snapshot(staged: DataFrame, item_keys: DataFrame, warehouse_keys: DataFrame,
                       near_days: int = S.NEAR_EXPIRY_DAYS) -> DataFrame:
    rows = lookup(lookup(staged, item_keys, "dim_item"), warehouse_keys, "dim_warehouse")
    expiry, day = F.col("expiry_date"), F.col("snapshot_date")
    return rows.select(
        "snapshot_date", keys.date_key("snapshot_date").alias("snapshot_date_id"), "dim_item_id", "dim_warehouse_id",
        "lot_no", "expiry_date", "qty_on_hand", "avg_unit_cost", "stock_value",
        F.datediff(expiry, day).alias("days_to_expiry"),
        M.expiry_status(expiry, day, near_days).alias("expiry_status"))


def movement(staged: DataFrame, item_keys: DataFrame, warehouse_keys: DataFrame, vendor_keys: DataFrame) -> DataFrame:
    rows = lookup(lookup(lookup(staged, item_keys, "dim_item"), warehouse_keys, "dim_warehouse"),
                  vendor_keys, "dim_vendor")
    direction = M.movement_direction(F.col("movement_type"))
    value = F.coalesce("line_value", F.lit(0).cast(S.VALUE))
    return rows.select(
        "source_txn_id", "ref_doc_no", "ref_doc_type", "txn_date", keys.date_key("txn_date").alias("txn_date_id"),
        "dim_item_id", "dim_warehouse_id", "dim_vendor_id",
        F.lower("movement_type").alias("movement_type"), direction.alias("movement_direction"),
        "lot_no", "expiry_date", "qty", M.signed(F.col("qty"), direction).alias("signed_qty"),
        "unit_cost", "line_value", M.signed(value, direction).alias("signed_value"),
        keys.business_hash(*S.STAGING["inventory_movement"].hash_parts).alias("source_row_hash"))


def purchase_order_line(staged: DataFrame, item_keys: DataFrame, vendor_keys: DataFrame) -> DataFrame:
    rows = lookup(lookup(staged, item_keys, "dim_item"), vendor_keys, "dim_vendor")
    return rows.select(
        "po_no", "po_date", keys.date_key("po_date").alias("po_date_id"), "dim_item_id", "dim_vendor_id",
        "ordered_qty", "ordered_unit_cost", "ordered_value", "po_status",
        keys.business_hash(*S.STAGING["purchase_order_line"].hash_parts).alias("source_row_hash"))


def goods_receipt_line(staged: DataFrame, item_keys: DataFrame, warehouse_keys: DataFrame,
                       vendor_keys: DataFrame) -> DataFrame:
    rows = lookup(lookup(lookup(staged, item_keys, "dim_item"), warehouse_keys, "dim_warehouse"),
                  vendor_keys, "dim_vendor")
    return rows.select(
        "gr_no", "gr_date", keys.date_key("gr_date").alias("gr_date_id"), "po_no",
        "dim_item_id", "dim_warehouse_id", "dim_vendor_id", "lot_no", "expiry_date",
        "received_qty", "received_unit_cost", "received_value",
        keys.business_hash(*S.STAGING["goods_receipt_line"].hash_parts).alias("source_row_hash"))


# Reload rules: what the fact holds after a batch ------------------------------

def insert_absent(current: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """All batch rows whose key the fact does not hold yet; rows of one batch that share a key are all new."""
    return batch.join(current.select(*key).distinct(), key, "left_anti")


def replace_keys(current: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Current rows without the batch's keys, plus the batch."""
    return current.join(batch.select(*key).distinct(), key, "left_anti").unionByName(batch)


def replace_window(current: DataFrame, batch: DataFrame, column: str, low, high) -> DataFrame:
    """Current rows outside the closed window, plus the recomputed window."""
    return current.filter(~F.col(column).between(low, high)).unionByName(batch)
