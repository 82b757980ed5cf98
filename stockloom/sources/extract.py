"""Extracts: operational tables to staging columns, and the windows they are read through."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.functions import keys, measures as M

CHUNK_ROWS = 500_000
DEFAULT_PARTS = 64  # parts of a read whose size is not known


# Reading --------------------------------------------------------------------

def jdbc_options(url: str, table: str, column: str | None = None, low=None, high=None,
                 rows: int | None = None, chunk_rows: int = CHUNK_ROWS) -> dict[str, str]:
    """Reader options: the read is split on ``column`` from ``low`` to ``high``, at about ``chunk_rows`` rows a part.

    Without a column the whole table would be one task, so that has to be asked
    for by ``rows``, at most one part's.
    """
    options = {"url": url, "dbtable": table, "fetchsize": "10000", "pushDownPredicate": "true"}
    if column is None:
        if rows is None or rows > chunk_rows:
            raise ValueError(f"{table}: a read in one task needs rows of at most {chunk_rows}; else name a column and its bounds")
        return options
    if low is None or high is None:
        raise ValueError(f"{table}: splitting on {column} needs its smallest and largest value")
    parts = DEFAULT_PARTS if rows is None else max(1, -(-rows // chunk_rows))
    return options | {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def read_window(df: DataFrame, mode: str, column: str, watermark_from: dt.date | None = None,
                watermark_to: dt.date | None = None, lookback_days: int = 0) -> DataFrame:
    """Rows with ``from <= column < to``; a plain column predicate, so scans prune on it.

    ``full`` reads everything, ``incremental`` starts ``lookback_days`` before the
    watermark, ``repair`` and ``backfill`` read exactly the given range.
    """
    if mode == "full":
        return df
    if mode not in ("incremental", "repair", "backfill"):
        raise ValueError(f"unknown mode {mode!r}")
    start = watermark_from
    if start is not None and mode == "incremental":
        start = start - dt.timedelta(days=lookback_days)
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if watermark_to is not None:
        df = df.filter(F.col(column) < F.lit(watermark_to))
    return df


def daily_snapshot(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Current-state table stamped with the day it was read."""
    return df.withColumn("snapshot_date", F.lit(as_of))


# Masters --------------------------------------------------------------------

def item_master(drug_gn: DataFrame, company: DataFrame) -> DataFrame:
    maker = company.select(keys.normal_code("COMPANY_CODE").alias("_maker"), "COMPANY_NAME")
    items = drug_gn.withColumn("_vendor", keys.normal_code("LAST_VENDOR_CODE"))
    return items.join(maker, F.col("_vendor") == F.col("_maker"), "left").select(
        F.col("WORKING_CODE").alias("source_item_code"),
        F.col("DRUG_NAME").alias("item_name"),
        F.col("DRUG_NAME_KEY").alias("generic_name"),
        F.col("GROUP_CODE").alias("item_group"),
        F.col("SUPPLY_TYPE").alias("item_type"),
        F.col("GROUP_KEY").alias("item_category"),
        F.col("VEN_FLAG").alias("ven_class"),
        F.coalesce(F.col("HIDE") == "N", F.lit(False)).alias("is_active"),
        F.col("SALE_UNIT").alias("standard_unit"),
        F.col("STRENGTH_UNIT").alias("strength_text"),
        F.col("DOSAGE_FORM").alias("dosage_form"),
        F.coalesce("COMPANY_NAME", "LAST_VENDOR_CODE").alias("manufacturer_name"),
    )


def warehouse_master(dept: DataFrame) -> DataFrame:
    return dept.select(
        F.col("DEPT_ID").alias("source_warehouse_code"),
        F.col("DEPT_NAME").alias("warehouse_name"),
        F.col("DEPT_TYPE").alias("warehouse_type"),
        F.coalesce(F.col("HIDE") == "N", F.lit(False)).alias("is_active"),
    )


def vendor_master(company: DataFrame) -> DataFrame:
    return company.select(
        keys.normal_code("COMPANY_CODE").alias("source_vendor_code"),
        F.col("COMPANY_NAME").alias("vendor_name"),
        M.vendor_type(F.col("VENDOR_FLAG"), F.col("MANUFAC_FLAG")).alias("vendor_type"),
        F.coalesce(F.col("HIDE") == "N", F.lit(False)).alias("is_active"),
    )


# Transactions ---------------------------------------------------------------

def live_card(card: DataFrame, strict_null: bool = False) -> DataFrame:
    """Receipts and issues that were not cancelled, with the warehouse resolved."""
    return (card.filter(F.col("R_S_STATUS").isin("R", "S") & M.not_cancelled(F.col("CANCEL_FLAG"), strict_null))
            .withColumn("source_warehouse_code", F.coalesce("STOCK_ID", "DEPT_ID")))


def _balance(rows: DataFrame, group: list[str], qty: str, cost: str, value: str, mode: str) -> DataFrame:
    if mode == "closing":
        # newest card row per group: one aggregation, no sort of the groups
        last = F.max_by(F.struct(qty, cost, value), F.struct("OPERATE_DATE", "RECORD_NUMBER"))
        return (rows.groupBy(*group).agg(last.alias("l"), F.max("OPERATE_DATE").alias("source_updated_ts"))
                .select(*group, F.col(f"l.{qty}").cast(S.QTY).alias("qty_on_hand"),
                        F.col(f"l.{cost}").cast(S.UNIT_COST).alias("avg_unit_cost"),
                        F.col(f"l.{value}").cast(S.VALUE).alias("stock_value"), "source_updated_ts"))
    if mode != "sum":
        raise ValueError(f"unknown balance mode {mode!r}")
    return rows.groupBy(*group).agg(
        F.sum(qty).cast(S.QTY).alias("qty_on_hand"),
        M.mean(F.sum(cost), F.count(cost)).cast(S.UNIT_COST).alias("avg_unit_cost"),
        F.sum(value).cast(S.VALUE).alias("stock_value"),
        F.max("OPERATE_DATE").alias("source_updated_ts"),
    )


def stock_balance(card: DataFrame, mode: str = "sum") -> DataFrame:
    rows = live_card(card).select(
        F.col("OPERATE_DATE").cast("date").alias("snapshot_date"), F.col("WORKING_CODE").alias("source_item_code"),
        "source_warehouse_code", "REMAIN_QTY", "REMAIN_COST", "REMAIN_VALUE", "OPERATE_DATE", "RECORD_NUMBER")
    return _balance(rows, ["snapshot_date", "source_item_code", "source_warehouse_code"],
                    "REMAIN_QTY", "REMAIN_COST", "REMAIN_VALUE", mode)


def stock_lot_balance(card: DataFrame, mode: str = "sum") -> DataFrame:
    rows = live_card(card).filter("LOT_NO IS NOT NULL AND REMAIN_QTY_LOT IS NOT NULL").select(
        F.col("OPERATE_DATE").cast("date").alias("snapshot_date"), F.col("WORKING_CODE").alias("source_item_code"),
        "source_warehouse_code", F.col("LOT_NO").alias("lot_no"), F.col("EXPIRED_DATE").cast("date").alias("expiry_date"),
        "REMAIN_QTY_LOT", "WT_AVG", "REMAIN_VALUE_LOT", "OPERATE_DATE", "RECORD_NUMBER")
    return _balance(rows, ["snapshot_date", "source_item_code", "source_warehouse_code", "lot_no", "expiry_date"],
                    "REMAIN_QTY_LOT", "WT_AVG", "REMAIN_VALUE_LOT", mode)


def inventory_movement(card: DataFrame, strict_null: bool = False) -> DataFrame:
    status = F.col("R_S_STATUS")
    return live_card(card, strict_null).select(
        F.concat("R_S_NUMBER", F.lit("-"), "RECORD_NUMBER").alias("source_txn_id"),
        F.col("OPERATE_DATE").cast("date").alias("txn_date"),
        F.col("WORKING_CODE").alias("source_item_code"),
        "source_warehouse_code",
        F.when(status == "R", "receive").when(status == "S", "issue").otherwise("other").alias("movement_type"),
        F.col("R_S_NUMBER").alias("ref_doc_no"),
        F.when(status == "R", "GR").when(status == "S", "ISSUANCE").otherwise("OTHER").alias("ref_doc_type"),
        F.col("LOT_NO").alias("lot_no"),
        F.col("EXPIRED_DATE").cast("date").alias("expiry_date"),
        F.col("ACTIVE_QTY").alias("qty"),
        F.col("COST").alias("unit_cost"),
        F.col("VALUE").alias("line_value"),
        keys.normal_code("VENDOR_CODE").alias("source_vendor_code"),
        F.col("OPERATE_DATE").alias("source_updated_ts"),
    )


def purchase_order_line(ms_po: DataFrame, ms_po_c: DataFrame) -> DataFrame:
    return ms_po.join(ms_po_c, "PO_NO").select(
        F.col("PO_NO").alias("po_no"),
        F.col("PO_DATE").cast("date").alias("po_date"),
        F.col("WORKING_CODE").alias("source_item_code"),
        keys.normal_code("VENDOR_CODE").alias("source_vendor_code"),
        F.col("QTY_ORDER").alias("ordered_qty"),
        F.col("BUY_UNIT_COST").alias("ordered_unit_cost"),
        (F.col("QTY_ORDER") * F.col("BUY_UNIT_COST")).cast(S.VALUE).alias("ordered_value"),
        M.order_status(F.col("PROCESS"), F.col("OK")).alias("po_status"),
        F.col("PO_DATE").alias("source_updated_ts"),
    )


def goods_receipt_line(ms_ivo: DataFrame, ms_ivo_c: DataFrame) -> DataFrame:
    """Received invoice lines; header and line meet on the invoice number alone."""
    head = ms_ivo.filter("RCV_FLAG = 'Y'").select(
        "INVOICE_NO", "INVOICE_DATE", "PO_NO", F.col("DEPT_ID").alias("_head_dept"), "VENDOR_CODE")
    return head.join(ms_ivo_c, "INVOICE_NO").select(
        F.col("INVOICE_NO").alias("gr_no"),
        F.col("INVOICE_DATE").cast("date").alias("gr_date"),
        F.col("PO_NO").alias("po_no"),
        F.col("WORKING_CODE").alias("source_item_code"),
        F.coalesce("DEPT_ID", "_head_dept").alias("source_warehouse_code"),
        keys.normal_code("VENDOR_CODE").alias("source_vendor_code"),
        F.col("LOT_NO").alias("lot_no"),
        F.col("EXPIRED_DATE").cast("date").alias("expiry_date"),
        F.col("QTY_ORDER").alias("received_qty"),
        F.col("BUY_UNIT_COST").alias("received_unit_cost"),
        (F.col("QTY_ORDER") * F.col("BUY_UNIT_COST")).cast(S.VALUE).alias("received_value"),
        F.col("INVOICE_DATE").alias("source_updated_ts"),
    )


def stage(df: DataFrame, table: str, batch_id: int, extracted_at: dt.datetime | None = None) -> DataFrame:
    """Staged form: batch tag, extraction time and business-key hash."""
    parts = S.STAGING[table].hash_parts
    at = F.lit(extracted_at) if extracted_at else F.current_timestamp()
    return (df.withColumn("etl_batch_id", F.lit(batch_id).cast("bigint"))
            .withColumn("extracted_ts", at)
            .withColumn("source_pk_hash", keys.business_hash(*parts)))


def dedupe_batch(df: DataFrame) -> DataFrame:
    """One row per batch and business key, for sources that may deliver a row twice.

    The jobs do not need it: a batch is written to its own folder, which a repeat
    replaces, and different lines under one key must all reach the fact.
    """
    return df.dropDuplicates(["etl_batch_id", "source_pk_hash"])
