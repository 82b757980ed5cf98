"""Registered queries: extracts, read windows, keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.catalog.registry import query
from stockloom.catalog.views import _code, _id, doubles, longs
from stockloom.functions import keys
from stockloom.operators import dims
from stockloom.plans.chunks import ChunkedExtract
from stockloom.plans.ledger import Ledger
from stockloom.plans.store import Store, work_folder
from stockloom.sources import extract

AS_OF = dt.date(1999, 6, 30)

ITEM_COLS = ("source_item_code, item_name, generic_name, item_group, item_type, item_category, ven_class, is_active, "
             "standard_unit, strength_text, dosage_form, manufacturer_name")


@query("src_01_relational_extract", f"SELECT RECORD_NUMBER, WORKING_CODE, OPERATE_DATE, R_S_STATUS, {doubles('ACTIVE_QTY', 'VALUE')} FROM card")
def _(w):
    return w.src.card.select("RECORD_NUMBER", "WORKING_CODE", "OPERATE_DATE", "R_S_STATUS", "ACTIVE_QTY", "VALUE")


@query("src_02_item_master", f"SELECT {ITEM_COLS} FROM item_src")
def _(w):
    return w.item_master


@query("src_03_warehouse_master", "SELECT * FROM warehouse_src")
def _(w):
    return w.warehouse_master


@query("src_04_vendor_master", "SELECT * FROM vendor_src")
def _(w):
    return w.vendor_master


_BAL = f"{doubles('qty_on_hand', 'avg_unit_cost', 'stock_value')}, source_updated_ts"


@query("src_05_stock_balance", f"SELECT snapshot_date, source_item_code, source_warehouse_code, {_BAL} FROM balance_src")
def _(w):
    return extract.stock_balance(w.src.card)


@query("src_05b_stock_balance_closing", f"""
SELECT snapshot_date, source_item_code, source_warehouse_code, {_BAL} FROM (
 SELECT OPERATE_DATE AS snapshot_date, WORKING_CODE AS source_item_code, wh AS source_warehouse_code,
  REMAIN_QTY AS qty_on_hand, REMAIN_COST AS avg_unit_cost, REMAIN_VALUE AS stock_value, OPERATE_DATE AS source_updated_ts
 FROM card_live
 QUALIFY row_number() OVER (PARTITION BY OPERATE_DATE, WORKING_CODE, wh ORDER BY RECORD_NUMBER DESC)=1)""")
def _(w):
    return extract.stock_balance(w.src.card, "closing")


@query("src_06_stock_lot_balance", f"""
SELECT snapshot_date, source_item_code, source_warehouse_code, lot_no, expiry_date, {_BAL} FROM lot_balance_src""")
def _(w):
    return extract.stock_lot_balance(w.src.card)


_MOVE = f"""source_txn_id, txn_date, source_item_code, source_warehouse_code, movement_type, ref_doc_no, ref_doc_type,
 lot_no, expiry_date, {doubles('qty', 'unit_cost', 'line_value')}, source_vendor_code, source_updated_ts"""


@query("src_07_inventory_movement", f"SELECT {_MOVE} FROM movement_src")
def _(w):
    return extract.inventory_movement(w.src.card)


@query("src_08_purchase_order_line", f"""
SELECT po_no, po_date, source_item_code, source_vendor_code, {doubles('ordered_qty', 'ordered_unit_cost', 'ordered_value')},
 po_status, source_updated_ts FROM po_src""")
def _(w):
    return extract.purchase_order_line(w.src.ms_po, w.src.ms_po_c)


@query("src_09_goods_receipt_line", f"""
SELECT gr_no, gr_date, po_no, source_item_code, source_warehouse_code, source_vendor_code, lot_no, expiry_date,
 {doubles('received_qty', 'received_unit_cost', 'received_value')}, source_updated_ts FROM gr_src""")
def _(w):
    return extract.goods_receipt_line(w.src.ms_ivo, w.src.ms_ivo_c)


@query("src_10_watermark_window", f"""
SELECT {_MOVE} FROM movement_src WHERE txn_date >= DATE '1999-06-01' AND txn_date < DATE '1999-07-01'""")
def _(w):
    return extract.read_window(extract.inventory_movement(w.src.card), "repair", "txn_date",
                               dt.date(1999, 6, 1), dt.date(1999, 7, 1))


@query("src_11_lookback_windows", """
SELECT 'movement' AS domain, CAST(count(*) AS BIGINT) AS row_count FROM movement_src
 WHERE txn_date >= DATE '1999-06-27' AND txn_date < DATE '1999-07-01'
UNION ALL SELECT 'purchase_order', CAST(count(*) AS BIGINT) FROM po_src
 WHERE po_date >= DATE '1999-06-23' AND po_date < DATE '1999-07-01'
UNION ALL SELECT 'goods_receipt', CAST(count(*) AS BIGINT) FROM gr_src
 WHERE gr_date >= DATE '1999-06-23' AND gr_date < DATE '1999-07-01'
UNION ALL SELECT 'snapshot', CAST(count(*) AS BIGINT) FROM balance_src
 WHERE snapshot_date >= DATE '1999-06-29' AND snapshot_date < DATE '1999-07-01'""")
def _(w):
    sources = {
        "movement": (extract.inventory_movement(w.src.card), "txn_date"),
        "purchase_order": (extract.purchase_order_line(w.src.ms_po, w.src.ms_po_c), "po_date"),
        "goods_receipt": (extract.goods_receipt_line(w.src.ms_ivo, w.src.ms_ivo_c), "gr_date"),
        "snapshot": (extract.stock_balance(w.src.card), "snapshot_date"),
    }
    out = None
    for domain, (df, column) in sources.items():
        read = extract.read_window(df, "incremental", column, AS_OF, AS_OF + dt.timedelta(days=1),
                                   S.LOOKBACK_DAYS[domain])
        row = read.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(domain).alias("domain"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


@query("src_12_chunked_extract", """
SELECT CAST(year(OPERATE_DATE)*100+month(OPERATE_DATE) AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS row_count,
 CAST(sum(VALUE) AS DOUBLE) AS chunk_value FROM card GROUP BY 1""")
def _(w):
    return w.src.card.groupBy(keys.month_key("OPERATE_DATE").alias("chunk")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("VALUE").alias("chunk_value"))


class _Killed(RuntimeError):
    pass


@query("src_12b_chunked_restart", """
SELECT CAST(year(OPERATE_DATE)*100+month(OPERATE_DATE) AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS row_count,
 CAST(sum(VALUE) AS DOUBLE) AS chunk_value FROM card GROUP BY 1""")
def _(w):
    """The card extracted in chunks of an eighth of its rows, killed before the third, and gone on with by another run."""
    store = Store(w.spark, work_folder(w.spark, "chunks"), "month")
    card = w.src.card.select("RECORD_NUMBER", "OPERATE_DATE", "VALUE")
    rows = max(1, card.count() // 8)

    def kill(c):
        if c.number == 2:
            raise _Killed

    try:
        ChunkedExtract(store, Ledger(store), "card", 1, rows).run(card, "OPERATE_DATE", kill)
    except _Killed:
        pass  # the second run finds what is done in the ledger
    again = ChunkedExtract(store, Ledger(store), "card", 1, rows)
    again.run(card, "OPERATE_DATE")
    return again.read().groupBy(keys.month_key("OPERATE_DATE").alias("chunk")).agg(F.count(F.lit(1)).alias("row_count"), F.sum("VALUE").alias("chunk_value"))


@query("src_13_read_modes", """
SELECT 'full' AS mode, CAST(count(*) AS BIGINT) AS row_count FROM movement_src
UNION ALL SELECT 'incremental', CAST(count(*) AS BIGINT) FROM movement_src
 WHERE txn_date >= DATE '1999-06-27' AND txn_date < DATE '1999-07-01'
UNION ALL SELECT 'repair', CAST(count(*) AS BIGINT) FROM movement_src
 WHERE txn_date >= DATE '1999-06-30' AND txn_date < DATE '1999-07-01'
UNION ALL SELECT 'backfill', CAST(count(*) AS BIGINT) FROM movement_src
 WHERE txn_date >= DATE '1999-06-30' AND txn_date < DATE '1999-07-01'""")
def _(w):
    moves = extract.inventory_movement(w.src.card)
    out = None
    for mode in ("full", "incremental", "repair", "backfill"):
        read = extract.read_window(moves, mode, "txn_date", AS_OF, AS_OF + dt.timedelta(days=1), 3)
        row = read.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(mode).alias("mode"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


@query("src_14_daily_snapshot", f"""
SELECT WORKING_CODE, TRADE_CODE, DEPT_ID, LOCATION, LOT_NO, EXPIRED_DATE, {doubles('QTY_ON_HAND', 'LOT_COST', 'PACK_COST', 'LOT_VALUE')},
 CAST(VENDOR_CODE AS BIGINT) AS VENDOR_CODE, DATE '1999-06-30' AS snapshot_date FROM inv_md_c""")
def _(w):
    return extract.daily_snapshot(w.src.inv_md_c, AS_OF)


@query("src_15_bound_parameters", """
SELECT R_S_STATUS, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(ACTIVE_QTY) AS DOUBLE) AS qty
FROM card WHERE OPERATE_DATE >= DATE '1997-01-01' AND R_S_STATUS <> 'C' GROUP BY 1""")
def _(w):
    return w.spark.sql(
        "SELECT R_S_STATUS, count(*) AS row_count, sum(ACTIVE_QTY) AS qty FROM {card} "
        "WHERE OPERATE_DATE >= :start AND R_S_STATUS <> :skip GROUP BY R_S_STATUS",
        args={"start": dt.date(1997, 1, 1), "skip": "C"}, card=w.src.card)


# Keys -------------------------------------------------------------------------

@query("key_01_business_hash", """
SELECT RECORD_NUMBER, sha256(coalesce(trim(RECORD_NUMBER),'') || '||' || coalesce(trim(WORKING_CODE),'') || '||' ||
 coalesce(trim(STOCK_ID),'') || '||' || coalesce(trim(LOT_NO),'') || '||' || coalesce(trim(R_S_STATUS),'')) AS row_hash
FROM card""")
def _(w):
    return w.src.card.select(
        "RECORD_NUMBER",
        keys.business_hash("RECORD_NUMBER", "WORKING_CODE", "STOCK_ID", "LOT_NO", "R_S_STATUS").alias("row_hash"))


@query("key_02_surrogate_ids", "SELECT dim_item_id, source_item_code, item_name, is_active FROM d_item")
def _(w):
    return w.items


@query("key_02b_sequential_ids", """
SELECT WORKING_CODE, CAST(1000 + row_number() OVER (ORDER BY substr(md5(WORKING_CODE),1,3), WORKING_CODE) AS BIGINT) AS dim_item_id
FROM drug_gn""")
def _(w):
    return dims.sequential_ids(w.src.drug_gn.select("WORKING_CODE"), "WORKING_CODE", "dim_item_id", after=1000)


@query("key_03_unknown_fallback", """
SELECT dim_item_id = 0 AS unknown_item, dim_warehouse_id = 0 AS unknown_warehouse, dim_vendor_id = 0 AS unknown_vendor,
 CAST(count(*) AS BIGINT) AS row_count, CAST(sum(qty) AS DOUBLE) AS qty FROM f_move GROUP BY 1,2,3""")
def _(w):
    return w.fact_inventory_movement.groupBy(
        (F.col("dim_item_id") == 0).alias("unknown_item"), (F.col("dim_warehouse_id") == 0).alias("unknown_warehouse"),
        (F.col("dim_vendor_id") == 0).alias("unknown_vendor"),
    ).agg(F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty"))


@query("key_04_date_month_keys", """
SELECT CAST(strftime(OPERATE_DATE,'%Y%m%d') AS BIGINT) AS date_id, CAST(strftime(OPERATE_DATE,'%Y%m') AS BIGINT) AS month_id,
 CAST(count(*) AS BIGINT) AS row_count FROM card GROUP BY 1,2""")
def _(w):
    return w.src.card.groupBy(keys.date_key("OPERATE_DATE").alias("date_id"), keys.month_key("OPERATE_DATE").alias("month_id")
                              ).agg(F.count(F.lit(1)).alias("row_count"))


@query("key_05_code_normalisation", f"""
SELECT PO_NO, {_code('VENDOR_CODE')} AS vendor_code, COMPANY_NAME, CAST(QTY_ORDER AS DOUBLE) AS QTY_ORDER
FROM ms_po_c LEFT JOIN company ON {_code('VENDOR_CODE')} = CAST(COMPANY_CODE AS VARCHAR)""")
def _(w):
    lines = w.src.ms_po_c.select("PO_NO", keys.normal_code("VENDOR_CODE").alias("vendor_code"), "QTY_ORDER")
    names = w.src.company.select(keys.normal_code("COMPANY_CODE").alias("vendor_code"), "COMPANY_NAME")
    return lines.join(names, "vendor_code", "left").select("PO_NO", "vendor_code", "COMPANY_NAME", "QTY_ORDER")
