"""Shared SQL views for the checking queries: sources, dimensions, facts.

Written for DuckDB and independent of the Spark plans, except that both sides
read the same source adapters.
"""

from __future__ import annotations

import re

from stockloom.sources.adapters import ADAPTERS

VIEWS: dict[str, str] = {name: re.sub(r"\{(\w+)\}", r"\1", sql) for name, sql in ADAPTERS.items()}


def _id(code: str) -> str:
    return f"CAST('0x' || substr(md5({code}),1,15) AS BIGINT)"


def _code(c: str) -> str:
    return f"regexp_replace(trim(CAST({c} AS VARCHAR)), '^0+(.)', '\\1')"


VIEWS["item_src"] = f"""
SELECT g.WORKING_CODE AS source_item_code, g.DRUG_NAME AS item_name, g.DRUG_NAME_KEY AS generic_name,
 g.GROUP_CODE AS item_group, g.SUPPLY_TYPE AS item_type, g.GROUP_KEY AS item_category, g.VEN_FLAG AS ven_class,
 (g.HIDE = 'N') AS is_active, g.SALE_UNIT AS standard_unit, g.STRENGTH_UNIT AS strength_text,
 g.DOSAGE_FORM AS dosage_form, coalesce(c.COMPANY_NAME, g.LAST_VENDOR_CODE) AS manufacturer_name
FROM drug_gn g LEFT JOIN company c ON CAST(g.LAST_VENDOR_CODE AS BIGINT) = c.COMPANY_CODE"""

VIEWS["warehouse_src"] = """
SELECT DEPT_ID AS source_warehouse_code, DEPT_NAME AS warehouse_name, DEPT_TYPE AS warehouse_type,
 (HIDE = 'N') AS is_active FROM dept_id"""

VIEWS["vendor_src"] = """
SELECT CAST(COMPANY_CODE AS VARCHAR) AS source_vendor_code, COMPANY_NAME AS vendor_name,
 CASE WHEN VENDOR_FLAG='Y' AND MANUFAC_FLAG='Y' THEN 'both' WHEN VENDOR_FLAG='Y' THEN 'vendor'
      WHEN MANUFAC_FLAG='Y' THEN 'manufacturer' ELSE 'other' END AS vendor_type,
 (HIDE = 'N') AS is_active FROM company"""

VIEWS["d_item"] = f"""
SELECT {_id('source_item_code')} AS dim_item_id, *,
 item_type='1' AS is_drug, item_type='2' AS is_supply FROM item_src
UNION ALL BY NAME
SELECT CAST(0 AS BIGINT) AS dim_item_id, 'UNKNOWN' AS source_item_code, 'Unknown Item' AS item_name,
 false AS is_active, false AS is_drug, false AS is_supply"""

VIEWS["d_warehouse"] = f"""
SELECT {_id('source_warehouse_code')} AS dim_warehouse_id, * FROM warehouse_src
UNION ALL BY NAME
SELECT CAST(0 AS BIGINT) AS dim_warehouse_id, 'UNKNOWN' AS source_warehouse_code,
 'Unknown Warehouse' AS warehouse_name, false AS is_active"""

VIEWS["d_vendor"] = f"""
SELECT {_id('source_vendor_code')} AS dim_vendor_id, * FROM vendor_src
UNION ALL BY NAME
SELECT CAST(0 AS BIGINT) AS dim_vendor_id, 'UNKNOWN' AS source_vendor_code, 'Unknown Vendor' AS vendor_name,
 false AS is_active"""

VIEWS["card_live"] = """
SELECT *, coalesce(STOCK_ID, DEPT_ID) AS wh FROM card WHERE R_S_STATUS IN ('R','S') AND CANCEL_FLAG IS NULL"""

VIEWS["balance_src"] = """
SELECT OPERATE_DATE AS snapshot_date, WORKING_CODE AS source_item_code, wh AS source_warehouse_code,
 sum(REMAIN_QTY) AS qty_on_hand, round(CAST(sum(REMAIN_COST) AS DOUBLE)/count(REMAIN_COST),6) AS avg_unit_cost,
 sum(REMAIN_VALUE) AS stock_value, max(OPERATE_DATE) AS source_updated_ts
FROM card_live GROUP BY ALL"""

VIEWS["lot_balance_src"] = """
SELECT OPERATE_DATE AS snapshot_date, WORKING_CODE AS source_item_code, wh AS source_warehouse_code,
 LOT_NO AS lot_no, EXPIRED_DATE AS expiry_date,
 sum(REMAIN_QTY_LOT) AS qty_on_hand, round(CAST(sum(WT_AVG) AS DOUBLE)/count(WT_AVG),6) AS avg_unit_cost,
 sum(REMAIN_VALUE_LOT) AS stock_value, max(OPERATE_DATE) AS source_updated_ts
FROM card_live WHERE LOT_NO IS NOT NULL AND REMAIN_QTY_LOT IS NOT NULL GROUP BY ALL"""

VIEWS["movement_src"] = f"""
SELECT R_S_NUMBER || '-' || RECORD_NUMBER AS source_txn_id, OPERATE_DATE AS txn_date,
 WORKING_CODE AS source_item_code, wh AS source_warehouse_code,
 CASE R_S_STATUS WHEN 'R' THEN 'receive' WHEN 'S' THEN 'issue' ELSE 'other' END AS movement_type,
 R_S_NUMBER AS ref_doc_no, CASE R_S_STATUS WHEN 'R' THEN 'GR' WHEN 'S' THEN 'ISSUANCE' ELSE 'OTHER' END AS ref_doc_type,
 LOT_NO AS lot_no, EXPIRED_DATE AS expiry_date, ACTIVE_QTY AS qty, COST AS unit_cost, VALUE AS line_value,
 CAST(VENDOR_CODE AS VARCHAR) AS source_vendor_code, OPERATE_DATE AS source_updated_ts
FROM card_live"""

VIEWS["po_src"] = f"""
SELECT p.PO_NO AS po_no, p.PO_DATE AS po_date, c.WORKING_CODE AS source_item_code,
 {_code('c.VENDOR_CODE')} AS source_vendor_code, c.QTY_ORDER AS ordered_qty, c.BUY_UNIT_COST AS ordered_unit_cost,
 CAST(c.QTY_ORDER*c.BUY_UNIT_COST AS DECIMAL(18,2)) AS ordered_value,
 CASE WHEN PROCESS='3' THEN 'received_full' WHEN PROCESS='2' THEN 'received_partial' WHEN PROCESS='1' THEN 'approved'
      WHEN PROCESS='4' OR OK='N' THEN 'cancelled' WHEN OK='Y' THEN 'approved' ELSE 'pending' END AS po_status,
 p.PO_DATE AS source_updated_ts
FROM ms_po p JOIN ms_po_c c ON p.PO_NO=c.PO_NO"""

VIEWS["gr_src"] = f"""
SELECT i.INVOICE_NO AS gr_no, i.INVOICE_DATE AS gr_date, i.PO_NO AS po_no, c.WORKING_CODE AS source_item_code,
 coalesce(c.DEPT_ID, i.DEPT_ID) AS source_warehouse_code, {_code('i.VENDOR_CODE')} AS source_vendor_code,
 c.LOT_NO AS lot_no, c.EXPIRED_DATE AS expiry_date, c.QTY_ORDER AS received_qty, c.BUY_UNIT_COST AS received_unit_cost,
 CAST(c.QTY_ORDER*c.BUY_UNIT_COST AS DECIMAL(18,2)) AS received_value, i.INVOICE_DATE AS source_updated_ts
FROM ms_ivo i JOIN ms_ivo_c c ON i.INVOICE_NO=c.INVOICE_NO WHERE i.RCV_FLAG='Y'"""


def _hash(*parts: str) -> str:
    return "sha256(" + " || '||' || ".join(f"coalesce(trim(CAST({p} AS VARCHAR)),'')" for p in parts) + ")"


_J_ITEM = "LEFT JOIN d_item i ON s.source_item_code=i.source_item_code"
_J_WH = "LEFT JOIN d_warehouse w ON s.source_warehouse_code=w.source_warehouse_code"
_J_VEN = "LEFT JOIN d_vendor v ON s.source_vendor_code=v.source_vendor_code"
_DK = "CAST(strftime({d},'%Y%m%d') AS BIGINT)"

VIEWS["f_stock"] = f"""
SELECT snapshot_date, {_DK.format(d='snapshot_date')} AS snapshot_date_id, coalesce(dim_item_id,0) AS dim_item_id,
 coalesce(dim_warehouse_id,0) AS dim_warehouse_id, qty_on_hand, avg_unit_cost, stock_value,
 CASE WHEN qty_on_hand>0 THEN 'normal' WHEN qty_on_hand=0 THEN 'zero' ELSE 'negative' END AS stock_status
FROM balance_src s {_J_ITEM} {_J_WH}"""

VIEWS["f_lot"] = f"""
SELECT snapshot_date, {_DK.format(d='snapshot_date')} AS snapshot_date_id, coalesce(dim_item_id,0) AS dim_item_id,
 coalesce(dim_warehouse_id,0) AS dim_warehouse_id, lot_no, expiry_date, qty_on_hand, avg_unit_cost, stock_value,
 CAST(expiry_date - snapshot_date AS BIGINT) AS days_to_expiry,
 CASE WHEN expiry_date IS NULL THEN 'no_expiry' WHEN expiry_date<snapshot_date THEN 'expired'
      WHEN expiry_date<=snapshot_date+90 THEN 'near_expiry' ELSE 'healthy' END AS expiry_status
FROM lot_balance_src s {_J_ITEM} {_J_WH}"""

VIEWS["f_move"] = f"""
SELECT source_txn_id, ref_doc_no, ref_doc_type, txn_date, {_DK.format(d='txn_date')} AS txn_date_id,
 coalesce(dim_item_id,0) AS dim_item_id, coalesce(dim_warehouse_id,0) AS dim_warehouse_id,
 coalesce(dim_vendor_id,0) AS dim_vendor_id, movement_type,
 CASE movement_type WHEN 'receive' THEN 'in' WHEN 'issue' THEN 'out' ELSE 'neutral' END AS movement_direction,
 lot_no, expiry_date, qty, CASE movement_type WHEN 'issue' THEN -qty ELSE qty END AS signed_qty, unit_cost, line_value,
 CASE movement_type WHEN 'issue' THEN -coalesce(line_value,0) ELSE coalesce(line_value,0) END AS signed_value,
 {_hash('source_txn_id', 's.source_item_code', 's.source_warehouse_code', 'lot_no', 'movement_type')} AS source_row_hash
FROM movement_src s {_J_ITEM} {_J_WH} {_J_VEN}"""

VIEWS["f_po"] = f"""
SELECT po_no, po_date, {_DK.format(d='po_date')} AS po_date_id, coalesce(dim_item_id,0) AS dim_item_id,
 coalesce(dim_vendor_id,0) AS dim_vendor_id, ordered_qty, ordered_unit_cost, ordered_value, po_status,
 {_hash('po_no', 's.source_item_code')} AS source_row_hash
FROM po_src s {_J_ITEM} {_J_VEN}"""

VIEWS["f_gr"] = f"""
SELECT gr_no, gr_date, {_DK.format(d='gr_date')} AS gr_date_id, po_no, coalesce(dim_item_id,0) AS dim_item_id,
 coalesce(dim_warehouse_id,0) AS dim_warehouse_id, coalesce(dim_vendor_id,0) AS dim_vendor_id, lot_no, expiry_date,
 received_qty, received_unit_cost, received_value,
 {_hash('gr_no', 's.source_item_code', 's.source_warehouse_code', 'lot_no')} AS source_row_hash
FROM gr_src s {_J_ITEM} {_J_WH} {_J_VEN}"""


def doubles(*names: str) -> str:
    """Select items casting the named columns to double."""
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n.split('.')[-1]}" for n in names)


def longs(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n.split('.')[-1]}" for n in names)


# Purchase plan for 1999-06, all stocks -------------------------------------------

VIEWS["p_card"] = """
SELECT STOCK_ID, WORKING_CODE, OPERATE_DATE, RECORD_NUMBER, R_S_STATUS, FREE_FLAG, VALUE, ACTIVE_QTY, REMAIN_QTY,
 year(OPERATE_DATE)*100+month(OPERATE_DATE) AS ym,
 CASE WHEN R_S_STATUS='C' THEN -ACTIVE_QTY ELSE ACTIVE_QTY END AS used
FROM card WHERE STOCK_ID IS NOT NULL AND WORKING_CODE<>''"""

VIEWS["p_use"] = """
SELECT STOCK_ID, WORKING_CODE,
 CAST(sum(CASE WHEN ym BETWEEN 199610 AND 199709 THEN used ELSE 0 END) AS DOUBLE) AS r1,
 CAST(sum(CASE WHEN ym BETWEEN 199710 AND 199809 THEN used ELSE 0 END) AS DOUBLE) AS r2,
 CAST(sum(CASE WHEN ym BETWEEN 199810 AND 199906 THEN used ELSE 0 END) AS DOUBLE)*12/9.0::DOUBLE AS r3
FROM p_card WHERE ym BETWEEN 199610 AND 199906 AND R_S_STATUS IN ('T','S','C')
 AND WORKING_CODE IN (SELECT WORKING_CODE FROM drug_gn) GROUP BY 1,2"""

VIEWS["p_hand"] = """
SELECT STOCK_ID, WORKING_CODE, CAST(REMAIN_QTY AS DOUBLE) AS on_hand FROM p_card WHERE ym<=199906
QUALIFY row_number() OVER (PARTITION BY STOCK_ID, WORKING_CODE ORDER BY OPERATE_DATE DESC, RECORD_NUMBER DESC)=1"""

VIEWS["p_trade_pack"] = """
SELECT WORKING_CODE, LAST_PACK_RATIO AS v FROM drug_vn WHERE LAST_BUY_COST>0
QUALIFY row_number() OVER (PARTITION BY WORKING_CODE ORDER BY LAST_BUY DESC, TRADE_CODE DESC)=1"""

VIEWS["p_receipt_pack"] = """
SELECT WORKING_CODE, CAST(ACTIVE_PACK AS DOUBLE) AS v FROM card WHERE R_S_STATUS='R' AND ACTIVE_PACK>0
QUALIFY row_number() OVER (PARTITION BY WORKING_CODE ORDER BY OPERATE_DATE DESC, RECORD_NUMBER DESC)=1"""

VIEWS["p_invoice_cost"] = """
SELECT l.WORKING_CODE, l.BUY_UNIT_COST AS v FROM ms_ivo_c l LEFT JOIN ms_ivo i ON i.RECEIVE_NO=l.RECEIVE_NO
QUALIFY row_number() OVER (PARTITION BY l.WORKING_CODE
 ORDER BY RECEIVE_DATE DESC NULLS LAST, l.RECEIVE_NO DESC, LINE_NO DESC, TRADE_CODE DESC, BUY_UNIT_COST DESC)=1"""

VIEWS["p_trade_cost"] = """
SELECT WORKING_CODE, LAST_BUY_COST AS v FROM drug_vn
QUALIFY row_number() OVER (PARTITION BY WORKING_CODE ORDER BY LAST_BUY DESC, TRADE_CODE DESC)=1"""

VIEWS["p_free"] = """
SELECT STOCK_ID, WORKING_CODE, CAST(sum(VALUE) AS DOUBLE) AS free_value, CAST(sum(ACTIVE_QTY) AS DOUBLE) AS free_qty
FROM p_card WHERE R_S_STATUS IN ('R','A') AND FREE_FLAG='Y' AND OPERATE_DATE BETWEEN DATE '1998-10-01' AND DATE '1999-06-30'
GROUP BY 1,2"""

VIEWS["p_ratio"] = """
SELECT *, a>0 AS ok FROM (SELECT STOCK_ID, WORKING_CODE, CAST(sum(used) AS DOUBLE) AS a,
 CAST(sum(CASE WHEN month(OPERATE_DATE) IN (10,11,12) THEN used ELSE 0 END) AS DOUBLE) AS t1,
 CAST(sum(CASE WHEN month(OPERATE_DATE) IN (1,2,3) THEN used ELSE 0 END) AS DOUBLE) AS t2,
 CAST(sum(CASE WHEN month(OPERATE_DATE) IN (4,5,6) THEN used ELSE 0 END) AS DOUBLE) AS t3,
 CAST(sum(CASE WHEN month(OPERATE_DATE) IN (7,8,9) THEN used ELSE 0 END) AS DOUBLE) AS t4
FROM p_card WHERE R_S_STATUS IN ('T','S','C') AND OPERATE_DATE BETWEEN DATE '1998-10-01' AND DATE '1999-06-30' GROUP BY 1,2)"""

VIEWS["p_base"] = """
SELECT u.STOCK_ID AS DEPT_ID, u.WORKING_CODE, CAST(2000 AS BIGINT) AS YEAR, CAST(6 AS BIGINT) AS CAL_MONTH, d.MOD_SYS,
 r1 AS RATE_1_YEAR, r2 AS RATE_2_YEAR, r3 AS RATE_3_YEAR, coalesce(h.on_hand,0) AS QTY_ON_HAND,
 f.free_value AS VALUE_FREE_Y3, f.free_qty AS QTY_FREE_Y3,
 coalesce(tp.v, rp.v, d.LAST_PACK_RATIO) AS PACK_RATIO, CAST(coalesce(ic.v, tc.v, g.LAST_BUY_COST) AS DOUBLE) AS PACK_UNIT_COST,
 CASE WHEN coalesce(d.FORECAST,0)>0 THEN d.FORECAST ELSE coalesce(e.FORECAST,0) END AS FORECAST,
 CASE WHEN q.ok THEN q.t1/q.a END AS DISP_RATIO1, CASE WHEN q.ok THEN q.t2/q.a END AS DISP_RATIO2,
 CASE WHEN q.ok THEN q.t3/q.a END AS DISP_RATIO3, CASE WHEN q.ok THEN q.t4/q.a END AS DISP_RATIO4
FROM p_use u JOIN inv_md d ON d.WORKING_CODE=u.WORKING_CODE AND d.DEPT_ID=u.STOCK_ID AND d.FIRST_PACK_RATIO IS NOT NULL
 AND (d.HIDE='N' OR d.HIDE IS NULL OR d.HIDE='')
LEFT JOIN drug_gn g ON g.WORKING_CODE=u.WORKING_CODE LEFT JOIN ed_group e ON e.CODE=g.GROUP_CODE
LEFT JOIN p_hand h ON h.STOCK_ID=u.STOCK_ID AND h.WORKING_CODE=u.WORKING_CODE
LEFT JOIN p_free f ON f.STOCK_ID=u.STOCK_ID AND f.WORKING_CODE=u.WORKING_CODE
LEFT JOIN p_ratio q ON q.STOCK_ID=u.STOCK_ID AND q.WORKING_CODE=u.WORKING_CODE
LEFT JOIN p_trade_pack tp ON tp.WORKING_CODE=u.WORKING_CODE LEFT JOIN p_receipt_pack rp ON rp.WORKING_CODE=u.WORKING_CODE
LEFT JOIN p_invoice_cost ic ON ic.WORKING_CODE=u.WORKING_CODE LEFT JOIN p_trade_cost tc ON tc.WORKING_CODE=u.WORKING_CODE"""

VIEWS["p_avg"] = """
SELECT *, CASE WHEN n>0 THEN round((RATE_1_YEAR+RATE_2_YEAR+RATE_3_YEAR)/n,0) END AS AVG_3_YEAR FROM (SELECT *,
 CASE WHEN RATE_1_YEAR<=0 THEN 0 ELSE 1 END + CASE WHEN RATE_2_YEAR<=0 THEN 0 ELSE 1 END + CASE WHEN RATE_3_YEAR<=0 THEN 0 ELSE 1 END AS n
 FROM p_base)"""

VIEWS["p_pre"] = """
SELECT *, CASE WHEN pre<0 THEN 0 ELSE pre END AS QTY_PRE_PLAN FROM (
 SELECT *, AVG_3_YEAR+round(RATE_3_YEAR/12,0)-QTY_ON_HAND AS pre FROM p_avg)"""

VIEWS["p_need"] = """
SELECT *, (coalesce(QTY_PRE_PLAN,0)+coalesce(QTY_FORECAST,0)-coalesce(QTY_FREE_Y3,0))/coalesce(PACK_RATIO,1) AS need
FROM (SELECT *, QTY_PRE_PLAN*(coalesce(FORECAST,0)/100) AS QTY_FORECAST FROM p_pre)"""

VIEWS["p_qty"] = """
SELECT *, CASE WHEN q2<0 THEN 0 ELSE q2 END AS QTY_THIS_YEAR FROM (
 SELECT *, CASE WHEN q1%4>0 THEN q1+10 ELSE q1 END * coalesce(PACK_RATIO,1) AS q2 FROM (
  SELECT *, floor((need+9)/10)*10 AS q1 FROM p_need))"""

VIEWS["p_plan"] = """
SELECT *, VALUE_THIS_YEAR/4 AS quarter_value, CASE WHEN VALUE_THIS_YEAR>0 THEN
 (SELECT min(BUYMET_CODE) FROM buymethod b WHERE b.HIDE='N' AND b.MIN_AMT<=VALUE_THIS_YEAR AND b.MAX_AMT>=VALUE_THIS_YEAR) ELSE '0' END AS BUYMET_CODE
FROM (SELECT *, round(QTY_THIS_YEAR/12,0) AS MIN_LEVEL,
 CAST(CAST(CAST(coalesce(QTY_THIS_YEAR/coalesce(PACK_RATIO,1),0) AS DECIMAL(18,4))*CAST(coalesce(PACK_UNIT_COST,0) AS DECIMAL(18,6))
  AS DECIMAL(18,2)) AS DOUBLE) AS VALUE_THIS_YEAR FROM p_qty)"""

VIEWS["plan_tracking"] = """
SELECT p.*, BUY_QTY, BUY_VALUE, b1 AS QTY_BUY_TRI1, b2 AS QTY_BUY_TRI2, b3 AS QTY_BUY_TRI3, b4 AS QTY_BUY_TRI4, QTY_THIS_YEAR/4 AS QTY_TRI
FROM p_plan p LEFT JOIN (SELECT source_warehouse_code, source_item_code, CAST(sum(received_qty) AS DOUBLE) AS BUY_QTY,
 CAST(sum(received_value) AS DOUBLE) AS BUY_VALUE,
 CAST(sum(CASE WHEN quarter(gr_date)=4 THEN received_qty END) AS DOUBLE) AS b1,
 CAST(sum(CASE WHEN quarter(gr_date)=1 THEN received_qty END) AS DOUBLE) AS b2,
 CAST(sum(CASE WHEN quarter(gr_date)=2 THEN received_qty END) AS DOUBLE) AS b3,
 CAST(sum(CASE WHEN quarter(gr_date)=3 THEN received_qty END) AS DOUBLE) AS b4
 FROM gr_src WHERE gr_date BETWEEN DATE '1999-10-01' AND DATE '2000-09-30' GROUP BY 1,2) r
 ON r.source_warehouse_code=p.DEPT_ID AND r.source_item_code=p.WORKING_CODE"""


# Report views ----------------------------------------------------------------------

VIEWS["v_balance"] = f"""
SELECT b.dim_item_id, b.dim_warehouse_id, b.quantity, b.last_updated, r.REORDER_QTY AS reorder_point FROM (
 SELECT dim_item_id, dim_warehouse_id, snapshot_date AS last_updated, sum(qty_on_hand) AS quantity FROM f_stock GROUP BY 1,2,3
 QUALIFY row_number() OVER (PARTITION BY dim_item_id, dim_warehouse_id ORDER BY snapshot_date DESC)=1) b
LEFT JOIN (SELECT {_id('WORKING_CODE')} AS dim_item_id, REORDER_QTY FROM drug_gn) r ON r.dim_item_id=b.dim_item_id"""

VIEWS["v_named"] = """
SELECT coalesce(i.source_item_code,'Unknown') AS item_code, coalesce(i.item_name,'Unknown') AS item_name,
 coalesce(w.warehouse_name,'Unknown') AS warehouse, quantity, coalesce(reorder_point,0) AS reorder_point, last_updated
FROM v_balance b LEFT JOIN d_item i ON i.dim_item_id=b.dim_item_id LEFT JOIN d_warehouse w ON w.dim_warehouse_id=b.dim_warehouse_id"""

VIEWS["v_order"] = """
SELECT po_no AS po_number, po_date, f.dim_vendor_id, v.vendor_name, ordered_value AS total_amount,
 CASE po_status WHEN 'approved' THEN 'OPEN' WHEN 'pending' THEN 'PENDING' WHEN 'received_partial' THEN 'PARTIAL'
  WHEN 'received_full' THEN 'CLOSED' WHEN 'cancelled' THEN 'CANCELLED' END AS status
FROM f_po f LEFT JOIN d_vendor v ON v.dim_vendor_id=f.dim_vendor_id"""

VIEWS["v_receipt"] = f"""
SELECT c.INVOICE_NO AS reference_number, i.INVOICE_DATE AS receipt_date, v.vendor_name, c.QTY_ORDER AS total_quantity,
 CASE WHEN i.RCV_FLAG<>'Y' THEN 'PENDING' WHEN p.PROCESS='2' THEN 'PARTIAL'
  WHEN EXISTS (SELECT 1 FROM quali_rcv q WHERE q.QUALI_VALUE='N' AND q.RECEIVE_NO=c.RECEIVE_NO AND q.WORKING_CODE=c.WORKING_CODE) THEN 'AWAITING_QC'
  ELSE 'RECEIVED' END AS status
FROM ms_ivo_c c JOIN ms_ivo i ON i.INVOICE_NO=c.INVOICE_NO LEFT JOIN ms_po p ON p.PO_NO=i.PO_NO
LEFT JOIN vendor_src v ON v.source_vendor_code={_code('i.VENDOR_CODE')}"""

VIEWS["v_move"] = """
SELECT dim_item_id, dim_warehouse_id, CASE movement_type WHEN 'issue' THEN 'CONSUMPTION' ELSE upper(movement_type) END AS movement_type,
 txn_date AS movement_date, expiry_date, qty AS quantity, unit_cost FROM f_move"""

VIEWS["v_budget"] = """
SELECT u.category, u.year, u.month, b.allocated, u.consumed, coalesce(b.allocated,0)-u.consumed AS remaining FROM (
 SELECT category, year(spend_date) AS year, month(spend_date) AS month, sum(amount) AS consumed,
  year(spend_date) + CASE WHEN month(spend_date)>=10 THEN 1 ELSE 0 END AS fy, quarter(spend_date)%4+1 AS fq FROM bdg_use GROUP BY ALL) u
LEFT JOIN (SELECT BUDGET_TYPE, FISCAL_YEAR, q, CAST(round(CAST(amt AS DECIMAL(30,8))/3,2) AS DECIMAL(24,2)) AS allocated FROM (
 SELECT BUDGET_TYPE, FISCAL_YEAR, 1 AS q, BUDGET_AMT_TRI1 AS amt FROM bdg_amt UNION ALL
 SELECT BUDGET_TYPE, FISCAL_YEAR, 2, BUDGET_AMT_TRI2 FROM bdg_amt UNION ALL
 SELECT BUDGET_TYPE, FISCAL_YEAR, 3, BUDGET_AMT_TRI3 FROM bdg_amt UNION ALL
 SELECT BUDGET_TYPE, FISCAL_YEAR, 4, BUDGET_AMT_TRI4 FROM bdg_amt)) b
 ON b.BUDGET_TYPE=u.category AND b.FISCAL_YEAR=u.fy AND b.q=u.fq"""

VIEWS["v_quality"] = """
SELECT q.event_id, q.test_date, g.DRUG_NAME AS item_name, d.DEPT_NAME AS warehouse_name, q.test_type, q.result_status, q.notes
FROM quality_result q LEFT JOIN drug_gn g ON g.WORKING_CODE=q.WORKING_CODE LEFT JOIN dept_id d ON d.DEPT_ID=q.DEPT_ID"""

VIEWS["r_low"] = "SELECT *, quantity AS stock_qty FROM v_named WHERE quantity <= reorder_point"

VIEWS["r_expiring"] = """
SELECT coalesce(i.source_item_code,'Unknown') AS item_code, coalesce(i.item_name,'Unknown') AS item_name,
 coalesce(w.warehouse_name,'Unknown') AS warehouse, expiry_date, quantity AS stock_qty,
 CAST(expiry_date - DATE '1999-06-30' AS BIGINT) AS days_to_expiry
FROM v_move m LEFT JOIN d_item i ON i.dim_item_id=m.dim_item_id LEFT JOIN d_warehouse w ON w.dim_warehouse_id=m.dim_warehouse_id
WHERE expiry_date <= DATE '1999-06-30' + 90 AND quantity>0"""

VIEWS["r_by_item"] = """
SELECT i.source_item_code AS item_code, i.item_name, sum(quantity) AS total_consumed,
 CAST(sum(quantity*unit_cost) AS DECIMAL(24,4)) AS total_cost
FROM v_move m LEFT JOIN d_item i ON i.dim_item_id=m.dim_item_id
WHERE movement_type='CONSUMPTION' AND movement_date >= DATE '1999-06-30' - 30 GROUP BY 1,2 ORDER BY 3 DESC, 1 LIMIT 50"""

VIEWS["r_dead"] = """
SELECT i.source_item_code AS item_code, i.item_name, w.warehouse_name, sum(quantity) AS stock_qty, max(movement_date) AS last_movement,
 CAST(DATE '1999-06-30' - max(movement_date) AS BIGINT) AS days_inactive
FROM v_move m LEFT JOIN d_item i ON i.dim_item_id=m.dim_item_id LEFT JOIN d_warehouse w ON w.dim_warehouse_id=m.dim_warehouse_id
GROUP BY 1,2,3 HAVING max(movement_date) < DATE '1999-06-30' - 90 AND sum(quantity)>0"""

VIEWS["r_moves"] = """
SELECT movement_type, CAST(count(*) AS BIGINT) AS transaction_count, sum(quantity) AS total_quantity,
 CAST(sum(quantity*unit_cost) AS DECIMAL(24,4)) AS total_value
FROM v_move WHERE movement_date >= DATE '1999-06-30' - 30 GROUP BY 1"""

VIEWS["r_vendors"] = """
SELECT dim_vendor_id, vendor_name, CAST(count(*) AS BIGINT) AS order_count, sum(total_amount) AS total_amount,
 round(CAST(sum(total_amount) AS DOUBLE)/count(total_amount),6) AS avg_order_value
FROM v_order WHERE po_date >= DATE '1999-06-30' - 180 GROUP BY 1,2 ORDER BY 4 DESC, 1 LIMIT 10"""

# every vendor and item, for totals and other rankings
for _name in ("r_vendors", "r_by_item"):
    VIEWS[f"{_name}_all"] = VIEWS[_name].rsplit("ORDER BY", 1)[0]

VIEWS["r_burn"] = """
SELECT month, CAST(coalesce(sum(allocated),0) AS DOUBLE) AS budget_allocated, CAST(coalesce(sum(consumed),0) AS DOUBLE) AS budget_consumed,
 CAST(coalesce(sum(remaining),0) AS DOUBLE) AS budget_remaining FROM v_budget WHERE year=1999 GROUP BY 1"""

VIEWS["r_category"] = """
SELECT coalesce(category,'Other') AS category, CAST(coalesce(sum(allocated),0) AS DOUBLE) AS allocated,
 CAST(coalesce(sum(consumed),0) AS DOUBLE) AS consumed, CAST(coalesce(sum(remaining),0) AS DOUBLE) AS remaining
FROM v_budget WHERE year=1999 GROUP BY 1"""

VIEWS["r_quality"] = """
SELECT result_status, CAST(count(*) AS BIGINT) AS count FROM v_quality WHERE test_date >= DATE '2024-01-30' - 30 GROUP BY 1"""

VIEWS["r_monthly"] = """
SELECT year(txn_date) AS YEAR, month(txn_date) AS MONTH, CAST(sum(CASE WHEN movement_direction='out' THEN abs(signed_qty) ELSE 0 END) AS DOUBLE) AS total_quantity,
 CAST(sum(CASE WHEN movement_direction='out' THEN abs(signed_value) ELSE 0 END) AS DOUBLE) AS total_value
FROM f_move WHERE year(txn_date) IN (1998,1999) GROUP BY 1,2"""

VIEWS["r_fresh"] = """
SELECT t AS table_name, d AS last_updated, CAST(date_diff('hour', CAST(d AS TIMESTAMP), TIMESTAMP '2001-12-01 00:00:00') AS DOUBLE) AS hours_since_update
FROM (SELECT 'core.fact_stock_snapshot' AS t, max(snapshot_date) AS d FROM f_stock
 UNION ALL SELECT 'core.fact_stock_lot_snapshot', max(snapshot_date) FROM f_lot
 UNION ALL SELECT 'core.fact_inventory_movement', max(txn_date) FROM f_move
 UNION ALL SELECT 'core.fact_purchase_order_line', max(po_date) FROM f_po
 UNION ALL SELECT 'core.fact_goods_receipt_line', max(gr_date) FROM f_gr)"""


# Subject-area model, snapshot of 2000-06-30 -------------------------------------------

VIEWS["m_snapshot"] = """
SELECT *, CASE WHEN qty_on_hand<=0 THEN 'out' WHEN low_stock_flag THEN 'low' ELSE 'in_stock' END AS stock_status FROM (
SELECT DATE '2000-06-30' AS snapshot_date, c.WORKING_CODE AS working_code, c.TRADE_CODE AS trade_code, c.DEPT_ID AS dept_id,
 c.LOCATION AS location, c.LOT_NO AS lot_no, c.EXPIRED_DATE AS expired_date, CAST(c.VENDOR_CODE AS VARCHAR) AS vendor_code,
 c.QTY_ON_HAND AS qty_on_hand, c.LOT_COST AS lot_cost, c.PACK_COST AS pack_cost,
 coalesce(c.LOT_VALUE, CAST(c.QTY_ON_HAND*c.LOT_COST AS DECIMAL(18,2)), CAST(c.QTY_ON_HAND*c.PACK_COST AS DECIMAL(18,2))) AS stock_value,
 CAST(c.EXPIRED_DATE - DATE '2000-06-30' AS BIGINT) AS days_to_expiry,
 CASE WHEN c.EXPIRED_DATE IS NULL THEN 'no_expiry' WHEN c.EXPIRED_DATE - DATE '2000-06-30'<=0 THEN 'Expired'
  WHEN c.EXPIRED_DATE - DATE '2000-06-30'<=30 THEN '0-30 Days' WHEN c.EXPIRED_DATE - DATE '2000-06-30'<=90 THEN '30-90 Days'
  WHEN c.EXPIRED_DATE - DATE '2000-06-30'<=180 THEN '90-180 Days' ELSE '180+ Days' END AS expiry_bucket,
 coalesce(g.REORDER_QTY, g.MIN_LEVEL, i.MIN_LEVEL) AS reorder_threshold, x.d AS last_movement_date,
 coalesce(DATE '2000-06-30' - x.d >= 180, false) AS dead_stock_flag,
 coalesce(CAST(c.QTY_ON_HAND AS DOUBLE) < coalesce(g.REORDER_QTY, g.MIN_LEVEL, i.MIN_LEVEL), false) AS low_stock_flag,
 c.QTY_ON_HAND<=0 AS out_of_stock_flag
FROM inv_md_c c LEFT JOIN drug_gn g ON g.WORKING_CODE=c.WORKING_CODE
LEFT JOIN inv_md i ON i.WORKING_CODE=c.WORKING_CODE AND i.DEPT_ID=c.DEPT_ID
LEFT JOIN (SELECT WORKING_CODE, TRADE_CODE, DEPT_ID, LOT_NO, max(OPERATE_DATE) AS d FROM card GROUP BY 1,2,3,4) x
 ON x.WORKING_CODE=c.WORKING_CODE AND x.TRADE_CODE=c.TRADE_CODE AND x.DEPT_ID=c.DEPT_ID AND x.LOT_NO=c.LOT_NO)"""

VIEWS["m_move"] = """
SELECT RECORD_NUMBER AS movement_id, OPERATE_DATE AS operate_date, WORKING_CODE AS working_code, TRADE_CODE AS trade_code, DEPT_ID AS dept_id,
 STOCK_ID AS stock_id, LOT_NO AS lot_no, EXPIRED_DATE AS expired_date, CAST(VENDOR_CODE AS VARCHAR) AS vendor_code, R_S_STATUS AS rs_status,
 R_S_NUMBER AS rs_number, VALUE AS value, COST AS cost, ACTIVE_QTY AS active_qty, REMAIN_QTY AS remain_qty, FREE_FLAG AS free_flag,
 CANCEL_FLAG AS cancel_flag, CASE WHEN R_S_STATUS IN ('R','I','B') THEN 'IN' WHEN R_S_STATUS IN ('S','D','O') THEN 'OUT'
  WHEN R_S_STATUS IN ('A','C','X') THEN 'ADJ' ELSE 'UNKNOWN' END AS movement_direction, abs(ACTIVE_QTY) AS movement_qty_abs,
 CAST(CASE WHEN CANCEL_FLAG='Y' THEN 0 ELSE 1 END AS BIGINT) AS valid_flag FROM card"""

VIEWS["m_disp"] = """
SELECT d.RECORD_NUMBER AS dispense_id, CAST(strptime(d.DISP_DATE,'%Y%m%d') AS DATE) AS disp_date, d.MED_CODE AS med_code,
 g.WORKING_CODE AS working_code, CASE WHEN g.WORKING_CODE IS NULL THEN 'unresolved' ELSE 'direct' END AS mapping_status,
 d.DISP_QTY AS disp_qty, d.DISP_DEPT AS disp_dept, coalesce(s.c, CAST(i.WA_COST AS DECIMAL(18,6)), g.LAST_BUY_COST) AS unit_cost_basis,
 CAST(d.DISP_QTY*coalesce(s.c, CAST(i.WA_COST AS DECIMAL(18,6)), g.LAST_BUY_COST) AS DECIMAL(24,2)) AS disp_value
FROM dispensed d LEFT JOIN drug_gn g ON g.WORKING_CODE=d.MED_CODE
LEFT JOIN (SELECT working_code, CAST(round(CAST(sum(stock_value) AS DOUBLE)/CAST(sum(qty_on_hand) AS DOUBLE),6) AS DECIMAL(18,6)) AS c
 FROM m_snapshot WHERE qty_on_hand>0 AND stock_value IS NOT NULL GROUP BY 1) s ON s.working_code=g.WORKING_CODE
LEFT JOIN inv_md i ON i.WORKING_CODE=g.WORKING_CODE AND i.DEPT_ID=d.DISP_DEPT"""

VIEWS["m_request"] = """
SELECT REQ_NO AS req_no, WORKING_CODE AS working_code, QTY_REQ AS qty_req, QTY_DIST AS qty_dist,
 CAST(try_strptime(REQ_DATE,'%Y%m%d') AS DATE) AS req_date, CAST(try_strptime(nullif(CONFIRM_DATE,'00000000'),'%Y%m%d') AS DATE) AS confirm_date,
 DEPT_ID AS dept_id, DEL_FLAG AS del_flag, round(CAST(QTY_DIST AS DOUBLE)/nullif(CAST(QTY_REQ AS DOUBLE),0),6) AS fill_rate,
 QTY_REQ-QTY_DIST AS pending_qty FROM accr_disp"""

VIEWS["m_budget"] = """
SELECT FISCAL_YEAR AS fiscal_year, a.BUDGET_TYPE AS budget_type, t.BUDGET_NAME AS budget_name, BUDGET_AMOUNT AS budget_amount, TOTAL_BUY AS total_buy,
 BUDGET_REMAIN AS budget_remain, DEBT AS debt, BUDGET_AMT_TRI1 AS tri1_budget, BUDGET_AMT_TRI2 AS tri2_budget, BUDGET_AMT_TRI3 AS tri3_budget,
 BUDGET_AMT_TRI4 AS tri4_budget, TOTAL_BUY_TRI1 AS tri1_buy, TOTAL_BUY_TRI2 AS tri2_buy, TOTAL_BUY_TRI3 AS tri3_buy, TOTAL_BUY_TRI4 AS tri4_buy,
 BUDGET_AMT_TRI1-TOTAL_BUY_TRI1 AS tri1_remain, BUDGET_AMT_TRI2-TOTAL_BUY_TRI2 AS tri2_remain, BUDGET_AMT_TRI3-TOTAL_BUY_TRI3 AS tri3_remain,
 BUDGET_AMT_TRI4-TOTAL_BUY_TRI4 AS tri4_remain,
 CASE WHEN BUDGET_AMOUNT>0 THEN round(CAST(TOTAL_BUY AS DOUBLE)/CAST(BUDGET_AMOUNT AS DOUBLE),6) END AS burn_rate
FROM bdg_amt a LEFT JOIN bdg_type t ON t.BUDGET_TYPE=a.BUDGET_TYPE"""

VIEWS["m_contract"] = f"""
SELECT c.CNT_NO AS cnt_no, WORKING_CODE AS working_code, TRADE_CODE AS trade_code, {_code('PARTIES_CODE')} AS vendor_contract_ref,
 CAST(strptime(EFFECTIVE_DATE,'%Y%m%d') AS DATE) AS effective_date, CAST(try_strptime(nullif(END_DATE,'00000000'),'%Y%m%d') AS DATE) AS contract_end_date,
 QTY_CNT AS qty_cnt, COST_CNT AS cost_cnt, COST_REMAIN AS cost_remain, TOTAL_COST AS total_contract_cost,
 round(CAST(COST_CNT-COST_REMAIN AS DOUBLE)/nullif(CAST(COST_CNT AS DOUBLE),0),6) AS utilization_rate
FROM cnt_c c JOIN cnt h ON h.CNT_NO=c.CNT_NO"""
