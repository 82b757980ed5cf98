"""Source tables derived from the supplied parquet tables.

The operational system is described only by its DDL, so each of its tables is
expressed here as portable SQL over the supplied tables.  ``{name}`` marks an
input: another adapter or a parquet table.
"""

from __future__ import annotations

import re

_ITEM = "lpad(CAST({k} AS STRING),12,'0')"


def _item(key: str) -> str:
    return _ITEM.replace("{k}", key)


ADAPTERS: dict[str, str] = {}

ADAPTERS["drug_gn"] = f"""
SELECT {_item('p_partkey')} AS WORKING_CODE,
 CASE WHEN p_partkey%101=0 THEN ' ' ELSE p_name END AS DRUG_NAME,
 upper(substr(p_name,1,15)) AS DRUG_NAME_KEY, p_brand AS GROUP_CODE, p_type AS GROUP_KEY,
 CASE WHEN p_size%4=0 THEN '2' ELSE '1' END AS SUPPLY_TYPE,
 CASE p_size%3 WHEN 0 THEN 'V' WHEN 1 THEN 'E' ELSE 'N' END AS VEN_FLAG,
 CASE WHEN p_size%10=0 THEN 'Y' ELSE 'N' END AS HIDE,
 concat('U',CAST(p_size%5 AS STRING)) AS SALE_UNIT, p_size%5 AS SALE_UNIT_ID,
 concat(CAST(p_size AS STRING),' mg') AS STRENGTH_UNIT, p_type AS DOSAGE_FORM, p_size%7 AS DFORM_ID,
 CASE p_size%6 WHEN 0 THEN 'Y' WHEN 1 THEN CAST(NULL AS STRING) ELSE 'N' END AS USE_TRADE_DIS,
 p_size%6 AS IS_ED, p_size%8 AS ED_LIST_NO, p_size%14 AS CLASS_NO, p_size%4 AS HOSP_LIST,
 CASE WHEN p_size%3=0 THEN CAST(NULL AS INT) ELSE p_size END AS COLOR,
 CASE WHEN p_size%5=0 THEN CAST(NULL AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS REORDER_QTY,
 CASE WHEN p_size%15=0 THEN CAST(NULL AS DOUBLE) ELSE CAST(p_size%7 AS DOUBLE) END AS MIN_LEVEL,
 CAST(p_retailprice AS DECIMAL(18,6)) AS LAST_BUY_COST,
 CASE WHEN p_partkey%9=0 THEN '999999' ELSE concat('00',CAST(p_partkey%10 AS STRING)) END AS LAST_VENDOR_CODE
FROM {{part}}"""

ADAPTERS["company"] = """
SELECT s_suppkey AS COMPANY_CODE, s_name AS COMPANY_NAME,
 CASE WHEN s_suppkey%2=0 THEN 'Y' ELSE 'N' END AS VENDOR_FLAG,
 CASE WHEN s_suppkey%3=0 THEN 'Y' ELSE 'N' END AS MANUFAC_FLAG,
 CASE WHEN s_acctbal<0 THEN 'Y' ELSE 'N' END AS HIDE
FROM {supplier}"""

ADAPTERS["dept_id"] = """
SELECT concat('D',lpad(CAST(n_nationkey AS STRING),2,'0')) AS DEPT_ID, n_name AS DEPT_NAME,
 CAST(n_regionkey AS STRING) AS DEPT_TYPE,
 CASE WHEN n_nationkey%2=0 THEN 'Y' ELSE 'N' END AS KEEP_INV,
 CASE WHEN n_nationkey%11=0 THEN 'Y' ELSE 'N' END AS HIDE
FROM {nation} WHERE n_nationkey<>24"""

ADAPTERS["card"] = f"""
SELECT concat_ws('.',CAST(l_orderkey AS STRING),CAST(l_linenumber AS STRING),CAST(l_partkey AS STRING),
   CAST(l_suppkey AS STRING),CAST(CAST(l_shipdate AS DATE) AS STRING)) AS RECORD_NUMBER,
 CASE WHEN l_partkey%97=0 THEN 'ZZZZZZZ' ELSE {_item('l_partkey')} END AS WORKING_CODE,
 l_partkey AS ITEM_NO,
 concat('T',CAST(l_partkey AS STRING),'.',CAST(l_suppkey AS STRING)) AS TRADE_CODE,
 CAST(l_shipdate AS DATE) AS OPERATE_DATE,
 replace(CAST(CAST(l_shipdate AS DATE) AS STRING),'-','') AS R_S_DATE,
 CASE WHEN l_returnflag='A' THEN 'R' WHEN l_returnflag='N' THEN 'S'
      WHEN l_linestatus='F' THEN 'C' ELSE 'T' END AS R_S_STATUS,
 concat(CASE WHEN l_returnflag='A' THEN 'G' ELSE 'I' END, CAST(l_orderkey AS STRING)) AS R_S_NUMBER,
 CASE WHEN l_linenumber=1 THEN CAST(NULL AS STRING)
      ELSE concat('D',lpad(CAST(c_nationkey AS STRING),2,'0')) END AS STOCK_ID,
 concat('D',lpad(CAST(c_nationkey AS STRING),2,'0')) AS DEPT_ID, l_suppkey AS VENDOR_CODE,
 CASE WHEN l_linenumber=2 THEN CAST(NULL AS STRING) ELSE concat('L',CAST(l_partkey%50 AS STRING)) END AS LOT_NO,
 CASE WHEN l_linenumber=3 THEN CAST(NULL AS DATE)
      ELSE CAST(l_shipdate AS DATE) + CAST(l_partkey%400-30 AS INT) END AS EXPIRED_DATE,
 CASE WHEN l_discount>=0.10 THEN 'Y' ELSE CAST(NULL AS STRING) END AS CANCEL_FLAG,
 CASE WHEN l_tax>=0.08 THEN 'Y' ELSE 'N' END AS FREE_FLAG,
 CAST(l_quantity AS DECIMAL(18,4)) AS ACTIVE_QTY,
 CAST(l_partkey%6*5 AS DECIMAL(18,4)) AS ACTIVE_PACK,
 CAST(CAST(l_extendedprice/l_quantity AS DECIMAL(20,8)) AS DECIMAL(18,6)) AS COST,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS VALUE,
 CAST(l_quantity-10 AS DECIMAL(18,4)) AS REMAIN_QTY,
 CAST(CAST(l_extendedprice/l_quantity AS DECIMAL(20,8)) AS DECIMAL(18,6)) AS REMAIN_COST,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS REMAIN_VALUE,
 CASE WHEN l_linenumber=4 THEN CAST(NULL AS DECIMAL(18,4))
      ELSE CAST(l_quantity-5 AS DECIMAL(18,4)) END AS REMAIN_QTY_LOT,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS REMAIN_VALUE_LOT,
 CAST(CAST(l_extendedprice/l_quantity AS DECIMAL(20,8)) AS DECIMAL(18,6)) AS WT_AVG
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey=o_orderkey JOIN {{customer}} ON o_custkey=c_custkey"""

ADAPTERS["ms_po"] = """
SELECT concat('P',CAST(o_orderkey AS STRING)) AS PO_NO, CAST(o_orderdate AS DATE) AS PO_DATE,
 CASE o_orderstatus WHEN 'F' THEN '3' WHEN 'P' THEN '2'
      ELSE CASE WHEN o_orderkey%7=0 THEN '4' WHEN o_orderkey%7=1 THEN '1' ELSE '0' END END AS PROCESS,
 CASE WHEN substr(o_orderpriority,1,1)='5' THEN 'N' WHEN substr(o_orderpriority,1,1)='1' THEN 'Y'
      ELSE CAST(NULL AS STRING) END AS OK
FROM {orders}"""

ADAPTERS["ms_po_c"] = f"""
SELECT concat('P',CAST(l_orderkey AS STRING)) AS PO_NO,
 CASE WHEN l_partkey%97=0 THEN 'ZZZZZZZ' ELSE {_item('l_partkey')} END AS WORKING_CODE,
 CASE WHEN l_suppkey%25=0 THEN CAST(NULL AS STRING) ELSE concat('00',CAST(l_suppkey AS STRING)) END AS VENDOR_CODE,
 CAST(l_quantity AS DECIMAL(18,4)) AS QTY_ORDER,
 CAST(CAST(l_extendedprice/l_quantity AS DECIMAL(20,8)) AS DECIMAL(18,6)) AS BUY_UNIT_COST
FROM {{lineitem}}"""

ADAPTERS["ms_ivo"] = """
SELECT concat('V',CAST(o_orderkey AS STRING)) AS INVOICE_NO,
 CAST(o_orderdate AS DATE) + CAST(o_orderkey%45-3 AS INT) AS INVOICE_DATE,
 concat('P',CAST(o_orderkey AS STRING)) AS PO_NO,
 concat('D',lpad(CAST(o_custkey%25 AS STRING),2,'0')) AS DEPT_ID,
 CASE WHEN o_custkey%40=0 THEN CAST(NULL AS STRING) ELSE concat('0',CAST(o_custkey%120 AS STRING)) END AS VENDOR_CODE,
 CASE WHEN o_orderkey%5=0 THEN 'N' ELSE 'Y' END AS RCV_FLAG,
 concat('R',CAST(o_orderkey AS STRING)) AS RECEIVE_NO,
 CAST(o_orderdate AS DATE) + CAST(o_orderkey%45 AS INT) AS RECEIVE_DATE
FROM {orders}"""

ADAPTERS["ms_ivo_c"] = f"""
SELECT concat('V',CAST(l_orderkey AS STRING)) AS INVOICE_NO,
 concat('R',CAST(l_orderkey AS STRING)) AS RECEIVE_NO, CAST(l_linenumber AS BIGINT) AS LINE_NO,
 CASE WHEN l_partkey%97=0 THEN 'ZZZZZZZ' ELSE {_item('l_partkey')} END AS WORKING_CODE,
 concat('T',CAST(l_partkey AS STRING),'.',CAST(l_suppkey AS STRING)) AS TRADE_CODE,
 CASE WHEN l_linenumber=1 THEN CAST(NULL AS STRING)
      ELSE concat('D',lpad(CAST(l_suppkey%26 AS STRING),2,'0')) END AS DEPT_ID,
 CASE WHEN l_linenumber=2 THEN CAST(NULL AS STRING) ELSE concat('L',CAST(l_partkey%50 AS STRING)) END AS LOT_NO,
 CASE WHEN l_linenumber=3 THEN CAST(NULL AS DATE)
      ELSE CAST(l_shipdate AS DATE) + CAST(l_partkey%400-30 AS INT) END AS EXPIRED_DATE,
 CAST(l_quantity AS DECIMAL(18,4)) AS QTY_ORDER,
 CAST(CAST(l_extendedprice/l_quantity AS DECIMAL(20,8)) AS DECIMAL(18,6)) AS BUY_UNIT_COST
FROM {{lineitem}} WHERE l_linestatus='F'"""

ADAPTERS["inv_md_c"] = """
SELECT WORKING_CODE, TRADE_CODE, DEPT_ID, concat('LOC',CAST(min(ITEM_NO)%4 AS STRING)) AS LOCATION,
 LOT_NO, EXPIRED_DATE, max(VENDOR_CODE) AS VENDOR_CODE, min(REMAIN_QTY) AS QTY_ON_HAND,
 CASE WHEN min(ITEM_NO)%6=0 THEN CAST(NULL AS DECIMAL(18,6)) ELSE max(COST) END AS LOT_COST,
 CASE WHEN min(ITEM_NO)%12=0 THEN CAST(NULL AS DECIMAL(18,6)) ELSE CAST(max(COST) AS DECIMAL(18,2)) END AS PACK_COST,
 CASE WHEN min(ITEM_NO)%3=0 THEN CAST(NULL AS DECIMAL(18,2)) ELSE max(REMAIN_VALUE) END AS LOT_VALUE
FROM {card} GROUP BY WORKING_CODE, TRADE_CODE, DEPT_ID, LOT_NO, EXPIRED_DATE"""

ADAPTERS["inv_md"] = """
SELECT WORKING_CODE, DEPT_ID, CAST(min(ITEM_NO)%9 AS DOUBLE) AS MIN_LEVEL,
 CASE WHEN min(ITEM_NO)%3=0 THEN CAST(NULL AS DOUBLE) ELSE CAST(min(ITEM_NO)%30 AS DOUBLE) END AS FORECAST,
 CASE WHEN min(ITEM_NO)%10=9 THEN CAST(NULL AS DOUBLE) ELSE CAST(min(ITEM_NO)%5*10+10 AS DOUBLE) END AS FIRST_PACK_RATIO,
 CASE WHEN min(ITEM_NO)%4=1 THEN CAST(NULL AS DOUBLE) ELSE CAST(min(ITEM_NO)%3*10+10 AS DOUBLE) END AS LAST_PACK_RATIO,
 CASE WHEN min(ITEM_NO)%4=0 THEN CAST(NULL AS DECIMAL(18,6))
      ELSE CAST(sum(VALUE) AS DECIMAL(18,2)) END AS WA_COST,
 CASE min(ITEM_NO)%3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS ABC_FLAG,
 max(OPERATE_DATE) AS LAST_UPDATE,
 CASE min(ITEM_NO)%8 WHEN 0 THEN 'Y' WHEN 1 THEN '' WHEN 2 THEN CAST(NULL AS STRING) ELSE 'N' END AS HIDE,
 'MED' AS MOD_SYS, sum(REMAIN_QTY) AS QTY_ON_HAND
FROM {card} GROUP BY WORKING_CODE, DEPT_ID"""

ADAPTERS["drug_vn"] = f"""
SELECT concat('T',CAST(l_partkey AS STRING),'.',CAST(l_suppkey AS STRING)) AS TRADE_CODE,
 CASE WHEN l_partkey%97=0 THEN 'ZZZZZZZ' ELSE {_item('l_partkey')} END AS WORKING_CODE,
 concat('00',CAST(l_suppkey AS STRING)) AS VENDOR_CODE,
 concat('0',CAST(l_suppkey%110 AS STRING)) AS MANUFAC_CODE,
 concat('Trade ',CAST(l_partkey AS STRING),' by ',CAST(l_suppkey AS STRING)) AS TRADE_NAME,
 CAST(l_partkey%4*10+10 AS DOUBLE) AS PACK_RATIO,
 CASE WHEN l_partkey%5=0 THEN CAST(NULL AS DOUBLE) ELSE CAST(l_suppkey%4*10+10 AS DOUBLE) END AS LAST_PACK_RATIO,
 CASE WHEN l_suppkey%6=0 THEN CAST(0 AS DECIMAL(18,6))
      ELSE CAST(CAST(max(l_extendedprice) AS DECIMAL(18,2)) AS DECIMAL(18,6)) END AS LAST_BUY_COST,
 max(CAST(l_shipdate AS DATE)) AS LAST_BUY,
 CASE WHEN l_partkey%13=0 THEN 'Y' WHEN l_partkey%13=1 THEN CAST(NULL AS STRING) ELSE 'N' END AS HIDE,
 CASE WHEN l_suppkey%20=0 THEN 'SUP' ELSE 'MED' END AS MOD_SYS
FROM {{lineitem}} GROUP BY l_partkey, l_suppkey"""

ADAPTERS["pack_ratio"] = """
SELECT WORKING_CODE, TRADE_CODE, CASE WHEN LAST_PACK_RATIO IS NULL THEN CAST(NULL AS DOUBLE) ELSE PACK_RATIO END AS PACK_RATIO,
 concat('885',TRADE_CODE) AS BAR_CODE,
 CASE WHEN length(TRADE_CODE)%3=0 THEN CAST(NULL AS INT) ELSE length(TRADE_CODE)%3 END AS PACK_CODE, LAST_BUY FROM {drug_vn}"""

ADAPTERS["dispensed"] = """
SELECT RECORD_NUMBER, R_S_DATE AS DISP_DATE, WORKING_CODE AS MED_CODE, ACTIVE_QTY AS DISP_QTY,
 DEPT_ID AS DISP_DEPT FROM {card} WHERE R_S_STATUS='S' AND CANCEL_FLAG IS NULL"""

ADAPTERS["accr_disp"] = f"""
SELECT concat('Q',CAST(event_id AS STRING)) AS REQ_NO, {_item('user_id')} AS WORKING_CODE,
 CASE WHEN event_type='view' THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(value AS DECIMAL(18,4)) END AS QTY_REQ,
 CASE WHEN event_type='view' THEN CAST(0 AS DECIMAL(18,4))
      ELSE CAST(floor(value*0.8) AS DECIMAL(18,4)) END AS QTY_DIST,
 replace(CAST(CAST(ts AS DATE) AS STRING),'-','') AS REQ_DATE,
 CASE WHEN event_id%10=0 THEN '00000000' ELSE replace(CAST(CAST(ts AS DATE)+2 AS STRING),'-','') END AS CONFIRM_DATE,
 concat('D',lpad(CAST(event_id%25 AS STRING),2,'0')) AS DEPT_ID,
 CASE WHEN event_id%50=0 THEN 'Y' ELSE 'N' END AS DEL_FLAG
FROM {{events}}"""

ADAPTERS["bdg_spend"] = """
SELECT c_mktsegment AS BUDGET_TYPE,
 CAST(year(CAST(o_orderdate AS DATE)) AS BIGINT) + CASE WHEN month(CAST(o_orderdate AS DATE))>=10 THEN 1 ELSE 0 END AS FISCAL_YEAR,
 sum(CAST(o_totalprice AS DECIMAL(18,2))) AS SPENT,
 sum(CASE WHEN month(CAST(o_orderdate AS DATE)) IN (10,11,12) THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS T1,
 sum(CASE WHEN month(CAST(o_orderdate AS DATE)) IN (1,2,3) THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS T2,
 sum(CASE WHEN month(CAST(o_orderdate AS DATE)) IN (4,5,6) THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS T3,
 sum(CASE WHEN month(CAST(o_orderdate AS DATE)) IN (7,8,9) THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS T4
FROM {orders} JOIN {customer} ON o_custkey=c_custkey GROUP BY 1, 2"""

ADAPTERS["bdg_amt"] = """
SELECT s.BUDGET_TYPE, s.FISCAL_YEAR,
 CAST(coalesce(p.SPENT,0)*1.1 AS DECIMAL(24,2)) AS BUDGET_AMOUNT, CAST(s.SPENT AS DECIMAL(24,2)) AS TOTAL_BUY,
 CAST(coalesce(p.SPENT,0)*1.1 AS DECIMAL(24,2)) - CAST(s.SPENT AS DECIMAL(24,2)) AS BUDGET_REMAIN,
 CAST(s.T4*0.1 AS DECIMAL(24,2)) AS DEBT,
 CAST(coalesce(p.T1,0)*1.1 AS DECIMAL(24,2)) AS BUDGET_AMT_TRI1, CAST(coalesce(p.T2,0)*1.1 AS DECIMAL(24,2)) AS BUDGET_AMT_TRI2,
 CAST(coalesce(p.T3,0)*1.1 AS DECIMAL(24,2)) AS BUDGET_AMT_TRI3, CAST(coalesce(p.T4,0)*1.1 AS DECIMAL(24,2)) AS BUDGET_AMT_TRI4,
 CAST(s.T1 AS DECIMAL(24,2)) AS TOTAL_BUY_TRI1, CAST(s.T2 AS DECIMAL(24,2)) AS TOTAL_BUY_TRI2,
 CAST(s.T3 AS DECIMAL(24,2)) AS TOTAL_BUY_TRI3, CAST(s.T4 AS DECIMAL(24,2)) AS TOTAL_BUY_TRI4
FROM {bdg_spend} s LEFT JOIN {bdg_spend} p ON p.BUDGET_TYPE=s.BUDGET_TYPE AND p.FISCAL_YEAR=s.FISCAL_YEAR-1"""

ADAPTERS["bdg_use"] = """
SELECT c_mktsegment AS category, CAST(o_orderdate AS DATE) AS spend_date, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM {orders} JOIN {customer} ON o_custkey=c_custkey"""

ADAPTERS["bdg_type"] = """
SELECT DISTINCT c_mktsegment AS BUDGET_TYPE, concat('Budget ',c_mktsegment) AS BUDGET_NAME,
 CASE WHEN c_mktsegment='FURNITURE' THEN 'Y' ELSE 'N' END AS HIDE FROM {customer}"""

ADAPTERS["cnt"] = """
SELECT concat('K',CAST(o_orderkey AS STRING)) AS CNT_NO,
 concat('00',CAST(o_custkey%120 AS STRING)) AS PARTIES_CODE,
 replace(CAST(CAST(o_orderdate AS DATE) AS STRING),'-','') AS EFFECTIVE_DATE,
 CASE WHEN o_orderkey%11=0 THEN '00000000'
      ELSE replace(CAST(CAST(o_orderdate AS DATE)+365 AS STRING),'-','') END AS END_DATE,
 CAST(o_totalprice AS DECIMAL(18,2)) AS TOTAL_COST
FROM {orders} WHERE substr(o_orderpriority,1,1)='1'"""

ADAPTERS["cnt_c"] = f"""
SELECT concat('K',CAST(l_orderkey AS STRING)) AS CNT_NO, {_item('l_partkey')} AS WORKING_CODE,
 concat('T',CAST(l_partkey AS STRING),'.',CAST(l_suppkey AS STRING)) AS TRADE_CODE,
 CAST(l_quantity AS DECIMAL(18,4)) AS QTY_CNT,
 CASE WHEN l_discount=0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS COST_CNT,
 CASE WHEN l_discount=0 THEN CAST(0 AS DECIMAL(18,2))
      ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2))*CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) END AS COST_REMAIN
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey=o_orderkey WHERE substr(o_orderpriority,1,1)='1'"""

ADAPTERS["inv_rtn_c"] = f"""
SELECT concat('N',CAST(l_orderkey AS STRING)) AS RETURN_NO, {_item('l_partkey')} AS WORKING_CODE,
 CAST(l_quantity AS DECIMAL(18,4)) AS RETURN_QTY, CAST(l_extendedprice AS DECIMAL(18,2)) AS RETURN_COST,
 CAST(l_linenumber%5 AS BIGINT) AS REASON_ID, replace(CAST(CAST(l_shipdate AS DATE) AS STRING),'-','') AS RETURN_DATE
FROM {{lineitem}} WHERE l_returnflag='R'"""

ADAPTERS["rtn_reason"] = """
SELECT * FROM (VALUES (CAST(0 AS BIGINT),'expired'),(CAST(1 AS BIGINT),'damaged'),(CAST(2 AS BIGINT),'recalled'),
 (CAST(3 AS BIGINT),'overstock')) AS t(REASON_ID, REASON_NAME)"""

ADAPTERS["quali_rcv"] = """
SELECT RECEIVE_NO, WORKING_CODE, TRADE_CODE, LOT_NO, LINE_NO AS QUALI_ID,
 CASE WHEN QTY_ORDER>=45 THEN 'N' ELSE 'Y' END AS QUALI_VALUE FROM {ms_ivo_c}"""

ADAPTERS["quality_result"] = f"""
SELECT event_id, CAST(ts AS DATE) AS test_date, {_item('user_id')} AS WORKING_CODE,
 concat('D',lpad(CAST(event_id%25 AS STRING),2,'0')) AS DEPT_ID,
 CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'PASSED' END AS result_status,
 event_type AS test_type, props AS notes
FROM {{events}}"""

ADAPTERS["buymethod"] = """
SELECT * FROM (VALUES ('1',CAST(0 AS DECIMAL(18,2)),CAST(100000 AS DECIMAL(18,2)),'N'),
 ('2',CAST(100000 AS DECIMAL(18,2)),CAST(1000000 AS DECIMAL(18,2)),'N'),
 ('3',CAST(500000 AS DECIMAL(18,2)),CAST(5000000 AS DECIMAL(18,2)),'Y'),
 ('4',CAST(1000000 AS DECIMAL(18,2)),CAST(999999999999 AS DECIMAL(18,2)),'N')) AS t(BUYMET_CODE, MIN_AMT, MAX_AMT, HIDE)"""

ADAPTERS["ed_group"] = """
SELECT DISTINCT p_brand AS CODE, CAST(length(p_brand) AS DOUBLE) AS FORECAST FROM {part}"""

ADAPTERS["sale_unit"] = "\nSELECT r_regionkey AS SU_ID, concat('unit ',r_name) AS SALE_UNIT FROM {region}"
ADAPTERS["dosage_form"] = "\nSELECT n_nationkey AS DFORM_ID, concat('form ',n_name) AS DFORM_NAME FROM {nation}"
ADAPTERS["hosp_list"] = """
SELECT * FROM (VALUES (0,'basic'),(1,'restricted'),(2,'special')) AS t(HOSP_LIST_CODE, PROD_TYPE)"""
ADAPTERS["inst_name"] = f"""
SELECT {_item('p_partkey')} AS REF_CODE, concat(p_type,' ',p_name) AS INST_NAME FROM {{part}} WHERE p_size%2=0"""
ADAPTERS["inv_site"] = f"""
SELECT {_item('p_partkey')} AS WORKING_CODE, 'HOS01' AS DEPT_ID FROM {{part}} WHERE p_size%3<>0"""

# Movements in event time, for the streaming path.
ADAPTERS["movement_event"] = f"""
SELECT event_id, ts, {_item('user_id')} AS source_item_code,
 concat('D',lpad(CAST(event_id%25 AS STRING),2,'0')) AS source_warehouse_code,
 CASE event_type WHEN 'purchase' THEN 'receive' WHEN 'view' THEN 'issue' WHEN 'click' THEN 'transfer_out'
      WHEN 'signup' THEN 'transfer_in' ELSE 'other' END AS movement_type,
 CAST(value AS DECIMAL(18,4)) AS qty
FROM {{events}}"""

#: Joins in the order Spark is to take, for the same rows: (as written, as run).  The narrow headers of the card meet first,
#: so its wide lines are shuffled once, and all readers of the card in one plan share the shuffle of the headers.
JOIN_ORDER = {"card": ("{lineitem} JOIN {orders} ON l_orderkey=o_orderkey JOIN {customer} ON o_custkey=c_custkey",
                       "{lineitem} JOIN (SELECT o_orderkey, c_nationkey FROM {orders} JOIN {customer} ON o_custkey=c_custkey) ON l_orderkey=o_orderkey")}


def plan_text(name: str) -> str:
    """The adapter's text with its joins in the order Spark is to take."""
    return ADAPTERS[name].replace(*JOIN_ORDER[name]) if name in JOIN_ORDER else ADAPTERS[name]


PARQUET_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def inputs_of(sql: str) -> list[str]:
    """Names marked as inputs in an adapter text, in order of first use."""
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))
