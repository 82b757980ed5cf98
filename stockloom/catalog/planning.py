"""Registered queries: purchase plan, on-hand lots, search, monthly balance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stockloom.catalog.registry import query
from stockloom.catalog.views import doubles
from stockloom.operators import planning as P
from stockloom.plans.nameindex import NameIndex, catalogue_names
from stockloom.plans.store import Store, work_folder
from stockloom.sources import extract

AS_OF = dt.date(1999, 6, 30)
YEAR, MONTH, PLAN_YEAR = 1999, 6, 2000
CNT = "CAST(count(*) AS BIGINT) AS row_count"


def plan_of(w):
    return P.buy_plan(w.src, YEAR, MONTH, PLAN_YEAR)


def tracked_plan(w):
    receipts = extract.goods_receipt_line(w.src.ms_ivo, w.src.ms_ivo_c)
    return P.plan_tracking(plan_of(w), receipts, PLAN_YEAR)


def _part(name, view, *columns):
    """Register one step of the plan: its key and the columns the step adds."""
    @query(name, f"SELECT DEPT_ID, WORKING_CODE, {', '.join(columns)} FROM {view}")
    def _(w):
        return plan_of(w).select("DEPT_ID", "WORKING_CODE", *columns)


@query("pln_01_fiscal_windows", """
SELECT CAST(CASE WHEN ym BETWEEN 199610 AND 199709 THEN 1 WHEN ym BETWEEN 199710 AND 199809 THEN 2
 WHEN ym BETWEEN 199810 AND 199906 THEN 3 ELSE 0 END AS BIGINT) AS plan_window, CAST(count(*) AS BIGINT) AS row_count,
 min(OPERATE_DATE) AS first_day, max(OPERATE_DATE) AS last_day FROM p_card GROUP BY 1""")
def _(w):
    win = P.plan_windows(YEAR, MONTH)
    number = F.lit(0)
    for i, bounds in enumerate((win.year_1, win.year_2, win.year_3), 1):
        number = F.when(P._within(bounds), i).otherwise(number)
    rows = w.src.card.filter("STOCK_ID IS NOT NULL AND WORKING_CODE <> ''")
    return rows.groupBy(number.alias("plan_window")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("OPERATE_DATE").alias("first_day"), F.max("OPERATE_DATE").alias("last_day"))


_part("pln_02_usage_rates", "p_plan", "RATE_1_YEAR", "RATE_2_YEAR", "RATE_3_YEAR")
_part("pln_03_on_hand", "p_plan", "QTY_ON_HAND")
_part("pln_04_pack_ratio", "p_plan", "PACK_RATIO")
_part("pln_05_unit_cost", "p_plan", "PACK_UNIT_COST")
_part("pln_06_forecast_percent", "p_plan", "FORECAST")
_part("pln_07_average_usage", "p_plan", "AVG_3_YEAR")
_part("pln_08_pre_plan", "p_plan", "QTY_PRE_PLAN", "QTY_FORECAST")
_part("pln_09_free_goods", "p_plan", "VALUE_FREE_Y3", "QTY_FREE_Y3")
_part("pln_10_order_quantity", "p_plan", "QTY_THIS_YEAR")
_part("pln_12_quarter_ratio", "p_plan", "DISP_RATIO1", "DISP_RATIO2", "DISP_RATIO3", "DISP_RATIO4")
_part("pln_13_purchase_method", "p_plan", "VALUE_THIS_YEAR", "BUYMET_CODE")


@query("pln_11_values_and_quarters", """
SELECT DEPT_ID, WORKING_CODE, MIN_LEVEL, VALUE_THIS_YEAR, QTY_THIS_YEAR AS REMAIN_QTY, VALUE_THIS_YEAR AS VALUE_DEFENCE,
 quarter_value AS TRIMESTER1, quarter_value AS TRIMESTER4, quarter_value AS RM_TRIMES2, quarter_value AS RM_TRIMES3 FROM p_plan""")
def _(w):
    return plan_of(w).select("DEPT_ID", "WORKING_CODE", "MIN_LEVEL", "VALUE_THIS_YEAR", "REMAIN_QTY", "VALUE_DEFENCE",
                             "TRIMESTER1", "TRIMESTER4", "RM_TRIMES2", "RM_TRIMES3")


_ALL = ("YEAR, CAL_MONTH, MOD_SYS, RATE_1_YEAR, RATE_2_YEAR, RATE_3_YEAR, QTY_ON_HAND, PACK_RATIO, PACK_UNIT_COST, FORECAST, "
        "AVG_3_YEAR, QTY_PRE_PLAN, QTY_FORECAST, QTY_THIS_YEAR, MIN_LEVEL, VALUE_THIS_YEAR, BUYMET_CODE").split(", ")
_part("pln_00_buy_plan", "p_plan", *_ALL)


_TEXT = """'[' || LOT_NO || ' : ' || strftime(EXPIRED_DATE,'%d/%m/%y') || ' : ' || CAST(CAST(floor(CAST(REMAIN_QTY_LOT AS DOUBLE)/CAST(ACTIVE_PACK AS DOUBLE)) AS BIGINT) AS VARCHAR)
 || ' x ' || rtrim(rtrim(CAST(ACTIVE_PACK AS VARCHAR),'0'),'.') ||
 CASE WHEN REMAIN_QTY_LOT % ACTIVE_PACK > 0 THEN ' (' || rtrim(rtrim(CAST(CAST(REMAIN_QTY_LOT % ACTIVE_PACK AS DECIMAL(18,4)) AS VARCHAR),'0'),'.') || ')' ELSE '' END || ']'"""


_LINES = f"""
WITH l AS (SELECT STOCK_ID, WORKING_CODE, TRADE_CODE, LOT_NO, EXPIRED_DATE, REMAIN_QTY_LOT, nullif(ACTIVE_PACK,0) AS ACTIVE_PACK FROM card
 WHERE OPERATE_DATE<=DATE '1999-06-30' AND ACTIVE_QTY>0 AND STOCK_ID IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY STOCK_ID,WORKING_CODE,TRADE_CODE,LOT_NO,EXPIRED_DATE ORDER BY RECORD_NUMBER DESC)=1),
 t AS (SELECT *, {_TEXT} AS line FROM l WHERE REMAIN_QTY_LOT>0)
"""


@query("onh_01_on_hand_lots", f"""{_LINES}
SELECT STOCK_ID, WORKING_CODE, string_agg(line, chr(10) ORDER BY EXPIRED_DATE, LOT_NO, TRADE_CODE) AS on_hand, CAST(count(*) AS BIGINT) AS lots
FROM t WHERE line IS NOT NULL GROUP BY 1,2""")
def _(w):
    return P.on_hand_text(w.src.card, AS_OF)


@query("onh_01b_on_hand_lines", f"""{_LINES}
SELECT STOCK_ID, WORKING_CODE, TRADE_CODE, LOT_NO, EXPIRED_DATE, CAST(REMAIN_QTY_LOT AS DOUBLE) AS REMAIN_QTY_LOT, line FROM t WHERE line IS NOT NULL""")
def _(w):
    return P.on_hand_lines(w.src.card, AS_OF).drop("ACTIVE_PACK")


def _trade_sql(found, pack="'0'"):
    """Trade products on sale whose own or whose item's code is among ``found``; labels are looked up for the page alone."""
    return f"""
WITH found(code) AS ({found}),
 sold AS (SELECT * FROM drug_vn WHERE MOD_SYS='MED' AND (HIDE='N' OR HIDE IS NULL)),
 page AS (SELECT sold.*, g.DRUG_NAME, g.SALE_UNIT_ID, g.IS_ED, g.COLOR, g.DFORM_ID, g.HOSP_LIST
  FROM sold JOIN (SELECT * FROM drug_gn WHERE HIDE='N' OR HIDE IS NULL) g USING (WORKING_CODE)
  WHERE TRADE_CODE IN (FROM found) OR WORKING_CODE IN (FROM found)
  ORDER BY LAST_BUY DESC NULLS LAST, DRUG_NAME, TRADE_NAME, TRADE_CODE LIMIT 20)
SELECT WORKING_CODE, TRADE_CODE, DRUG_NAME, TRADE_NAME, MANUFAC_CODE, LAST_BUY, CAST(SALE_UNIT_ID AS BIGINT) AS SALE_UNIT_ID,
 CAST(IS_ED AS BIGINT) AS IS_ED, CAST(COLOR AS BIGINT) AS COLOR, {pack} AS PACK_CODE,
 (SELECT min(COMPANY_NAME) FROM company WHERE COMPANY_CODE=CAST(page.MANUFAC_CODE AS BIGINT)) AS MANUFAC_NAME,
 (SELECT min(PROD_TYPE) FROM hosp_list WHERE HOSP_LIST_CODE=page.HOSP_LIST) AS PROD_TYPE,
 (SELECT min(DFORM_NAME) FROM dosage_form f WHERE f.DFORM_ID=page.DFORM_ID) AS DFORM_NAME,
 (SELECT min(SALE_UNIT) FROM sale_unit WHERE SU_ID=page.SALE_UNIT_ID) AS SALE_UNIT
FROM page"""


_LAST_BARCODE = """SELECT max(BAR_CODE) FROM pack_ratio WHERE TRADE_CODE IN (SELECT TRADE_CODE FROM drug_vn
 WHERE MOD_SYS='MED' AND HIDE='N' AND WORKING_CODE IN (SELECT WORKING_CODE FROM drug_gn WHERE HIDE='N'))"""


def _names_sql(part):
    return f"""SELECT WORKING_CODE FROM drug_gn WHERE contains(upper(DRUG_NAME),'{part}')
 UNION SELECT TRADE_CODE FROM drug_vn WHERE contains(upper(TRADE_NAME),'{part}')
 UNION SELECT REF_CODE FROM inst_name WHERE contains(upper(INST_NAME),'{part}')"""


def _names(w):
    """The stored name index of the catalogue."""
    index = NameIndex(Store(w.spark, work_folder(w.spark, "names")), "catalogue")
    index.build(catalogue_names(w.src))
    return index


@query("sch_01a_trade_by_barcode", _trade_sql(f"SELECT TRADE_CODE FROM pack_ratio WHERE BAR_CODE=({_LAST_BARCODE})",
       "coalesce((SELECT CAST(min(p.PACK_CODE) AS VARCHAR) FROM pack_ratio p WHERE p.TRADE_CODE=page.TRADE_CODE),'')"))
def _(w):
    sold = w.src.drug_vn.filter("MOD_SYS = 'MED' AND HIDE = 'N'").join(
        w.src.drug_gn.filter("HIDE = 'N'").select("WORKING_CODE"), "WORKING_CODE", "left_semi").select("TRADE_CODE")
    last = w.src.pack_ratio.join(sold, "TRADE_CODE", "left_semi").agg(F.max("BAR_CODE")).scalar()
    return P.trade_search(w.src, last, "barcode")


@query("sch_01b_trade_by_code", _trade_sql("SELECT '000000000071'"))
def _(w):
    return P.trade_search(w.src, "000000000071", "code")


@query("sch_01c_trade_by_name", _trade_sql(_names_sql("RING")))
def _(w):
    return P.trade_search(w.src, "%ring%", "name")


@query("sch_01d_trade_by_indexed_name", _trade_sql(_names_sql("Y 7")))
def _(w):
    return P.trade_search(w.src, "%y 7%", "name", index=_names(w))


def _stock_sql(found, pack):
    """What department D07 shows of the items ``found`` that site HOS01 carries."""
    return f"""
WITH here AS (SELECT * FROM inv_md WHERE DEPT_ID='D07' AND coalesce(HIDE,'') IN ('','N') AND WORKING_CODE IN ({found})
  AND WORKING_CODE IN (SELECT WORKING_CODE FROM inv_site WHERE DEPT_ID='HOS01')),
 packs AS (SELECT *, row_number() OVER (PARTITION BY WORKING_CODE ORDER BY LAST_BUY DESC, TRADE_CODE DESC) AS age_rank
  FROM pack_ratio WHERE PACK_RATIO IS NOT NULL),
 newest AS (SELECT WORKING_CODE, PACK_RATIO AS newest_pack FROM packs WHERE age_rank=1)
SELECT DISTINCT WORKING_CODE, DEPT_ID, MIN_LEVEL, FORECAST, FIRST_PACK_RATIO, LAST_PACK_RATIO, {doubles('WA_COST','QTY_ON_HAND')}, ABC_FLAG,
 LAST_UPDATE, here.HIDE, MOD_SYS, DRUG_NAME, (SELECT min(SALE_UNIT) FROM sale_unit WHERE SU_ID=g.SALE_UNIT_ID) AS SALE_UNIT,
 CAST(IS_ED AS BIGINT) AS IS_ED, USE_TRADE_DIS, {pack} AS PACK_RATIO, CAST(coalesce(COLOR,16777215) AS BIGINT) AS COLOR
FROM here JOIN (SELECT WORKING_CODE, DRUG_NAME, SALE_UNIT_ID, IS_ED, USE_TRADE_DIS, COLOR FROM drug_gn) g USING (WORKING_CODE)
LEFT JOIN newest USING (WORKING_CODE)"""


_PACK = "coalesce(FIRST_PACK_RATIO, newest_pack)"
_ITEM_NAMES = """SELECT WORKING_CODE FROM drug_gn WHERE contains(upper(DRUG_NAME),'WIDGET')
 UNION SELECT REF_CODE FROM inst_name WHERE contains(upper(INST_NAME),'WIDGET')"""
_STOCKED = """SELECT m.WORKING_CODE FROM inv_md m WHERE m.DEPT_ID='D07' AND m.HIDE='N' AND m.WORKING_CODE IN (SELECT WORKING_CODE FROM inv_site)"""


@query("sch_02a_stock_by_name", _stock_sql(_ITEM_NAMES, _PACK))
def _(w):
    return P.stock_search(w.src, "%widget%", "D07", "HOS01", "name")


@query("sch_02d_stock_by_indexed_name", _stock_sql(_ITEM_NAMES, _PACK))
def _(w):
    return P.stock_search(w.src, "%widget%", "D07", "HOS01", "name", index=_names(w))


@query("sch_02b_stock_by_code", _stock_sql(f"SELECT max(WORKING_CODE) FROM ({_STOCKED})", _PACK))
def _(w):
    stocked = (w.src.inv_md.filter("DEPT_ID = 'D07' AND HIDE = 'N'")
               .join(w.src.inv_site.select("WORKING_CODE"), "WORKING_CODE", "left_semi"))
    return P.stock_search(w.src, stocked.agg(F.max("WORKING_CODE")).scalar(), "D07", "HOS01", "code")


_BARCODE = f"(SELECT max(BAR_CODE) FROM pack_ratio WHERE WORKING_CODE IN ({_STOCKED}))"


@query("sch_02c_stock_by_barcode", _stock_sql(f"SELECT WORKING_CODE FROM pack_ratio WHERE BAR_CODE={_BARCODE}",
       f"coalesce((SELECT max(p.PACK_RATIO) FROM pack_ratio p WHERE p.BAR_CODE={_BARCODE}), FIRST_PACK_RATIO, LAST_PACK_RATIO, 1)"))
def _(w):
    stocked = (w.src.inv_md.filter("DEPT_ID = 'D07' AND HIDE = 'N'")
               .join(w.src.inv_site.select("WORKING_CODE"), "WORKING_CODE", "left_semi").select("WORKING_CODE"))
    code = w.src.pack_ratio.join(stocked, "WORKING_CODE", "left_semi").agg(F.max("BAR_CODE")).scalar()
    return P.stock_search(w.src, code, "D07", "HOS01", "barcode")


@query("mbs_01_monthly_balance", f"""
WITH m AS (SELECT DEPT_ID, g.IS_ED, year(OPERATE_DATE) AS YEAR, month(OPERATE_DATE) AS MONTH,
 sum(CASE WHEN R_S_STATUS='R' THEN ACTIVE_QTY ELSE 0 END) AS RCV_QUAN, sum(CASE WHEN R_S_STATUS='R' THEN VALUE ELSE 0 END) AS RCV_VALUE,
 sum(CASE WHEN R_S_STATUS='S' THEN ACTIVE_QTY ELSE 0 END) AS SALE_QUAN, sum(CASE WHEN R_S_STATUS='S' THEN VALUE ELSE 0 END) AS SALE_VALUE
 FROM card_live c LEFT JOIN drug_gn g ON g.WORKING_CODE=c.WORKING_CODE GROUP BY 1,2,3,4),
 r AS (SELECT *, sum(RCV_QUAN-SALE_QUAN) OVER w AS REMAIN_QUAN, sum(RCV_VALUE-SALE_VALUE) OVER w AS REMAIN_VALUE FROM m
  WINDOW w AS (PARTITION BY DEPT_ID, IS_ED ORDER BY YEAR, MONTH))
SELECT DEPT_ID, CAST(IS_ED AS BIGINT) AS IS_ED, YEAR, MONTH, {doubles('RCV_QUAN','RCV_VALUE','SALE_QUAN','SALE_VALUE','REMAIN_QUAN','REMAIN_VALUE')},
 CAST(REMAIN_QUAN-RCV_QUAN+SALE_QUAN AS DOUBLE) AS BFW_QTY, CAST(REMAIN_VALUE-RCV_VALUE+SALE_VALUE AS DOUBLE) AS BFW_VALUE FROM r""")
def _(w):
    return P.monthly_balance(w.src.card, w.src.drug_gn)
