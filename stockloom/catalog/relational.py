"""Registered queries: filters, projections, joins, aggregates, windows, sorting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockloom.catalog.registry import query
from stockloom.catalog.views import _code, _id, doubles
from stockloom.functions import keys, measures as M
from stockloom.operators import lookups, marts, ordered, planning, relational as R
from stockloom.sources import extract

AS_OF = dt.date(1999, 6, 30)
CNT = "CAST(count(*) AS BIGINT) AS row_count"
QTY_SQL = "CAST(sum(ACTIVE_QTY) AS DOUBLE) AS qty"


def count_rows():
    return F.count(F.lit(1)).alias("row_count")


def total_qty():
    return F.sum("ACTIVE_QTY").alias("qty")



# Filters ------------------------------------------------------------------------

@query("flt_01_status_not_cancelled", f"SELECT R_S_STATUS, {CNT}, {QTY_SQL} FROM card WHERE R_S_STATUS IN ('R','S') AND CANCEL_FLAG IS NULL GROUP BY 1")
def _(w):
    return extract.live_card(w.src.card, strict_null=True).groupBy("R_S_STATUS").agg(count_rows(), total_qty())


@query("flt_02_closed_window", f"""
SELECT OPERATE_DATE, {CNT} FROM card WHERE OPERATE_DATE BETWEEN DATE '1999-03-02' AND DATE '1999-06-30' GROUP BY 1""")
def _(w):
    return marts.between_dates(w.src.card, "OPERATE_DATE", AS_OF - dt.timedelta(days=120), AS_OF).groupBy("OPERATE_DATE").agg(count_rows())


@query("flt_02b_month_window", f"""
SELECT CAST(strftime(OPERATE_DATE,'%Y%m') AS BIGINT) AS ym, {CNT} FROM card
WHERE CAST(strftime(OPERATE_DATE,'%Y%m') AS BIGINT) BETWEEN 199707 AND 199906 GROUP BY 1""")
def _(w):
    return marts.between_months(w.src.card, "OPERATE_DATE", 199707, 199906).groupBy(keys.month_key("OPERATE_DATE").alias("ym")).agg(count_rows())


@query("flt_03_trailing_windows", "\nUNION ALL ".join(
    f"SELECT CAST({n} AS BIGINT) AS days, {CNT}, {QTY_SQL} FROM card WHERE OPERATE_DATE >= DATE '1999-06-30' - {n}" for n in (30, 90, 180)))
def _(w):
    parts = [R.trailing(w.src.card, "OPERATE_DATE", AS_OF, n).agg(count_rows(), total_qty()).select(F.lit(n).alias("days"), "row_count", "qty")
             for n in (30, 90, 180)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("flt_04_below_reorder", """
SELECT WORKING_CODE, coalesce(MIN_LEVEL,0) AS level, coalesce(REORDER_QTY,0) AS reorder FROM drug_gn
WHERE coalesce(MIN_LEVEL,0) <= coalesce(REORDER_QTY,0)""")
def _(w):
    level, reorder = F.coalesce("MIN_LEVEL", F.lit(0.0)), F.coalesce("REORDER_QTY", F.lit(0.0))
    return w.src.drug_gn.filter(level <= reorder).select("WORKING_CODE", level.alias("level"), reorder.alias("reorder"))


@query("flt_05_status_list", f"SELECT po_status, {CNT} FROM po_src WHERE po_status IN ('approved','pending','received_partial') GROUP BY 1")
def _(w):
    po = extract.purchase_order_line(w.src.ms_po, w.src.ms_po_c)
    return po.filter(F.col("po_status").isin("approved", "pending", "received_partial")).groupBy("po_status").agg(count_rows())


@query("flt_06_this_and_last_year", f"SELECT year(OPERATE_DATE) AS y, {CNT} FROM card WHERE year(OPERATE_DATE) IN (1999,1998) GROUP BY 1")
def _(w):
    low, high = dt.date(AS_OF.year - 1, 1, 1), dt.date(AS_OF.year, 12, 31)
    return marts.between_dates(w.src.card, "OPERATE_DATE", low, high).groupBy(F.year("OPERATE_DATE").alias("y")).agg(count_rows())


@query("flt_07_having", f"""
SELECT WORKING_CODE, max(OPERATE_DATE) AS last_date, {QTY_SQL} FROM card GROUP BY 1
HAVING max(OPERATE_DATE) < DATE '2001-09-01' AND sum(ACTIVE_QTY) > 100""")
def _(w):
    g = w.src.card.groupBy("WORKING_CODE").agg(F.max("OPERATE_DATE").alias("last_date"), total_qty())
    return g.filter((F.col("last_date") < F.lit(dt.date(2001, 9, 1))) & (F.col("qty") > 100))


@query("flt_08_text_match", """
SELECT WORKING_CODE, DRUG_NAME FROM drug_gn WHERE regexp_matches(lower(DRUG_NAME),'blue|widget') OR lower(WORKING_CODE) LIKE '%77%'""")
def _(w):
    hit = R.text_match("BLUE|widget", "DRUG_NAME") | R.text_match("77", "WORKING_CODE", regex=False)
    return w.src.drug_gn.filter(hit).select("WORKING_CODE", "DRUG_NAME")


@query("flt_09_optional_filters", f"SELECT R_S_STATUS, {CNT} FROM card WHERE DEPT_ID='D03' AND ACTIVE_QTY>=20 GROUP BY 1")
def _(w):
    return R.choose(w.src.card, DEPT_ID="D03", R_S_STATUS=R.ALL).filter("ACTIVE_QTY >= 20").groupBy("R_S_STATUS").agg(count_rows())


@query("flt_10_not_hidden", f"SELECT DEPT_ID, {CNT} FROM inv_md WHERE HIDE='N' OR HIDE IS NULL OR HIDE='' GROUP BY 1")
def _(w):
    return w.src.inv_md.filter(M.is_visible(F.col("HIDE"))).groupBy("DEPT_ID").agg(count_rows())


@query("flt_11_alias_search", """
SELECT WORKING_CODE, DRUG_NAME FROM drug_gn WHERE upper(DRUG_NAME) LIKE 'RED%'
 OR WORKING_CODE IN (SELECT REF_CODE FROM inst_name WHERE INST_NAME ILIKE '%promo%')""")
def _(w):
    alias = w.src.inst_name.filter(F.col("INST_NAME").ilike("%promo%")).select(F.col("REF_CODE").alias("WORKING_CODE")).distinct()
    items = w.src.drug_gn.select("WORKING_CODE", "DRUG_NAME")
    named = F.upper("DRUG_NAME").like("RED%")
    return items.filter(named).unionByName(items.filter(~named).join(alias, "WORKING_CODE", "left_semi"))


@query("flt_12_report_filters", f"""
SELECT WORKING_CODE, {CNT}, {QTY_SQL} FROM card WHERE OPERATE_DATE BETWEEN DATE '1998-10-01' AND DATE '1999-09-30'
 AND DEPT_ID IN ('D01','D02','D05') AND R_S_STATUS='S' GROUP BY 1""")
def _(w):
    rows = R.report_filter(w.src.card, "OPERATE_DATE", dt.date(1998, 10, 1), dt.date(1999, 9, 30),
                           DEPT_ID=["D01", "D02", "D05"], R_S_STATUS="S", WORKING_CODE=None)
    return rows.groupBy("WORKING_CODE").agg(count_rows(), total_qty())


@query("prj_01_contract_names", f"""
SELECT RECORD_NUMBER AS movement_id, WORKING_CODE AS item_code, coalesce(STOCK_ID,DEPT_ID) AS warehouse, 'card' AS source_table,
 CAST(ACTIVE_QTY AS DOUBLE) AS quantity FROM card""")
def _(w):
    return w.src.card.select(F.col("RECORD_NUMBER").alias("movement_id"), F.col("WORKING_CODE").alias("item_code"),
                             F.coalesce("STOCK_ID", "DEPT_ID").alias("warehouse"), F.lit("card").alias("source_table"),
                             F.col("ACTIVE_QTY").alias("quantity"))


@query("prj_02_item_flags", "SELECT source_item_code, is_active, is_drug, is_supply FROM d_item")
def _(w):
    return w.dim_item.select("source_item_code", "is_active", "is_drug", "is_supply")


@query("prj_03_boolean_cast", f"SELECT CAST(HIDE='Y' AS BOOLEAN) AS hidden, CAST(CAST(HIDE='Y' AS BOOLEAN) AS BIGINT) AS hidden_int, {CNT} FROM drug_gn GROUP BY ALL")
def _(w):
    flag = F.when(F.col("HIDE") == "Y", 1).otherwise(0).cast("boolean")
    return w.src.drug_gn.groupBy(flag.alias("hidden"), flag.cast("bigint").alias("hidden_int")).agg(count_rows())


# Joins --------------------------------------------------------------------------

@query("jon_01_header_line", """
SELECT p.PO_NO, p.PO_DATE, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(c.QTY_ORDER) AS DOUBLE) AS qty FROM ms_po p JOIN ms_po_c c ON p.PO_NO=c.PO_NO GROUP BY 1,2""")
def _(w):
    return (w.src.ms_po.select("PO_NO", "PO_DATE").join(w.src.ms_po_c.select("PO_NO", "QTY_ORDER"), "PO_NO")
            .groupBy("PO_NO", "PO_DATE").agg(count_rows(), F.sum("QTY_ORDER").alias("qty")))


@query("jon_02_fact_dimensions", """
SELECT source_txn_id, i.item_name, d.warehouse_name, v.vendor_name, CAST(qty AS DOUBLE) AS qty FROM f_move f
LEFT JOIN d_item i ON i.dim_item_id=f.dim_item_id LEFT JOIN d_warehouse d ON d.dim_warehouse_id=f.dim_warehouse_id
LEFT JOIN d_vendor v ON v.dim_vendor_id=f.dim_vendor_id""")
def _(w):
    return (w.fact_inventory_movement.join(w.items.select("dim_item_id", "item_name"), "dim_item_id", "left")
            .join(w.dim_warehouse.select("dim_warehouse_id", "warehouse_name"), "dim_warehouse_id", "left")
            .join(w.dim_vendor.select("dim_vendor_id", "vendor_name"), "dim_vendor_id", "left")
            .select("source_txn_id", "item_name", "warehouse_name", "vendor_name", "qty"))


@query("jon_03_aggregated_subquery", """
SELECT d.WORKING_CODE, d.DEPT_ID, x.last_issue FROM inv_md d LEFT JOIN (
 SELECT WORKING_CODE, DEPT_ID, max(OPERATE_DATE) AS last_issue FROM card WHERE R_S_STATUS='S' GROUP BY 1,2) x
 ON x.WORKING_CODE=d.WORKING_CODE AND x.DEPT_ID=d.DEPT_ID""")
def _(w):
    last = (w.src.card.filter("R_S_STATUS = 'S'").groupBy("WORKING_CODE", "DEPT_ID")
            .agg(F.max("OPERATE_DATE").alias("last_issue")))
    return w.src.inv_md.select("WORKING_CODE", "DEPT_ID").join(last, ["WORKING_CODE", "DEPT_ID"], "left")


@query("jon_04_null_safe_full_outer", f"""
WITH a AS (SELECT WORKING_CODE, VENDOR_CODE, sum(QTY_ORDER) AS ordered FROM (SELECT WORKING_CODE, {_code('VENDOR_CODE')} AS VENDOR_CODE, QTY_ORDER FROM ms_po_c) GROUP BY 1,2),
 b AS (SELECT c.WORKING_CODE, {_code('i.VENDOR_CODE')} AS VENDOR_CODE, sum(c.QTY_ORDER) AS received FROM ms_ivo i JOIN ms_ivo_c c ON i.INVOICE_NO=c.INVOICE_NO GROUP BY 1,2)
SELECT coalesce(a.WORKING_CODE,b.WORKING_CODE) AS WORKING_CODE, coalesce(a.VENDOR_CODE,b.VENDOR_CODE) AS VENDOR_CODE,
 CAST(ordered AS DOUBLE) AS ordered, CAST(received AS DOUBLE) AS received
FROM a FULL JOIN b ON a.WORKING_CODE=b.WORKING_CODE AND coalesce(a.VENDOR_CODE,'-1')=coalesce(b.VENDOR_CODE,'-1')""")
def _(w):
    k = keys.normal_code("VENDOR_CODE").alias("VENDOR_CODE")
    a = w.src.ms_po_c.groupBy("WORKING_CODE", k).agg(F.sum("QTY_ORDER").alias("ordered")).alias("a")
    b = (w.src.ms_ivo.select("INVOICE_NO", "VENDOR_CODE").join(w.src.ms_ivo_c.select("INVOICE_NO", "WORKING_CODE", "QTY_ORDER"), "INVOICE_NO")
         .groupBy("WORKING_CODE", k).agg(F.sum("QTY_ORDER").alias("received")).alias("b"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("WORKING_CODE", "VENDOR_CODE")]
    return a.join(b, same, "full_outer").select(
        F.coalesce("a.WORKING_CODE", "b.WORKING_CODE").alias("WORKING_CODE"),
        F.coalesce("a.VENDOR_CODE", "b.VENDOR_CODE").alias("VENDOR_CODE"), "ordered", "received")


@query("jon_05_delete_by_key", f"""
SELECT po_no, dim_item_id, CAST(ordered_qty AS DOUBLE) AS ordered_qty FROM f_po f
WHERE NOT EXISTS (SELECT 1 FROM f_po s WHERE s.po_date >= DATE '1999-01-01' AND s.po_no=f.po_no AND s.dim_item_id=f.dim_item_id)""")
def _(w):
    f = w.fact_purchase_order_line.select("po_no", "po_date", "dim_item_id", "ordered_qty")
    gone = f.filter("po_date >= DATE '1999-01-01'").select("po_no", "dim_item_id").distinct()
    return f.join(gone, ["po_no", "dim_item_id"], "left_anti").drop("po_date")


@query("jon_06_semi_join", f"SELECT R_S_STATUS, {CNT} FROM card c WHERE EXISTS (SELECT 1 FROM drug_gn g WHERE g.WORKING_CODE=c.WORKING_CODE) GROUP BY 1")
def _(w):
    return w.src.card.join(w.src.drug_gn.select("WORKING_CODE"), "WORKING_CODE", "left_semi").groupBy("R_S_STATUS").agg(count_rows())


@query("jon_07_anti_join", f"""
SELECT WORKING_CODE, DEPT_ID, {CNT} FROM card c WHERE NOT EXISTS (SELECT 1 FROM dept_id d WHERE d.DEPT_ID=c.DEPT_ID)
 OR NOT EXISTS (SELECT 1 FROM drug_gn g WHERE g.WORKING_CODE=c.WORKING_CODE) GROUP BY 1,2""")
def _(w):
    per_key = w.src.card.groupBy("WORKING_CODE", "DEPT_ID").agg(count_rows())
    no_dept = R.orphans(per_key, "DEPT_ID", w.src.dept_id, "DEPT_ID")
    no_item = R.orphans(per_key, "WORKING_CODE", w.src.drug_gn, "WORKING_CODE")
    return no_dept.unionByName(no_item).distinct()


@query("jon_08_latest_with_fallback", """
SELECT g.WORKING_CODE, CAST(coalesce(a.v,b.v,g.LAST_BUY_COST) AS DOUBLE) AS unit_cost FROM drug_gn g
LEFT JOIN p_invoice_cost a ON a.WORKING_CODE=g.WORKING_CODE LEFT JOIN p_trade_cost b ON b.WORKING_CODE=g.WORKING_CODE""")
def _(w):
    a = planning.latest_invoice_cost(w.src.ms_ivo, w.src.ms_ivo_c)
    b = planning.latest_trade_cost(w.src.drug_vn)
    g = w.src.drug_gn.select("WORKING_CODE", "LAST_BUY_COST")
    return g.join(a, "WORKING_CODE", "left").join(b, "WORKING_CODE", "left").select(
        "WORKING_CODE", F.coalesce("invoice_cost", "trade_cost", "LAST_BUY_COST").alias("unit_cost"))


@query("jon_09_value_bands", """
SELECT PO_NO, v AS order_value, (SELECT min(BUYMET_CODE) FROM buymethod b WHERE b.HIDE='N' AND b.MIN_AMT<=v AND b.MAX_AMT>=v) AS method
FROM (SELECT PO_NO, CAST(CAST(sum(QTY_ORDER*BUY_UNIT_COST) AS DECIMAL(18,2)) AS DOUBLE) AS v FROM ms_po_c GROUP BY 1)""")
def _(w):
    orders = w.src.ms_po_c.groupBy("PO_NO").agg(
        F.sum(F.col("QTY_ORDER") * F.col("BUY_UNIT_COST")).cast("decimal(18,2)").cast("double").alias("order_value"))
    return lookups.band_lookup(orders, "order_value", w.src.buymethod.filter("HIDE = 'N'"), "MIN_AMT", "MAX_AMT",
                               "BUYMET_CODE", "method")


@query("jon_10_cast_key", f"""
SELECT v.TRADE_CODE, c.COMPANY_NAME AS maker FROM drug_vn v LEFT JOIN company c ON CAST(v.MANUFAC_CODE AS BIGINT)=c.COMPANY_CODE""")
def _(w):
    maker = w.src.company.select(keys.normal_code("COMPANY_CODE").alias("_m"), F.col("COMPANY_NAME").alias("maker"))
    return (w.src.drug_vn.select("TRADE_CODE", keys.normal_code("MANUFAC_CODE").alias("_m")).join(maker, "_m", "left").drop("_m"))


_LOT = "a.WORKING_CODE=b.WORKING_CODE AND a.TRADE_CODE=b.TRADE_CODE AND a.LOT_NO=b.LOT_NO AND a.DEPT_ID=b.DEPT_ID"


@query("jon_11_lot_join", f"""
SELECT a.WORKING_CODE, a.TRADE_CODE, a.DEPT_ID, a.LOT_NO, a.EXPIRED_DATE, b.last_move AS last_move, x.last_move AS last_move_exact
FROM inv_md_c a
LEFT JOIN (SELECT WORKING_CODE,TRADE_CODE,DEPT_ID,LOT_NO,max(OPERATE_DATE) AS last_move FROM card GROUP BY 1,2,3,4) b ON {_LOT}
LEFT JOIN (SELECT WORKING_CODE,TRADE_CODE,DEPT_ID,LOT_NO,EXPIRED_DATE,max(OPERATE_DATE) AS last_move FROM card GROUP BY 1,2,3,4,5) x
 ON {_LOT.replace('b.', 'x.')} AND a.EXPIRED_DATE=x.EXPIRED_DATE""")
def _(w):
    lot = ["WORKING_CODE", "TRADE_CODE", "DEPT_ID", "LOT_NO"]
    moved = w.src.card.groupBy(*lot, "EXPIRED_DATE").agg(F.max("OPERATE_DATE").alias("last_move_exact"))
    by_lot = moved.groupBy(*lot).agg(F.max("last_move_exact").alias("last_move"))
    # lots and movements already lie by all five columns, so the exact match, taken first, moves no row
    return (w.src.inv_md_c.select(*lot, "EXPIRED_DATE").join(moved, [*lot, "EXPIRED_DATE"], "left")
            .join(by_lot, lot, "left").select(*lot, "EXPIRED_DATE", "last_move", "last_move_exact"))


@query("jon_12_conformed_joins", f"""
SELECT d.DEPT_NAME, g.GROUP_CODE, co.COMPANY_NAME, {CNT}, CAST(sum(c.VALUE) AS DOUBLE) AS total_value FROM card c
JOIN drug_gn g ON g.WORKING_CODE=c.WORKING_CODE JOIN drug_vn v ON v.TRADE_CODE=c.TRADE_CODE
JOIN company co ON co.COMPANY_CODE=CAST(v.VENDOR_CODE AS BIGINT) JOIN dept_id d ON d.DEPT_ID=c.DEPT_ID GROUP BY 1,2,3""")
def _(w):
    vendor = w.src.company.select(keys.normal_code("COMPANY_CODE").alias("_v"), "COMPANY_NAME")
    trade = w.src.drug_vn.select("TRADE_CODE", keys.normal_code("VENDOR_CODE").alias("_v"))
    return (w.src.card.select("WORKING_CODE", "TRADE_CODE", "DEPT_ID", "VALUE")
            .join(w.src.drug_gn.select("WORKING_CODE", "GROUP_CODE"), "WORKING_CODE")
            .join(trade, "TRADE_CODE").join(vendor, "_v")
            .join(w.src.dept_id.select("DEPT_ID", "DEPT_NAME"), "DEPT_ID")
            .groupBy("DEPT_NAME", "GROUP_CODE", "COMPANY_NAME").agg(count_rows(), F.sum("VALUE").alias("total_value")))


@query("jon_13_latest_per_lot", """
SELECT WORKING_CODE, TRADE_CODE, LOT_NO, EXPIRED_DATE, RECORD_NUMBER, CAST(REMAIN_QTY_LOT AS DOUBLE) AS REMAIN_QTY_LOT FROM card
QUALIFY row_number() OVER (PARTITION BY WORKING_CODE,TRADE_CODE,LOT_NO,EXPIRED_DATE ORDER BY RECORD_NUMBER DESC)=1""")
def _(w):
    return lookups.latest(w.src.card, ["WORKING_CODE", "TRADE_CODE", "LOT_NO", "EXPIRED_DATE"], [F.col("RECORD_NUMBER")],
                          ["RECORD_NUMBER", "REMAIN_QTY_LOT"])


# Aggregates -----------------------------------------------------------------------

@query("agg_01_grouped", f"""
SELECT DEPT_ID, R_S_STATUS, CAST(sum(VALUE) AS DOUBLE) AS total, round(CAST(sum(VALUE) AS DOUBLE)/count(VALUE),6) AS average,
 max(OPERATE_DATE) AS newest, {CNT} FROM card GROUP BY 1,2""")
def _(w):
    return w.src.card.groupBy("DEPT_ID", "R_S_STATUS").agg(
        F.sum("VALUE").alias("total"), M.mean(F.sum("VALUE"), F.count("VALUE")).alias("average"),
        F.max("OPERATE_DATE").alias("newest"), count_rows())


@query("agg_02_conditional_sum", """
SELECT DEPT_ID, CAST(sum(CASE WHEN R_S_STATUS='S' THEN abs(ACTIVE_QTY) ELSE 0 END) AS DOUBLE) AS issued,
 CAST(sum(CASE WHEN R_S_STATUS='R' THEN abs(ACTIVE_QTY) ELSE 0 END) AS DOUBLE) AS received FROM card GROUP BY 1""")
def _(w):
    def part(code):
        return F.sum(F.when(F.col("R_S_STATUS") == code, F.abs("ACTIVE_QTY")).otherwise(0))
    return w.src.card.groupBy("DEPT_ID").agg(part("S").alias("issued"), part("R").alias("received"))


@query("agg_03_distinct_counts", """
SELECT OPERATE_DATE, CAST(count(DISTINCT WORKING_CODE) AS BIGINT) AS items,
 CAST(count(DISTINCT CASE WHEN REMAIN_QTY>0 THEN WORKING_CODE END) AS BIGINT) AS stocked FROM card GROUP BY 1""")
def _(w):
    # one row per day and item first, so both counts are plain counts
    per_item = w.src.card.groupBy("OPERATE_DATE", "WORKING_CODE").agg(F.max(F.col("REMAIN_QTY") > 0).alias("s"))
    return per_item.groupBy("OPERATE_DATE").agg(F.count("WORKING_CODE").alias("items"), F.count_if("s").alias("stocked"))


@query("agg_04_null_to_zero_sum", """
SELECT LOT_NO, CAST(coalesce(sum(REMAIN_QTY_LOT),0) AS DOUBLE) AS lot_qty, CAST(sum(coalesce(REMAIN_QTY_LOT,0)) AS DOUBLE) AS lot_qty2 FROM card GROUP BY 1""")
def _(w):
    return w.src.card.groupBy("LOT_NO").agg(
        F.coalesce(F.sum("REMAIN_QTY_LOT"), F.lit(0).cast("decimal(28,4)")).alias("lot_qty"),
        F.sum(F.coalesce("REMAIN_QTY_LOT", F.lit(0).cast("decimal(18,4)"))).alias("lot_qty2"))


@query("agg_05_scalar_totals", """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM drug_gn) AS items, (SELECT CAST(count(DISTINCT DEPT_ID) AS BIGINT) FROM card) AS departments,
 (SELECT CAST(sum(VALUE) AS DOUBLE) FROM card) AS total_value""")
def _(w):
    return R.one_row(w.spark, items=w.src.drug_gn.agg(F.count(F.lit(1))),
                     departments=w.src.card.agg(F.count_distinct("DEPT_ID")), total_value=w.src.card.agg(F.sum("VALUE")))


@query("agg_06_value_counts", f"SELECT R_S_STATUS, {CNT}, CAST(count(DISTINCT DEPT_ID) AS BIGINT) AS departments FROM card GROUP BY 1")
def _(w):
    return w.src.card.groupBy("R_S_STATUS").agg(count_rows(), F.count_distinct("DEPT_ID").alias("departments")).orderBy(F.desc("row_count"))


@query("agg_07_pivot_periods", """
SELECT WORKING_CODE, CAST(sum(CASE WHEN quarter(OPERATE_DATE)=4 THEN ACTIVE_QTY ELSE 0 END) AS DOUBLE) AS q1,
 CAST(sum(CASE WHEN quarter(OPERATE_DATE)=1 THEN ACTIVE_QTY ELSE 0 END) AS DOUBLE) AS q2,
 CAST(sum(CASE WHEN quarter(OPERATE_DATE)=2 THEN ACTIVE_QTY ELSE 0 END) AS DOUBLE) AS q3,
 CAST(sum(CASE WHEN quarter(OPERATE_DATE)=3 THEN ACTIVE_QTY ELSE 0 END) AS DOUBLE) AS q4 FROM card GROUP BY 1""")
def _(w):
    from stockloom.functions.dates import fiscal_quarter
    parts = [F.sum(F.when(fiscal_quarter("OPERATE_DATE") == q, F.col("ACTIVE_QTY")).otherwise(0)).alias(f"q{q}") for q in (1, 2, 3, 4)]
    return w.src.card.groupBy("WORKING_CODE").agg(*parts)


@query("agg_08_group_by_expression", f"""
SELECT CASE WHEN EXPIRED_DATE IS NULL THEN 'no_expiry' WHEN EXPIRED_DATE<OPERATE_DATE THEN 'expired'
 WHEN EXPIRED_DATE<=OPERATE_DATE+90 THEN 'near_expiry' ELSE 'healthy' END AS status, {CNT} FROM card GROUP BY 1""")
def _(w):
    return w.src.card.groupBy(M.expiry_status(F.col("EXPIRED_DATE"), F.col("OPERATE_DATE")).alias("status")).agg(count_rows())


@query("agg_09_string_list", """
SELECT DEPT_ID, string_agg(LOT_NO, chr(10) ORDER BY LOT_NO) AS lots FROM (SELECT DISTINCT DEPT_ID, LOT_NO FROM card WHERE LOT_NO IS NOT NULL) GROUP BY 1""")
def _(w):
    lots = w.src.card.filter("LOT_NO IS NOT NULL").select("DEPT_ID", "LOT_NO").distinct()
    return lots.groupBy("DEPT_ID").agg(F.expr("listagg(LOT_NO, '\\n') WITHIN GROUP (ORDER BY LOT_NO)").alias("lots"))


@query("agg_10_distinct_rows", "SELECT DISTINCT WORKING_CODE, DEPT_ID, LOT_NO FROM card")
def _(w):
    return w.src.card.select("WORKING_CODE", "DEPT_ID", "LOT_NO").dropDuplicates()


@query("agg_11_histogram", f"""
WITH r AS (SELECT CAST(min(VALUE) AS DOUBLE) AS lo, CAST(max(VALUE) AS DOUBLE) AS hi FROM card)
SELECT CAST(least(floor((CAST(VALUE AS DOUBLE)-lo)/((hi-lo)/20.0::DOUBLE)),19) AS BIGINT) AS bin, {CNT} FROM card, r GROUP BY 1""")
def _(w):
    return R.histogram(w.src.card, "VALUE", 20)


@query("agg_12_guarded_ratio", """
SELECT DEPT_ID, CAST(sum(CASE WHEN R_S_STATUS='S' THEN VALUE ELSE 0 END) AS DOUBLE)
 / greatest(CAST(sum(CASE WHEN CANCEL_FLAG='Y' THEN 1 ELSE 0 END) AS DOUBLE),1.0::DOUBLE) AS per_cancel FROM card GROUP BY 1""")
def _(w):
    issued = F.sum(F.when(F.col("R_S_STATUS") == "S", F.col("VALUE")).otherwise(0))
    return w.src.card.groupBy("DEPT_ID").agg(
        M.guarded_ratio(issued, F.count_if(F.col("CANCEL_FLAG") == "Y")).alias("per_cancel"))


# Windows --------------------------------------------------------------------------

@query("win_01_running_total", """
SELECT ym, CAST(v AS DOUBLE) AS month_value, CAST(sum(v) OVER (ORDER BY ym) AS DOUBLE) AS running FROM (
 SELECT CAST(strftime(OPERATE_DATE,'%Y%m') AS BIGINT) AS ym, sum(VALUE) AS v FROM card GROUP BY 1)""")
def _(w):
    m = w.src.card.groupBy(keys.month_key("OPERATE_DATE").alias("ym")).agg(F.sum("VALUE").alias("month_value"))
    run = Window.orderBy("ym").rowsBetween(Window.unboundedPreceding, 0)  # one row per month
    return m.withColumn("running", F.sum("month_value").over(run))


@query("win_02_share_of_total", """
SELECT R_S_STATUS, CAST(count(*) AS BIGINT) AS row_count, round(100.0::DOUBLE*count(*)/sum(count(*)) OVER (),2) AS percentage FROM card GROUP BY 1""")
def _(w):
    g = w.src.card.groupBy("R_S_STATUS").agg(count_rows())
    return g.withColumn("percentage", M.percent(F.col("row_count"), g.agg(F.sum("row_count")).scalar()))


_DAILY = "SELECT WORKING_CODE, DEPT_ID, OPERATE_DATE, sum(ACTIVE_QTY) AS q FROM card WHERE R_S_STATUS='S' GROUP BY 1,2,3"


@query("win_03_trailing_average", "WITH d AS (" + _DAILY + ") SELECT WORKING_CODE, DEPT_ID, OPERATE_DATE, CAST(q AS DOUBLE) AS q, " + ", ".join(
    f"round(CAST(sum(q) OVER (PARTITION BY WORKING_CODE, DEPT_ID ORDER BY OPERATE_DATE RANGE BETWEEN INTERVAL {n-1} DAYS PRECEDING AND CURRENT ROW) AS DOUBLE)/{n}.0::DOUBLE,4) AS avg{n}"
    for n in (30, 90)) + " FROM d")
def _(w):
    daily = (w.src.card.filter("R_S_STATUS = 'S'").groupBy("WORKING_CODE", "DEPT_ID", "OPERATE_DATE").agg(F.sum("ACTIVE_QTY").alias("q"))
             .select(F.col("WORKING_CODE").alias("dim_item_id"), F.col("DEPT_ID").alias("dim_warehouse_id"), "OPERATE_DATE", "q",
                     F.unix_date("OPERATE_DATE").alias("_day")))
    return daily.select(F.col("dim_item_id").alias("WORKING_CODE"), F.col("dim_warehouse_id").alias("DEPT_ID"), "OPERATE_DATE", "q",
                        marts.trailing_average(daily, "q", 30).alias("avg30"), marts.trailing_average(daily, "q", 90).alias("avg90"))


@query("win_04_latest_row", """
SELECT WORKING_CODE, STOCK_ID, OPERATE_DATE, CAST(REMAIN_QTY AS DOUBLE) AS REMAIN_QTY FROM card
QUALIFY row_number() OVER (PARTITION BY WORKING_CODE, STOCK_ID ORDER BY OPERATE_DATE DESC, RECORD_NUMBER DESC)=1""")
def _(w):
    return lookups.latest(w.src.card, ["WORKING_CODE", "STOCK_ID"], [F.col("OPERATE_DATE"), F.col("RECORD_NUMBER")],
                          ["OPERATE_DATE", "REMAIN_QTY"])


_ITEM_VALUE = "SELECT WORKING_CODE, sum(VALUE) AS v, sum(ACTIVE_QTY) AS q FROM card WHERE R_S_STATUS='S' GROUP BY 1"


@query("win_05_top_fifth", f"""
SELECT WORKING_CODE, CAST(q AS DOUBLE) AS qty FROM (SELECT *, percent_rank() OVER (ORDER BY q DESC) AS p FROM ({_ITEM_VALUE})) WHERE p<=0.2""")
def _(w):
    items = w.src.card.filter("R_S_STATUS = 'S'").groupBy("WORKING_CODE").agg(total_qty())
    return ordered.top_share(items, "qty", 0.20)


@query("win_06_abc_classes", f"""
SELECT WORKING_CODE, CAST(v AS DOUBLE) AS total_value, CASE WHEN s<0.80 THEN 'A' WHEN s<0.95 THEN 'B' ELSE 'C' END AS abc_class FROM (
 SELECT *, CAST(sum(v) OVER (ORDER BY v DESC) - v*count(*) OVER (PARTITION BY v) AS DOUBLE)/CAST(sum(v) OVER () AS DOUBLE) AS s FROM ({_ITEM_VALUE}))""")
def _(w):
    items = w.src.card.filter("R_S_STATUS = 'S'").groupBy("WORKING_CODE").agg(F.sum("VALUE").alias("total_value"))
    return ordered.abc_classes(items, "total_value")


@query("win_07_first_match", """
SELECT WORKING_CODE, min(TRADE_CODE) AS first_trade, CAST(count(*) AS BIGINT) AS row_count FROM drug_vn WHERE HIDE='N' GROUP BY 1""")
def _(w):
    return w.src.drug_vn.filter("HIDE = 'N'").groupBy("WORKING_CODE").agg(F.min("TRADE_CODE").alias("first_trade"), count_rows())


# Sorting --------------------------------------------------------------------------

@query("srt_01_order_by", "SELECT WORKING_CODE, VEN_FLAG, REORDER_QTY FROM drug_gn ORDER BY VEN_FLAG, REORDER_QTY DESC, WORKING_CODE")
def _(w):
    return w.src.drug_gn.select("WORKING_CODE", "VEN_FLAG", "REORDER_QTY").orderBy("VEN_FLAG", F.desc("REORDER_QTY"), "WORKING_CODE")


@query("srt_02_top_k", "SELECT RECORD_NUMBER, OPERATE_DATE, CAST(VALUE AS DOUBLE) AS VALUE FROM card ORDER BY VALUE DESC, RECORD_NUMBER LIMIT 1000")
def _(w):
    return R.top(w.src.card.select("RECORD_NUMBER", "OPERATE_DATE", "VALUE"), 1000, F.desc("VALUE"), F.col("RECORD_NUMBER"))


@query("srt_03_rank_order", """
SELECT CAST(k AS BIGINT) AS rank_no, expiry_range, CAST(count(*) AS BIGINT) AS row_count FROM (SELECT
 CASE WHEN n<=0 THEN 1 WHEN n<=30 THEN 2 WHEN n<=90 THEN 3 WHEN n<=180 THEN 4 ELSE 5 END AS k,
 CASE WHEN n<=0 THEN 'Expired' WHEN n<=30 THEN '0-30 Days' WHEN n<=90 THEN '30-90 Days' WHEN n<=180 THEN '90-180 Days' ELSE '180+ Days' END AS expiry_range
 FROM (SELECT EXPIRED_DATE - DATE '1999-06-30' AS n FROM card)) GROUP BY 1,2 ORDER BY 1""")
def _(w):
    left = F.datediff("EXPIRED_DATE", F.lit(AS_OF))
    return (w.src.card.groupBy(M.expiry_range_rank(left).alias("rank_no"), M.expiry_range(left).alias("expiry_range")).agg(count_rows())
            .orderBy("rank_no"))


@query("srt_04_largest_groups", """
SELECT WORKING_CODE, CAST(sum(ACTIVE_QTY) AS DOUBLE) AS qty FROM card GROUP BY 1 ORDER BY sum(ACTIVE_QTY) DESC, WORKING_CODE LIMIT 15""")
def _(w):
    return R.top(w.src.card.groupBy("WORKING_CODE").agg(total_qty()), 15, F.desc("qty"), F.col("WORKING_CODE"))


@query("srt_05_page", """
SELECT RECORD_NUMBER, WORKING_CODE FROM card WHERE RECORD_NUMBER > (SELECT max(RECORD_NUMBER) FROM (SELECT RECORD_NUMBER FROM card ORDER BY 1 LIMIT 50))
ORDER BY RECORD_NUMBER LIMIT 50""")
def _(w):
    rows = w.src.card.select("RECORD_NUMBER", "WORKING_CODE")
    first = R.page_after(rows, "RECORD_NUMBER", None, 50)
    return R.page_after(rows, "RECORD_NUMBER", first.agg(F.max("RECORD_NUMBER")).scalar(), 50)
