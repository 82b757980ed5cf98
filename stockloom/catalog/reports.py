"""Registered queries: named reports and page roll-ups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stockloom.catalog.registry import query
from stockloom.catalog.views import doubles, longs
from stockloom.operators import marts, relational as R, reports as P
from stockloom.plans.freshness import newest_dates

AS_OF = dt.date(1999, 6, 30)
QC_AS_OF = dt.date(2024, 1, 30)
CLOCK = dt.datetime(2001, 12, 1)
CNT = "CAST(count(*) AS BIGINT)"


def balance(w):
    return P.balance_view(w.fact_stock_snapshot, w.reorder_points)


def moves(w):
    return P.movement_view(w.fact_inventory_movement)


def orders(w):
    return P.order_view(w.fact_purchase_order_line)


def receipts(w):
    return P.receipt_view(w.src.ms_ivo, w.src.ms_ivo_c, w.src.ms_po, w.src.quali_rcv)


def budget(w):
    return P.budget_view(w.src.bdg_use, w.src.bdg_amt)


def quality(w):
    return P.quality_view(w.src.quality_result, w.src.drug_gn, w.src.dept_id)


def level(w):
    """Every balance with names; the list report shows its first thousand rows."""
    return P._named(balance(w), w.items, w.dim_warehouse)


def low(w):
    return P.low_stock(balance(w), w.items, w.dim_warehouse)


def expiring(w):
    return P.expiring(moves(w), w.items, w.dim_warehouse, AS_OF)


def dead(w):
    return P.dead_stock(moves(w), w.items, w.dim_warehouse, AS_OF)


def by_item(w, limit=50):
    return P.consumption_by_item(moves(w), w.items, AS_OF, limit=limit)


def monthly(w):
    return P.consumption_monthly(marts.consumption_monthly(w.fact_inventory_movement, 199801, 199912), AS_OF)


def vendors(w, limit=10):
    return P.top_vendors(orders(w), w.dim_vendor, AS_OF, limit=limit)


def fresh(w):
    return P.data_freshness(newest_dates(w), CLOCK)


@query("rpt_01_summary_totals", f"""
SELECT (SELECT {CNT} FROM d_item) AS total_items, (SELECT CAST(count(DISTINCT dim_warehouse_id) AS BIGINT) FROM d_warehouse) AS total_warehouses,
 (SELECT CAST(count(DISTINCT dim_vendor_id) AS BIGINT) FROM d_vendor) AS total_vendors,
 (SELECT CAST(coalesce(sum(quantity),0) AS DOUBLE) FROM v_balance) AS total_stock_qty""")
def _(w):
    return P.summary_totals(w.items, w.dim_warehouse, w.dim_vendor, balance(w))


@query("rpt_02_inventory_level", "SELECT item_code, item_name, warehouse, CAST(quantity AS DOUBLE) AS quantity, last_updated FROM v_named ORDER BY item_code, warehouse LIMIT 1000")
def _(w):
    return P.inventory_level(balance(w), w.items, w.dim_warehouse)


@query("rpt_03_low_stock", f"SELECT item_code, item_name, warehouse, {doubles('stock_qty','reorder_point')}, last_updated AS last_checked FROM r_low")
def _(w):
    return low(w)


@query("rpt_04_expiring_items", "SELECT * REPLACE (CAST(stock_qty AS DOUBLE) AS stock_qty) FROM r_expiring")
def _(w):
    return expiring(w)


@query("rpt_05_consumption_daily", """
SELECT txn_date AS date, CAST(sum(CASE WHEN movement_direction='out' THEN abs(signed_qty) ELSE 0 END) AS DOUBLE) AS total_quantity,
 CAST(sum(CASE WHEN movement_direction='out' THEN abs(signed_value) ELSE 0 END) AS DOUBLE) AS total_value
FROM f_move WHERE txn_date >= DATE '1999-06-30' - 30 GROUP BY 1""")
def _(w):
    # the report's window reaches the mart's window, so the fact scan prunes too
    mart = marts.consumption_daily(w.fact_inventory_movement, AS_OF - dt.timedelta(days=30))
    return P.consumption_daily(mart, AS_OF)


@query("rpt_06_consumption_monthly", "SELECT * FROM r_monthly")
def _(w):
    return monthly(w)


@query("rpt_07_consumption_by_item", f"SELECT item_code, item_name, {doubles('total_consumed','total_cost')} FROM r_by_item")
def _(w):
    return by_item(w)


@query("rpt_08_open_orders", """
SELECT po_number, po_date, vendor_name, CAST(total_amount AS DOUBLE) AS total_amount, status FROM v_order WHERE status IN ('OPEN','PENDING','PARTIAL')""")
def _(w):
    return P.open_orders(orders(w), w.dim_vendor)


@query("rpt_09_pending_receipts", """
SELECT reference_number, receipt_date, vendor_name, CAST(total_quantity AS DOUBLE) AS total_quantity, status FROM v_receipt
WHERE status IN ('PENDING','PARTIAL','AWAITING_QC')""")
def _(w):
    return P.pending_receipts(receipts(w), w.dim_vendor)


@query("rpt_10_budget_burn", "SELECT *, round(100.0::DOUBLE*budget_consumed/nullif(budget_allocated,0),2) AS burn_percentage FROM r_burn")
def _(w):
    return P.budget_burn(budget(w), AS_OF.year)


@query("rpt_11_budget_by_category", "SELECT * FROM r_category")
def _(w):
    return P.budget_by_category(budget(w), AS_OF.year)


@query("rpt_12_quality_recent", "SELECT * FROM v_quality ORDER BY test_date DESC, event_id DESC LIMIT 100")
def _(w):
    return P.quality_recent(quality(w))


@query("rpt_13_quality_summary", "SELECT result_status, count, round(100.0::DOUBLE*count/sum(count) OVER (),2) AS percentage FROM r_quality")
def _(w):
    return P.quality_summary(quality(w), QC_AS_OF)


@query("rpt_14_dead_stock", "SELECT * REPLACE (CAST(stock_qty AS DOUBLE) AS stock_qty) FROM r_dead")
def _(w):
    return dead(w)


@query("rpt_15_expiry_summary", f"""
SELECT CASE WHEN n<=0 THEN 'Expired' WHEN n<=30 THEN '0-30 Days' WHEN n<=90 THEN '30-90 Days' WHEN n<=180 THEN '90-180 Days' ELSE '180+ Days' END AS expiry_range,
 {CNT} AS item_count, CAST(sum(quantity) AS DOUBLE) AS total_quantity
FROM (SELECT expiry_date - DATE '1999-06-30' AS n, quantity FROM v_move WHERE quantity>0) GROUP BY 1""")
def _(w):
    return P.expiry_summary(moves(w), AS_OF)


@query("rpt_16_movement_summary", f"SELECT movement_type, transaction_count, {doubles('total_quantity','total_value')} FROM r_moves")
def _(w):
    return P.movement_summary(moves(w), AS_OF)


@query("rpt_17_top_vendors", "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM r_vendors")
def _(w):
    return vendors(w)


@query("rpt_18_data_freshness", "SELECT * FROM r_fresh")
def _(w):
    return fresh(w)


@query("rpt_19_movement_kpis", """
SELECT CAST(sum(transaction_count) AS BIGINT) AS transactions, CAST(sum(total_quantity) AS DOUBLE) AS quantity, CAST(sum(total_value) AS DOUBLE) AS value,
 CAST(sum(total_value) AS DOUBLE)/greatest(CAST(sum(transaction_count) AS DOUBLE),1) AS avg_transaction_value FROM r_moves""")
def _(w):
    return P.movement_kpis(P.movement_summary(moves(w), AS_OF))


@query("rpt_20_freshness_bands", """
SELECT table_name, hours_since_update, CASE WHEN hours_since_update IS NULL THEN 'unknown' WHEN hours_since_update<24 THEN 'fresh'
 WHEN hours_since_update<48 THEN 'aging' ELSE 'old' END AS band FROM r_fresh""")
def _(w):
    return P.freshness_bands(fresh(w))


@query("rpt_21a_stock_metrics", """
SELECT CAST(count(DISTINCT item_code) AS BIGINT) AS items, CAST(count(DISTINCT warehouse) AS BIGINT) AS warehouses,
 CAST(sum(quantity) AS DOUBLE) AS total_quantity, max(last_updated) AS last_updated FROM v_named""")
def _(w):
    return P.stock_metrics(level(w))


@query("rpt_21b_top_items", """
SELECT item_code, CAST(sum(quantity) AS DOUBLE) AS quantity FROM v_named GROUP BY 1 ORDER BY sum(quantity) DESC, 1 LIMIT 15""")
def _(w):
    return P.top_items(level(w))


@query("rpt_22a_low_stock_risk", f"""
SELECT CAST(count_if(stock_qty<=0) AS BIGINT) AS critical, CAST(count_if(stock_qty>0 AND CAST(stock_qty AS DOUBLE)<=reorder_point*0.5) AS BIGINT) AS warning,
 {CNT} AS total FROM r_low""")
def _(w):
    return P.low_stock_risk(low(w))


@query("rpt_22b_low_stock_by_warehouse", f"SELECT warehouse, {CNT} AS count FROM r_low GROUP BY 1")
def _(w):
    return P.low_stock_by_warehouse(low(w))


@query("rpt_23a_expiry_risk", f"""
SELECT CAST(count_if(days_to_expiry<=0) AS BIGINT) AS expired, CAST(count_if(days_to_expiry BETWEEN 1 AND 30) AS BIGINT) AS within_30,
 CAST(count_if(days_to_expiry BETWEEN 31 AND 90) AS BIGINT) AS within_90, {CNT} AS total FROM r_expiring""")
def _(w):
    return P.expiry_risk(expiring(w))


def _hist_sql(view, column, bins):
    return f"""WITH r AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {view})
SELECT CAST(least(floor((CAST({column} AS DOUBLE)-lo)/((hi-lo)/{bins}.0::DOUBLE)),{bins - 1}) AS BIGINT) AS bin, {CNT} AS row_count FROM {view}, r GROUP BY 1"""


@query("rpt_23b_expiry_histogram", _hist_sql("r_expiring", "days_to_expiry", 20))
def _(w):
    return R.histogram(expiring(w), "days_to_expiry", 20)


@query("rpt_24a_dead_stock_metrics", f"""
SELECT {CNT} AS items, CAST(sum(stock_qty) AS DOUBLE) AS total_qty, round(CAST(sum(days_inactive) AS DOUBLE)/count(*),6) AS avg_days_inactive FROM r_dead""")
def _(w):
    return P.dead_stock_metrics(dead(w))


@query("rpt_24b_dead_stock_histogram", _hist_sql("r_dead", "days_inactive", 20))
def _(w):
    return R.histogram(dead(w), "days_inactive", 20)


@query("rpt_25a_order_metrics", f"""
SELECT {CNT} AS documents, CAST(sum(total_amount) AS DOUBLE) AS total_value, CAST(count(DISTINCT vendor_name) AS BIGINT) AS vendors,
 CAST(sum(total_amount) AS DOUBLE)/greatest(CAST(count(*) AS DOUBLE),1) AS avg_order_value FROM v_order WHERE status IN ('OPEN','PENDING','PARTIAL')""")
def _(w):
    return P.order_metrics(P.open_orders(orders(w), w.dim_vendor))


@query("rpt_25b_order_status_counts", f"SELECT status, {CNT} AS count FROM v_order WHERE status IN ('OPEN','PENDING','PARTIAL') GROUP BY 1")
def _(w):
    return P.status_counts(P.open_orders(orders(w), w.dim_vendor))


_PENDING = "SELECT * FROM v_receipt WHERE status IN ('PENDING','PARTIAL','AWAITING_QC')"


@query("rpt_26a_receipt_metrics", f"""
SELECT {CNT} AS documents, CAST(sum(total_quantity) AS DOUBLE) AS total_quantity, CAST(count(DISTINCT vendor_name) AS BIGINT) AS vendors,
 CAST(sum(total_quantity) AS DOUBLE)/greatest(CAST(count(*) AS DOUBLE),1) AS avg_quantity FROM ({_PENDING})""")
def _(w):
    return P.receipt_metrics(P.pending_receipts(receipts(w), w.dim_vendor))


@query("rpt_26b_days_pending_histogram", "WITH q AS (SELECT CAST(DATE '1999-06-30' - receipt_date AS BIGINT) AS days_pending FROM (" + _PENDING + ")), " +
       _hist_sql("q", "days_pending", 15)[5:])
def _(w):
    return R.histogram(P.days_pending(P.pending_receipts(receipts(w), w.dim_vendor), AS_OF), "days_pending", 15)


@query("rpt_27a_vendor_metrics", f"""
SELECT {CNT} AS vendors, CAST(sum(total_amount) AS DOUBLE) AS total_spent, CAST(sum(total_amount) AS DOUBLE)/greatest(CAST(count(*) AS DOUBLE),1) AS avg_vendor_value FROM r_vendors_all""")
def _(w):
    return P.vendor_metrics(vendors(w, None))


@query("rpt_27b_vendors_by_orders", "SELECT vendor_name, order_count, CAST(total_amount AS DOUBLE) AS total_amount FROM r_vendors_all ORDER BY order_count DESC, dim_vendor_id LIMIT 10")
def _(w):
    return R.top(vendors(w, None), 10, F.desc("order_count"), F.col("dim_vendor_id")).select("vendor_name", "order_count", "total_amount")


@query("rpt_28a_budget_metrics", """
SELECT sum(budget_allocated) AS allocated, sum(budget_consumed) AS consumed, sum(budget_remaining) AS remaining, p AS burn_pct,
 CASE WHEN p>100 THEN p-100 ELSE 0 END AS over_budget_pct FROM (
 SELECT CAST(sum(allocated) AS DOUBLE) AS budget_allocated, CAST(sum(consumed) AS DOUBLE) AS budget_consumed, CAST(sum(remaining) AS DOUBLE) AS budget_remaining,
 CAST(sum(consumed) AS DOUBLE)/greatest(CAST(sum(allocated) AS DOUBLE),1)*100 AS p FROM v_budget WHERE year=1999) GROUP BY p""")
def _(w):
    return P.budget_metrics(P.budget_burn(budget(w), AS_OF.year))


@query("rpt_28b_category_burn", "SELECT *, round(consumed/greatest(allocated,1)*100,1) AS burn_pct FROM r_category")
def _(w):
    return P.category_burn(P.budget_by_category(budget(w), AS_OF.year))


@query("rpt_29_quality_metrics", """
SELECT CAST(sum(CASE WHEN result_status='PASSED' THEN count ELSE 0 END) AS BIGINT) AS passed, CAST(sum(CASE WHEN result_status='FAILED' THEN count ELSE 0 END) AS BIGINT) AS failed,
 CAST(sum(count) AS BIGINT) AS total, CAST(sum(CASE WHEN result_status='PASSED' THEN count ELSE 0 END) AS DOUBLE)/greatest(CAST(sum(count) AS DOUBLE),1)*100 AS pass_rate FROM r_quality""")
def _(w):
    return P.quality_metrics(P.quality_summary(quality(w), QC_AS_OF))


@query("rpt_30_quality_filter_counts", f"""
WITH f AS (SELECT * FROM v_quality WHERE result_status='PASSED' AND regexp_matches(lower(item_name),'red|bolt'))
SELECT 'test_type' AS dimension, coalesce(test_type,'') AS member, {CNT} AS count FROM f GROUP BY 2
UNION ALL SELECT 'status', coalesce(result_status,''), {CNT} FROM f GROUP BY 2
UNION ALL SELECT 'warehouse', coalesce(warehouse_name,''), {CNT} FROM f GROUP BY 2""")
def _(w):
    return P.quality_filter_counts(quality(w), item="RED|bolt", status="PASSED", test_type=R.ALL)


@query("rpt_31a_consumption_metrics", f"SELECT {CNT} AS items, CAST(sum(total_consumed) AS DOUBLE) AS total_quantity, CAST(sum(total_cost) AS DOUBLE) AS total_cost FROM r_by_item_all")
def _(w):
    return P.consumption_metrics(by_item(w, None))


def _unit(order):
    return f"""SELECT item_code, item_name, {doubles('total_consumed','total_cost')},
 CAST(total_cost AS DOUBLE)/greatest(CAST(total_consumed AS DOUBLE),1) AS unit_cost FROM r_by_item_all ORDER BY {order} DESC, item_code LIMIT 20"""


@query("rpt_31b_top_by_quantity", _unit("r_by_item_all.total_consumed"))
def _(w):
    return P.consumption_unit_cost(by_item(w, None))


@query("rpt_31c_top_by_cost", _unit("r_by_item_all.total_cost"))
def _(w):
    return P.consumption_unit_cost(by_item(w, None), by="total_cost")


@query("rpt_32_monthly_trend", "SELECT *, CAST(MONTH AS VARCHAR) || '/' || CAST(YEAR AS VARCHAR) AS date_label FROM r_monthly")
def _(w):
    return P.monthly_trend(monthly(w))
