"""Registered queries: subject-area model, key figures, serving tables."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from stockloom.catalog.planning import tracked_plan
from stockloom.catalog.registry import query
from stockloom.catalog.views import _id, doubles
from stockloom.operators import kpi as K, models as M, serving as V
from stockloom.plans.serving import ServingLayer
from stockloom.plans.slices import in_slices
from stockloom.plans.store import Store, work_folder
from stockloom.sources import extract

SNAP = dt.date(2000, 6, 30)
CNT = "CAST(count(*) AS BIGINT)"


def snapshot(w):
    return M.inventory_snapshot(w.src, SNAP)


def dispensed(w):
    return M.dispensing(w.src, M.valued_lots(w.src))


def plan(w):
    return M.plan_budget(tracked_plan(w))


def budget(w):
    return M.budget_summary(w.src.bdg_amt, w.src.bdg_type)


def contract(w):
    return M.contracts(w.src.cnt, w.src.cnt_c)


def gr(w):
    return extract.goods_receipt_line(w.src.ms_ivo, w.src.ms_ivo_c)


# Model ---------------------------------------------------------------------------

@query("mod_01_dim_product", f"""
SELECT {_id('g.WORKING_CODE')} AS product_key, g.WORKING_CODE AS working_code, DRUG_NAME AS drug_name, DOSAGE_FORM AS dosage_form_name, SALE_UNIT AS sale_unit,
 GROUP_CODE AS group_code, GROUP_KEY AS group_key, SUPPLY_TYPE AS supply_type, REORDER_QTY AS reorder_qty, MIN_LEVEL AS min_level,
 CAST(LAST_BUY_COST AS DOUBLE) AS last_buy_cost, LAST_VENDOR_CODE AS last_vendor_code, CAST(IS_ED AS BIGINT) AS is_ed, CAST(HOSP_LIST AS BIGINT) AS hosp_list,
 HIDE AS hide_flag, a.ABC_FLAG AS abc_flag, CAST(CASE WHEN HIDE IS NULL OR HIDE<>'Y' THEN 1 ELSE 0 END AS BIGINT) AS active_flag
FROM drug_gn g LEFT JOIN (SELECT WORKING_CODE, ABC_FLAG FROM inv_md QUALIFY row_number() OVER (PARTITION BY WORKING_CODE ORDER BY LAST_UPDATE DESC, DEPT_ID DESC)=1) a
 ON a.WORKING_CODE=g.WORKING_CODE""")
def _(w):
    return M.dim_product(w.src.drug_gn, w.src.inv_md)


@query("mod_02_dim_trade_product", f"""
SELECT {_id('TRADE_CODE')} AS trade_product_key, TRADE_CODE AS trade_code, WORKING_CODE AS working_code, ltrim(VENDOR_CODE,'0') AS vendor_code,
 CASE WHEN ltrim(MANUFAC_CODE,'0')='' THEN '0' ELSE ltrim(MANUFAC_CODE,'0') END AS manufac_code, TRADE_NAME AS trade_name, PACK_RATIO AS pack_ratio,
 CAST(LAST_BUY_COST AS DOUBLE) AS buy_unit_cost, HIDE AS hide_flag
FROM (SELECT * REPLACE (CASE WHEN VENDOR_CODE='000' THEN '000' ELSE VENDOR_CODE END AS VENDOR_CODE) FROM drug_vn) WHERE VENDOR_CODE<>'000'
UNION ALL SELECT {_id('TRADE_CODE')}, TRADE_CODE, WORKING_CODE, '0', CASE WHEN ltrim(MANUFAC_CODE,'0')='' THEN '0' ELSE ltrim(MANUFAC_CODE,'0') END,
 TRADE_NAME, PACK_RATIO, CAST(LAST_BUY_COST AS DOUBLE), HIDE FROM drug_vn WHERE VENDOR_CODE='000'""")
def _(w):
    return M.dim_trade_product(w.src.drug_vn)


@query("mod_03_dim_vendor", f"""
SELECT {_id('CAST(COMPANY_CODE AS VARCHAR)')} AS vendor_key, COMPANY_CODE AS company_code, COMPANY_NAME AS company_name, VENDOR_FLAG AS vendor_flag,
 MANUFAC_FLAG AS manufac_flag, HIDE AS hide_flag FROM company""")
def _(w):
    return M.dim_vendor(w.src.company)


@query("mod_04_dim_department", f"""
SELECT {_id('DEPT_ID')} AS department_key, DEPT_ID AS dept_id, DEPT_NAME AS dept_name, KEEP_INV AS keep_inv, DEPT_TYPE AS dept_type, HIDE AS hide_flag FROM dept_id""")
def _(w):
    return M.dim_department(w.src.dept_id)


@query("mod_05_dim_budget", f"SELECT {_id('BUDGET_TYPE')} AS budget_key, BUDGET_TYPE AS budget_type, BUDGET_NAME AS budget_name, HIDE AS hide_flag FROM bdg_type")
def _(w):
    return M.dim_budget(w.src.bdg_type)


@query("mod_06_inventory_snapshot", "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ("qty_on_hand", "lot_cost", "pack_cost", "stock_value")) + ") FROM m_snapshot")
def _(w):
    return in_slices(w.src, lambda t: M.inventory_snapshot(t, SNAP), "snapshot")


@query("mod_07_movement_detail", "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ("value", "cost", "active_qty", "remain_qty", "movement_qty_abs")) + ") FROM m_move")
def _(w):
    return M.movement_detail(w.src.card)


@query("mod_08_dispensing", "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ("disp_qty", "unit_cost_basis", "disp_value")) + ") FROM m_disp")
def _(w):
    return dispensed(w)


@query("mod_09_requests", "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ("qty_req", "qty_dist", "pending_qty")) + ") FROM m_request")
def _(w):
    return M.requests(w.src.accr_disp)


_TRI = ", ".join(f"QTY_TRI AS qty_tri{q}" for q in (1, 2, 3, 4)) + ", " + ", ".join(
    f"QTY_BUY_TRI{q} AS qty_{p}_tri{q}" for p in ("buy", "rcv") for q in (1, 2, 3, 4))
_PLAN = f"""SELECT YEAR AS plan_year, WORKING_CODE AS working_code, DEPT_ID AS dept_id, PACK_RATIO AS pack_ratio, AVG_3_YEAR AS avg_3_year,
 RATE_1_YEAR AS rate_1_year, RATE_2_YEAR AS rate_2_year, RATE_3_YEAR AS rate_3_year, MIN_LEVEL AS min_level, QTY_THIS_YEAR AS qty_this_year,
 VALUE_THIS_YEAR AS value_this_year, BUY_QTY AS buy_qty, BUY_VALUE AS buy_value, QTY_ON_HAND AS qty_on_hand, PACK_UNIT_COST AS pack_unit_cost,
 FORECAST AS forecast_value, QTY_FORECAST AS qty_forecast, QTY_PRE_PLAN AS qty_pre_plan, BUYMET_CODE AS buy_method_code, {_TRI} FROM plan_tracking"""


@query("mod_10_plan_budget", _PLAN)
def _(w):
    return plan(w)


@query("mod_10b_plan_budget_long", f"WITH p AS ({_PLAN}) " + "\nUNION ALL ".join(
    f"SELECT plan_year, working_code, dept_id, CAST({q} AS BIGINT) AS quarter, qty_tri{q} AS qty_plan, qty_buy_tri{q} AS qty_buy, qty_rcv_tri{q} AS qty_rcv FROM p"
    for q in (1, 2, 3, 4)))
def _(w):
    return M.plan_budget_long(plan(w))


_BUD = [f"tri{q}_{n}" for n in ("budget", "buy", "remain") for q in (1, 2, 3, 4)]


@query("mod_11_budget_summary", "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ["budget_amount", "total_buy", "budget_remain", "debt", *_BUD]) + ") FROM m_budget")
def _(w):
    return budget(w)


@query("mod_12_contracts", "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ("qty_cnt", "cost_cnt", "cost_remain", "total_contract_cost")) + ") FROM m_contract")
def _(w):
    return contract(w)


# Single-row key figures: name, column, SQL ------------------------------------------

def _single(name, frame, column, sql):
    @query(name, sql)
    def _(w):
        return frame(w).select(column)


_single("kpi_001_total_inventory_value", lambda w: K.position_kpis(snapshot(w)), "total_inventory_value",
        "SELECT CAST(sum(stock_value) AS DOUBLE) AS total_inventory_value FROM m_snapshot")
_single("kpi_002_total_sku", lambda w: K.active_items(M.dim_product(w.src.drug_gn, w.src.inv_md)), "sku_count",
        "SELECT CAST(count(DISTINCT WORKING_CODE) AS BIGINT) AS sku_count FROM drug_gn WHERE HIDE IS NULL OR HIDE<>'Y'")
_single("kpi_003_stocked_sku", lambda w: K.position_kpis(snapshot(w)), "active_stocked_sku_count",
        "SELECT CAST(count(DISTINCT working_code) AS BIGINT) AS active_stocked_sku_count FROM m_snapshot WHERE qty_on_hand>0")
_single("kpi_004_low_stock_sku", lambda w: K.position_kpis(snapshot(w)), "low_stock_sku_count",
        "SELECT CAST(count(DISTINCT working_code) AS BIGINT) AS low_stock_sku_count FROM m_snapshot WHERE CAST(qty_on_hand AS DOUBLE)<reorder_threshold")
_single("kpi_005_out_of_stock_sku", lambda w: K.position_kpis(snapshot(w)), "out_of_stock_sku_count",
        "SELECT CAST(count(DISTINCT working_code) AS BIGINT) AS out_of_stock_sku_count FROM m_snapshot WHERE qty_on_hand<=0")
_single("kpi_006_near_expiry_value", lambda w: K.position_kpis(snapshot(w)), "near_expiry_value",
        "SELECT CAST(sum(stock_value) AS DOUBLE) AS near_expiry_value FROM m_snapshot WHERE days_to_expiry BETWEEN 0 AND 90")
_single("kpi_007_expired_value", lambda w: K.position_kpis(snapshot(w)), "expired_stock_value",
        "SELECT CAST(sum(stock_value) AS DOUBLE) AS expired_stock_value FROM m_snapshot WHERE expired_date<snapshot_date AND qty_on_hand>0")
_single("kpi_008_dead_stock_value", lambda w: K.position_kpis(snapshot(w)), "dead_stock_value",
        "SELECT CAST(sum(stock_value) AS DOUBLE) AS dead_stock_value FROM m_snapshot WHERE snapshot_date-last_movement_date>=180")
_single("kpi_010_consumption_qty", lambda w: dispensed(w).agg(F.sum("disp_qty").alias("consumption_qty")), "consumption_qty",
        "SELECT CAST(sum(DISP_QTY) AS DOUBLE) AS consumption_qty FROM dispensed")
_single("kpi_011_consumption_value", lambda w: dispensed(w).agg(F.sum("disp_value").alias("consumption_value")), "consumption_value",
        "SELECT CAST(sum(disp_value) AS DOUBLE) AS consumption_value FROM m_disp")
_single("kpi_016_contracted_items", lambda w: K.contract_kpis(contract(w)), "contracted_items",
        "SELECT CAST(count(DISTINCT working_code) AS BIGINT) AS contracted_items FROM m_contract")
_single("kpi_017_contract_value", lambda w: K.contract_kpis(contract(w)), "contract_value",
        "SELECT CAST(sum(cost_cnt) AS DOUBLE) AS contract_value FROM m_contract")
_single("kpi_018_remaining_contract_value", lambda w: K.contract_kpis(contract(w)), "remaining_value",
        "SELECT CAST(sum(cost_remain) AS DOUBLE) AS remaining_value FROM m_contract")
_single("kpi_020_contract_utilization", lambda w: K.contract_kpis(contract(w)), "utilization_rate",
        "SELECT round(CAST(sum(cost_cnt)-sum(cost_remain) AS DOUBLE)/CAST(sum(cost_cnt) AS DOUBLE),6) AS utilization_rate FROM m_contract")

_LIVE = "m_request WHERE del_flag<>'Y' OR del_flag IS NULL"
for _n, _c, _s in (("kpi_021_requested_qty", "requested_qty", "CAST(sum(qty_req) AS DOUBLE)"),
                   ("kpi_022_distributed_qty", "distributed_qty", "CAST(sum(qty_dist) AS DOUBLE)"),
                   ("kpi_023_fill_rate", "fill_rate", "round(CAST(sum(qty_dist) AS DOUBLE)/CAST(sum(qty_req) AS DOUBLE),6)"),
                   ("kpi_024_pending_qty", "pending_qty", "CAST(sum(qty_req-qty_dist) AS DOUBLE)")):
    _single(_n, lambda w: K.request_kpis(M.requests(w.src.accr_disp)), _c, f"SELECT {_s} AS {_c} FROM {_LIVE}")

for _n, _c, _s in (("kpi_025_movement_count", "movement_count", CNT),
                   ("kpi_026_adjustment_count", "adjustment_count", "CAST(count_if(movement_direction='ADJ') AS BIGINT)"),
                   ("kpi_027_movement_value", "movement_value", "CAST(sum(value) AS DOUBLE)"),
                   ("kpi_028_free_goods_value", "free_goods_value", "CAST(sum(CASE WHEN free_flag='Y' THEN value END) AS DOUBLE)")):
    _single(_n, lambda w: K.movement_kpis(M.movement_detail(w.src.card)), _c,
            f"SELECT {_s} AS {_c} FROM m_move WHERE cancel_flag IS NULL OR cancel_flag<>'Y'")


def _dec(c):
    return f"CAST(sum(CAST({c} AS DECIMAL(24,4))) AS DOUBLE)"


for _n, _c, _s in (("kpi_029_planned_qty", "planned_qty", _dec("QTY_THIS_YEAR")), ("kpi_030_planned_value", "planned_value", _dec("VALUE_THIS_YEAR")),
                   ("kpi_031_forecast_qty", "forecast_qty", _dec("QTY_FORECAST")), ("kpi_032_forecast_value", "forecast_value", _dec("FORECAST")),
                   ("kpi_033_buy_value", "buy_value", _dec("BUY_VALUE")),
                   ("kpi_034_plan_completion", "completion_rate", f"round({_dec('BUY_QTY')}/{_dec('QTY_THIS_YEAR')},6)")):
    _single(_n, lambda w: K.plan_kpis(plan(w)), _c, f"SELECT {_s} AS {_c} FROM plan_tracking")


@query("kpi_035_quarter_completion", "SELECT " + ", ".join(
    f"round({_dec(f'QTY_BUY_TRI{q}')}/{_dec('QTY_TRI')},6) AS completion_t{q}" for q in (1, 2, 3, 4)) + " FROM plan_tracking")
def _(w):
    return K.plan_kpis(plan(w)).select(*[f"completion_t{q}" for q in (1, 2, 3, 4)])


for _n, _c, _s in (("kpi_036_budget_allocated", "allocated", "CAST(sum(budget_amount) AS DOUBLE)"), ("kpi_037_budget_used", "used", "CAST(sum(total_buy) AS DOUBLE)"),
                   ("kpi_038_budget_remaining", "remaining", "CAST(sum(budget_remain) AS DOUBLE)"),
                   ("kpi_039_burn_rate", "burn_rate", "round(CAST(sum(total_buy) AS DOUBLE)/CAST(sum(budget_amount) AS DOUBLE),6)"),
                   ("kpi_040_debt", "debt", "CAST(sum(debt) AS DOUBLE)")):
    _single(_n, lambda w: K.budget_kpis(budget(w)), _c, f"SELECT {_s} AS {_c} FROM m_budget")


# Grouped key figures -------------------------------------------------------------------

_USE90 = """SELECT working_code, sum(disp_qty) AS use_qty FROM m_disp WHERE working_code IS NOT NULL
 AND disp_date BETWEEN DATE '2000-06-30' - 89 AND DATE '2000-06-30' GROUP BY 1"""
_STOCK = "SELECT working_code, sum(qty_on_hand) AS qty_on_hand FROM m_snapshot GROUP BY 1"


@query("kpi_009_days_of_stock", f"""
WITH u AS ({_USE90}), s AS ({_STOCK})
SELECT s.working_code, CAST(qty_on_hand AS DOUBLE) AS qty_on_hand, round(CAST(use_qty AS DOUBLE)/90.0::DOUBLE,6) AS avg_daily_consumption,
 round(CAST(qty_on_hand AS DOUBLE)/nullif(CAST(use_qty AS DOUBLE)/90.0::DOUBLE,0),2) AS days_of_stock FROM s LEFT JOIN u ON u.working_code=s.working_code""")
def _(w):
    return K.days_of_stock(snapshot(w), dispensed(w), SNAP)


@query("kpi_012_average_monthly_usage", """
SELECT working_code, round(CAST(sum(disp_qty) AS DOUBLE)/3.0::DOUBLE,6) AS avg_monthly_usage FROM m_disp
WHERE working_code IS NOT NULL AND disp_date BETWEEN DATE '2000-04-01' AND DATE '2000-06-30' GROUP BY 1""")
def _(w):
    return K.monthly_usage(dispensed(w), SNAP)


@query("kpi_013_fast_movers", f"""
WITH u AS ({_USE90}) SELECT working_code, CAST(use_qty AS DOUBLE) AS use_qty FROM u QUALIFY percent_rank() OVER (ORDER BY use_qty DESC)<=0.2""")
def _(w):
    return K.fast_movers(dispensed(w), SNAP)


@query("kpi_014_slow_movers", f"""
WITH u AS ({_USE90}), s AS ({_STOCK}) SELECT s.working_code, CAST(qty_on_hand AS DOUBLE) AS qty_on_hand, CAST(coalesce(use_qty,0) AS DOUBLE) AS use_qty
FROM s LEFT JOIN u ON u.working_code=s.working_code WHERE qty_on_hand>0 AND coalesce(use_qty,0)<=10""")
def _(w):
    return K.slow_movers(snapshot(w), dispensed(w), SNAP)


@query("kpi_015_department_share", """
SELECT DISP_DEPT AS disp_dept, CAST(sum(DISP_QTY) AS DOUBLE) AS disp_qty,
 round(CAST(sum(DISP_QTY) AS DOUBLE)/CAST(sum(sum(DISP_QTY)) OVER () AS DOUBLE),6) AS share FROM dispensed GROUP BY 1""")
def _(w):
    return K.department_share(dispensed(w))


@query("kpi_019_contract_by_vendor", "SELECT vendor_contract_ref, CAST(sum(cost_cnt) AS DOUBLE) AS contract_value FROM m_contract GROUP BY 1")
def _(w):
    return K.contract_by_vendor(contract(w))


@query("kpi_041_plan_vs_actual", """
SELECT YEAR AS plan_year, WORKING_CODE AS working_code, DEPT_ID AS dept_id, QTY_THIS_YEAR AS qty_this_year, coalesce(BUY_QTY,0) AS buy_qty,
 round((coalesce(BUY_QTY,0)-QTY_THIS_YEAR)/nullif(QTY_THIS_YEAR,0),6) AS variance FROM plan_tracking""")
def _(w):
    return K.plan_vs_actual(plan(w))


_ALERT = "SELECT '{k}' AS alert, working_code AS subject, dept_id AS place, trade_code, lot_no, CAST({m} AS DOUBLE) AS measure FROM m_snapshot WHERE {r}"


@query("kpi_042_alerts", "\nUNION ALL ".join(_ALERT.replace("{k}", k).replace("{m}", m).replace("{r}", r) for k, m, r in (
    ("low_stock", "qty_on_hand", "low_stock_flag AND qty_on_hand>0"), ("out_of_stock", "qty_on_hand", "qty_on_hand=0"),
    ("near_expiry", "days_to_expiry", "days_to_expiry BETWEEN 0 AND 90 AND qty_on_hand>0"),
    ("dead_stock", "stock_value", "dead_stock_flag AND qty_on_hand>0"))) + """
UNION ALL SELECT 'budget_risk', budget_type, CAST(fiscal_year AS VARCHAR), NULL, NULL, burn_rate FROM m_budget WHERE fiscal_year=2000 AND burn_rate*100>85""")
def _(w):
    stock = in_slices(w.src, lambda t: M.inventory_snapshot(t, SNAP).select(*K.ALERTED), "alerts")
    return K.alerts(stock, budget(w), SNAP)


@query("kpi_043a_vendor_spend", f"SELECT source_vendor_code, CAST(sum(received_value) AS DOUBLE) AS spend, {CNT} AS line_count FROM gr_src GROUP BY 1")
def _(w):
    return K.vendor_spend(gr(w))


@query("kpi_043b_lead_times", f"""
SELECT source_vendor_code, {CNT} AS line_count, round(CAST(sum(d) AS DOUBLE)/count(*),6) AS avg_lead_days, min(d) AS min_lead_days, max(d) AS max_lead_days FROM (
 SELECT g.source_vendor_code, CAST(g.gr_date-p.PO_DATE AS BIGINT) AS d FROM gr_src g JOIN ms_po p ON p.PO_NO=g.po_no) WHERE d>=0 GROUP BY 1""")
def _(w):
    return K.lead_times(w.src.ms_po, gr(w))


@query("kpi_043c_price_trend", """
WITH d AS (SELECT source_item_code, source_vendor_code, gr_date, round(CAST(sum(received_unit_cost) AS DOUBLE)/count(*),10) AS unit_price FROM gr_src GROUP BY 1,2,3),
 l AS (SELECT *, lag(unit_price) OVER (PARTITION BY source_item_code, source_vendor_code ORDER BY gr_date) AS previous_price FROM d)
SELECT *, round((unit_price-previous_price)/abs(previous_price)*100,4) AS change_pct FROM l""")
def _(w):
    return K.price_trend(gr(w))


@query("kpi_044_return_trend", f"""
SELECT CAST(substr(RETURN_DATE,1,6) AS BIGINT) AS year_month, coalesce(REASON_NAME,'unknown') AS reason, {CNT} AS return_count,
 CAST(sum(RETURN_QTY) AS DOUBLE) AS return_qty, CAST(sum(RETURN_COST) AS DOUBLE) AS return_cost
FROM inv_rtn_c r LEFT JOIN rtn_reason n ON n.REASON_ID=r.REASON_ID GROUP BY 1,2""")
def _(w):
    return K.return_trend(w.src.inv_rtn_c, w.src.rtn_reason)


@query("kpi_045_receipt_quality", f"""
SELECT WORKING_CODE, {CNT} AS tests, CAST(count_if(QUALI_VALUE<>'N') AS BIGINT) AS passed, CAST(count_if(QUALI_VALUE='N') AS BIGINT) AS failed,
 round(CAST(count_if(QUALI_VALUE<>'N') AS DOUBLE)/count(*),6) AS pass_rate, round(CAST(count_if(QUALI_VALUE='N') AS DOUBLE)/count(*),6) AS fail_rate
FROM quali_rcv GROUP BY 1""")
def _(w):
    return K.receipt_quality(w.src.quali_rcv)


@query("kpi_046a_stock_breakdown", f"SELECT dept_id, location, lot_no, CAST(sum(qty_on_hand) AS DOUBLE) AS qty_on_hand, CAST(sum(stock_value) AS DOUBLE) AS stock_value, {CNT} AS lots FROM m_snapshot GROUP BY 1,2,3")
def _(w):
    return K.stock_breakdown(snapshot(w))


@query("kpi_046b_top_stock_items", """
SELECT working_code, CAST(sum(qty_on_hand) AS DOUBLE) AS qty_on_hand, CAST(sum(stock_value) AS DOUBLE) AS stock_value FROM m_snapshot GROUP BY 1
ORDER BY sum(m_snapshot.stock_value) DESC, 1 LIMIT 20""")
def _(w):
    return K.top_stock_items(snapshot(w))


@query("kpi_046c_risk_heat", f"SELECT dept_id, expiry_bucket, stock_status, {CNT} AS lots, CAST(sum(stock_value) AS DOUBLE) AS stock_value FROM m_snapshot GROUP BY 1,2,3")
def _(w):
    return K.risk_heat(snapshot(w))


# Serving ---------------------------------------------------------------------------------

_EXEC = """
SELECT DATE '2000-06-30' AS snapshot_date, CAST(sum(stock_value) AS DOUBLE) AS total_inventory_value,
 CAST(count(DISTINCT CASE WHEN qty_on_hand>0 THEN working_code END) AS BIGINT) AS active_stocked_sku_count,
 CAST(count(DISTINCT CASE WHEN low_stock_flag THEN working_code END) AS BIGINT) AS low_stock_sku_count,
 CAST(sum(CASE WHEN days_to_expiry BETWEEN 0 AND 90 THEN stock_value END) AS DOUBLE) AS near_expiry_value,
 CAST(sum(CASE WHEN days_to_expiry<0 AND qty_on_hand>0 THEN stock_value END) AS DOUBLE) AS expired_stock_value,
 CAST(sum(CASE WHEN dead_stock_flag THEN stock_value END) AS DOUBLE) AS dead_stock_value,
 (SELECT CAST(sum(disp_value) AS DOUBLE) FROM m_disp WHERE disp_date BETWEEN DATE '2000-06-01' AND DATE '2000-06-30') AS monthly_consumption_value,
 (SELECT CAST(sum(total_buy) AS DOUBLE) FROM m_budget WHERE fiscal_year=2000) AS budget_used,
 (SELECT CAST(sum(budget_remain) AS DOUBLE) FROM m_budget WHERE fiscal_year=2000) AS budget_remaining,
 (SELECT round(CAST(sum(total_buy) AS DOUBLE)/CAST(sum(budget_amount) AS DOUBLE),6) FROM m_budget WHERE fiscal_year=2000) AS budget_burn_rate
FROM m_snapshot"""


@query("srv_01_exec_dashboard", _EXEC)
def _(w):
    stock = in_slices(w.src, lambda t: M.inventory_snapshot(t, SNAP).select(*K.POSITIONED), "stock")
    used = in_slices(w.src, lambda t: M.dispensing(t, M.valued_lots(t)).select("disp_date", "disp_value"), "used")
    return V.exec_dashboard(stock, used, budget(w), SNAP)


def serving(w):
    """The stored layer of this source, one for each application: built once, then rebuilt where an input changed."""
    shared = w.spark.conf.get("spark.checkpoint.dir", None)
    name = f"{w.spark.sparkContext.applicationId}-{hashlib.sha256(w.src.data_dir.encode()).hexdigest()[:12]}"
    if name not in _LAYERS:
        root = f"{shared.rstrip('/')}/stockloom/serving-{name}" if shared else work_folder(w.spark, "serving")
        _LAYERS[name] = ServingLayer(w.spark, w.src.data_dir, Store(w.spark, root), SNAP)
    return _LAYERS[name]


_LAYERS: dict[str, ServingLayer] = {}


@query("srv_01b_stored_dashboard", _EXEC)
def _(w):
    """The executive row from its stored table."""
    layer = serving(w)
    layer.refresh(("serving.exec_dashboard",))
    return layer.read("serving.exec_dashboard")


@query("srv_02_inventory_risk", """
WITH u AS (SELECT working_code, disp_dept, sum(disp_qty) AS q FROM m_disp WHERE working_code IS NOT NULL
 AND disp_date BETWEEN DATE '2000-06-30' - 89 AND DATE '2000-06-30' GROUP BY 1,2),
r AS (SELECT s.*, u.q, CASE WHEN days_to_expiry<0 AND qty_on_hand>0 THEN 'expired' WHEN qty_on_hand<=0 THEN 'out_of_stock'
 WHEN days_to_expiry<=90 THEN 'near_expiry' WHEN dead_stock_flag THEN 'dead_stock' WHEN low_stock_flag THEN 'low_stock' ELSE 'none' END AS risk_type
 FROM m_snapshot s LEFT JOIN u ON u.working_code=s.working_code AND u.disp_dept=s.dept_id)
SELECT snapshot_date, working_code, trade_code, dept_id, lot_no, expired_date, CAST(qty_on_hand AS DOUBLE) AS qty_on_hand, CAST(stock_value AS DOUBLE) AS stock_value,
 days_to_expiry, round(CAST(qty_on_hand AS DOUBLE)/nullif(CAST(q AS DOUBLE)/90.0::DOUBLE,0),2) AS dos, risk_type,
 CAST(CASE risk_type WHEN 'expired' THEN 100 WHEN 'out_of_stock' THEN 90 WHEN 'near_expiry' THEN 80 WHEN 'dead_stock' THEN 60 WHEN 'low_stock' THEN 50 ELSE 0 END AS BIGINT) AS risk_score,
 CASE risk_type WHEN 'expired' THEN 'remove from stock' WHEN 'out_of_stock' THEN 'reorder now' WHEN 'near_expiry' THEN 'use first or return'
  WHEN 'dead_stock' THEN 'move to another department' WHEN 'low_stock' THEN 'reorder' ELSE 'none' END AS suggested_action FROM r""")
def _(w):
    return in_slices(w.src, lambda t: V.inventory_risk(M.inventory_snapshot(t, SNAP), M.dispensing(t, M.valued_lots(t)), SNAP), "risk")


@query("srv_03_expiry_lots", f"SELECT snapshot_date, working_code, trade_code, lot_no, expired_date, days_to_expiry, {doubles('qty_on_hand','stock_value')}, dept_id, location FROM m_snapshot")
def _(w):
    return V.expiry_lots(snapshot(w))


_MONTH_USE = """SELECT CAST(strftime(disp_date,'%Y%m') AS BIGINT) AS year_month, working_code, disp_dept AS dept_id, sum(disp_qty) AS q, sum(disp_value) AS v,
 year(disp_date)*12+month(disp_date) AS n FROM m_disp WHERE working_code IS NOT NULL GROUP BY ALL"""


_CONSUMED = f"""
WITH m AS ({_MONTH_USE}), c AS (SELECT working_code, CASE WHEN percent_rank() OVER (ORDER BY t DESC)<=0.2 THEN 'fast' WHEN t<=50 THEN 'slow' ELSE 'normal' END AS movement_class
 FROM (SELECT working_code, sum(q) AS t FROM m GROUP BY 1))
SELECT year_month, m.working_code, dept_id, CAST(q AS DOUBLE) AS total_disp_qty, CAST(v AS DOUBLE) AS total_disp_value,
 round(CAST(sum(q) OVER (PARTITION BY m.working_code, dept_id ORDER BY n RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)/3.0::DOUBLE,6) AS avg_monthly_usage, movement_class
FROM m JOIN c ON c.working_code=m.working_code"""


@query("srv_04_consumption_monthly", _CONSUMED)
def _(w):
    return V.consumption_monthly(dispensed(w))


@query("srv_04b_stored_consumption", _CONSUMED)
def _(w):
    layer = serving(w)
    layer.refresh(("serving.consumption_monthly",))
    return layer.read("serving.consumption_monthly")


@query("srv_05_department_usage", f"""
WITH m AS ({_MONTH_USE}), d AS (SELECT year_month, dept_id, sum(q) AS q, sum(v) AS v, count(DISTINCT working_code) AS n FROM m GROUP BY 1,2)
SELECT year_month, dept_id, CAST(q AS DOUBLE) AS total_usage_qty, CAST(v AS DOUBLE) AS total_usage_value, CAST(n AS BIGINT) AS active_item_count,
 round(100.0::DOUBLE*CAST(q AS DOUBLE)/CAST(sum(q) OVER (PARTITION BY year_month) AS DOUBLE),2) AS usage_share_pct FROM d""")
def _(w):
    return V.department_usage(dispensed(w))


@query("srv_06_plan_vs_actual", """
SELECT YEAR AS plan_year, WORKING_CODE AS working_code, DEPT_ID AS dept_id, QTY_THIS_YEAR AS planned_qty, VALUE_THIS_YEAR AS planned_value,
 coalesce(BUY_QTY,0) AS actual_buy_qty, coalesce(BUY_VALUE,0) AS actual_buy_value,
 coalesce(QTY_BUY_TRI1,0)+coalesce(QTY_BUY_TRI2,0)+coalesce(QTY_BUY_TRI3,0)+coalesce(QTY_BUY_TRI4,0) AS actual_rcv_qty,
 round((coalesce(BUY_QTY,0)-QTY_THIS_YEAR)*100/nullif(QTY_THIS_YEAR,0),2) AS variance_pct, round(coalesce(BUY_QTY,0)/nullif(QTY_THIS_YEAR,0),6) AS completion_rate
FROM plan_tracking""")
def _(w):
    return V.plan_vs_actual(plan(w))


@query("srv_07_budget_burn", f"SELECT fiscal_year, budget_type, budget_name, {doubles('budget_amount','total_buy','budget_remain','debt')}, burn_rate FROM m_budget")
def _(w):
    return V.budget_burn(budget(w))


@query("srv_08_movement_exceptions", """
WITH r AS (SELECT m.*, CASE WHEN cancel_flag='Y' THEN 'cancelled' WHEN g.WORKING_CODE IS NULL THEN 'unknown item' WHEN movement_direction='UNKNOWN' THEN 'unknown status'
 WHEN remain_qty<0 THEN 'negative balance' WHEN movement_direction='ADJ' THEN 'adjustment' END AS exception_reason
 FROM m_move m LEFT JOIN drug_gn g ON g.WORKING_CODE=m.working_code)
SELECT operate_date AS movement_date, dept_id, working_code, movement_direction, rs_status, exception_reason, CAST(sum(movement_qty_abs) AS DOUBLE) AS movement_qty,
 CAST(sum(value) AS DOUBLE) AS movement_value, exception_reason IS NOT NULL AS exception_flag FROM r GROUP BY 1,2,3,4,5,6""")
def _(w):
    return V.movement_exceptions(M.movement_detail(w.src.card), w.src.drug_gn)
