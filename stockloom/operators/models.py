"""Subject-area model: product, vendor, department and budget dimensions, snapshot and activity facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.functions import dates as D, keys, measures as M
from stockloom.operators.lookups import latest

LOT_KEY = ["working_code", "trade_code", "dept_id", "lot_no"]


def _active() -> Column:
    return (F.coalesce("HIDE", F.lit("N")) != "Y").cast("int").alias("active_flag")


# Dimensions ---------------------------------------------------------------------

def dim_product(drug_gn: DataFrame, inv_md: DataFrame) -> DataFrame:
    """Items with the newest ABC class any department gave them."""
    abc = latest(inv_md, ["WORKING_CODE"], [F.col("LAST_UPDATE"), F.col("DEPT_ID")], ["ABC_FLAG"])
    return drug_gn.join(abc, "WORKING_CODE", "left").select(
        keys.surrogate_id("WORKING_CODE").alias("product_key"), F.col("WORKING_CODE").alias("working_code"),
        F.col("DRUG_NAME").alias("drug_name"), F.col("DOSAGE_FORM").alias("dosage_form_name"), F.col("SALE_UNIT").alias("sale_unit"),
        F.col("GROUP_CODE").alias("group_code"), F.col("GROUP_KEY").alias("group_key"), F.col("SUPPLY_TYPE").alias("supply_type"),
        F.col("REORDER_QTY").alias("reorder_qty"), F.col("MIN_LEVEL").alias("min_level"), F.col("LAST_BUY_COST").alias("last_buy_cost"),
        F.col("LAST_VENDOR_CODE").alias("last_vendor_code"), F.col("IS_ED").alias("is_ed"), F.col("HOSP_LIST").alias("hosp_list"),
        F.col("HIDE").alias("hide_flag"), F.col("ABC_FLAG").alias("abc_flag"), _active())


def dim_trade_product(drug_vn: DataFrame) -> DataFrame:
    return drug_vn.select(
        keys.surrogate_id("TRADE_CODE").alias("trade_product_key"), F.col("TRADE_CODE").alias("trade_code"),
        F.col("WORKING_CODE").alias("working_code"), keys.normal_code("VENDOR_CODE").alias("vendor_code"),
        keys.normal_code("MANUFAC_CODE").alias("manufac_code"), F.col("TRADE_NAME").alias("trade_name"),
        F.col("PACK_RATIO").alias("pack_ratio"), F.col("LAST_BUY_COST").alias("buy_unit_cost"), F.col("HIDE").alias("hide_flag"))


def dim_vendor(company: DataFrame) -> DataFrame:
    return company.select(
        keys.surrogate_id(keys.normal_code("COMPANY_CODE")).alias("vendor_key"), F.col("COMPANY_CODE").alias("company_code"),
        F.col("COMPANY_NAME").alias("company_name"), F.col("VENDOR_FLAG").alias("vendor_flag"),
        F.col("MANUFAC_FLAG").alias("manufac_flag"), F.col("HIDE").alias("hide_flag"))


def dim_department(dept: DataFrame) -> DataFrame:
    return dept.select(
        keys.surrogate_id("DEPT_ID").alias("department_key"), F.col("DEPT_ID").alias("dept_id"), F.col("DEPT_NAME").alias("dept_name"),
        F.col("KEEP_INV").alias("keep_inv"), F.col("DEPT_TYPE").alias("dept_type"), F.col("HIDE").alias("hide_flag"))


def dim_budget(bdg_type: DataFrame) -> DataFrame:
    return bdg_type.select(
        keys.surrogate_id("BUDGET_TYPE").alias("budget_key"), F.col("BUDGET_TYPE").alias("budget_type"),
        F.col("BUDGET_NAME").alias("budget_name"), F.col("HIDE").alias("hide_flag"))


# Facts ----------------------------------------------------------------------------

def last_movement(card: DataFrame) -> DataFrame:
    return (card.filter("LOT_NO IS NOT NULL")
            .groupBy(F.col("WORKING_CODE").alias("working_code"), F.col("TRADE_CODE").alias("trade_code"),
                     F.col("DEPT_ID").alias("dept_id"), F.col("LOT_NO").alias("lot_no"))
            .agg(F.max(F.to_date("OPERATE_DATE")).alias("last_movement_date")))


def _lots(t) -> DataFrame:
    return t.inv_md_c.select(
        F.col("WORKING_CODE").alias("working_code"), F.col("TRADE_CODE").alias("trade_code"), F.col("DEPT_ID").alias("dept_id"),
        F.col("LOCATION").alias("location"), F.col("LOT_NO").alias("lot_no"), F.col("EXPIRED_DATE").alias("expired_date"),
        F.col("VENDOR_CODE").alias("vendor_code"), F.col("QTY_ON_HAND").alias("qty_on_hand"), F.col("LOT_COST").alias("lot_cost"),
        F.col("PACK_COST").alias("pack_cost"), F.col("LOT_VALUE").alias("lot_value"))


def _value(kept: str) -> Column:
    """Value of a lot: the one kept with it, else its quantity at the lot's or the pack's cost."""
    qty = F.col("qty_on_hand")
    return F.coalesce(F.col(kept), (qty * F.col("lot_cost")).cast(S.VALUE), (qty * F.col("pack_cost")).cast(S.VALUE))


def valued_lots(t) -> DataFrame:
    """Item, quantity and value of the lots, each as often as `inventory_snapshot` has it, without what else that looks up."""
    item = t.drug_gn.select(F.col("WORKING_CODE").alias("working_code"))
    place = t.inv_md.select(F.col("WORKING_CODE").alias("working_code"), F.col("DEPT_ID").alias("dept_id"))
    lots = _lots(t).select("working_code", "dept_id", "qty_on_hand", _value("lot_value").alias("stock_value"))
    return lots.join(place, ["working_code", "dept_id"], "left").join(item, "working_code", "left").select("working_code", "qty_on_hand", "stock_value")


def inventory_snapshot(t, as_of: dt.date, near_days: int = S.NEAR_EXPIRY_DAYS, dead_days: int = S.DEAD_STOCK_DAYS) -> DataFrame:
    """Every lot on one day: value, expiry bucket, reorder threshold and stock flags.

    What an item's departments keep of it, one short list, meets the lots together with
    the item, so that the wide lots are shuffled for the item alone.
    """
    item = t.drug_gn.select(F.col("WORKING_CODE").alias("working_code"), F.col("REORDER_QTY").alias("_reorder"), F.col("MIN_LEVEL").alias("_min"))
    places = (t.inv_md.groupBy(F.col("WORKING_CODE").alias("working_code"))
              .agg(F.collect_list(F.struct("DEPT_ID", "MIN_LEVEL")).alias("_places")))
    here = F.filter("_places", lambda p: p["DEPT_ID"] == F.col("dept_id"))
    rows = (_lots(t).join(last_movement(t.card), LOT_KEY, "left").join(item.join(places, "working_code", "full"), "working_code", "left")
            .withColumn("_place", F.explode_outer(here)).withColumn("_dept_min", F.col("_place.MIN_LEVEL"))
            .withColumn("vendor_code", keys.normal_code("vendor_code")).withColumn("stock_value", _value("lot_value")))
    left = F.datediff("expired_date", F.lit(as_of))
    threshold = F.coalesce("_reorder", "_min", "_dept_min")
    amount = F.col("qty_on_hand").cast("double")
    low = F.coalesce(amount < threshold, F.lit(False))
    idle = F.datediff(F.lit(as_of), "last_movement_date")
    return rows.select(
        F.lit(as_of).alias("snapshot_date"), "working_code", "trade_code", "dept_id", "location", "lot_no", "expired_date", "vendor_code",
        "qty_on_hand", "lot_cost", "pack_cost", "stock_value", left.alias("days_to_expiry"),
        F.when(left.isNull(), "no_expiry").otherwise(M.expiry_range(left)).alias("expiry_bucket"),
        threshold.alias("reorder_threshold"), "last_movement_date",
        F.when(amount <= 0, "out").when(low, "low").otherwise("in_stock").alias("stock_status"),
        F.coalesce(idle >= dead_days, F.lit(False)).alias("dead_stock_flag"), low.alias("low_stock_flag"),
        (amount <= 0).alias("out_of_stock_flag"))


def movement_detail(card: DataFrame, preset: str = "mapping") -> DataFrame:
    """Every card row with direction and validity."""
    return card.select(
        F.col("RECORD_NUMBER").alias("movement_id"), F.to_date("OPERATE_DATE").alias("operate_date"),
        F.col("WORKING_CODE").alias("working_code"), F.col("TRADE_CODE").alias("trade_code"), F.col("DEPT_ID").alias("dept_id"),
        F.col("STOCK_ID").alias("stock_id"), F.col("LOT_NO").alias("lot_no"), F.col("EXPIRED_DATE").alias("expired_date"),
        keys.normal_code("VENDOR_CODE").alias("vendor_code"), F.col("R_S_STATUS").alias("rs_status"), F.col("R_S_NUMBER").alias("rs_number"),
        F.col("VALUE").alias("value"), F.col("COST").alias("cost"), F.col("ACTIVE_QTY").alias("active_qty"), F.col("REMAIN_QTY").alias("remain_qty"),
        F.col("FREE_FLAG").alias("free_flag"), F.col("CANCEL_FLAG").alias("cancel_flag"),
        M.status_direction(F.col("R_S_STATUS"), preset).alias("movement_direction"), F.abs("ACTIVE_QTY").alias("movement_qty_abs"),
        M.not_cancelled(F.col("CANCEL_FLAG")).cast("int").alias("valid_flag"))


def weighted_cost(snapshot: DataFrame) -> DataFrame:
    """Value over quantity of the stocked lots per item."""
    stocked = snapshot.filter("qty_on_hand > 0 AND stock_value IS NOT NULL")
    return stocked.groupBy("working_code").agg(
        M.ratio(F.sum("stock_value"), F.sum("qty_on_hand")).cast(S.UNIT_COST).alias("weighted_cost"))


def dispensing(t, snapshot: DataFrame) -> DataFrame:
    """Dispensed lines; codes without an item stay in an unresolved bucket, cost from stock, department, then item."""
    item = t.drug_gn.select(F.col("WORKING_CODE").alias("working_code"), F.col("LAST_BUY_COST").alias("_last_cost"))
    place = t.inv_md.select(F.col("WORKING_CODE").alias("_w"), F.col("DEPT_ID").alias("_d"), F.col("WA_COST").cast(S.UNIT_COST).alias("_dept_cost"))
    cost = weighted_cost(snapshot).withColumnRenamed("working_code", "_c")
    rows = (t.dispensed.join(item, F.col("MED_CODE") == F.col("working_code"), "left")
            .join(cost, F.col("working_code") == F.col("_c"), "left")
            .join(place, (F.col("working_code") == F.col("_w")) & (F.col("DISP_DEPT") == F.col("_d")), "left"))
    basis = F.coalesce("weighted_cost", "_dept_cost", "_last_cost")
    return rows.select(
        F.col("RECORD_NUMBER").alias("dispense_id"), D.parse_date8("DISP_DATE").alias("disp_date"), F.col("MED_CODE").alias("med_code"),
        "working_code", F.when(F.col("working_code").isNull(), "unresolved").otherwise("direct").alias("mapping_status"),
        F.col("DISP_QTY").alias("disp_qty"), F.col("DISP_DEPT").alias("disp_dept"), basis.alias("unit_cost_basis"),
        (F.col("DISP_QTY") * basis).cast("decimal(24,2)").alias("disp_value"))


def requests(accr_disp: DataFrame) -> DataFrame:
    req, dist = F.col("QTY_REQ"), F.col("QTY_DIST")
    return accr_disp.select(
        F.col("REQ_NO").alias("req_no"), F.col("WORKING_CODE").alias("working_code"), req.alias("qty_req"), dist.alias("qty_dist"),
        D.parse_date8("REQ_DATE").alias("req_date"), D.parse_date8("CONFIRM_DATE").alias("confirm_date"), F.col("DEPT_ID").alias("dept_id"),
        F.col("DEL_FLAG").alias("del_flag"), M.ratio(dist, req).alias("fill_rate"), (req - dist).alias("pending_qty"))


PLAN_COLUMNS = {
    "YEAR": "plan_year", "WORKING_CODE": "working_code", "DEPT_ID": "dept_id", "PACK_RATIO": "pack_ratio", "AVG_3_YEAR": "avg_3_year",
    "RATE_1_YEAR": "rate_1_year", "RATE_2_YEAR": "rate_2_year", "RATE_3_YEAR": "rate_3_year", "MIN_LEVEL": "min_level",
    "QTY_THIS_YEAR": "qty_this_year", "VALUE_THIS_YEAR": "value_this_year", "BUY_QTY": "buy_qty", "BUY_VALUE": "buy_value",
    "QTY_ON_HAND": "qty_on_hand", "PACK_UNIT_COST": "pack_unit_cost", "FORECAST": "forecast_value", "QTY_FORECAST": "qty_forecast",
    "QTY_PRE_PLAN": "qty_pre_plan", "BUYMET_CODE": "buy_method_code",
    **{f"QTY_{p}TRI{q}": f"qty_{p.lower()}tri{q}" for p in ("", "BUY_", "RCV_") for q in (1, 2, 3, 4)},
}


def plan_budget(plan: DataFrame) -> DataFrame:
    return plan.select(*[F.col(c).alias(n) for c, n in PLAN_COLUMNS.items()])


def plan_budget_long(wide: DataFrame) -> DataFrame:
    """One row per plan row and fiscal quarter."""
    rows = ", ".join(f"{q}, qty_tri{q}, qty_buy_tri{q}, qty_rcv_tri{q}" for q in (1, 2, 3, 4))
    return wide.select("plan_year", "working_code", "dept_id", F.expr(f"stack(4, {rows}) AS (quarter, qty_plan, qty_buy, qty_rcv)"))


def budget_summary(bdg_amt: DataFrame, bdg_type: DataFrame) -> DataFrame:
    burn = F.when(F.col("BUDGET_AMOUNT") > 0, M.ratio(F.col("TOTAL_BUY"), F.col("BUDGET_AMOUNT")))
    quarters = [F.col(f"{src}_TRI{q}").alias(f"tri{q}_{name}") for src, name in (("BUDGET_AMT", "budget"), ("TOTAL_BUY", "buy")) for q in (1, 2, 3, 4)]
    remain = [(F.col(f"BUDGET_AMT_TRI{q}") - F.col(f"TOTAL_BUY_TRI{q}")).alias(f"tri{q}_remain") for q in (1, 2, 3, 4)]
    return bdg_amt.join(bdg_type.select("BUDGET_TYPE", "BUDGET_NAME"), "BUDGET_TYPE", "left").select(
        F.col("FISCAL_YEAR").alias("fiscal_year"), F.col("BUDGET_TYPE").alias("budget_type"), F.col("BUDGET_NAME").alias("budget_name"),
        F.col("BUDGET_AMOUNT").alias("budget_amount"), F.col("TOTAL_BUY").alias("total_buy"), F.col("BUDGET_REMAIN").alias("budget_remain"),
        F.col("DEBT").alias("debt"), *quarters, *remain, burn.alias("burn_rate"))


def contracts(cnt: DataFrame, cnt_c: DataFrame) -> DataFrame:
    cost, left = F.col("COST_CNT"), F.col("COST_REMAIN")
    head = cnt.select("CNT_NO", "PARTIES_CODE", "EFFECTIVE_DATE", "END_DATE", "TOTAL_COST")
    return cnt_c.join(head, "CNT_NO").select(
        F.col("CNT_NO").alias("cnt_no"), F.col("WORKING_CODE").alias("working_code"), F.col("TRADE_CODE").alias("trade_code"),
        keys.normal_code("PARTIES_CODE").alias("vendor_contract_ref"), D.parse_date8("EFFECTIVE_DATE").alias("effective_date"),
        D.parse_date8("END_DATE").alias("contract_end_date"), F.col("QTY_CNT").alias("qty_cnt"), cost.alias("cost_cnt"),
        left.alias("cost_remain"), F.col("TOTAL_COST").alias("total_contract_cost"), M.ratio(cost - left, cost).alias("utilization_rate"))
