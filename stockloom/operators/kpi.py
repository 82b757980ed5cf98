"""Key figures over the subject-area model.

Distinct item counts are taken over one row per item, never as several distinct
aggregates over the lots.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.functions import dates as D, keys, measures as M
from stockloom.operators import ordered, relational as R


def _count() -> Column:
    return F.count(F.lit(1))


# Inventory position --------------------------------------------------------------

def active_items(products: DataFrame) -> DataFrame:
    return products.filter("active_flag = 1").agg(F.count_distinct("working_code").alias("sku_count"))


#: Columns of the snapshot that ``item_position`` and ``alerts`` read.
POSITIONED = ("working_code", "qty_on_hand", "stock_value", "days_to_expiry", "low_stock_flag", "dead_stock_flag")
ALERTED = (*POSITIONED, "dept_id", "lot_no", "trade_code")


def item_position(snapshot: DataFrame) -> DataFrame:
    """One row per item: value sums and the flags the counts are made of."""
    qty, day = F.col("qty_on_hand"), F.col("days_to_expiry")

    def value(rule: Column) -> Column:
        return F.sum(F.when(rule, F.col("stock_value")))

    return snapshot.groupBy("working_code").agg(
        F.sum("stock_value").alias("stock_value"), F.max(qty > 0).alias("stocked"), F.max("low_stock_flag").alias("low"),
        F.max(qty <= 0).alias("out"), value(day.between(0, S.NEAR_EXPIRY_DAYS)).alias("near_expiry_value"),
        value((day < 0) & (qty > 0)).alias("expired_value"), value(F.col("dead_stock_flag")).alias("dead_value"))


def position_kpis(snapshot: DataFrame) -> DataFrame:
    return item_position(snapshot).agg(
        F.sum("stock_value").alias("total_inventory_value"), F.count_if("stocked").alias("active_stocked_sku_count"),
        F.count_if("low").alias("low_stock_sku_count"), F.count_if("out").alias("out_of_stock_sku_count"),
        F.sum("near_expiry_value").alias("near_expiry_value"), F.sum("expired_value").alias("expired_stock_value"),
        F.sum("dead_value").alias("dead_stock_value"))


def recent_use(dispensed: DataFrame, as_of: dt.date, days: int = 90, by: tuple[str, ...] = ("working_code",)) -> DataFrame:
    """Dispensed quantity of the ``days`` days up to ``as_of``."""
    start = as_of - dt.timedelta(days=days - 1)
    rows = dispensed.filter(F.col("disp_date").between(F.lit(start), F.lit(as_of)) & F.col("working_code").isNotNull())
    return rows.groupBy(*by).agg(F.sum("disp_qty").alias("use_qty"))


def days_of_stock(snapshot: DataFrame, dispensed: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    stock = snapshot.groupBy("working_code").agg(F.sum("qty_on_hand").alias("qty_on_hand"))
    daily = F.col("use_qty").cast("double") / F.lit(float(days))
    return stock.join(recent_use(dispensed, as_of, days), "working_code", "left").select(
        "working_code", "qty_on_hand", F.round(daily, 6).alias("avg_daily_consumption"),
        F.round(F.try_divide(F.col("qty_on_hand").cast("double"), daily), 2).alias("days_of_stock"))


# Consumption -----------------------------------------------------------------------

def monthly_usage(dispensed: DataFrame, as_of: dt.date, months: int = 3) -> DataFrame:
    window = F.col("disp_date").between(F.add_months(F.lit(as_of + dt.timedelta(days=1)), -months), F.lit(as_of))
    return (dispensed.filter(window & F.col("working_code").isNotNull()).groupBy("working_code")
            .agg(F.round(F.sum("disp_qty").cast("double") / float(months), 6).alias("avg_monthly_usage")))


def fast_movers(dispensed: DataFrame, as_of: dt.date, share: float = 0.20) -> DataFrame:
    return ordered.top_share(recent_use(dispensed, as_of), "use_qty", share)


def slow_movers(snapshot: DataFrame, dispensed: DataFrame, as_of: dt.date, threshold: float = 10) -> DataFrame:
    stock = snapshot.groupBy("working_code").agg(F.sum("qty_on_hand").alias("qty_on_hand")).filter("qty_on_hand > 0")
    use = F.coalesce("use_qty", F.lit(0).cast(S.QTY))
    return (stock.join(recent_use(dispensed, as_of), "working_code", "left").filter(use <= threshold)
            .select("working_code", "qty_on_hand", use.alias("use_qty")))


def department_share(dispensed: DataFrame) -> DataFrame:
    per = dispensed.groupBy("disp_dept").agg(F.sum("disp_qty").alias("disp_qty"))
    return per.withColumn("share", M.ratio(F.col("disp_qty"), per.agg(F.sum("disp_qty")).scalar()))


# Contracts, requests, movements, plan, budget: single-row sums ------------------------

def contract_kpis(contract: DataFrame) -> DataFrame:
    cost, left = F.sum("cost_cnt"), F.sum("cost_remain")
    return contract.agg(F.count_distinct("working_code").alias("contracted_items"), cost.alias("contract_value"),
                        left.alias("remaining_value"), M.ratio(cost - left, cost).alias("utilization_rate"))


def contract_by_vendor(contract: DataFrame) -> DataFrame:
    return contract.groupBy("vendor_contract_ref").agg(F.sum("cost_cnt").alias("contract_value"))


def request_kpis(request: DataFrame) -> DataFrame:
    live = request.filter("del_flag <> 'Y' OR del_flag IS NULL")
    return live.agg(F.sum("qty_req").alias("requested_qty"), F.sum("qty_dist").alias("distributed_qty"),
                    M.ratio(F.sum("qty_dist"), F.sum("qty_req")).alias("fill_rate"), F.sum("pending_qty").alias("pending_qty"))


def movement_kpis(moves: DataFrame) -> DataFrame:
    valid = moves.filter("valid_flag = 1")
    return valid.agg(_count().alias("movement_count"), F.count_if(F.col("movement_direction") == "ADJ").alias("adjustment_count"),
                     F.sum("value").alias("movement_value"), F.sum(F.when(F.col("free_flag") == "Y", F.col("value"))).alias("free_goods_value"))


# figures of quantities kept as doubles are summed as decimals, so the result does not depend on row order
def _exact(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(24,4)"))


def plan_kpis(plan: DataFrame) -> DataFrame:
    quarter = [M.ratio(_exact(f"qty_buy_tri{q}"), _exact(f"qty_tri{q}")).alias(f"completion_t{q}") for q in (1, 2, 3, 4)]
    return plan.agg(_exact("qty_this_year").alias("planned_qty"), _exact("value_this_year").alias("planned_value"),
                    _exact("qty_forecast").alias("forecast_qty"), _exact("forecast_value").alias("forecast_value"),
                    _exact("buy_value").alias("buy_value"), M.ratio(_exact("buy_qty"), _exact("qty_this_year")).alias("completion_rate"), *quarter)


def budget_kpis(budget: DataFrame) -> DataFrame:
    return budget.agg(F.sum("budget_amount").alias("allocated"), F.sum("total_buy").alias("used"), F.sum("budget_remain").alias("remaining"),
                      M.ratio(F.sum("total_buy"), F.sum("budget_amount")).alias("burn_rate"), F.sum("debt").alias("debt"))


def plan_vs_actual(plan: DataFrame) -> DataFrame:
    bought = F.coalesce("buy_qty", F.lit(0.0))
    return plan.select("plan_year", "working_code", "dept_id", "qty_this_year", bought.alias("buy_qty"),
                       M.ratio(bought - F.col("qty_this_year"), F.col("qty_this_year")).alias("variance"))


# Alerts -----------------------------------------------------------------------------

def alerts(snapshot: DataFrame, budget: DataFrame, as_of: dt.date) -> DataFrame:
    """All alerts of a day in one frame: kind, subject, place, measure.

    The stock rules are evaluated in one pass: each lot carries its list of
    alerts and is repeated once per alert.
    """
    qty, value = F.col("qty_on_hand").cast("double"), F.col("stock_value").cast("double")
    days = F.col("days_to_expiry")
    rules = (("low_stock", F.col("low_stock_flag") & (qty > 0), qty), ("out_of_stock", qty == 0, qty),
             ("near_expiry", days.between(0, S.NEAR_EXPIRY_DAYS) & (qty > 0), days.cast("double")),
             ("dead_stock", F.col("dead_stock_flag") & (qty > 0), value))
    marks = F.array_compact(F.array(*[F.when(rule, F.struct(F.lit(kind).alias("alert"), measure.alias("measure"))) for kind, rule, measure in rules]))
    stock = (snapshot.select("working_code", "dept_id", "lot_no", "trade_code", F.explode(marks).alias("m"))
             .select("m.alert", F.col("working_code").alias("subject"), F.col("dept_id").alias("place"), "trade_code", "lot_no", "m.measure"))
    fy = D.current_fiscal_year(as_of)
    over = budget.filter((F.col("fiscal_year") == fy) & (F.col("burn_rate") * 100 > S.BUDGET_ALERT_PCT))
    money = over.select(F.lit("budget_risk").alias("alert"), F.col("budget_type").alias("subject"), F.col("fiscal_year").cast("string").alias("place"),
                        F.lit(None).cast("string").alias("trade_code"), F.lit(None).cast("string").alias("lot_no"), F.col("burn_rate").alias("measure"))
    return stock.unionByName(money)


# Procurement, returns, quality --------------------------------------------------------

def vendor_spend(receipts: DataFrame) -> DataFrame:
    return receipts.groupBy("source_vendor_code").agg(F.sum("received_value").alias("spend"), _count().alias("line_count"))


def lead_times(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    """Days from order to receipt per vendor; receipts dated before their order are left out."""
    lines = receipts.groupBy("po_no", "gr_date", "source_vendor_code").agg(_count().alias("n"))
    days = F.datediff("gr_date", "po_date")
    rows = lines.join(orders.select(F.col("PO_NO").alias("po_no"), F.col("PO_DATE").alias("po_date")), "po_no").filter(days >= 0)
    return rows.groupBy("source_vendor_code").agg(
        F.sum("n").alias("line_count"), M.ratio(F.sum(days * F.col("n")), F.sum("n")).alias("avg_lead_days"),
        F.min(days).alias("min_lead_days"), F.max(days).alias("max_lead_days"))


def price_trend(receipts: DataFrame) -> DataFrame:
    """Average unit price per item, vendor and day against the day before it was bought.

    Reduced to one row per day first, so a window never holds more rows than days.
    """
    daily = (receipts.groupBy("source_item_code", "source_vendor_code", "gr_date")
             .agg(M.mean(F.sum("received_unit_cost"), F.count("received_unit_cost"), 10).alias("unit_price")))
    before = F.lag("unit_price").over(Window.partitionBy("source_item_code", "source_vendor_code").orderBy("gr_date"))
    return daily.withColumn("previous_price", before).withColumn(
        "change_pct", F.round(M.trend_pct(F.col("unit_price"), F.col("previous_price")), 4))


def return_trend(returns: DataFrame, reasons: DataFrame) -> DataFrame:
    day = D.parse_date8("RETURN_DATE")
    monthly = returns.groupBy(keys.month_key(day).alias("year_month"), "REASON_ID").agg(
        _count().alias("return_count"), F.sum("RETURN_QTY").alias("return_qty"), F.sum("RETURN_COST").alias("return_cost"))
    return monthly.join(reasons, "REASON_ID", "left").select(
        "year_month", F.coalesce("REASON_NAME", F.lit("unknown")).alias("reason"), "return_count", "return_qty", "return_cost")


def receipt_quality(quali: DataFrame) -> DataFrame:
    failed, n = F.count_if(F.col("QUALI_VALUE") == "N"), _count()
    return quali.groupBy("WORKING_CODE").agg(n.alias("tests"), (n - failed).alias("passed"), failed.alias("failed"),
                                             M.ratio(n - failed, n).alias("pass_rate"), M.ratio(failed, n).alias("fail_rate"))


def stock_breakdown(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("dept_id", "location", "lot_no").agg(
        F.sum("qty_on_hand").alias("qty_on_hand"), F.sum("stock_value").alias("stock_value"), _count().alias("lots"))


def top_stock_items(snapshot: DataFrame, k: int = 20) -> DataFrame:
    per = snapshot.groupBy("working_code").agg(F.sum("qty_on_hand").alias("qty_on_hand"), F.sum("stock_value").alias("stock_value"))
    return R.top(per, k, F.desc("stock_value"), F.col("working_code"))


def risk_heat(snapshot: DataFrame) -> DataFrame:
    """Lots per department, expiry bucket and stock status."""
    return snapshot.groupBy("dept_id", "expiry_bucket", "stock_status").agg(_count().alias("lots"), F.sum("stock_value").alias("stock_value"))
