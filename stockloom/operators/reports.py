"""Reports: the named dashboard queries and the roll-ups of the dashboard pages.

The ``*_view`` functions give warehouse tables the names and vocabulary the
reports use.  Reports take ``as_of`` instead of reading the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions import dates as D, measures as M
from stockloom.operators import relational as R
from stockloom.operators.lookups import latest

# Order status as the reports name it.
ORDER_STATUS = {"approved": "OPEN", "pending": "PENDING", "received_partial": "PARTIAL",
                "received_full": "CLOSED", "cancelled": "CANCELLED"}
OPEN_ORDER = ("OPEN", "PENDING", "PARTIAL")
PENDING_RECEIPT = ("PENDING", "PARTIAL", "AWAITING_QC")


def _count() -> Column:
    return F.count(F.lit(1))


# Report views -------------------------------------------------------------------

def balance_view(snapshot: DataFrame, reorder_points: DataFrame) -> DataFrame:
    """Newest snapshot row per item and warehouse.

    A place may hold several rows on its newest day (unknown items share one
    id), so the newest day's quantities are summed.
    """
    place = ["dim_item_id", "dim_warehouse_id"]
    per_day = snapshot.groupBy(*place, "snapshot_date").agg(F.sum("qty_on_hand").alias("quantity"))
    return (latest(per_day.withColumn("last_updated", F.col("snapshot_date")), place, [F.col("snapshot_date")], ["quantity", "last_updated"])
            .join(reorder_points, "dim_item_id", "left"))


def order_view(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("po_no").alias("po_number"), "po_date", "dim_vendor_id", F.col("ordered_value").alias("total_amount"),
        M.label(F.col("po_status"), ORDER_STATUS).alias("status"))


def receipt_view(ms_ivo: DataFrame, ms_ivo_c: DataFrame, ms_po: DataFrame, quali_rcv: DataFrame) -> DataFrame:
    """Every invoice line with its receiving state: not received, part of a partial order, failed inspection, received."""
    from stockloom.functions.keys import normal_code, surrogate_id
    failed = (quali_rcv.filter("QUALI_VALUE = 'N'").select("RECEIVE_NO", "WORKING_CODE", F.lit(True).alias("_failed")).distinct())
    orders = ms_po.select("PO_NO", (F.col("PROCESS") == "2").alias("_partial"))
    head = ms_ivo.select("INVOICE_NO", "INVOICE_DATE", "PO_NO", "VENDOR_CODE", "RCV_FLAG")
    lines = ms_ivo_c.select("INVOICE_NO", "RECEIVE_NO", "WORKING_CODE", "QTY_ORDER")
    status = (F.when(F.col("RCV_FLAG") != "Y", "PENDING").when(F.col("_partial"), "PARTIAL")
              .when(F.col("_failed"), "AWAITING_QC").otherwise("RECEIVED"))
    return (lines.join(head, "INVOICE_NO").join(orders, "PO_NO", "left").join(failed, ["RECEIVE_NO", "WORKING_CODE"], "left")
            .select(F.col("INVOICE_NO").alias("reference_number"), F.col("INVOICE_DATE").alias("receipt_date"),
                    surrogate_id(normal_code("VENDOR_CODE")).alias("dim_vendor_id"),
                    F.col("QTY_ORDER").alias("total_quantity"), status.alias("status")))


def movement_view(movements: DataFrame) -> DataFrame:
    kind = F.when(F.col("movement_type") == "issue", "CONSUMPTION").otherwise(F.upper("movement_type"))
    return movements.select("dim_item_id", "dim_warehouse_id", kind.alias("movement_type"),
                            F.col("txn_date").alias("movement_date"), "expiry_date", F.col("qty").alias("quantity"), "unit_cost")


def budget_view(spend: DataFrame, budgets: DataFrame) -> DataFrame:
    """Budget per calendar month and type: a third of the fiscal quarter's budget against the month's spend.

    ``spend`` has ``category``, ``spend_date`` and ``amount``.
    """
    day = F.col("spend_date")
    used = (spend.groupBy("category", F.year(day).alias("year"), F.month(day).alias("month"), D.fiscal_year(day).alias("fiscal_year"),
                          D.fiscal_quarter(day).alias("quarter")).agg(F.sum("amount").alias("consumed")))
    quarters = budgets.select(
        F.col("BUDGET_TYPE").alias("category"), F.col("FISCAL_YEAR").cast("int").alias("fiscal_year"),
        F.explode(F.array(*[F.struct(F.lit(q).alias("quarter"), F.col(f"BUDGET_AMT_TRI{q}").alias("amount")) for q in (1, 2, 3, 4)])).alias("b"))
    third = quarters.select("category", "fiscal_year", F.col("b.quarter").alias("quarter"),
                            (F.col("b.amount") / 3).cast("decimal(24,2)").alias("allocated"))
    return (used.join(third, ["category", "fiscal_year", "quarter"], "left")
            .select("category", "year", "month", "allocated", "consumed",
                    (F.coalesce("allocated", F.lit(0).cast("decimal(24,2)")) - F.col("consumed")).alias("remaining")))


def quality_view(results: DataFrame, drug_gn: DataFrame, dept: DataFrame) -> DataFrame:
    return (results.join(drug_gn.select("WORKING_CODE", F.col("DRUG_NAME").alias("item_name")), "WORKING_CODE", "left")
            .join(dept.select("DEPT_ID", F.col("DEPT_NAME").alias("warehouse_name")), "DEPT_ID", "left")
            .select("event_id", "test_date", "item_name", "warehouse_name", "test_type", "result_status", "notes"))


# Named queries --------------------------------------------------------------------

def _named(df: DataFrame, items: DataFrame, warehouses: DataFrame) -> DataFrame:
    unknown = F.lit("Unknown")
    return (df.join(items.select("dim_item_id", "source_item_code", "item_name"), "dim_item_id", "left")
            .join(warehouses.select("dim_warehouse_id", "warehouse_name"), "dim_warehouse_id", "left")
            .withColumn("item_code", F.coalesce("source_item_code", unknown))
            .withColumn("item_name", F.coalesce("item_name", unknown))
            .withColumn("warehouse", F.coalesce("warehouse_name", unknown)))


def summary_totals(items: DataFrame, warehouses: DataFrame, vendors: DataFrame, balance: DataFrame) -> DataFrame:
    return R.one_row(items.sparkSession, total_items=items.agg(_count()),
                     total_warehouses=warehouses.agg(F.count_distinct("dim_warehouse_id")),
                     total_vendors=vendors.agg(F.count_distinct("dim_vendor_id")),
                     total_stock_qty=balance.agg(F.coalesce(F.sum("quantity"), F.lit(0).cast("decimal(38,4)"))))


def inventory_level(balance: DataFrame, items: DataFrame, warehouses: DataFrame, limit: int = 1000) -> DataFrame:
    rows = _named(balance, items, warehouses).select("item_code", "item_name", "warehouse", "quantity", "last_updated")
    return R.top(rows, limit, F.col("item_code"), F.col("warehouse"))


def low_stock(balance: DataFrame, items: DataFrame, warehouses: DataFrame) -> DataFrame:
    qty, point = F.coalesce("quantity", F.lit(0).cast("decimal(18,4)")), F.coalesce("reorder_point", F.lit(0.0))
    rows = balance.filter(qty.cast("double") <= point)
    return _named(rows, items, warehouses).select(
        "item_code", "item_name", "warehouse", qty.alias("stock_qty"), point.alias("reorder_point"),
        F.col("last_updated").alias("last_checked")).orderBy("stock_qty", "item_code", "warehouse")


def expiring(moves: DataFrame, items: DataFrame, warehouses: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    rows = moves.filter((F.col("expiry_date") <= F.lit(as_of + dt.timedelta(days=days))) & (F.col("quantity") > 0))
    return _named(rows, items, warehouses).select(
        "item_code", "item_name", "warehouse", "expiry_date", F.col("quantity").alias("stock_qty"),
        F.datediff("expiry_date", F.lit(as_of)).alias("days_to_expiry")).orderBy("expiry_date")


def consumption_daily(mart: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    rows = R.trailing(mart, "summary_date", as_of, days)
    return (rows.groupBy(F.col("summary_date").alias("date"))
            .agg(F.sum("issue_qty").alias("total_quantity"), F.sum("issue_value").alias("total_value")).orderBy(F.desc("date")))


def consumption_monthly(mart: DataFrame, as_of: dt.date) -> DataFrame:
    rows = mart.filter(F.col("year_month").between((as_of.year - 1) * 100 + 1, as_of.year * 100 + 12))
    return (rows.groupBy("year_month").agg(F.sum("issue_qty").alias("total_quantity"), F.sum("issue_value").alias("total_value"))
            .select(F.floor(F.col("year_month") / 100).alias("YEAR"), (F.col("year_month") % 100).alias("MONTH"), "total_quantity", "total_value")
            .orderBy(F.desc("YEAR"), F.desc("MONTH")))


def _cost() -> Column:
    return F.sum(F.col("quantity") * F.col("unit_cost")).cast("decimal(24,4)")


def consumption_by_item(moves: DataFrame, items: DataFrame, as_of: dt.date, days: int = 30, limit: int | None = 50) -> DataFrame:
    used = R.trailing(moves.filter("movement_type = 'CONSUMPTION'"), "movement_date", as_of, days)
    per_item = used.groupBy("dim_item_id").agg(F.sum("quantity").alias("total_consumed"), _cost().alias("total_cost"))
    named = per_item.join(items.select("dim_item_id", F.col("source_item_code").alias("item_code"), "item_name"), "dim_item_id", "left")
    rows = named.select("item_code", "item_name", "total_consumed", "total_cost")
    return rows if limit is None else R.top(rows, limit, F.desc("total_consumed"), F.col("item_code"))


def _with_vendor(df: DataFrame, vendors: DataFrame) -> DataFrame:
    return df.join(vendors.select("dim_vendor_id", "vendor_name"), "dim_vendor_id", "left")


def open_orders(orders: DataFrame, vendors: DataFrame) -> DataFrame:
    rows = orders.filter(F.col("status").isin(*OPEN_ORDER))
    return (_with_vendor(rows, vendors).select("po_number", "po_date", "vendor_name", "total_amount", "status")
            .orderBy(F.desc("po_date")))


def pending_receipts(receipts: DataFrame, vendors: DataFrame) -> DataFrame:
    rows = receipts.filter(F.col("status").isin(*PENDING_RECEIPT))
    return (_with_vendor(rows, vendors).select("reference_number", "receipt_date", "vendor_name", "total_quantity", "status")
            .orderBy(F.desc("receipt_date")))


def budget_burn(view: DataFrame, year: int) -> DataFrame:
    sums = (view.filter(F.col("year") == year).groupBy("month")
            .agg(*[F.coalesce(F.sum(c), F.lit(0).cast("decimal(34,2)")).alias(f"budget_{c}") for c in ("allocated", "consumed", "remaining")]))
    return sums.withColumn("burn_percentage", M.percent(F.col("budget_consumed"), F.col("budget_allocated"))).orderBy("month")


def budget_by_category(view: DataFrame, year: int) -> DataFrame:
    return (view.filter(F.col("year") == year).groupBy(F.coalesce("category", F.lit("Other")).alias("category"))
            .agg(*[F.coalesce(F.sum(c), F.lit(0).cast("decimal(34,2)")).alias(c) for c in ("allocated", "consumed", "remaining")]))


def quality_recent(view: DataFrame, limit: int = 100) -> DataFrame:
    return R.top(view, limit, F.desc("test_date"), F.desc("event_id"))


def quality_summary(view: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    counts = R.trailing(view, "test_date", as_of, days).groupBy("result_status").agg(_count().alias("count"))
    return (counts.withColumn("percentage", M.percent(F.col("count"), counts.agg(F.sum("count")).scalar()))
            .orderBy(F.desc("count")))


def dead_stock(moves: DataFrame, items: DataFrame, warehouses: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    last = (moves.groupBy("dim_item_id", "dim_warehouse_id")
            .agg(F.sum("quantity").alias("stock_qty"), F.max("movement_date").alias("last_movement")))
    rows = last.filter((F.col("last_movement") < F.lit(as_of - dt.timedelta(days=days))) & (F.col("stock_qty") > 0))
    return (rows.join(items.select("dim_item_id", F.col("source_item_code").alias("item_code"), "item_name"), "dim_item_id", "left")
            .join(warehouses.select("dim_warehouse_id", "warehouse_name"), "dim_warehouse_id", "left")
            .select("item_code", "item_name", "warehouse_name", "stock_qty", "last_movement",
                    F.datediff(F.lit(as_of), "last_movement").alias("days_inactive")).orderBy(F.desc("days_inactive")))


def expiry_summary(moves: DataFrame, as_of: dt.date) -> DataFrame:
    left = F.datediff("expiry_date", F.lit(as_of))
    return (moves.filter("quantity > 0")
            .groupBy(M.expiry_range_rank(left).alias("_rank"), M.expiry_range(left).alias("expiry_range"))
            .agg(_count().alias("item_count"), F.sum("quantity").alias("total_quantity")).orderBy("_rank").drop("_rank"))


def movement_summary(moves: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return (R.trailing(moves, "movement_date", as_of, days).groupBy("movement_type")
            .agg(_count().alias("transaction_count"), F.sum("quantity").alias("total_quantity"), _cost().alias("total_value"))
            .orderBy(F.desc("transaction_count")))


def top_vendors(orders: DataFrame, vendors: DataFrame, as_of: dt.date, days: int = 180, limit: int | None = 10) -> DataFrame:
    per_vendor = (R.trailing(orders, "po_date", as_of, days).groupBy("dim_vendor_id")
                  .agg(_count().alias("order_count"), F.sum("total_amount").alias("total_amount"),
                       M.mean(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value")))
    first = per_vendor if limit is None else R.top(per_vendor, limit, F.desc("total_amount"), F.col("dim_vendor_id"))
    return (_with_vendor(first, vendors).select("dim_vendor_id", "vendor_name", "order_count", "total_amount", "avg_order_value")
            .orderBy(F.desc("total_amount"), "dim_vendor_id"))


def data_freshness(latest_dates: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Age in hours of the newest row per table; ``latest_dates`` has ``table_name`` and ``last_updated``."""
    return (latest_dates.select("table_name", "last_updated",
                                D.hours_between(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")), F.col("last_updated")).alias("hours_since_update"))
            .orderBy(F.desc("last_updated")))


# Page roll-ups ----------------------------------------------------------------------

def movement_kpis(summary: DataFrame) -> DataFrame:
    total, value = F.sum("transaction_count"), F.sum("total_value")
    return summary.agg(total.alias("transactions"), F.sum("total_quantity").alias("quantity"), value.alias("value"),
                       M.guarded_ratio(value, total).alias("avg_transaction_value"))


def freshness_bands(freshness: DataFrame) -> DataFrame:
    return freshness.select("table_name", "hours_since_update", M.freshness_band(F.col("hours_since_update")).alias("band"))


def stock_metrics(level: DataFrame) -> DataFrame:
    return level.agg(F.count_distinct("item_code").alias("items"), F.count_distinct("warehouse").alias("warehouses"),
                     F.sum("quantity").alias("total_quantity"), F.max("last_updated").alias("last_updated"))


def top_items(level: DataFrame, k: int = 15) -> DataFrame:
    return R.top(level.groupBy("item_code").agg(F.sum("quantity").alias("quantity")), k, F.desc("quantity"), F.col("item_code"))


def low_stock_risk(low: DataFrame) -> DataFrame:
    qty = F.col("stock_qty").cast("double")
    return low.agg(F.count_if(qty <= 0).alias("critical"), F.count_if((qty > 0) & (qty <= F.col("reorder_point") * 0.5)).alias("warning"),
                   _count().alias("total"))


def low_stock_by_warehouse(low: DataFrame) -> DataFrame:
    return low.groupBy("warehouse").agg(_count().alias("count"))


def expiry_risk(rows: DataFrame) -> DataFrame:
    d = F.col("days_to_expiry")
    return rows.agg(F.count_if(d <= 0).alias("expired"), F.count_if((d > 0) & (d <= 30)).alias("within_30"),
                    F.count_if((d > 30) & (d <= 90)).alias("within_90"), _count().alias("total"))


def dead_stock_metrics(rows: DataFrame) -> DataFrame:
    return rows.agg(_count().alias("items"), F.sum("stock_qty").alias("total_qty"),
                    M.mean(F.sum("days_inactive"), F.count("days_inactive")).alias("avg_days_inactive"))


def _document_metrics(rows: DataFrame, amount: str, total: str, average: str) -> DataFrame:
    value, n = F.sum(amount), _count()
    return rows.agg(n.alias("documents"), value.alias(total), F.count_distinct("vendor_name").alias("vendors"),
                    M.guarded_ratio(value, n).alias(average))


def order_metrics(rows: DataFrame) -> DataFrame:
    return _document_metrics(rows, "total_amount", "total_value", "avg_order_value")


def receipt_metrics(rows: DataFrame) -> DataFrame:
    return _document_metrics(rows, "total_quantity", "total_quantity", "avg_quantity")


def status_counts(rows: DataFrame, column: str = "status") -> DataFrame:
    return rows.groupBy(column).agg(_count().alias("count")).orderBy(F.desc("count"), column)


def days_pending(rows: DataFrame, as_of: dt.date) -> DataFrame:
    return rows.withColumn("days_pending", F.datediff(F.lit(as_of), "receipt_date"))


def vendor_metrics(vendors: DataFrame) -> DataFrame:
    total, n = F.sum("total_amount"), _count()
    return vendors.agg(n.alias("vendors"), total.alias("total_spent"), M.guarded_ratio(total, n).alias("avg_vendor_value"))


def budget_metrics(burn: DataFrame) -> DataFrame:
    pct = M.guarded_ratio(F.sum("budget_consumed"), F.sum("budget_allocated")) * 100
    return burn.agg(F.sum("budget_allocated").alias("allocated"), F.sum("budget_consumed").alias("consumed"),
                    F.sum("budget_remaining").alias("remaining"), pct.alias("burn_pct"),
                    F.when(pct > 100, pct - 100).otherwise(F.lit(0.0)).alias("over_budget_pct"))


def category_burn(categories: DataFrame) -> DataFrame:
    pct = F.round(M.guarded_ratio(F.col("consumed"), F.col("allocated")) * 100, 1)
    return categories.select("category", "allocated", "consumed", "remaining", pct.alias("burn_pct"))


def quality_metrics(summary: DataFrame) -> DataFrame:
    def of(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("result_status") == status, F.col("count"))), F.lit(0).cast("bigint"))
    total = F.sum("count")
    return summary.agg(of("PASSED").alias("passed"), of("FAILED").alias("failed"), total.alias("total"),
                       (M.guarded_ratio(of("PASSED"), total) * 100).alias("pass_rate"))


def quality_filter_counts(view: DataFrame, item: str | None = None, status: str | None = None, test_type: str | None = None) -> DataFrame:
    """Counts by test type, status and warehouse of the filtered results, in one pass."""
    rows = R.choose(view, result_status=status, test_type=test_type)
    if item:
        rows = rows.filter(R.text_match(item, "item_name"))
    marks = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(c), F.lit("")).alias("member"))
                      for d, c in (("test_type", "test_type"), ("status", "result_status"), ("warehouse", "warehouse_name"))])
    return (rows.select(F.explode(marks).alias("m")).groupBy(F.col("m.dimension").alias("dimension"), F.col("m.member").alias("member"))
            .agg(_count().alias("count")))


def consumption_metrics(rows: DataFrame) -> DataFrame:
    return rows.agg(_count().alias("items"), F.sum("total_consumed").alias("total_quantity"), F.sum("total_cost").alias("total_cost"))


def consumption_unit_cost(rows: DataFrame, k: int = 20, by: str = "total_consumed") -> DataFrame:
    first = R.top(rows, k, F.desc(by), F.col("item_code"))
    return first.withColumn("unit_cost", M.guarded_ratio(F.col("total_cost"), F.col("total_consumed")))


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return (monthly.orderBy("YEAR", "MONTH")
            .withColumn("date_label", D.month_label(F.col("YEAR"), F.col("MONTH"))))
