"""Summary tables over the facts.

Daily marts take a closed date window, monthly marts a closed month window
(``YYYYMM``); month windows are turned into date ranges so fact scans prune.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.functions import keys, measures as M


def between_dates(df: DataFrame, column: str, low: dt.date | None, high: dt.date | None) -> DataFrame:
    if low is not None:
        df = df.filter(F.col(column) >= F.lit(low))
    if high is not None:
        df = df.filter(F.col(column) <= F.lit(high))
    return df


def month_bounds(low: int | None, high: int | None) -> tuple[dt.date | None, dt.date | None]:
    """First and last day of a month window."""
    first = dt.date(low // 100, low % 100, 1) if low is not None else None
    last = None
    if high is not None:
        year, month = divmod(high, 100)
        last = dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)
    return first, last


def between_months(df: DataFrame, column: str, low: int | None, high: int | None) -> DataFrame:
    return between_dates(df, column, *month_bounds(low, high))


def _zero(kind: str) -> Column:
    return F.lit(0).cast(kind)


def inventory_daily(snapshot: DataFrame, items: DataFrame, low=None, high=None) -> DataFrame:
    """SKU counts, quantities and values per day.

    The snapshot is first reduced to one row per day and item; the distinct
    counts then become plain counts over it.
    """
    f = between_dates(snapshot, "snapshot_date", low, high)
    active = items.filter("is_active").select("dim_item_id", F.lit(True).alias("_active"))
    per_item = (f.groupBy("snapshot_date", "dim_item_id")
                .agg(F.sum("qty_on_hand").alias("qty"), F.sum("stock_value").alias("value"),
                     F.max(F.col("qty_on_hand") == 0).alias("zero"), F.max(F.col("qty_on_hand") < 0).alias("negative"))
                .join(active, "dim_item_id", "left"))
    per_day = per_item.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("total_sku_count"),
        F.count("_active").alias("active_sku_count"),
        F.coalesce(F.sum("qty"), _zero(S.QTY)).alias("total_qty_on_hand"),
        F.coalesce(F.sum("value"), _zero(S.VALUE)).alias("total_stock_value"),
        F.count_if("zero").alias("zero_stock_sku_count"),
        F.count_if("negative").alias("negative_stock_sku_count"))
    sites = (f.select("snapshot_date", "dim_warehouse_id").distinct()
             .groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("warehouse_count")))
    return per_day.join(sites, "snapshot_date").select(
        F.col("snapshot_date").alias("summary_date"), "total_sku_count", "active_sku_count", "warehouse_count",
        "total_qty_on_hand", "total_stock_value", "zero_stock_sku_count", "negative_stock_sku_count",
        F.lit(0).alias("near_expiry_sku_count"), F.lit(0).alias("expired_sku_count"),
        F.lit(0).alias("dead_stock_sku_count"))


def stock_position_daily(snapshot: DataFrame, low=None, high=None) -> DataFrame:
    return between_dates(snapshot, "snapshot_date", low, high).select(
        F.col("snapshot_date").alias("summary_date"), "dim_item_id", "dim_warehouse_id", "qty_on_hand",
        "avg_unit_cost", "stock_value", "stock_status", F.lit(None).cast(S.VALUE).alias("days_of_stock_est"),
        F.lit(False).alias("reorder_flag"), F.lit(False).alias("overstock_flag"))


def expiry_daily(lots: DataFrame, low=None, high=None) -> DataFrame:
    return between_dates(lots, "snapshot_date", low, high).select(
        F.col("snapshot_date").alias("summary_date"), "dim_item_id", "dim_warehouse_id", "lot_no", "expiry_date",
        "days_to_expiry", "expiry_status", "qty_on_hand", "stock_value")


def _issued(amount: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("movement_direction") == "out", F.abs(amount))), _zero("decimal(28,4)"))


def consumption_daily(movements: DataFrame, low=None, high=None) -> DataFrame:
    return (between_dates(movements, "txn_date", low, high)
            .groupBy(F.col("txn_date").alias("summary_date"), "dim_item_id", "dim_warehouse_id")
            .agg(_issued("signed_qty").alias("issue_qty"), _issued("signed_value").alias("issue_value"))
            .withColumn("avg_daily_consumption_30d", F.lit(None).cast(S.QTY))
            .withColumn("avg_daily_consumption_90d", F.lit(None).cast(S.QTY)))


def movement_daily(movements: DataFrame, low=None, high=None) -> DataFrame:
    return (between_dates(movements, "txn_date", low, high)
            .groupBy(F.col("txn_date").alias("summary_date"), "dim_item_id", "dim_warehouse_id", "movement_type")
            .agg(F.coalesce(F.sum(F.abs("qty")), _zero(S.QTY)).alias("movement_qty"),
                 F.coalesce(F.sum(F.abs(F.coalesce("line_value", _zero(S.VALUE)))), _zero(S.VALUE)).alias("movement_value"),
                 F.count(F.lit(1)).alias("txn_count")))


def last_issue(movements: DataFrame) -> DataFrame:
    return (movements.filter("movement_direction = 'out'").groupBy("dim_item_id", "dim_warehouse_id")
            .agg(F.max("txn_date").alias("last_issue_date")))


def dead_stock_daily(snapshot: DataFrame, movements: DataFrame | None, low=None, high=None, as_of_snapshot: bool = False,
                     dead_days: int = S.DEAD_STOCK_DAYS, slow_days: int = S.SLOW_STOCK_DAYS, issues: DataFrame | None = None) -> DataFrame:
    """Days since the last issue, with dead and slow flags.

    The last issue is the newest one known at all and may follow the snapshot;
    ``as_of_snapshot`` takes the newest one up to the snapshot day instead.
    ``issues`` are stored newest issues, in place of the movements.
    """
    f = between_dates(snapshot, "snapshot_date", low, high)
    if as_of_snapshot:
        rows = _with_issue_before(f, movements)
    else:
        rows = f.join(last_issue(movements) if issues is None else issues, ["dim_item_id", "dim_warehouse_id"], "left")
    days, stocked = F.datediff("snapshot_date", "last_issue_date"), F.col("qty_on_hand") > 0
    return rows.select(
        F.col("snapshot_date").alias("summary_date"), "dim_item_id", "dim_warehouse_id", "qty_on_hand", "stock_value",
        "last_issue_date", days.alias("days_since_last_issue"),
        F.coalesce((F.col("last_issue_date").isNull() | (days >= dead_days)) & stocked, F.lit(False)).alias("dead_stock_flag"),
        F.coalesce(days.between(slow_days, dead_days - 1) & stocked, F.lit(False)).alias("slow_moving_flag"))


def _with_issue_before(snapshot: DataFrame, movements: DataFrame) -> DataFrame:
    """Snapshot rows with the newest issue date not after the snapshot.

    Issues are reduced to one row per day first, so a key's window holds at most
    two rows per calendar day and the snapshot rows themselves.
    """
    place = ["dim_item_id", "dim_warehouse_id"]
    issues = (movements.filter("movement_direction = 'out'")
              .select(*place, F.col("txn_date").alias("snapshot_date")).distinct()
              .withColumn("_issue", F.col("snapshot_date")))
    days = snapshot.select(*place, "snapshot_date").distinct().join(issues, [*place, "snapshot_date"], "full_outer")
    w = Window.partitionBy(*place).orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, 0)
    filled = days.withColumn("last_issue_date", F.max("_issue").over(w)).drop("_issue")
    return snapshot.join(filled, [*place, "snapshot_date"], "left")


def consumption_monthly(movements: DataFrame, low=None, high=None) -> DataFrame:
    """Issues per month; reduced to one row per day first, so the distinct-day count is a plain count."""
    daily = (between_months(movements, "txn_date", low, high)
             .groupBy("txn_date", "dim_item_id", "dim_warehouse_id")
             .agg(_issued("signed_qty").alias("q"), _issued("signed_value").alias("v")))
    return (daily.groupBy(keys.month_key("txn_date").alias("year_month"), "dim_item_id", "dim_warehouse_id")
            .agg(F.sum("q").alias("issue_qty"), F.sum("v").alias("issue_value"),
                 F.count(F.lit(1)).alias("movement_days")))


def procurement_monthly(orders: DataFrame, receipts: DataFrame, low=None, high=None) -> DataFrame:
    """Orders and receipts per month, item and vendor; either side may be missing."""
    place = ["year_month", "dim_item_id", "dim_vendor_id"]

    def side(df: DataFrame, date: str, doc: str, qty: str, value: str, count: str) -> DataFrame:
        # one row per document first: the distinct count becomes a plain count
        docs = (between_months(df, date, low, high)
                .groupBy(keys.month_key(date).alias("year_month"), "dim_item_id", "dim_vendor_id", doc)
                .agg(F.sum(qty).alias("q"), F.sum(F.coalesce(value, _zero(S.VALUE))).alias("v")))
        return docs.groupBy(*place).agg(F.sum("q").alias(qty), F.sum("v").alias(value), F.count(doc).alias(count))

    po = side(orders, "po_date", "po_no", "ordered_qty", "ordered_value", "po_count").alias("po")
    gr = side(receipts, "gr_date", "gr_no", "received_qty", "received_value", "gr_count").alias("gr")
    same = [F.col(f"po.{c}").eqNullSafe(F.col(f"gr.{c}")) for c in place]
    measures = [("po", "ordered_qty"), ("po", "ordered_value"), ("gr", "received_qty"), ("gr", "received_value"),
                ("po", "po_count"), ("gr", "gr_count")]
    return po.join(gr, same, "full_outer").select(
        *[F.coalesce(f"po.{c}", f"gr.{c}").alias(c) for c in place],
        *[F.coalesce(f"{s}.{c}", F.lit(0)).alias(c) for s, c in measures])


def monthly_spend(receipts: DataFrame, low=None, high=None) -> DataFrame:
    return (between_months(receipts, "gr_date", low, high)
            .groupBy(keys.month_key("gr_date").alias("year_month"))
            .agg(F.sum(F.coalesce("received_value", _zero(S.VALUE))).alias("actual_spend_amount")))


def running_spend(monthly: DataFrame) -> DataFrame:
    """Budget burn from the spend per month; the running windows hold one row per month."""
    w = Window.orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    fiscal = F.floor(F.col("year_month") / 100) + F.when(F.col("year_month") % 100 >= 10, 1).otherwise(0)
    by_year = Window.partitionBy("_fy").orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn("_fy", fiscal).select(
        "year_month", F.lit(None).cast(S.VALUE).alias("budget_amount"), "actual_spend_amount",
        F.lit(None).cast(S.VALUE).alias("variance_amount"), F.lit(None).cast("decimal(10,2)").alias("burn_rate_pct"),
        F.sum("actual_spend_amount").over(w).alias("ytd_actual_spend"),
        F.sum("actual_spend_amount").over(by_year).alias("ytd_fiscal"))


def budget_burn_monthly(receipts: DataFrame, low=None, high=None) -> DataFrame:
    """Spend per month with its running totals."""
    return running_spend(monthly_spend(receipts, low, high))


# Enriched variants: the columns the plain marts leave constant -----------------

def inventory_daily_enriched(snapshot: DataFrame, lots: DataFrame, movements: DataFrame, items: DataFrame,
                             low=None, high=None) -> DataFrame:
    base = inventory_daily(snapshot, items, low, high).drop(
        "near_expiry_sku_count", "expired_sku_count", "dead_stock_sku_count")
    expiry = (expiry_daily(lots, low, high).groupBy("summary_date", "dim_item_id")
              .agg(F.max(F.col("expiry_status") == "near_expiry").alias("near"),
                   F.max(F.col("expiry_status") == "expired").alias("gone"))
              .groupBy("summary_date").agg(F.count_if("near").alias("near_expiry_sku_count"),
                                           F.count_if("gone").alias("expired_sku_count")))
    dead = (dead_stock_daily(snapshot, movements, low, high).filter("dead_stock_flag")
            .select("summary_date", "dim_item_id").distinct()
            .groupBy("summary_date").agg(F.count(F.lit(1)).alias("dead_stock_sku_count")))
    return base.join(expiry, "summary_date", "left").join(dead, "summary_date", "left").na.fill(
        0, ["near_expiry_sku_count", "expired_sku_count", "dead_stock_sku_count"])


def trailing_average(daily: DataFrame, measure: str, days: int) -> Column:
    """Sum of the last ``days`` days over ``days``; ``daily`` has one row per key and day."""
    w = (Window.partitionBy("dim_item_id", "dim_warehouse_id").orderBy("_day").rangeBetween(-(days - 1), 0))
    return F.round(F.sum(measure).over(w).cast("double") / F.lit(float(days)), 4)


def consumption_daily_enriched(movements: DataFrame, low=None, high=None) -> DataFrame:
    """Daily issues with trailing 30- and 90-day averages; 89 more days are read for the first day."""
    start = low - dt.timedelta(days=89) if low is not None else None
    daily = (consumption_daily(movements, start, high)
             .withColumn("_day", F.unix_date("summary_date")))
    out = (daily.withColumn("avg_daily_consumption_30d", trailing_average(daily, "issue_qty", 30))
           .withColumn("avg_daily_consumption_90d", trailing_average(daily, "issue_qty", 90)).drop("_day"))
    return between_dates(out, "summary_date", low, high)


def stock_position_enriched(snapshot: DataFrame, movements: DataFrame, reorder_points: DataFrame, low=None, high=None,
                            overstock_days: int = 365) -> DataFrame:
    """Position with days of stock (quantity over the 90-day average), reorder and overstock flags."""
    place = ["summary_date", "dim_item_id", "dim_warehouse_id"]
    use = consumption_daily_enriched(movements, low, high).select(
        *place, F.col("avg_daily_consumption_90d").alias("_avg"))
    rows = (stock_position_daily(snapshot, low, high).join(use, place, "left")
            .join(reorder_points, "dim_item_id", "left"))
    days = F.round(F.try_divide(F.col("qty_on_hand").cast("double"), F.col("_avg")), 2)
    return rows.select(
        *place, "qty_on_hand", "avg_unit_cost", "stock_value", "stock_status", days.alias("days_of_stock_est"),
        (F.col("qty_on_hand").cast("double") <= F.coalesce("reorder_point", F.lit(0.0))).alias("reorder_flag"),
        F.coalesce(days > overstock_days, F.lit(False)).alias("overstock_flag"))


def budget_burn_enriched(receipts: DataFrame, budgets: DataFrame, low=None, high=None) -> DataFrame:
    """Monthly spend against a twelfth of the fiscal year's budget."""
    base = budget_burn_monthly(receipts, low, high).select("year_month", "actual_spend_amount", "ytd_fiscal")
    yearly = budgets.groupBy(F.col("FISCAL_YEAR").alias("fiscal_year")).agg(
        F.round(F.sum("BUDGET_AMOUNT").cast("double") / 12, 2).alias("budget_amount"))
    fiscal = F.floor(F.col("year_month") / 100) + F.when(F.col("year_month") % 100 >= 10, 1).otherwise(0)
    spend = F.col("actual_spend_amount").cast("double")
    return base.withColumn("fiscal_year", fiscal).join(yearly, "fiscal_year", "left").select(
        "year_month", "fiscal_year", "budget_amount", "actual_spend_amount",
        F.round(F.col("budget_amount") - spend, 2).alias("variance_amount"),
        F.round(F.try_divide(spend * 100, F.col("budget_amount")), 2).alias("burn_rate_pct"), "ytd_fiscal")
