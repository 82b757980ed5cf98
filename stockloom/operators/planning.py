"""Annual purchase plan, on-hand lots, item search and the monthly balance report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions import dates as D, keys, measures as M
from stockloom.operators.lookups import band_lookup, latest
from stockloom.operators.marts import month_bounds

SEARCH_LIMIT = 20
DEFAULT_COLOR = 16777215  # fixed value: colour of an item without one


# Windows ----------------------------------------------------------------------

@dataclass(frozen=True)
class PlanWindows:
    """Usage windows of a plan as ``YYYYMM`` bounds, and the current window as dates."""

    year_1: tuple[int, int]
    year_2: tuple[int, int]
    year_3: tuple[int, int]
    months: int
    first_day: dt.date
    last_day: dt.date


def plan_windows(year: int, month: int) -> PlanWindows:
    """Two past fiscal years and the current one up to ``year``-``month``.

    As in the source procedure, a December plan starts its current window in that
    same October, which leaves its second window empty, and October and November
    plans still count from the October before.
    """
    december = month == 12
    start_3 = year if december else year - 1
    end_2, start_2 = (year - 1, year - 1) if december else (year - 1, year - 2)
    end_1, start_1 = (year - 2, year - 2) if december else (year - 2, year - 3)
    last = month_bounds(None, year * 100 + month)[1]
    return PlanWindows((start_1 * 100 + 10, end_1 * 100 + 9), (start_2 * 100 + 10, end_2 * 100 + 9),
                       (start_3 * 100 + 10, year * 100 + month), (year - start_3) * 12 + month - 10 + 1,
                       dt.date(start_3, 10, 1), last)


def _within(window: tuple[int, int]) -> Column:
    low, high = month_bounds(*window)
    day = F.to_date("OPERATE_DATE")
    return (day >= F.lit(low)) & (day <= F.lit(high))


# Fallback lookups ---------------------------------------------------------------

def latest_trade_pack(drug_vn: DataFrame) -> DataFrame:
    rows = drug_vn.filter("LAST_BUY_COST > 0").withColumnRenamed("LAST_PACK_RATIO", "trade_pack")
    return latest(rows, ["WORKING_CODE"], [F.col("LAST_BUY"), F.col("TRADE_CODE")], ["trade_pack"])


def latest_receipt_pack(card: DataFrame) -> DataFrame:
    rows = card.filter("R_S_STATUS = 'R' AND ACTIVE_PACK > 0").withColumn("receipt_pack", F.col("ACTIVE_PACK").cast("double"))
    return latest(rows, ["WORKING_CODE"], [F.col("OPERATE_DATE"), F.col("RECORD_NUMBER")], ["receipt_pack"])


def latest_invoice_cost(ms_ivo: DataFrame, ms_ivo_c: DataFrame) -> DataFrame:
    """Unit cost of the newest receipt per item; lines are reduced per receipt before the join."""
    order = ["LINE_NO", "TRADE_CODE", "BUY_UNIT_COST"]
    per_receipt = ms_ivo_c.groupBy("WORKING_CODE", "RECEIVE_NO").agg(F.max(F.struct(*order)).alias("_l"))
    rows = (per_receipt.join(ms_ivo.select("RECEIVE_NO", "RECEIVE_DATE"), "RECEIVE_NO", "left")
            .withColumn("invoice_cost", F.col("_l.BUY_UNIT_COST")))
    # undated lines sort below dated ones: NULL is the smallest value inside a struct
    return latest(rows, ["WORKING_CODE"], [F.col("RECEIVE_DATE"), F.col("RECEIVE_NO")], ["invoice_cost"])


def latest_trade_cost(drug_vn: DataFrame) -> DataFrame:
    rows = drug_vn.withColumnRenamed("LAST_BUY_COST", "trade_cost")
    return latest(rows, ["WORKING_CODE"], [F.col("LAST_BUY"), F.col("TRADE_CODE")], ["trade_cost"])


def latest_trade(drug_vn: DataFrame) -> DataFrame:
    """`latest_trade_pack` and `latest_trade_cost` in one pass."""
    newest = F.struct("LAST_BUY", "TRADE_CODE")
    pack = F.max_by(F.struct("LAST_PACK_RATIO"), F.when(F.col("LAST_BUY_COST") > 0, newest))
    return (drug_vn.groupBy("WORKING_CODE").agg(pack.alias("_p"), F.max_by(F.struct("LAST_BUY_COST"), newest).alias("_c"))
            .select("WORKING_CODE", F.col("_p.LAST_PACK_RATIO").alias("trade_pack"), F.col("_c.LAST_BUY_COST").alias("trade_cost")))


# The plan -----------------------------------------------------------------------

def card_measures(card: DataFrame, windows: PlanWindows, history_from: int | None = None,
                  dept: str | None = None) -> DataFrame:
    """Everything the plan needs from the card per stock and item."""
    start, end = history_from or windows.year_1[0], windows.year_3[1]
    low, high = month_bounds(start, end)
    status, day = F.col("R_S_STATUS"), F.to_date("OPERATE_DATE")
    used = status.isin("T", "S", "C") & (day >= F.lit(low)) & (day <= F.lit(high))
    qty = F.when(status == "C", -F.col("ACTIVE_QTY")).otherwise(F.col("ACTIVE_QTY"))
    in_year = F.col("OPERATE_DATE").between(F.lit(windows.first_day), F.lit(windows.last_day))
    free = in_year & status.isin("R", "A") & (F.col("FREE_FLAG") == "Y")
    recent = in_year & status.isin("T", "S", "C")
    rows = card.filter("STOCK_ID IS NOT NULL AND WORKING_CODE IS NOT NULL AND WORKING_CODE <> ''")
    if dept is not None:
        rows = rows.filter(F.col("STOCK_ID") == dept)

    looked_at = day >= F.lit(min(low, windows.first_day))  # rows before it add nothing, not even a zero

    def usage(window: tuple[int, int]) -> Column:
        return F.sum(F.when(used & _within(window), qty).when(looked_at, 0)).cast("double")

    quarters = [F.sum(F.when(recent & (D.fiscal_quarter(day) == q), qty).when(looked_at, 0)).cast("double").alias(f"use_q{q}")
                for q in (1, 2, 3, 4)]
    # the newest balance looks at all dates up to the end, the sums only from the first they look at; the card is read once for both
    dated = rows.filter(day <= F.lit(max(high, windows.last_day)))
    newest = F.max_by(F.struct("REMAIN_QTY"), F.when(day <= F.lit(high), F.struct("OPERATE_DATE", "RECORD_NUMBER")))
    return (dated.groupBy(F.col("STOCK_ID").alias("DEPT_ID"), "WORKING_CODE").agg(
        F.count_if(used).alias("_used"),
        usage(windows.year_1).alias("RATE_1_YEAR"), usage(windows.year_2).alias("RATE_2_YEAR"),
        usage(windows.year_3).alias("_rate_3"),
        F.sum(F.when(free, F.col("VALUE"))).cast("double").alias("VALUE_FREE_Y3"),
        F.sum(F.when(free, F.col("ACTIVE_QTY"))).cast("double").alias("QTY_FREE_Y3"),
        F.sum(F.when(recent, qty)).cast("double").alias("use_all"), *quarters,
        F.coalesce(newest["REMAIN_QTY"].cast("double"), F.lit(0.0)).alias("QTY_ON_HAND"))
        .filter("_used > 0").drop("_used")
        .withColumn("RATE_3_YEAR", F.col("_rate_3") * 12 / float(windows.months)).drop("_rate_3"))


def order_quantity(need: Column, pack: Column) -> Column:
    """Units to order: whole packs rounded up to tens, ten more unless divisible by four, never negative."""
    tens = F.floor((F.try_divide(need, pack) + 9) / 10).cast("double") * 10
    packs = F.when(tens % 4 > 0, tens + 10).otherwise(tens)
    return F.greatest(packs * pack, F.lit(0.0))


def buy_plan(t, year: int, month: int, plan_year: int, dept: str | None = None, history_from: int | None = None) -> DataFrame:
    """Purchase plan per stock and item from the tables ``t``; all stocks unless ``dept`` is given."""
    win = plan_windows(year, month)
    place = ["DEPT_ID", "WORKING_CODE"]
    group = t.ed_group.select(F.col("CODE").alias("GROUP_CODE"), F.col("FORECAST").alias("_group_forecast"))
    item = (t.drug_gn.select("WORKING_CODE", "GROUP_CODE", F.col("LAST_BUY_COST").alias("_item_cost"))
            .join(group, "GROUP_CODE", "left").drop("GROUP_CODE"))
    stocked = (t.inv_md.filter(M.is_visible(F.col("HIDE")) & F.col("FIRST_PACK_RATIO").isNotNull())
               .select(*place, F.col("LAST_PACK_RATIO").alias("_stock_pack"), F.col("FORECAST").alias("_own_forecast"), "MOD_SYS"))
    base = (card_measures(t.card, win, history_from, dept).join(stocked, place).join(item, "WORKING_CODE")
            .join(latest_trade(t.drug_vn), "WORKING_CODE", "left")
            .join(latest_receipt_pack(t.card), "WORKING_CODE", "left")
            .join(latest_invoice_cost(t.ms_ivo, t.ms_ivo_c), "WORKING_CODE", "left"))
    own = F.col("_own_forecast")
    plan = base.select(
        *place, F.lit(plan_year).alias("YEAR"), F.lit(month).alias("CAL_MONTH"), "MOD_SYS",
        "RATE_1_YEAR", "RATE_2_YEAR", "RATE_3_YEAR", "QTY_ON_HAND", "VALUE_FREE_Y3", "QTY_FREE_Y3",
        F.coalesce("trade_pack", "receipt_pack", "_stock_pack").alias("PACK_RATIO"),
        F.coalesce("invoice_cost", "trade_cost", "_item_cost").cast("double").alias("PACK_UNIT_COST"),
        F.when(F.coalesce(own, F.lit(0.0)) > 0, own).otherwise(F.coalesce("_group_forecast", F.lit(0.0))).alias("FORECAST"),
        *[F.when(F.col("use_all") > 0, F.col(f"use_q{q}") / F.col("use_all")).alias(f"DISP_RATIO{q}") for q in (1, 2, 3, 4)])
    return _purchase_method(_quantities(plan), t.buymethod)


def _quantities(plan: DataFrame) -> DataFrame:
    rates = [F.col(f"RATE_{i}_YEAR") for i in (1, 2, 3)]
    years = sum((F.when(r > 0, 1).otherwise(0) for r in rates[1:]), F.when(rates[0] > 0, 1).otherwise(0))
    pack = F.coalesce("PACK_RATIO", F.lit(1.0))
    zero = F.lit(0.0)
    plan = plan.withColumn("AVG_3_YEAR", F.when(years > 0, F.round((rates[0] + rates[1] + rates[2]) / F.nullif(years, F.lit(0)), 0)))
    plan = plan.withColumn("QTY_PRE_PLAN", F.when(F.col("AVG_3_YEAR").isNotNull(), F.greatest(
        F.col("AVG_3_YEAR") + F.round(F.col("RATE_3_YEAR") / 12, 0) - F.col("QTY_ON_HAND"), zero)))
    plan = plan.withColumn("QTY_FORECAST", F.col("QTY_PRE_PLAN") * (F.coalesce("FORECAST", zero) / 100))
    need = F.coalesce("QTY_PRE_PLAN", zero) + F.coalesce("QTY_FORECAST", zero) - F.coalesce("QTY_FREE_Y3", zero)
    plan = plan.withColumn("QTY_THIS_YEAR", order_quantity(need, pack))
    qty = F.col("QTY_THIS_YEAR")
    packs = F.coalesce(F.try_divide(qty, pack), zero).cast("decimal(18,4)")
    cost = F.coalesce("PACK_UNIT_COST", zero).cast("decimal(18,6)")
    value = (packs * cost).cast("decimal(18,2)").cast("double")  # money is rounded as decimal
    plan = (plan.withColumn("MIN_LEVEL", F.round(qty / 12, 0)).withColumn("VALUE_THIS_YEAR", value)
            .withColumn("REMAIN_QTY", qty).withColumn("VALUE_DEFENCE", F.col("VALUE_THIS_YEAR")))
    quarter = F.col("VALUE_DEFENCE") / 4
    return plan.withColumns({f"{n}{q}": quarter for n in ("TRIMESTER", "RM_TRIMES") for q in (1, 2, 3, 4)})


def _purchase_method(plan: DataFrame, buymethod: DataFrame) -> DataFrame:
    bands = buymethod.filter("HIDE = 'N'")
    found = band_lookup(plan, "VALUE_DEFENCE", bands, "MIN_AMT", "MAX_AMT", "BUYMET_CODE", "_method")
    return found.withColumn("BUYMET_CODE", F.when(F.col("VALUE_DEFENCE") > 0, F.col("_method")).otherwise(F.lit("0"))).drop("_method")


def plan_tracking(plan: DataFrame, receipts: DataFrame, plan_year: int) -> DataFrame:
    """The plan with what was received for it in its fiscal year, by fiscal quarter."""
    first, last = dt.date(plan_year - 1, 10, 1), dt.date(plan_year, 9, 30)
    quarter = D.fiscal_quarter("gr_date")
    got = (receipts.filter(F.col("gr_date").between(F.lit(first), F.lit(last)))
           .groupBy(F.col("source_warehouse_code").alias("DEPT_ID"), F.col("source_item_code").alias("WORKING_CODE"))
           .agg(F.sum("received_qty").cast("double").alias("BUY_QTY"), F.sum("received_value").cast("double").alias("BUY_VALUE"),
                *[F.sum(F.when(quarter == q, F.col("received_qty"))).cast("double").alias(f"QTY_BUY_TRI{q}") for q in (1, 2, 3, 4)]))
    return (plan.join(got, ["DEPT_ID", "WORKING_CODE"], "left")
            .withColumns({f"QTY_TRI{q}": F.col("QTY_THIS_YEAR") / 4 for q in (1, 2, 3, 4)})
            .withColumns({f"QTY_RCV_TRI{q}": F.col(f"QTY_BUY_TRI{q}") for q in (1, 2, 3, 4)}))


# On-hand lots ---------------------------------------------------------------------

def _plain_number(c: Column) -> Column:
    """Decimal text without trailing zeros."""
    return F.rtrim(F.rtrim(c.cast("decimal(18,4)").cast("string"), F.lit("0")), F.lit("."))


def on_hand_lots(card: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest movement of every lot up to a day, where something is left."""
    lot = ["STOCK_ID", "WORKING_CODE", "TRADE_CODE", "LOT_NO", "EXPIRED_DATE"]
    rows = card.filter((F.col("OPERATE_DATE") <= F.lit(as_of)) & (F.col("ACTIVE_QTY") > 0) & F.col("STOCK_ID").isNotNull())
    return latest(rows, lot, [F.col("RECORD_NUMBER")], ["REMAIN_QTY_LOT", "ACTIVE_PACK"]).filter("REMAIN_QTY_LOT > 0")


def on_hand_lines(card: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per lot on hand with its text ``[lot : expiry : packs x size (rest)]``.

    A lot without number, expiry or pack size has no text and is left out.
    """
    pack = F.nullif(F.col("ACTIVE_PACK"), F.lit(0).cast("decimal(18,4)"))
    packs = F.floor(F.try_divide(F.col("REMAIN_QTY_LOT"), pack))
    rest = F.try_mod(F.col("REMAIN_QTY_LOT"), pack)
    text = F.concat(F.lit("["), "LOT_NO", F.lit(" : "), F.date_format("EXPIRED_DATE", "dd/MM/yy"), F.lit(" : "),
                    packs.cast("bigint").cast("string"), F.lit(" x "), _plain_number(pack),
                    F.when(rest > 0, F.concat(F.lit(" ("), _plain_number(rest), F.lit(")"))).otherwise(F.lit("")), F.lit("]"))
    return on_hand_lots(card, as_of).withColumn("line", text).filter("line IS NOT NULL")


def on_hand_text(card: DataFrame, as_of: dt.date) -> DataFrame:
    """The lines of `on_hand_lines` as one text per stock and item.

    The text holds every lot of the item, so it is for showing one item's lots;
    jobs over all lots use the lines.
    """
    in_order = F.array_sort(F.collect_list(F.struct("EXPIRED_DATE", "LOT_NO", "TRADE_CODE", "line")))
    return (on_hand_lines(card, as_of).groupBy("STOCK_ID", "WORKING_CODE")
            .agg(F.concat_ws("\n", F.transform(in_order, lambda x: x["line"])).alias("on_hand"), F.count(F.lit(1)).alias("lots")))


# Search ---------------------------------------------------------------------------

def _as_col(term) -> Column:
    return term if isinstance(term, Column) else F.lit(term)


def _named(hits: DataFrame, *kinds: str) -> DataFrame:
    return hits.filter(F.col("kind").isin(*kinds)).select("code").distinct()


def trade_search(t, term, by: str = "code", limit: int = SEARCH_LIMIT, index=None) -> DataFrame:
    """Items and trade products by ``barcode``, ``code`` or ``name`` (a LIKE pattern), newest purchases first.

    ``index`` is a `NameIndex` of the catalogue's names, which then are not scanned; ``term`` is a plain text then.
    """
    maker = t.company.select(keys.normal_code("COMPANY_CODE").alias("_maker"), F.col("COMPANY_NAME").alias("MANUFAC_NAME"))
    item = t.drug_gn.filter(F.coalesce("HIDE", F.lit("N")) == "N")
    trade = t.drug_vn.filter((F.col("MOD_SYS") == "MED") & (F.coalesce("HIDE", F.lit("N")) == "N"))
    rows = item.select("WORKING_CODE", "DRUG_NAME", "SALE_UNIT_ID", "IS_ED", "COLOR", "DFORM_ID", "HOSP_LIST").join(
        trade.select("WORKING_CODE", "TRADE_CODE", "TRADE_NAME", "MANUFAC_CODE", "LAST_BUY"), "WORKING_CODE")
    text, pack = _as_col(term), F.lit("0")
    if by == "barcode":
        wanted = t.pack_ratio.filter(F.col("BAR_CODE") == text).groupBy("TRADE_CODE").agg(F.min("PACK_CODE").alias("_pack_code"))
        rows = rows.join(wanted, "TRADE_CODE")
        pack = F.coalesce(F.col("_pack_code").cast("string"), F.lit(""))
    elif by == "code":
        rows = rows.filter((F.col("WORKING_CODE") == text) | (F.col("TRADE_CODE") == text))
    elif by == "name" and index is not None:
        hits = index.search(term)
        item_hits = _named(hits, "item", "alias").withColumnRenamed("code", "WORKING_CODE")
        trade_hits = _named(hits, "trade", "alias").withColumnRenamed("code", "TRADE_CODE")
        rows = rows.join(item_hits, "WORKING_CODE", "left_semi").unionByName(
            rows.join(trade_hits, "TRADE_CODE", "left_semi").join(item_hits, "WORKING_CODE", "left_anti"))
    elif by == "name":
        pattern = F.upper(text)
        alias = t.inst_name.filter(F.like(F.upper("INST_NAME"), pattern)).select(F.col("REF_CODE").alias("_ref")).distinct()
        named = (F.like(F.upper("DRUG_NAME"), pattern) | F.like(F.upper("TRADE_NAME"), pattern))
        known = alias.withColumn("_alias", F.lit(True))
        rows = (rows.join(known, F.col("WORKING_CODE") == F.col("_ref"), "left")
                .filter(named | F.col("_alias")).drop("_ref", "_alias"))
    else:
        raise ValueError(f"unknown search {by!r}")
    # cut to the page before the label joins, which keep every row
    first = rows.orderBy(F.desc("LAST_BUY"), "DRUG_NAME", "TRADE_NAME", "TRADE_CODE").limit(limit)
    return (first.withColumn("_maker", keys.normal_code("MANUFAC_CODE")).join(maker, "_maker", "left")
            .join(t.dosage_form, "DFORM_ID", "left")
            .join(t.sale_unit.withColumnRenamed("SU_ID", "SALE_UNIT_ID"), "SALE_UNIT_ID", "left")
            .join(t.hosp_list.withColumnRenamed("HOSP_LIST_CODE", "HOSP_LIST"), "HOSP_LIST", "left")
            .select("WORKING_CODE", "DRUG_NAME", "TRADE_CODE", "TRADE_NAME", "MANUFAC_NAME", "SALE_UNIT_ID", "MANUFAC_CODE",
                    "IS_ED", "COLOR", pack.alias("PACK_CODE"), "PROD_TYPE", "DFORM_NAME", "SALE_UNIT", "LAST_BUY"))


def stock_search(t, term, dept: str, site: str, by: str = "code", index=None) -> DataFrame:
    """Visible items a department stocks and a site carries: all columns of the stock, the item's and the pack size to use.

    ``index`` is a `NameIndex` as for `trade_search`.
    """
    text = _as_col(term)
    stock = t.inv_md.filter((F.col("DEPT_ID") == dept) & M.is_visible(F.col("HIDE")))
    item = t.drug_gn.select("WORKING_CODE", "DRUG_NAME", "IS_ED", "USE_TRADE_DIS", "SALE_UNIT_ID", F.coalesce("COLOR", F.lit(DEFAULT_COLOR)).alias("COLOR"))
    carried = t.inv_site.filter(F.col("DEPT_ID") == site).select("WORKING_CODE")
    rows = stock.join(item, "WORKING_CODE").join(carried, "WORKING_CODE", "left_semi")
    packs = t.pack_ratio.filter("PACK_RATIO IS NOT NULL").withColumnRenamed("PACK_RATIO", "_pack")
    newest = [F.col("LAST_BUY"), F.col("TRADE_CODE")]
    if by == "barcode":
        coded = t.pack_ratio.filter(F.col("BAR_CODE") == text).select("WORKING_CODE").distinct()
        rows = rows.join(coded, "WORKING_CODE", "left_semi")
        pack = latest(packs.filter(F.col("BAR_CODE") == text), ["WORKING_CODE"], newest, ["_pack"])
        choice = F.coalesce("_pack", "FIRST_PACK_RATIO", "LAST_PACK_RATIO", F.lit(1.0))
    else:
        if by == "code":
            trade = t.drug_vn.filter(F.col("TRADE_CODE") == text).agg(F.min("WORKING_CODE")).scalar()
            rows = rows.filter((F.col("WORKING_CODE") == text) | (F.col("WORKING_CODE") == trade))
        elif by == "name" and index is not None:
            rows = rows.join(_named(index.search(term), "item", "alias").withColumnRenamed("code", "WORKING_CODE"), "WORKING_CODE", "left_semi")
        elif by == "name":
            pattern = F.upper(text)
            alias = (t.inst_name.filter(F.like(F.upper("INST_NAME"), pattern))
                     .select(F.col("REF_CODE").alias("WORKING_CODE"), F.lit(True).alias("_alias")).distinct())
            rows = rows.join(alias, "WORKING_CODE", "left").filter(F.like(F.upper("DRUG_NAME"), pattern) | F.col("_alias")).drop("_alias")
        else:
            raise ValueError(f"unknown search {by!r}")
        pack = latest(packs, ["WORKING_CODE"], newest, ["_pack"])
        choice = F.coalesce("FIRST_PACK_RATIO", "_pack")
    return (rows.join(pack, "WORKING_CODE", "left").join(t.sale_unit.withColumnRenamed("SU_ID", "SALE_UNIT_ID"), "SALE_UNIT_ID", "left")
            .select(*t.inv_md.columns, "DRUG_NAME", "SALE_UNIT", "IS_ED", "USE_TRADE_DIS", choice.alias("PACK_RATIO"), "COLOR")
            .distinct().orderBy("DRUG_NAME", "WORKING_CODE"))


# Monthly balance ----------------------------------------------------------------------

def monthly_balance(card: DataFrame, drug_gn: DataFrame) -> DataFrame:
    """Received, issued and remaining per month, department and item class, with the balance brought forward."""
    kind = ["DEPT_ID", "IS_ED"]
    status = F.col("R_S_STATUS")

    def part(code: str, amount: str) -> Column:
        return F.sum(F.when(status == code, F.col(amount)).otherwise(0))

    per_item = (card.filter(status.isin("R", "S") & M.not_cancelled(F.col("CANCEL_FLAG")))
                .groupBy("DEPT_ID", "WORKING_CODE", F.year("OPERATE_DATE").alias("YEAR"), F.month("OPERATE_DATE").alias("MONTH"))
                .agg(part("R", "ACTIVE_QTY").alias("RCV_QUAN"), part("R", "VALUE").alias("RCV_VALUE"),
                     part("S", "ACTIVE_QTY").alias("SALE_QUAN"), part("S", "VALUE").alias("SALE_VALUE")))
    sums = ["RCV_QUAN", "RCV_VALUE", "SALE_QUAN", "SALE_VALUE"]
    monthly = (per_item.join(drug_gn.select("WORKING_CODE", "IS_ED"), "WORKING_CODE", "left")
               .groupBy(*kind, "YEAR", "MONTH").agg(*[F.sum(c).alias(c) for c in sums]))
    w = Window.partitionBy(*kind).orderBy("YEAR", "MONTH").rowsBetween(Window.unboundedPreceding, 0)  # one row per month
    qty, value = F.col("RCV_QUAN") - F.col("SALE_QUAN"), F.col("RCV_VALUE") - F.col("SALE_VALUE")
    return (monthly.withColumn("REMAIN_QUAN", F.sum(qty).over(w)).withColumn("REMAIN_VALUE", F.sum(value).over(w))
            .withColumn("BFW_QTY", F.col("REMAIN_QUAN") - qty).withColumn("BFW_VALUE", F.col("REMAIN_VALUE") - value))
