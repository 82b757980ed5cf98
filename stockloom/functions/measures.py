"""Numeric and classification expressions shared by facts, marts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockloom import schemas as S


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Double division; ``default`` where the denominator is NULL or zero."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(float(default))).otherwise(n / d)


def ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """Rounded double quotient; NULL where the denominator is zero."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), digits)


def mean(total: Column, count: Column, digits: int = 6) -> Column:
    return ratio(total, count, digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient with the denominator raised to at least one."""
    return numerator.cast("double") / F.greatest(denominator.cast("double"), F.lit(1.0))


def trend_pct(current: Column, previous: Column) -> Column:
    c, p = current.cast("double"), previous.cast("double")
    return F.try_divide(c - p, F.abs(p)) * 100


def trend_text(current: Column, previous: Column) -> Column:
    pct = trend_pct(current, previous)
    number = F.format_string("%+.1f", pct)
    return (F.when(pct > 0, F.concat(F.lit("↑ "), number, F.lit("%")))
            .when(pct < 0, F.concat(F.lit("↓ "), number, F.lit("%")))
            .when(pct == 0, F.lit("→ 0%")))


def is_visible(hide: Column) -> Column:
    """The three spellings of "not hidden": 'N', NULL and ''."""
    return F.coalesce(hide, F.lit("N")).isin("N", "")


def not_cancelled(flag: Column, strict_null: bool = False) -> Column:
    """Cancel rule: anything but 'Y' (default), or only NULL."""
    return flag.isNull() if strict_null else F.coalesce(flag, F.lit("N")) != "Y"


def movement_direction(movement_type: Column) -> Column:
    t = F.lower(movement_type)
    return F.when(t.isin(*S.MOVEMENT_IN), "in").when(t.isin(*S.MOVEMENT_OUT), "out").otherwise("neutral")


def signed(amount: Column, direction: Column) -> Column:
    return F.when(direction == "out", -amount).otherwise(amount)


def status_direction(status: Column, preset: str = "mapping") -> Column:
    """IN / OUT / ADJ / UNKNOWN of a card status code under one preset."""
    out = F.lit("UNKNOWN")
    for name, codes in reversed(S.DIRECTION_PRESETS[preset].items()):
        if codes:
            out = F.when(status.isin(*codes), name).otherwise(out)
    return out


# The status and class names below, and the codes they stand for.

def order_status(process: Column, ok: Column) -> Column:
    return (F.when(process == "3", "received_full").when(process == "2", "received_partial")
            .when(process == "1", "approved").when((process == "4") | (ok == "N"), "cancelled")
            .when(ok == "Y", "approved").otherwise("pending"))


def vendor_type(vendor_flag: Column, maker_flag: Column) -> Column:
    vendor, maker = vendor_flag == "Y", maker_flag == "Y"
    return (F.when(vendor & maker, "both").when(vendor, "vendor").when(maker, "manufacturer").otherwise("other"))


def stock_status(qty: Column) -> Column:
    return F.when(qty > 0, "normal").when(qty == 0, "zero").otherwise("negative")


def expiry_status(expiry: Column, as_of: Column, near_days: int = S.NEAR_EXPIRY_DAYS) -> Column:
    left = F.datediff(expiry, as_of)
    return (F.when(expiry.isNull(), "no_expiry").when(left < 0, "expired")
            .when(left <= near_days, "near_expiry").otherwise("healthy"))


# Expiry ranges in order, with their upper bounds in days.

def expiry_range(days_left: Column) -> Column:
    return (F.when(days_left <= 0, "Expired").when(days_left <= 30, "0-30 Days")
            .when(days_left <= 90, "30-90 Days").when(days_left <= 180, "90-180 Days").otherwise("180+ Days"))


def expiry_range_rank(days_left: Column) -> Column:
    return (F.when(days_left <= 0, 1).when(days_left <= 30, 2)
            .when(days_left <= 90, 3).when(days_left <= 180, 4).otherwise(5))


def freshness_band(hours: Column) -> Column:
    return F.when(hours.isNull(), "unknown").when(hours < 24, "fresh").when(hours < 48, "aging").otherwise("old")


# Code-to-label tables of the source application.
ED_CLASS = {1: "ED", 2: "NED", 3: "NDMS", 4: "CM", 5: "PS"}
ED_LIST = {1: "ก", 2: "ข", 3: "ค", 4: "ง", 5: "จ (1)", 6: "จ (2)"}
ITEM_CLASS = {
    1: "ยาในบัญชียาหลักแห่งชาติ", 2: "ยานอกบัญชียาหลักแห่งชาติ", 3: "เวชภัณฑ์มิใช่ยา", 4: "เคมีภัณฑ์",
    5: "วัสดุห้องปฏิบัติการ", 6: "วัสดุเภสัชกรรม", 7: "วัสดุทางทันตกรรม", 8: "วัสดุการแพทย์ทั่วไป",
    9: "วัสดุทางรังสี", 10: "วัสดุทั่วไป", 11: "ครุภัณฑ์", 12: "ครุภัณฑ์การแพทย์",
}
# Supply code to item type.
SUPPLY_TYPE = {"1": "drug", "2": "supply"}


def label(code: Column, table: dict, default: str | None = None) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    # try_element_at: an unlisted code is NULL, not an error
    found = F.try_element_at(F.create_map(*entries), code)
    return found if default is None else F.coalesce(found, F.lit(default))


# Display text ---------------------------------------------------------------

def currency_text(value: Column, sign: str = "฿") -> Column:
    return F.concat(F.lit(sign), F.format_number(F.coalesce(value.cast("double"), F.lit(0.0)), 2))


def number_text(value: Column, digits: int = 0) -> Column:
    v = value.cast("double")
    if digits == 0:
        return F.when(v.isNull(), "0").otherwise(F.format_number(v.cast("bigint"), 0))
    return F.when(v.isNull(), "0").otherwise(F.format_number(v, digits))


def date_text(value: Column, pattern: str = "dd/MM/yyyy") -> Column:
    return F.coalesce(F.date_format(value, pattern), F.lit("N/A"))


def display_frame(df):
    """All-text copy of a report, formatted by column name and type."""
    money = ("price", "cost", "amount", "value")
    out = []
    for f in df.schema.fields:
        c, name, kind = F.col(f.name), f.name.lower(), f.dataType.typeName()
        if kind in ("double", "float", "decimal"):
            text = (currency_text(c) if any(m in name for m in money)
                    else F.when(c.isNull(), "N/A").otherwise(number_text(c, 2)))
        elif name.endswith("date") or name.endswith("_at"):
            text = date_text(c, "dd/MM/yyyy HH:mm") if kind in ("date", "timestamp") else c.cast("string")
        else:
            text = c.cast("string")
        out.append(text.alias(f.name))
    return df.select(*out)
