"""Calendar expressions: 8-digit dates, fiscal and Buddhist calendars, Thai date text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thai month names, January first.
THAI_MONTH_SHORT = ("ม.ค.", "ก.พ.", "มี.ค.", "เม.ย.", "พ.ค.", "มิ.ย.", "ก.ค.", "ส.ค.", "ก.ย.", "ต.ค.", "พ.ย.", "ธ.ค.")
THAI_MONTH_LONG = (
    "มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน",
    "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม",
)
BUDDHIST_OFFSET = 543


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date8(text: Column | str) -> Column:
    """``YYYYMMDD`` text to date; anything else, and the year 0000, is NULL."""
    t = F.trim(_col(text))
    return F.when(t.rlike("^(?!0000)[0-9]{8}$"), F.try_to_timestamp(t, F.lit("yyyyMMdd")).cast("date"))


def parse_date8_lenient(text: Column | str) -> Column:
    """As `parse_date8`, but a missing month and day (``YYYY0000``) means 1 January."""
    t = F.trim(_col(text))
    return parse_date8(F.when(F.right(t, F.lit(4)) == "0000", F.concat(F.left(t, F.lit(4)), F.lit("0101"))).otherwise(t))


def format_date8(date: Column | str) -> Column:
    return F.date_format(_col(date), "yyyyMMdd")


def fiscal_year(date: Column | str) -> Column:
    """Year in which the fiscal year (October to September) ends."""
    d = _col(date)
    return F.year(d) + F.when(F.month(d) >= 10, 1).otherwise(0)


def fiscal_year_start(date: Column | str) -> Column:
    return F.make_date(fiscal_year(date) - 1, F.lit(10), F.lit(1))


def thai_fiscal_year(date: Column | str) -> Column:
    return fiscal_year(date) + BUDDHIST_OFFSET


def thai_fiscal_year_text(date: Column | str) -> Column:
    return F.concat(F.lit("ปีงบประมาณ "), thai_fiscal_year(date).cast("string"))


def fiscal_quarter(date: Column | str) -> Column:
    """1 for October to December."""
    return F.quarter(_col(date)) % 4 + 1


def current_fiscal_year(as_of: dt.date, calendar: str = "G") -> int:
    """Fiscal year containing ``as_of``: Gregorian ``G`` or Buddhist ``B``."""
    year = as_of.year + (as_of.month >= 10)
    return year + (BUDDHIST_OFFSET if calendar == "B" else 0)


def _month_name(names: tuple[str, ...], month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), month)


def thai_date_short(date: Column | str) -> Column:
    d = _col(date)
    year = (F.year(d) + BUDDHIST_OFFSET).cast("string")
    return F.concat_ws(" ", F.dayofmonth(d).cast("string"), _month_name(THAI_MONTH_SHORT, F.month(d)), year)


def thai_date_numeric(date: Column | str) -> Column:
    d = _col(date)
    return F.concat_ws("/", F.dayofmonth(d), F.month(d), F.year(d) + BUDDHIST_OFFSET)


def thai_month_year(date: Column | str) -> Column:
    d = _col(date)
    return F.concat_ws(" ", _month_name(THAI_MONTH_LONG, F.month(d)), (F.year(d) + BUDDHIST_OFFSET).cast("string"))


def months_between_keys(later: Column, earlier: Column) -> Column:
    """Whole months between two ``YYYYMM`` integers."""
    def months(key: Column) -> Column:
        return F.floor(key / 100) * 12 + key % 100
    return months(later) - months(earlier)


def hours_between(later: Column, earlier: Column) -> Column:
    seconds = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))
    return seconds / F.lit(3600.0)


def month_label(year: Column, month: Column) -> Column:
    return F.concat(month.cast("string"), F.lit("/"), year.cast("string"))


def day(value: dt.date | str) -> Column:
    """Date literal."""
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)
