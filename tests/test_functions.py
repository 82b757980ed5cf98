"""Golden rows for the scalar rules."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from stockloom.functions import dates as D, keys, measures as M


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluated(spark, values, kind, make):
    rows = column(spark, values, kind).select("i", make(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows)]


def test_dates_strict_and_lenient(spark):
    texts = ["20260401", "20260230", "00000000", "2026041", "20250000", "2026-4-1", None]
    assert evaluated(spark, texts, "string", D.parse_date8) == [dt.date(2026, 4, 1), None, None, None, None, None, None]
    lenient = evaluated(spark, texts, "string", D.parse_date8_lenient)
    assert lenient[0] == dt.date(2026, 4, 1) and lenient[4] == dt.date(2025, 1, 1) and lenient[1] is None


def test_fiscal_calendar(spark):
    days = [dt.date(2026, 9, 30), dt.date(2026, 10, 1)]
    assert evaluated(spark, days, "date", D.fiscal_year_start) == [dt.date(2025, 10, 1), dt.date(2026, 10, 1)]
    assert evaluated(spark, days, "date", D.thai_fiscal_year) == [2569, 2570]
    assert evaluated(spark, days, "date", D.thai_fiscal_year_text) == ["ปีงบประมาณ 2569", "ปีงบประมาณ 2570"]
    months = [dt.date(2026, m, 1) for m in range(1, 13)]
    assert evaluated(spark, months, "date", D.fiscal_quarter) == [2, 2, 2, 3, 3, 3, 4, 4, 4, 1, 1, 1]
    assert D.current_fiscal_year(dt.date(2026, 12, 1)) == 2027 and D.current_fiscal_year(dt.date(2026, 9, 30), "B") == 2569


def test_thai_text(spark):
    day = [dt.date(2026, 4, 1)]
    assert evaluated(spark, day, "date", D.thai_date_short) == ["1 เม.ย. 2569"]
    assert evaluated(spark, day, "date", D.thai_date_numeric) == ["1/4/2569"]
    assert evaluated(spark, day, "date", D.thai_month_year) == ["เมษายน 2569"]


def test_hash_counts_null_as_blank(spark):
    df = spark.createDataFrame([("  a ", None, 7)], "x string, y string, z int")
    got = df.select(keys.business_hash("x", "y", "z")).first()[0]
    assert got == hashlib.sha256(b"a||||7").hexdigest()


def test_code_normalisation(spark):
    assert evaluated(spark, ["007", " 12 ", "0", "000", "A0", None], "string", keys.normal_code) == ["7", "12", "0", "0", "A0", None]


@pytest.mark.parametrize("kind,direction", [
    ("receive", "in"), ("transfer_in", "in"), ("return_in", "in"), ("adjust_in", "in"), ("issue", "out"), ("transfer_out", "out"),
    ("return_out", "out"), ("ADJUST_OUT", "out"), ("Receive", "in"), ("other", "neutral"), ("??", "neutral")])
def test_movement_direction(spark, kind, direction):
    assert evaluated(spark, [kind], "string", M.movement_direction) == [direction]


def test_order_status_first_match_wins(spark):
    rows = [("1", None), ("1", "N"), ("2", "Y"), ("3", "N"), ("4", "Y"), ("0", "N"), ("0", "Y"), ("0", None), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p string, ok string")
    got = [r[1] for r in df.select("i", M.order_status(F.col("p"), F.col("ok"))).orderBy("i").collect()]
    assert got == ["approved", "approved", "received_partial", "received_full", "cancelled", "cancelled", "approved", "pending", "pending"]


def test_expiry_and_stock_status(spark):
    day = dt.date(2026, 4, 1)
    shifts = [None, -1, 0, 90, 91]
    dates = [None if s is None else day + dt.timedelta(days=s) for s in shifts]
    assert evaluated(spark, dates, "date", lambda c: M.expiry_status(c, F.lit(day))) == [
        "no_expiry", "expired", "near_expiry", "near_expiry", "healthy"]
    assert evaluated(spark, [1, 0, -1], "int", M.stock_status) == ["normal", "zero", "negative"]


def test_expiry_ranges(spark):
    assert evaluated(spark, [0, 1, 30, 31, 90, 91, 180, 181, None], "int", M.expiry_range) == [
        "Expired", "0-30 Days", "0-30 Days", "30-90 Days", "30-90 Days", "90-180 Days", "90-180 Days", "180+ Days", "180+ Days"]


def test_division_guards_and_trend(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0), (2.0, 2.0), (1.0, 2.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = df.select(M.safe_divide(a, b).alias("d"), M.trend_text(a, b).alias("t")).collect()
    assert [r["d"] for r in got] == [0.0, 0.0, 1.5, 1.0, 0.5]
    assert [r["t"] for r in got] == [None, None, "↑ +50.0%", "→ 0%", "↓ -50.0%"]


def test_display_frame(spark):
    df = spark.createDataFrame([(1234.5, 2.0, None, dt.date(2026, 4, 1))], "total_cost double, qty double, rate double, due_date date")
    assert tuple(M.display_frame(df).first()) == ("฿1,234.50", "2.00", "N/A", "01/04/2026 00:00")


def test_hidden_flag(spark):
    assert evaluated(spark, ["N", "Y", "", None], "string", M.is_visible) == [True, False, True, True]
