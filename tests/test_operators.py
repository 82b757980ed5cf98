"""Facts, marts, ordered totals, lookups and planning on hand-made rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockloom.operators import dims, facts, lookups, marts, ordered, planning as P, quality as Q, relational as R
from tests.conftest import values

DAY = dt.date(2026, 4, 1)


def test_dead_and_slow_stock(spark):
    ages = [(1, 5, None), (2, 0, None), (3, 5, 89), (4, 5, 90), (5, 5, 179), (6, 5, 180), (7, 0, 200)]
    snap = spark.createDataFrame([(DAY, i, 1, Decimal(q), Decimal(1)) for i, q, _ in ages],
                                 "snapshot_date date, dim_item_id long, dim_warehouse_id long, qty_on_hand decimal(18,4), stock_value decimal(18,2)")
    moves = spark.createDataFrame([(i, 1, DAY - dt.timedelta(days=a), "out") for i, _, a in ages if a is not None],
                                  "dim_item_id long, dim_warehouse_id long, txn_date date, movement_direction string")
    got = values(marts.dead_stock_daily(snap, moves), "dim_item_id", "dead_stock_flag", "slow_moving_flag")
    assert got == [(1, True, False), (2, False, False), (3, False, False), (4, False, True), (5, False, True), (6, True, False), (7, False, False)]
    same = values(marts.dead_stock_daily(snap, moves, as_of_snapshot=True), "dim_item_id", "dead_stock_flag", "slow_moving_flag")
    assert same == got


def test_issue_after_snapshot(spark):
    snap = spark.createDataFrame([(DAY, 1, 1, Decimal(5), Decimal(1))],
                                 "snapshot_date date, dim_item_id long, dim_warehouse_id long, qty_on_hand decimal(18,4), stock_value decimal(18,2)")
    moves = spark.createDataFrame([(1, 1, DAY + dt.timedelta(days=3), "out"), (1, 1, DAY - dt.timedelta(days=200), "out")],
                                  "dim_item_id long, dim_warehouse_id long, txn_date date, movement_direction string")
    assert values(marts.dead_stock_daily(snap, moves), "days_since_last_issue", "dead_stock_flag") == [(-3, False)]
    assert values(marts.dead_stock_daily(snap, moves, as_of_snapshot=True), "days_since_last_issue", "dead_stock_flag") == [(200, True)]


def test_procurement_keeps_both_sides(spark):
    po = spark.createDataFrame([(DAY, 1, 1, "P1", Decimal(2), Decimal(20)), (DAY, 2, None, "P2", Decimal(3), None)],
                               "po_date date, dim_item_id long, dim_vendor_id long, po_no string, ordered_qty decimal(18,4), ordered_value decimal(18,2)")
    gr = spark.createDataFrame([(DAY, 2, None, "G1", Decimal(1), Decimal(5)), (DAY, 3, 1, "G2", Decimal(4), Decimal(8))],
                               "gr_date date, dim_item_id long, dim_vendor_id long, gr_no string, received_qty decimal(18,4), received_value decimal(18,2)")
    got = {r["dim_item_id"]: r for r in marts.procurement_monthly(po, gr).collect()}
    assert len(got) == 3
    assert (got[1]["po_count"], got[1]["gr_count"]) == (1, 0)
    assert (got[2]["po_count"], got[2]["gr_count"], got[2]["ordered_value"], got[2]["received_qty"]) == (1, 1, 0, 1)
    assert (got[3]["ordered_qty"], got[3]["received_value"]) == (0, 8)


def test_month_bounds():
    assert marts.month_bounds(202612, 202612) == (dt.date(2026, 12, 1), dt.date(2026, 12, 31))
    assert marts.month_bounds(None, 202402) == (None, dt.date(2024, 2, 29))


def test_lookup_unknown_member(spark):
    dim = spark.createDataFrame([("A", 5)], "source_item_code string, dim_item_id long")
    rows = spark.createDataFrame([("A",), ("B",), (None,)], "source_item_code string")
    assert [r[0] for r in sorted(dims.lookup(rows, dim, "dim_item").select("dim_item_id").collect())] == [0, 0, 5]


def test_upsert_keeps_first_sighting_and_missing_columns(spark):
    first = spark.createDataFrame([("W1", "a", "t", True), ("W2", "b", "t", None)],
                                  "source_warehouse_code string, warehouse_name string, warehouse_type string, is_active boolean")
    one = dims.upsert_dimension(None, first.withColumn("parent_warehouse_code", F.lit("HQ")), "dim_warehouse", dt.datetime(2026, 1, 1))
    second = first.filter("source_warehouse_code = 'W1'").withColumn("warehouse_name", F.lit("new"))
    two = dims.upsert_dimension(one, second, "dim_warehouse", dt.datetime(2026, 1, 2))
    got = {r["source_warehouse_code"]: r for r in two.collect()}
    assert (got["W1"]["warehouse_name"], got["W1"]["parent_warehouse_code"]) == ("new", "HQ")
    assert got["W1"]["first_seen_ts"].day == 1 and got["W1"]["last_seen_ts"].day == 2
    assert got["W2"]["last_seen_ts"].day == 1 and got["W2"]["is_active"] is True
    assert dims.with_unknown(two, "dim_warehouse").filter("dim_warehouse_id = 0").count() == 1


def test_sequential_ids_are_dense(spark):
    codes = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("code"))
    got = sorted(r[0] for r in dims.sequential_ids(codes, "code", "n", after=10).select("n").collect())
    assert got == list(range(11, 5011))


def test_reload_rules_are_idempotent(spark):
    now = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    once = facts.replace_keys(now, batch, ["k"])
    assert values(once) == values(facts.replace_keys(once, batch, ["k"])) == [("a", 1), ("b", 3), ("c", 4)]
    added = now.unionByName(facts.insert_absent(now, batch, ["k"]))
    assert values(added) == [("a", 1), ("b", 2), ("c", 4)]
    assert facts.insert_absent(added, batch, ["k"]).count() == 0


# Ordered totals -------------------------------------------------------------------

def skewed_items(n=3000, seed=5):
    """A third of the items share one value; the rest spread over many magnitudes, some zero or negative."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = 42 if i % 3 == 0 else round(10 ** rng.uniform(-2, 7), 2) if i % 7 else rng.choice([0, -3.5, -1000.25])
        rows.append((f"i{i}", Decimal(str(v)).quantize(Decimal("0.01"))))
    return rows


def test_running_total_equals_brute_force(spark):
    rows = skewed_items()
    df = spark.createDataFrame(rows, "item string, v decimal(18,2)")
    want, total = {}, Decimal(0)
    for v in sorted({v for _, v in rows}, reverse=True):
        total += sum(x for _, x in rows if x == v)
        want[v] = total
    got = ordered.running_from_top(df, "v", F.col("v")).collect()
    assert {r["value"]: r["running"] for r in got} == want
    assert {r["total"] for r in got} == {total}


def test_top_share_equals_percent_rank(spark):
    rows = skewed_items()
    df = spark.createDataFrame(rows, "item string, v decimal(18,2)")
    n = len(rows)
    want = {i for i, v in rows if sum(x > v for _, x in rows) / (n - 1) <= 0.2}
    assert {r["item"] for r in ordered.top_share(df, "v").collect()} == want


def test_abc_classes_equal_brute_force(spark):
    rows = [r for r in skewed_items() if r[1] >= 0]
    total = sum(v for _, v in rows)
    share = {v: sum(x for _, x in rows if x > v) / total for v in {v for _, v in rows}}
    want = {i: "A" if share[v] < Decimal("0.8") else "B" if share[v] < Decimal("0.95") else "C" for i, v in rows}
    got = ordered.abc_classes(spark.createDataFrame(rows, "item string, v decimal(18,2)"), "v")
    assert {r["item"]: r["abc_class"] for r in got.collect()} == want


def test_band_lookup_equals_brute_force(spark):
    rng = random.Random(3)
    bands = [(f"{c:02}", Decimal(lo), Decimal(lo + rng.randrange(1, 5000))) for c, lo in enumerate(rng.sample(range(0, 9000), 12))]
    vals = [(i, float(v)) for i, v in enumerate([0, 0.5, 1, 2, 4096, 8192, *[b[1] for b in bands], *[b[2] for b in bands], 99999])]
    got = lookups.band_lookup(spark.createDataFrame(vals, "i int, v double"), "v", spark.createDataFrame(bands, "c string, lo decimal(18,2), hi decimal(18,2)"),
                              "lo", "hi", "c", "m").collect()
    want = {i: min((c for c, lo, hi in bands if float(lo) <= v <= float(hi)), default=None) for i, v in vals}
    assert {r["i"]: r["m"] for r in got} == want


def test_latest_takes_newest_row_even_if_null(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("b", 1, 7)], "k string, t int, v int")
    assert values(lookups.latest(df, ["k"], [F.col("t")], ["v"])) == [("a", None), ("b", 7)]


# Planning ---------------------------------------------------------------------------

@pytest.mark.parametrize("packs,want", [(0.1, 0), (1, 20), (10, 20), (12, 20), (20, 20), (30, 40), (-5, 0)])
def test_pack_rounding(spark, packs, want):
    got = spark.createDataFrame([(float(packs),)], "n double").select(P.order_quantity(F.col("n"), F.lit(1.0))).first()[0]
    assert got == want


def test_plan_windows():
    july = P.plan_windows(2025, 7)
    assert (july.year_1, july.year_2, july.year_3, july.months) == ((202210, 202309), (202310, 202409), (202410, 202507), 10)
    assert (july.first_day, july.last_day) == (dt.date(2024, 10, 1), dt.date(2025, 7, 31))
    december = P.plan_windows(2025, 12)
    assert december.year_3 == (202510, 202512) and december.months == 3 and december.year_2 == (202410, 202409)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (9.99,), (10.0,), (None,)], "v double")
    assert values(R.histogram(df, "v", 2)) == [(0, 1), (1, 3)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert values(R.histogram(flat, "v", 4)) == [(0, 2)]


def test_text_match_and_choose(spark):
    df = spark.createDataFrame([("Aspirin", "x"), ("b.c", "y"), (None, "x")], "name string, kind string")
    assert df.filter(R.text_match("ASP", "name")).count() == 1
    assert df.filter(R.text_match("b.c", "name", regex=False)).count() == 1
    assert df.filter(R.text_match("z|asp", "name", "kind")).count() == 1
    assert R.choose(df, kind="All", name=None).count() == 3 and R.choose(df, kind="x").count() == 2


# Quality --------------------------------------------------------------------------------

def test_rules_catch_seeded_rows(spark):
    rows = [("t1", DAY, "i", "w", "receive", Decimal(1), Decimal(2), Decimal(2)), ("t2", DAY, "i", "w", "teleport", Decimal(0), None, None),
            ("t3", DAY, None, "w", "issue", Decimal(2), None, Decimal(9)), (None, DAY, "i", "w", "issue", None, None, None)]
    df = spark.createDataFrame(rows, "source_txn_id string, txn_date date, source_item_code string, source_warehouse_code string, "
                                     "movement_type string, qty decimal(18,4), unit_cost decimal(18,6), line_value decimal(18,2)")
    failed = {r["rule"]: r["failed"] for r in Q.report(df, "inventory_movement").collect()}
    assert failed["source_txn_id missing"] == 1 and failed["source_item_code missing"] == 1 and failed["qty missing"] == 1
    assert failed["unknown movement type"] == 1 and failed["zero quantity"] == 1 and failed["quantity without cost"] == 1
    good, bad = Q.split(df, "inventory_movement")
    assert good.count() == 2 and values(bad, "rejected_for") == [("source_item_code missing",), ("source_txn_id missing; qty missing",)]
    with pytest.raises(Q.DataQualityError):
        Q.enforce(df, "inventory_movement")


def test_duplicate_key_fails(spark):
    row = (DAY, "i", "w", Decimal(1))
    df = spark.createDataFrame([row, row], "snapshot_date date, source_item_code string, source_warehouse_code string, qty_on_hand decimal(18,4)")
    with pytest.raises(Q.DataQualityError, match="duplicate"):
        Q.enforce(df, "stock_balance")


def test_date_states(spark):
    df = spark.createDataFrame([(t,) for t in ("20260401", "2026041", "20260230", "18000101", None)], "d string")
    got = {r["d"]: r["date_state"] for r in Q.date_quarantine(df, "d").collect()}
    assert got == {"20260401": "ok", "2026041": "bad format", "20260230": "not a date", "18000101": "unrealistic", None: "bad format"}


def test_repeated_master_codes_are_set_aside(spark):
    """All rows of a repeated code go; vendors without a code are not repeats of one another."""
    vendors = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), (None, "d"), (None, "e")], "source_vendor_code string, vendor_name string")
    good, bad = Q.split_duplicates(vendors, "vendor_master")
    assert sorted(r.vendor_name for r in good.collect()) == ["c", "d", "e"]
    assert sorted((r.vendor_name, r.rejected_for) for r in bad.collect()) == [("a", "duplicate business key"), ("b", "duplicate business key")]
    with pytest.raises(Q.DataQualityError, match="duplicate business key"):
        Q.enforce(vendors, "vendor_master")
    Q.enforce(good, "vendor_master")
