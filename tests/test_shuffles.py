"""How often wide rows are moved: plans of the shared steps over the card, and the rows they give."""

import datetime as dt
import re
from types import SimpleNamespace

import pytest

from stockloom.catalog import QUERIES
from stockloom.catalog.planning import plan_of
from stockloom.operators import models as M, planning as P
from stockloom.plans.warehouse import Warehouse
from stockloom.sources.adapters import ADAPTERS, inputs_of
from tests.conftest import values

DAY = dt.date(2000, 6, 30)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_of_the_card_are_shuffled_once(spark, data, no_broadcast):
    src = Warehouse(spark, data).src
    lines = physical(src.card).splitlines()
    depth = [len(re.match(r"[\s:|+\-]*", line).group()) for line in lines]
    for i, line in enumerate(lines):
        if "hashpartitioning(o_custkey" in line:
            below = [j for j in range(i + 1, len(lines)) if all(depth[k] > depth[i] for k in range(i + 1, j + 1))]
            assert not any("l_partkey" in lines[j] for j in below)
    written = spark.sql(ADAPTERS["card"], **{n: src[n] for n in inputs_of(ADAPTERS["card"])})
    assert src.card.columns == written.columns
    assert src.card.exceptAll(written).count() == written.exceptAll(src.card).count() == 0


def test_lots_match_their_movements_where_they_lie(spark, data, no_broadcast):
    plan = physical(QUERIES["jon_11_lot_join"].build(Warehouse(spark, data)))
    by_all = re.findall(r"hashpartitioning\(WORKING_CODE#\d+, TRADE_CODE#\d+, DEPT_ID#\d+, LOT_NO#\d+, EXPIRED_DATE#\d+", plan)
    assert len(by_all) == 3  # the lots, and the movements for either match, each as they are summed


def test_the_snapshot_shuffles_its_lots_for_the_item_alone(spark, data, no_broadcast):
    plan = physical(M.inventory_snapshot(Warehouse(spark, data).src, DAY))
    assert not re.search(r"hashpartitioning\(working_code#\d+, dept_id#\d+, \d+\)", plan)


def test_the_plan_reads_the_card_once_for_sums_and_balance(spark, data):
    plan = plan_of(Warehouse(spark, data))._jdf.queryExecution().optimizedPlan().toString()
    # the card for sums and balance, for packs and for the stocks; trade products; receipts
    assert len(re.findall(r"Relation \[l_orderkey", plan)) == 5


def test_snapshot_and_valued_lots_repeat_lots_as_their_lookups_do(spark):
    lots = [("a", "t", "D1", "x", "L1", None, "7", 4, 2, None, None), ("a", "t", "D2", "x", "L1", None, "007", 5, None, 3, None),
            ("b", "t", "D1", "x", None, None, None, -1, None, None, 9), (None, "t", "D1", "x", "L1", None, "1", 1, 1, 1, 1), ("c", "t", None, "x", "L1", None, "1", 3, 1, 1, 1)]
    t = SimpleNamespace(
        inv_md_c=spark.createDataFrame(lots, "WORKING_CODE string, TRADE_CODE string, DEPT_ID string, LOCATION string, LOT_NO string, EXPIRED_DATE date, VENDOR_CODE string, "
                                       "QTY_ON_HAND int, LOT_COST int, PACK_COST int, LOT_VALUE int").selectExpr(
            "* EXCEPT (QTY_ON_HAND, LOT_COST, PACK_COST, LOT_VALUE)", "CAST(QTY_ON_HAND AS DECIMAL(18,4)) QTY_ON_HAND", "CAST(LOT_COST AS DECIMAL(18,6)) LOT_COST",
            "CAST(PACK_COST AS DECIMAL(18,6)) PACK_COST", "CAST(LOT_VALUE AS DECIMAL(18,2)) LOT_VALUE"),
        # two rows for one place, an item without a department, a department without an item
        inv_md=spark.createDataFrame([("a", "D1", 1.0), ("a", "D1", 2.0), ("b", "D1", None), ("c", None, 8.0), (None, "D1", 6.0), ("z", "D1", 5.0)],
                                     "WORKING_CODE string, DEPT_ID string, MIN_LEVEL double"),
        # one item twice
        drug_gn=spark.createDataFrame([("a", None, None), ("b", 3.0, None), ("b", None, 4.0), (None, 9.0, 9.0)], "WORKING_CODE string, REORDER_QTY double, MIN_LEVEL double"),
        card=spark.createDataFrame([("a", "t", "D1", "L1", dt.date(2000, 6, 1)), ("a", "t", "D1", "L1", dt.date(1999, 1, 1)), ("a", "t", "D2", "L1", dt.date(1999, 1, 1))],
                                   "WORKING_CODE string, TRADE_CODE string, DEPT_ID string, LOT_NO string, OPERATE_DATE date"))
    snap = M.inventory_snapshot(t, DAY)
    got = values(snap.selectExpr("working_code", "dept_id", "vendor_code", "int(stock_value)", "int(reorder_threshold)", "dead_stock_flag", "stock_status"))
    assert got == sorted([("a", "D1", "7", 8, 1, False, "in_stock"), ("a", "D1", "7", 8, 2, False, "in_stock"), ("a", "D2", "7", 15, None, True, "in_stock"),
                          ("b", "D1", None, 9, 3, False, "out"), ("b", "D1", None, 9, 4, False, "out"), (None, "D1", "1", 1, None, False, "in_stock"),
                          ("c", None, "1", 1, None, False, "in_stock")], key=str)
    columns = ("working_code", "qty_on_hand", "stock_value")
    assert values(M.valued_lots(t), *columns) == values(snap, *columns)


def test_sums_of_the_plan_take_no_zero_from_rows_before_them(spark):
    card = spark.createDataFrame([("D1", "a", dt.date(1999, 1, 5), "S", None, "2", 7), ("D1", "a", dt.date(1990, 1, 5), "S", 5, "1", 9),
                                  ("D1", "b", dt.date(1999, 1, 5), "S", 4, "1", None), ("D1", "b", dt.date(1990, 1, 5), "S", 5, "9", 3), ("D1", "c", dt.date(1990, 1, 5), "S", 5, "1", 1)],
                                 "STOCK_ID string, WORKING_CODE string, OPERATE_DATE date, R_S_STATUS string, ACTIVE_QTY int, RECORD_NUMBER string, REMAIN_QTY int").selectExpr(
        "* EXCEPT (ACTIVE_QTY, REMAIN_QTY)", "CAST(ACTIVE_QTY AS DECIMAL(18,4)) ACTIVE_QTY", "CAST(REMAIN_QTY AS DECIMAL(18,4)) REMAIN_QTY", "'N' FREE_FLAG", "CAST(1 AS DECIMAL(18,2)) VALUE")
    got = P.card_measures(card, P.plan_windows(1999, 6))
    assert values(got, "WORKING_CODE", "RATE_1_YEAR", "RATE_3_YEAR", "use_q1", "use_q2", "QTY_ON_HAND") == [
        ("a", 0.0, None, 0.0, None, 7.0), ("b", 0.0, 4 * 12 / 9, 0.0, 4.0, 0.0)]
