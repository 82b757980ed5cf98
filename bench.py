"""Time the headline queries and print one JSON line.

Every query is written to the no-op sink, so it computes all of its rows and
collects none.  One warm-up run, then the better of two.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stockloom.catalog import QUERIES, run  # noqa: E402
from stockloom.session import local_session  # noqa: E402

HEADLINE = (
    "src_05_stock_balance", "src_06_stock_lot_balance", "key_01_business_hash", "snk_08_movement_fact", "snk_09_purchase_order_reload",
    "mart_01_inventory_daily", "mart_04_consumption_daily", "mart_05_movement_daily", "mart_06_dead_stock_daily",
    "mart_07_consumption_monthly", "mart_08_procurement_monthly", "mart_09_budget_burn_monthly", "mart_10b_consumption_daily_enriched",
    "rpt_02_inventory_level", "rpt_07_consumption_by_item", "rpt_14_dead_stock", "rpt_17_top_vendors",
    "kpi_042_alerts", "srv_01_exec_dashboard", "srv_04_consumption_monthly", "pln_00_buy_plan", "onh_01_on_hand_lots",
    "win_06_abc_classes", "dq_11_severity_report",
)


def seconds(spark, name: str, data: str) -> float:
    start = time.perf_counter()
    run(QUERIES[name], spark, data).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "stockloom-bench")
    timed = {}
    for name in wanted:
        seconds(spark, name, data)
        timed[name] = round(min(seconds(spark, name, data) for _ in range(2)), 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(timed.values()), 3), "unit": "sec",
                      "queries": timed, "sf": Path(data).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
