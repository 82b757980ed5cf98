"""Idempotent loads, jobs and the ledger, and the streaming path."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockloom.plans import jobs
from stockloom.plans.jobs import JOBS, Job, JobFailed, Runner
from stockloom.plans.ledger import BATCH, TABLE_RUN, Ledger
from stockloom.plans.store import Store, work_folder
from stockloom.sources import extract
from stockloom.streaming import movements as T
from tests.conftest import values

AS_OF = dt.date(1999, 6, 30)
CLOCK = dt.datetime(1999, 7, 1)


def rows(spark, *data):
    return spark.createDataFrame([(dt.date.fromisoformat(d), k, v) for d, k, v in data], "d date, k string, v int")


@pytest.mark.parametrize("grain", ["day", "month"])
def test_replace_range_drops_emptied_days(spark, grain):
    s = Store(spark, work_folder(spark, "range"), grain)
    s.append(rows(spark, ("2026-01-05", "a", 1), ("2026-01-20", "b", 2), ("2026-02-03", "c", 3), ("2026-03-01", "d", 4)), "m.t", "d")
    new = rows(spark, ("2026-01-21", "x", 9))
    for _ in range(2):
        s.replace_range(new, "m.t", "d", dt.date(2026, 1, 10), dt.date(2026, 2, 28))
        assert values(s.read("m.t"), "k") == [("a",), ("d",), ("x",)]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_replace_days_and_keys(spark, grain):
    s = Store(spark, work_folder(spark, "keys"), grain)
    s.append(rows(spark, ("2026-01-05", "a", 1), ("2026-01-06", "b", 2), ("2026-02-03", "c", 3)), "f.t", "d")
    for _ in range(2):
        s.replace_days(rows(spark, ("2026-01-06", "e", 5)), "f.t", "d")
        assert values(s.read("f.t"), "k") == [("a",), ("c",), ("e",)]
    moved = rows(spark, ("2026-03-01", "c", 7))
    for _ in range(2):
        s.replace_keys(moved, "f.t", ["k"], "d")
        assert values(s.read("f.t"), "k", "v") == [("a", 1), ("c", 7), ("e", 5)]
    assert dt.date(2026, 2, 1) not in s.parts("f.t") and dt.date(2026, 2, 3) not in s.parts("f.t")


def test_insert_absent_twice(spark, store):
    batch = rows(spark, ("2026-01-05", "a", 1), ("2026-01-06", "b", 2))
    assert store.insert_absent(batch, "f.t", ["k"], "d") == 2
    assert store.insert_absent(batch, "f.t", ["k"], "d") == 0
    assert store.read("f.t").count() == 2


def test_versions_swap(spark, store):
    assert store.read_version("c.d") is None
    store.swap(spark.range(3), "c.d")
    store.swap(store.read_version("c.d").filter("id > 0"), "c.d")
    assert store.current_version("c.d") == 2 and store.read_version("c.d").count() == 2


def test_a_crash_at_any_step_leaves_the_version_before(spark, store, monkeypatch):
    store.swap(spark.range(3), "c.d")

    def refuse(_df):
        raise ValueError("check")

    with pytest.raises(ValueError):
        store.swap(spark.range(5), "c.d", refuse)  # written, not committed
    real = Store._commit
    monkeypatch.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.swap(spark.range(7), "c.d")
    monkeypatch.setattr(Store, "_commit", real)
    assert store.current_version("c.d") == 1 and store.read_version("c.d").count() == 3
    store.swap(spark.range(9), "c.d")
    store.swap(spark.range(11), "c.d")
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit("c.d", 3, "version=3-other")
    future = dt.datetime.now() + dt.timedelta(days=1)
    assert store.collect_versions("c.d") == []  # within the term
    assert store.collect_versions("c.d", 2, future) == [1]
    assert store.read_version("c.d").count() == 11 and store.read_version("c.d", 2).count() == 9
    assert sum(n.startswith("version=") for n in store._children(store.path("c.d"))) == 2  # abandoned folders went too


def test_staged_batches_are_retired(spark, store):
    for b in (1, 2, 3):
        store.write_batch(spark.range(b), "stg.t", b)
    assert store.drop_batches("stg.t", 3) == [1, 2]
    assert store.read_batch("stg.t", 3).count() == 3


def test_retention_and_archive(spark, store):
    store.append(rows(spark, ("2024-01-05", "a", 1), ("2025-05-01", "b", 2), ("2026-01-01", "c", 3)), "f.t", "d")
    assert store.archive_before("f.t", "old.t", "d", dt.date(2025, 6, 1)) == 2
    assert values(store.read("f.t"), "k") == [("c",)] and values(store.read("old.t"), "k") == [("a",), ("b",)]
    assert store.drop_before("f.t", dt.date(2027, 1, 1)) == [dt.date(2026, 1, 1)]


def counts(store):
    return {t: store.read(f"core.{t}").count() for t in ("fact_stock_snapshot", "fact_inventory_movement", "fact_purchase_order_line", "fact_goods_receipt_line")}


def test_daily_rerun_changes_nothing(spark, data):
    store = Store(spark, work_folder(spark, "daily"), "month")
    runner = Runner(spark, data, store, "quarantine", clock=CLOCK)
    runner.run_daily(AS_OF, "full")
    before, mart = counts(store), values(store.read("mart.sum_movement_daily"))
    assert before["fact_inventory_movement"] > 0 and mart
    runner.run_daily(AS_OF)  # incremental, overlapping by its look-back
    assert counts(store) == before
    assert values(store.read("mart.sum_movement_daily")) == mart
    states = values(runner.ledger.batches(), "etl_batch_id", "batch_type", "batch_status")
    assert states == [(1, "full", "success"), (2, "incremental", "success")]
    moved = store.read("core.fact_inventory_movement").agg(F.sum(F.abs("qty"))).first()[0]
    assert store.read("mart.sum_movement_daily").agg(F.sum("movement_qty")).first()[0] == moved
    fresh = store.read_version("ops.etl_data_freshness")
    assert fresh.count() == 5 and fresh.filter("last_success_batch_id = 2").count() == 5


def stored_marts(store):
    from stockloom.plans import refresh
    return {n: values(store.read(f"mart.{n}")) for n in refresh.MARTS}


def test_a_repaired_month_reaches_every_stored_row(spark, data):
    """Old receipts, orders and movements changed in the store: after their repair the marts equal a full rebuild."""
    store = Store(spark, work_folder(spark, "reach"), "month")
    runner = Runner(spark, data, store, "quarantine", clock=CLOCK)
    runner.run_daily(AS_OF, "full")
    right = stored_marts(store)
    may = (dt.date(1998, 5, 1), dt.date(1998, 5, 31))
    receipts, orders = store.read("core.fact_goods_receipt_line"), store.read("core.fact_purchase_order_line")
    store.replace_keys(receipts.filter(F.col("gr_date").between(*may)).withColumn("received_value", (F.col("received_value") * 3).cast("decimal(18,2)")),
                       "core.fact_goods_receipt_line", ["gr_no", "dim_item_id", "dim_warehouse_id"], "gr_date")
    # orders of May, kept by the store in a much older month
    store.replace_keys(orders.filter(F.col("po_date").between(*may)).withColumn("po_date", F.add_months("po_date", -30)),
                       "core.fact_purchase_order_line", ["po_no", "dim_item_id"], "po_date")
    runner.run_job("ETL-009", "full")
    wrong = stored_marts(store)
    assert wrong["sum_budget_burn_monthly"] != right["sum_budget_burn_monthly"] and wrong["sum_procurement_monthly"] != right["sum_procurement_monthly"]
    runner.run_job("ETL-007", "repair", *may)  # its marts are refreshed by the next repair
    runner.repair("ETL-008", *may)
    assert stored_marts(store) == right
    # movements after the day of the last run change the dead stock of every day
    store.drop_before("core.fact_inventory_movement", dt.date(1992, 2, 1))
    runner.repair("ETL-006", dt.date(1992, 1, 1), dt.date(1999, 12, 31))
    after = stored_marts(store)
    runner.run_job("ETL-009", "full")
    assert stored_marts(store) == after


def test_newest_issues_are_kept_by_the_loads(spark, store):
    from stockloom.plans import refresh
    issue = lambda *r: spark.createDataFrame([(i, 1, dt.date.fromisoformat(d), k) for i, d, k in r], "dim_item_id bigint, dim_warehouse_id bigint, txn_date date, movement_direction string")
    assert refresh.merge_issues(store, issue((1, "2026-01-05", "out"), (1, "2026-03-01", "in"), (2, "2026-02-01", "out")))
    assert not refresh.merge_issues(store, issue((1, "2025-12-01", "out")))
    assert refresh.merge_issues(store, issue((1, "2026-02-02", "out"), (3, "2026-01-01", "out")))
    assert values(store.read_version(refresh.LAST_ISSUE), "dim_item_id", "last_issue_date") == [
        (1, dt.date(2026, 2, 2)), (2, dt.date(2026, 2, 1)), (3, dt.date(2026, 1, 1))]


def test_dependencies_close_over_months():
    from stockloom.plans import refresh
    d = dt.date
    burn, daily = refresh.MARTS["sum_budget_burn_monthly"], refresh.MARTS["sum_movement_daily"]
    own = refresh.changed(burn, {"fact_goods_receipt_line": {d(2026, 2, 9), d(2026, 2, 11)}, "fact_inventory_movement": {d(2020, 1, 1)}})
    assert own == {d(2026, 2, 1)}
    assert refresh.closed(burn, own, {d(2026, 1, 1), d(2026, 3, 1), d(2027, 1, 1)}) == {d(2026, 2, 1), d(2026, 3, 1), d(2027, 1, 1)}
    assert refresh.closed(daily, {d(2026, 2, 9)}, {d(2026, 3, 1)}) == {d(2026, 2, 9)}
    assert refresh.runs([d(2026, 1, 2), d(2026, 1, 1), d(2026, 1, 4)], "day") == [(d(2026, 1, 1), d(2026, 1, 2)), (d(2026, 1, 4), d(2026, 1, 4))]
    assert refresh.runs([d(2025, 12, 1), d(2026, 1, 1)], "month") == [(d(2025, 12, 1), d(2026, 1, 31))]


def test_fail_policy_stops_on_bad_rows(spark, data):
    def bad(_run):
        raise RuntimeError("no")
    jobs = dict(JOBS) | {"ETL-002": Job("ETL-002", "load_warehouse_master", "dimension", "core.dim_warehouse", bad)}
    store = Store(spark, work_folder(spark, "policy"), "month")
    runner = Runner(spark, data, store, "quarantine", jobs, CLOCK)
    with pytest.raises(JobFailed):
        runner.run_daily(AS_OF, "full")
    assert not store.exists("core.fact_stock_snapshot")
    runs = values(runner.ledger.runs(), "job_code", "run_status")
    assert runs == [("ETL-001", "success"), ("ETL-002", "failed"), ("ETL-003", "success")]
    strict = Runner(spark, data, Store(spark, work_folder(spark, "strict"), "month"), "fail", clock=CLOCK)
    with pytest.raises(JobFailed, match="blank"):
        strict.run_job("ETL-001")


# Streaming ------------------------------------------------------------------------------

def shuffled_files(spark, data, folder, n=4):
    """The events in random order over several files."""
    events = spark.read.parquet(f"{data}/events.parquet").orderBy(F.rand(7)).withColumn("f", F.monotonically_increasing_id() % n)
    for i in range(n):
        events.filter(F.col("f") == i).drop("f").coalesce(1).write.mode("append").parquet(folder)


def day_totals(spark, data):
    return spark.read.parquet(f"{data}/events.parquet").count()


def test_summary_with_covering_delay_equals_batch(spark, data, store):
    folder = f"{store.root}/in"
    shuffled_files(spark, data, folder)
    stream = T.event_stream(spark, folder, files_per_trigger=1)
    T.run_to_store(T.daily_summary(stream), store, "mart.event_daily", ["summary_date", "movement_type"], "summary_date", "update")
    assert store.read("mart.event_daily").agg(F.sum("txn_count")).first()[0] == day_totals(spark, data)


def test_summary_with_short_delay_drops_late_rows(spark, data, store):
    folder = f"{store.root}/in"
    shuffled_files(spark, data, folder)
    stream = T.event_stream(spark, folder, files_per_trigger=1)
    T.run_to_store(T.daily_summary(stream, "3 days"), store, "mart.event_daily", ["summary_date", "movement_type"], "summary_date", "update")
    assert store.read("mart.event_daily").agg(F.sum("txn_count")).first()[0] < day_totals(spark, data)


def test_ingest_restart_adds_only_new_files(spark, data, store):
    folder = f"{store.root}/in"
    events = spark.read.parquet(f"{data}/events.parquet")

    def drain():
        moves = T.with_hash(T.event_stream(spark, folder)).withColumn("txn_date", F.to_date("ts"))
        T.run_to_store(moves, store, "core.movement_event", T.EVENT_KEY, "txn_date")
        return store.read("core.movement_event").count()

    events.filter("event_id % 2 = 0").coalesce(1).write.mode("append").parquet(folder)
    half = drain()
    assert drain() == half  # nothing new
    events.coalesce(1).write.mode("append").parquet(folder)  # the other half, and the first one again
    assert drain() == events.count()


def test_late_rows_are_counted_and_kept_apart(spark, store):
    folder = f"{store.root}/in"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    last = events.agg(F.max("ts")).scalar()
    events.filter("event_id % 2 = 0").coalesce(1).write.mode("append").parquet(folder)
    events.filter("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(folder)

    def drain():
        moves = T.with_hash(T.event_stream(spark, folder, files_per_trigger=1)).withColumn("txn_date", F.to_date("ts"))
        T.counting_late(moves, store, "core.movement_event", T.EVENT_KEY, "txn_date")

    drain()
    drain()  # nothing new
    counted = store.read("ops.movement_event_late").agg(F.sum("kept"), F.sum("late")).first()
    assert tuple(counted) == (store.read("core.movement_event").count(), store.read("late.movement_event").count())
    assert sum(counted) == events.count() and counted[1] > 0
    newest = events.filter("event_id % 2 = 0").agg(F.max("ts").alias("t")).first().t
    assert store.read("late.movement_event").filter(F.col("ts") >= F.lit(newest) - F.expr("INTERVAL 3 DAYS")).isEmpty() and last is not None


def test_chunks_of_about_equal_rows():
    from stockloom.plans.chunks import planned
    d = lambda n: dt.date(2026, 1, n)
    chunks = planned([(d(3), 5), (d(1), 4), (None, 3), (d(2), 6), (d(4), 25), (d(5), 1)], 10)
    assert [(c.low, c.high, c.slice, c.slices) for c in chunks] == [
        (d(1), d(2), 0, 1), (d(3), d(3), 0, 1), (d(4), d(4), 0, 3), (d(4), d(4), 1, 3), (d(4), d(4), 2, 3), (d(5), d(5), 0, 1), (None, None, 0, 1)]
    assert [c.number for c in chunks] == list(range(7)) and planned([]) == []


def test_a_killed_extract_goes_on_where_it_was(spark, store):
    from stockloom.plans.chunks import ChunkedExtract
    from stockloom.plans.ledger import Ledger
    df = spark.range(500).selectExpr("id", "if(id % 50 = 0, null, date_add(date'2026-01-01', cast(if(id < 200, 0, id % 9) as int))) as day")

    def kill(c):
        if c.number == 3:
            raise RuntimeError("killed")

    first = ChunkedExtract(store, Ledger(store), "t", 1, 60)
    with pytest.raises(RuntimeError, match="killed"):
        first.run(df, "day", kill)
    with pytest.raises(RuntimeError, match="not extracted"):
        first.read()
    again = ChunkedExtract(store, Ledger(store), "t", 1, 60)
    total = len(again.plan(df, "day")[0])
    assert again.run(df, "day") == total - 3 and again.run(df, "day") == 0
    assert sorted(map(tuple, again.read().select("id", "day").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_rows_that_share_a_key_are_all_loaded(spark, store):
    batch = rows(spark, ("2026-01-05", "a", 1), ("2026-01-05", "a", 2))
    assert store.insert_absent(batch, "f.t", ["k"], "d") == 2
    more = rows(spark, ("2026-01-05", "a", 3), ("2026-01-06", "b", 4), ("2026-01-06", "b", 5))
    assert store.insert_absent(more, "f.t", ["k"], "d") == 2
    assert store.read("f.t").count() == 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("grain", ["day", "month"])
def test_a_key_whose_date_moved_is_stored_once(spark, grain):
    s = Store(spark, work_folder(spark, "moved"), grain)
    assert s.insert_absent(rows(spark, ("2026-01-05", "a", 1), ("2026-01-06", "b", 2)), "f.t", ["k"], "d") == 2
    assert s.insert_absent(rows(spark, ("2026-03-09", "a", 9), ("2025-02-01", "c", 3)), "f.t", ["k"], "d") == 1
    assert values(s.read("f.t"), "k", "v") == [("a", 1), ("b", 2), ("c", 3)]
    heard = []
    assert s.replace_keys(rows(spark, ("2026-04-01", "a", 4)), "f.t", ["k"], "d", heard.append) == 1
    assert values(s.read("f.t"), "k", "v") == [("a", 4), ("b", 2), ("c", 3)]
    assert heard and {s.part_of(dt.date(2026, 4, 1)), s.part_of(dt.date(2026, 1, 5))} <= heard[0]


def test_rows_without_a_date_keep_their_key(spark, store):
    undated = spark.createDataFrame([(None, "n", 1)], "d date, k string, v int")
    assert store.insert_absent(undated, "f.t", ["k"], "d") == 1
    assert store.insert_absent(rows(spark, ("2026-01-05", "n", 2), ("2026-01-05", "m", 2)), "f.t", ["k"], "d") == 1
    assert store.parts("f.t") == {dt.date(2026, 1, 5)}
    assert store.replace_keys(rows(spark, ("2026-01-07", "n", 3)), "f.t", ["k"], "d") == 1
    assert values(store.read("f.t"), "k", "v") == [("m", 2), ("n", 3)]


def test_a_load_reads_only_buckets_and_partitions_of_its_keys(spark, store):
    from stockloom.plans.keyindex import BUCKET, KeyIndex
    many = spark.range(2000).selectExpr("date_add(date'2026-01-01', cast(id % 50 as int)) as d", "concat('k', id) as k", "cast(id as int) as v")
    store.insert_absent(many, "f.t", ["k"], "d")
    index = KeyIndex(store, "f.t", ["k"], "part")
    one = rows(spark, ("2026-09-09", "k7", 0))
    assert index.parts(one) == {dt.date(2026, 1, 8)}
    plan = plan_of(index.entries(one))
    assert f"PartitionFilters: [{BUCKET}" in plan.replace("isnotnull(", "") or f"({BUCKET}#" in plan and "PartitionFilters: []" not in plan
    plan = plan_of(store.read_parts("f.t", index.parts(one)))
    assert "PartitionFilters: []" not in plan and "2026-01-08" in plan


def test_index_of_an_older_table_and_its_rebuild(spark, store):
    from stockloom.plans.keyindex import KeyIndex
    store.append(rows(spark, ("2026-01-05", "a", 1), ("2026-02-05", "b", 2)), "f.t", "d")  # written without an index
    assert store.insert_absent(rows(spark, ("2026-05-05", "b", 2)), "f.t", ["k"], "d") == 0
    store.replace_keys(rows(spark, ("2026-06-01", "a", 5)), "f.t", ["k"], "d")
    index = KeyIndex(store, "f.t", ["k"], "part")
    first = index.buckets()
    assert len(index.parts(rows(spark, ("2026-01-01", "a", 0)))) == 2  # where it was and is
    assert store.reindex("f.t", ["k"]) > first
    assert index.parts(rows(spark, ("2026-01-01", "a", 0))) == {dt.date(2026, 6, 1)}


def test_a_load_broken_after_its_index_loads_again(spark, store, monkeypatch):
    store.insert_absent(rows(spark, ("2026-01-05", "a", 1)), "f.t", ["k"], "d")
    batch = rows(spark, ("2026-01-05", "a", 2), ("2026-01-06", "b", 2))
    real = Store.append
    monkeypatch.setattr(Store, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.insert_absent(batch, "f.t", ["k"], "d")
    monkeypatch.setattr(Store, "append", real)
    assert store.insert_absent(batch, "f.t", ["k"], "d") == 1
    assert values(store.read("f.t"), "k", "v") == [("a", 1), ("b", 2)]


def test_counts_are_rows_loaded_not_rewritten(spark, store):
    import datetime as dt
    first = rows(spark, *[("2026-01-05", f"k{i}", i) for i in range(20)])
    assert store.replace_range(first, "f.t", "d", dt.date(2026, 1, 5), dt.date(2026, 1, 5)) == 20
    assert store.replace_keys(rows(spark, ("2026-01-05", "k3", 99)), "f.t", ["k"], "d") == 1
    assert store.read("f.t").count() == 20


def test_rows_a_reload_takes_away_are_counted(spark):
    for grain in ("day", "month"):
        s = Store(spark, work_folder(spark, "deleted"), grain)
        s.append(rows(spark, ("2026-01-05", "a", 1), ("2026-01-05", "b", 2), ("2026-01-09", "c", 3)), "f.t", "d")
        counts = {}
        s.replace_keys(rows(spark, ("2026-01-07", "a", 5), ("2026-02-01", "n", 6)), "f.t", ["k"], "d", counts=counts)
        assert counts == {"deleted": 1}
        s.replace_range(rows(spark, ("2026-01-06", "x", 1)), "f.t", "d", dt.date(2026, 1, 5), dt.date(2026, 1, 7), counts)
        assert counts == {"deleted": 2} and values(s.read("f.t"), "k") == [("c",), ("n",), ("x",)]
        s.replace_days(rows(spark, ("2026-01-09", "y", 1), ("2026-01-09", "z", 1)), "f.t", "d", counts)
        assert counts == {"deleted": 1} and values(s.read("f.t"), "k") == [("n",), ("x",), ("y",), ("z",)]


def test_ledger_counts_of_a_second_run(spark, store, data):
    runner = Runner(spark, data, store, "quarantine", clock=CLOCK)
    for _ in range(2):
        for code in ("ETL-001", "ETL-002", "ETL-003", "ETL-007"):
            runner.run_job(code)
    numbers = runner.ledger.runs().orderBy("etl_batch_id").collect()
    first, second = numbers[:4], numbers[4:]
    assert [(r.row_updated, r.row_deleted) for r in first] == [(0, 0)] * 4
    assert [r.row_updated for r in second] == [r.row_inserted - 1 for r in second[:3]] + [0]  # all but the unknown member
    assert second[3].row_deleted == second[3].row_inserted > 0
    assert [r.source_table for r in first] == ["drug_gn, company", "dept_id", "company", "ms_po, ms_po_c"]


def test_freshness_reads_the_newest_partition(spark):
    from stockloom import schemas as S
    from stockloom.plans import freshness
    s = Store(spark, work_folder(spark, "newest"), "month")
    for fact, date in S.FACT_DATE.items():
        days = rows(spark, ("2026-01-05", "a", 1), ("2026-03-02", "b", 2), ("2026-03-09", "c", 3), ("2026-01-06", "undated", 4))
        days = days.withColumn("d", F.when(F.col("k") != "undated", F.col("d")))
        s.append(days.withColumnRenamed("d", date), f"core.{fact}", date)
    dates = freshness.newest_dates(freshness.NewestParts(s))
    scans = [line for line in plan_of(dates).splitlines() if "PartitionFilters" in line]  # before it runs: each scan once
    assert {r.last_updated for r in dates.collect()} == {dt.date(2026, 3, 9)}
    assert len(scans) == len(S.FACT_DATE) and all("2026-03-01" in line for line in scans)


def test_runs_of_an_older_ledger_are_read(spark, store):
    old = "etl_batch_id bigint, job_code string, target_table string, run_status string, row_inserted bigint"
    store.append(spark.createDataFrame([(1, "ETL-001", "core.dim_item", "success", 5)], old), TABLE_RUN)
    ledger = Ledger(store)
    ledger.table_run(2, "ETL-001", "drug_gn", "core.dim_item", "full", "success", {"inserted": 6, "updated": 5}, CLOCK)
    assert values(ledger.runs(), "etl_batch_id", "source_table", "row_inserted", "row_updated") == [(1, None, 5, None), (2, "drug_gn", 6, 5)]


def test_old_ledger_rows_are_retired(spark, store, monkeypatch):
    from stockloom.plans import chunks, ledger as ledger_module, refresh
    times = iter(dt.datetime(2020 + i, 1, 1) for i in range(99))

    def batch(name, status, job="ETL-006", high=None):
        when = next(times)
        monkeypatch.setattr(ledger_module, "_now", lambda: when)
        b = book.open_batch(name, "full", None, high)
        refresh.Backlog(store, book).note(b, "fact_inventory_movement", {when.date()})
        if status != "running":
            book.table_run(b, job, "card", "t", "full", status, {}, when)
            book.close_batch(b, name, "full", status, None, high)
        return b

    book = Ledger(store)
    assert book.retire(dt.datetime(2030, 1, 1)) == {}
    watermark = batch("daily", "success", high=dt.date(2020, 1, 1))
    batch("daily", "failed", high=dt.date(2021, 1, 1))
    resumes = batch("job", "running")
    chunks.ChunkedExtract(store, book, "t", resumes)._record([(resumes, "t", 0, None, None, 0, 1, 1, "planned", None, dt.datetime(2022, 1, 1))])
    batch("job", "running")
    refreshed = batch("marts", "success", "ETL-009")
    batch("job", "failed")
    newest = batch("job", "failed")
    gone = book.retire(dt.datetime(2030, 1, 1))
    kept = [r[0] for r in store.read(BATCH).select("etl_batch_id").distinct().orderBy("etl_batch_id").collect()]
    assert kept == [watermark, resumes, refreshed, newest]
    assert gone[BATCH] == 5 and gone[TABLE_RUN] == 2 and gone[chunks.CHUNK] == 0
    assert book.last_watermark("daily") == dt.date(2020, 1, 1) and book.last_refresh("ETL-009") == refreshed
    pending = {dt.date(2025, 1, 1), dt.date(2026, 1, 1)}  # seen by no refresh, so kept whatever their age
    assert refresh.Backlog(store, book).pending(refreshed) == {"fact_inventory_movement": pending} and gone[refresh.BACKLOG] == 5
    assert book.open_batch("job", "full") == newest + 1
    assert sum(book.retire(dt.datetime(2019, 1, 1)).values()) == 0


def test_fiscal_running_totals_survive_an_incremental_run(spark, store, data, as_of):
    import datetime as dt
    from stockloom.operators import marts
    from stockloom.plans import jobs, refresh
    from stockloom.plans.warehouse import Warehouse
    fact = Warehouse(spark, data).fact_goods_receipt_line
    store.append(fact, "core.fact_goods_receipt_line", "gr_date")
    run = lambda mode: jobs.Run(spark, None, store, 1, mode, None, None)
    name = "sum_budget_burn_monthly"
    jobs.refresh_monthly_mart(run("full"), name, jobs.changed_parts(run("full"), refresh.MARTS[name], {}, 0))
    jobs.refresh_monthly_mart(run("incremental"), name, {dt.date(1997, 7, 1), dt.date(1997, 8, 1)})
    key = ["year_month", "actual_spend_amount", "ytd_actual_spend", "ytd_fiscal"]
    read = lambda df: sorted(map(tuple, df.select(*key).collect()))
    assert read(store.read(f"mart.{name}")) == read(marts.budget_burn_monthly(fact))


def test_duplicate_codes_are_refused(spark):
    from stockloom.operators import dims
    twice = spark.createDataFrame([(1, "7"), (1, "7"), (2, "8")], "dim_vendor_id bigint, source_vendor_code string")
    assert [r["dim_vendor_id"] for r in dims.colliding_ids(twice, "dim_vendor").collect()] == [1]


def test_duplicate_keys_are_set_aside(spark):
    from stockloom import schemas as S
    from stockloom.operators import quality
    key = S.STAGING["stock_balance"].unique
    df = spark.createDataFrame([tuple(["x"] * len(key)), tuple(["x"] * len(key)), tuple(["y"] * len(key))], ", ".join(f"{c} string" for c in key))
    kept, bad = quality.split_duplicates(df, "stock_balance")
    assert kept.count() == 1 and bad.count() == 2


def test_submit_entry(spark, store, data):
    from stockloom.__main__ import main
    assert main(["job", data, store.root, "ETL-002"], spark) == [1]
    assert store.read_version("core.dim_warehouse").count() > 1


def test_reads_over_jdbc_are_split():
    import pytest
    from stockloom.sources.extract import jdbc_options
    assert jdbc_options("jdbc:x", "card", "ID", 1, 10)["numPartitions"] == "64"
    assert "numPartitions" not in jdbc_options("jdbc:x", "dept", rows=10)
    for bad in ({}, {"rows": 10**7}, {"column": "ID"}):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x", "card", **bad)


def test_a_batch_keeps_no_shuffle_files_of_ended_queries(spark, data, store):
    """Inside a batch Spark drops a query's shuffle files when it ends; the setting is as before afterwards."""
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(name, None)
    job = Job("X-1", "look", "dimension", "core.none", lambda r: seen.append(r.spark.conf.get(name)) or {})
    Runner(spark, data, store, jobs={"X-1": job}).run_job("X-1")
    assert seen == ["true"] and spark.conf.get(name, None) == before


def test_repeated_keys_are_stored_once_and_set_aside(spark, data, store):
    """Without a repeated key no row is compared; with one, all its rows are set aside."""
    day = dt.date(2026, 1, 1)
    schema = "snapshot_date date, source_item_code string, source_warehouse_code string, qty_on_hand int"
    for batch, rows in enumerate(([(day, "a", "w", 1), (day, "b", "w", 1)], [(day, "a", "w", 1), (day, "a", "w", 2), (day, "b", "w", 1), (day, None, "w", 1)]), 1):
        r = jobs.Run(spark, None, store, batch, "full", None, None, "quarantine")
        kept, counts = jobs._stage(r, spark.createDataFrame(rows, schema), "stock_balance")
        assert sorted(x.source_item_code for x in kept.collect()) == [["a", "b"], ["b"]][batch - 1]
        assert counts == {"extracted": len(rows), "rejected": [0, 3][batch - 1]}
        assert store.read_batch("stg.stock_balance_repeated", batch).count() == batch - 1
    files = [f for f in store._children(f"{store.path('stg.stock_balance')}/etl_batch_id=1") if f.endswith(".parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def receipts_source(spark, folder):
    """Three items, suppliers and warehouses, and an invoice of two lines a day for four months."""
    tables = {
        "part": "id as p_partkey, concat('part ', id) as p_name, 'b' as p_brand, 't' as p_type, cast(id as int) as p_size, cast(id as double) as p_retailprice",
        "supplier": "id as s_suppkey, concat('s', id) as s_name, 1D as s_acctbal",
        "nation": "cast(id as int) as n_nationkey, concat('n', id) as n_name, 0 as n_regionkey"}
    for name, columns in tables.items():
        spark.sql(f"SELECT {columns} FROM range(1, 4)").write.parquet(f"{folder}/{name}.parquet")
    spark.sql("SELECT id*45 + 4 as o_orderkey, id % 3 + 1 as o_custkey, date_add(date'2024-01-01', cast(id as int)) as o_orderdate, "
              "'F' as o_orderstatus, '1-URGENT' as o_orderpriority FROM range(0, 120)").write.parquet(f"{folder}/orders.parquet")
    spark.sql("SELECT o_orderkey as l_orderkey, cast(n as int) as l_linenumber, n as l_partkey, n as l_suppkey, 10D as l_quantity, 50D * n as l_extendedprice, 'F' as l_linestatus, "
              f"o_orderdate as l_shipdate FROM parquet.`{folder}/orders.parquet` LATERAL VIEW explode(array(1L, 2L)) AS n").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_a_backfill_reads_its_source_once_for_all_months(spark, tmp_path, monkeypatch):
    source, reads, real = receipts_source(spark, str(tmp_path)), [], extract.goods_receipt_line
    monkeypatch.setattr(extract, "goods_receipt_line", lambda *a: reads.append(1) or real(*a))
    jobs = {c: JOBS[c] for c in ("ETL-001", "ETL-002", "ETL-003", "ETL-008")}
    chunked, whole = (Runner(spark, source, Store(spark, work_folder(spark, n), "month"), "quarantine", jobs, clock=CLOCK) for n in ("chunked", "whole"))
    low, high = dt.date(2024, 1, 10), dt.date(2024, 4, 5)
    batches = chunked.backfill(low, high)
    assert len(batches) == 4 and len(reads) == 1
    for code in jobs:
        whole.run_job(code, "backfill", low, high)
    fact = "core.fact_goods_receipt_line"
    assert values(chunked.store.read(fact)) == values(whole.store.read(fact)) and chunked.store.read(fact).count() > 100
    assert sum(chunked.store.read_batch("stg.goods_receipt_line", b).count() for b in batches) == chunked.store.read(fact).count()
    assert chunked.store._children(chunked.store.path("land")) == []  # what was landed went


def test_a_broken_backfill_leaves_nothing_landed(spark, tmp_path, monkeypatch):
    jobs = {c: JOBS[c] for c in ("ETL-001", "ETL-002", "ETL-003", "ETL-008")}
    runner = Runner(spark, receipts_source(spark, str(tmp_path)), Store(spark, work_folder(spark, "broken"), "month"), "quarantine", jobs, clock=CLOCK)
    monkeypatch.setattr(Store, "replace_keys", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(JobFailed):
        runner.backfill(dt.date(2024, 1, 10), dt.date(2024, 3, 5))
    assert runner.store._children(runner.store.path("land")) == []


def test_a_load_meets_the_index_once(spark, store, monkeypatch):
    from stockloom.plans.keyindex import KeyIndex
    met, real = [], KeyIndex._touched
    monkeypatch.setattr(KeyIndex, "_touched", lambda self, wanted: met.append(1) or real(self, wanted))
    store.replace_keys(rows(spark, ("2026-01-05", "a", 1), ("2026-01-05", "a", 2), ("2026-02-05", "b", 2)), "f.t", ["k"], "d")
    assert not met  # the first load makes the index from the fact
    index = KeyIndex(store, "f.t", ["k"], "part")
    held = lambda: values(spark.read.parquet(index._path(index.buckets())), "k", "part")
    assert held() == [("a", dt.date(2026, 1, 5)), ("b", dt.date(2026, 2, 5))]
    store.replace_keys(rows(spark, ("2026-02-05", "b", 3), ("2026-03-05", "a", 3), ("2026-03-05", "c", 3)), "f.t", ["k"], "d")
    assert len(met) == 1
    assert held() == [("a", dt.date(2026, 1, 5)), ("a", dt.date(2026, 3, 5)), ("b", dt.date(2026, 2, 5)), ("c", dt.date(2026, 3, 5))]  # known pairs aren't repeated
    assert store.insert_absent(rows(spark, ("2026-04-05", "a", 9), ("2026-04-05", "e", 9)), "f.t", ["k"], "d") == 1
    assert len(met) == 2 and values(store.read("f.t"), "k", "v") == [("a", 3), ("b", 3), ("c", 3), ("e", 9)]


def test_a_first_load_broken_before_its_index_loads_again(spark, store, monkeypatch):
    from stockloom.plans.keyindex import KeyIndex
    real = KeyIndex.rebuild
    monkeypatch.setattr(KeyIndex, "rebuild", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    batch = rows(spark, ("2026-01-05", "a", 1), ("2026-01-06", "b", 2))
    with pytest.raises(RuntimeError):
        store.insert_absent(batch, "f.t", ["k"], "d")
    monkeypatch.setattr(KeyIndex, "rebuild", real)
    assert store.insert_absent(batch, "f.t", ["k"], "d") == 0
    assert values(store.read("f.t"), "k", "v") == [("a", 1), ("b", 2)]
