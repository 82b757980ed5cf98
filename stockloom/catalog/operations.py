"""Registered queries: data quality, sinks, jobs, streaming."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.catalog.loads import BURN_SQL
from stockloom.catalog.registry import query
from stockloom.catalog.views import doubles
from stockloom.operators import marts, quality as Q
from stockloom.plans import freshness
from stockloom.plans.jobs import JOBS, DAILY_MARTS, Job, JobFailed, Runner
from stockloom.plans.ledger import Ledger
from stockloom.plans.store import Store, work_folder
from stockloom.sources import extract
from stockloom.streaming import movements as T

AS_OF = dt.date(1999, 6, 30)
CLOCK = dt.datetime(2001, 12, 1)
CNT = "CAST(count(*) AS BIGINT)"


def staged(w):
    """The eight extracts by staging table."""
    return {
        "item_master": w.item_master, "warehouse_master": w.warehouse_master, "vendor_master": w.vendor_master,
        "stock_balance": extract.stock_balance(w.src.card), "stock_lot_balance": extract.stock_lot_balance(w.src.card),
        "inventory_movement": extract.inventory_movement(w.src.card),
        "purchase_order_line": extract.purchase_order_line(w.src.ms_po, w.src.ms_po_c),
        "goods_receipt_line": extract.goods_receipt_line(w.src.ms_ivo, w.src.ms_ivo_c)}


STAGE_VIEW = {"item_master": "item_src", "warehouse_master": "warehouse_src", "vendor_master": "vendor_src", "stock_balance": "balance_src",
              "stock_lot_balance": "lot_balance_src", "inventory_movement": "movement_src", "purchase_order_line": "po_src",
              "goods_receipt_line": "gr_src"}


def _union(frames):
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


#: The rules once more, written out for checking: table, rule, severity, a condition that holds for failing rows.
CHECKS = [line.strip().split(" | ") for line in """
item_master | source_item_code missing | ERROR | source_item_code IS NULL
item_master | item_name missing | ERROR | item_name IS NULL
item_master | item_name blank | ERROR | length(trim(item_name))=0
warehouse_master | source_warehouse_code missing | ERROR | source_warehouse_code IS NULL
warehouse_master | warehouse_name missing | ERROR | warehouse_name IS NULL
vendor_master | source_vendor_code missing | WARN | source_vendor_code IS NULL
vendor_master | vendor_name missing | ERROR | vendor_name IS NULL
stock_balance | snapshot_date missing | ERROR | snapshot_date IS NULL
stock_balance | source_item_code missing | ERROR | source_item_code IS NULL
stock_balance | source_warehouse_code missing | ERROR | source_warehouse_code IS NULL
stock_balance | qty_on_hand missing | ERROR | qty_on_hand IS NULL
stock_balance | negative quantity | WARN | sign(qty_on_hand)=-1
stock_lot_balance | snapshot_date missing | ERROR | snapshot_date IS NULL
stock_lot_balance | source_item_code missing | ERROR | source_item_code IS NULL
stock_lot_balance | source_warehouse_code missing | ERROR | source_warehouse_code IS NULL
stock_lot_balance | qty_on_hand missing | ERROR | qty_on_hand IS NULL
stock_lot_balance | negative quantity | WARN | sign(qty_on_hand)=-1
stock_lot_balance | unrealistic expiry | WARN | year(expiry_date)<2000
inventory_movement | source_txn_id missing | ERROR | source_txn_id IS NULL
inventory_movement | txn_date missing | ERROR | txn_date IS NULL
inventory_movement | source_item_code missing | ERROR | source_item_code IS NULL
inventory_movement | source_warehouse_code missing | ERROR | source_warehouse_code IS NULL
inventory_movement | movement_type missing | ERROR | movement_type IS NULL
inventory_movement | qty missing | ERROR | qty IS NULL
inventory_movement | zero quantity | WARN | qty=0
inventory_movement | unknown movement type | WARN | NOT regexp_full_match(lower(movement_type),'receive|issue|other|(transfer|return|adjust)_(in|out)')
inventory_movement | quantity without cost | WARN | qty>0 AND unit_cost IS NULL
inventory_movement | value off quantity times cost | WARN | line_value NOT BETWEEN qty*unit_cost-0.01 AND qty*unit_cost+0.01
purchase_order_line | po_no missing | ERROR | po_no IS NULL
purchase_order_line | po_date missing | ERROR | po_date IS NULL
purchase_order_line | source_item_code missing | ERROR | source_item_code IS NULL
purchase_order_line | ordered_qty missing | ERROR | ordered_qty IS NULL
purchase_order_line | vendor missing | INFO | source_vendor_code IS NULL
goods_receipt_line | gr_no missing | ERROR | gr_no IS NULL
goods_receipt_line | gr_date missing | ERROR | gr_date IS NULL
goods_receipt_line | source_item_code missing | ERROR | source_item_code IS NULL
goods_receipt_line | source_warehouse_code missing | ERROR | source_warehouse_code IS NULL
goods_receipt_line | received_qty missing | ERROR | received_qty IS NULL
goods_receipt_line | vendor missing | INFO | source_vendor_code IS NULL
""".strip().splitlines()]
#: Business keys for checking, by view.
KEYS = {"item_master": "source_item_code", "warehouse_master": "source_warehouse_code", "vendor_master": "source_vendor_code",
        "stock_balance": "snapshot_date, source_item_code, source_warehouse_code",
        "stock_lot_balance": "snapshot_date, source_item_code, source_warehouse_code, lot_no, expiry_date",
        "inventory_movement": "source_txn_id", "purchase_order_line": "po_no, source_item_code",
        "goods_receipt_line": "gr_no, source_item_code, source_warehouse_code, lot_no"}


# Quality ------------------------------------------------------------------------

@query("dq_01_required_columns", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS missing, {CNT} AS row_count FROM {v}" for t, v in STAGE_VIEW.items()))
def _(w):
    return _union(df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(t).alias("table_name"), F.lit(len(Q.missing_columns(df, t))).alias("missing"), "row_count") for t, df in staged(w).items())


def _dq(name, *wanted):
    """Register the report of all rules, or of the rules whose names end in one of ``wanted``."""
    sql = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{severity}' AS severity, {CNT} AS checked, "
        f"CAST(count_if({failed}) AS BIGINT) AS failed FROM {STAGE_VIEW[t]}" for t, rule, severity, failed in CHECKS if rule.endswith(wanted or ("",)))

    @query(name, sql)
    def _(w):
        picked = {t: [r for r in rules if r.name.endswith(wanted or ("",))] for t, rules in Q.RULES.items()}
        frames = staged(w)
        return _union(Q.report(frames[t], t, rules) for t, rules in picked.items() if rules)


_dq("dq_02_required_not_null", "missing")
_dq("dq_03_blank_names", "item_name blank")
_dq("dq_05_quantity_warnings", "negative quantity", "zero quantity")
_dq("dq_11_severity_report")


@query("dq_04b_duplicate_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, {CNT} AS repeated_keys, CAST(coalesce(sum(n),0) AS BIGINT) AS repeated_rows FROM "
    f"(SELECT count(*) AS n FROM {STAGE_VIEW[t]} GROUP BY {key}) WHERE n>1" for t, key in KEYS.items()))
def _(w):
    """Keys held several times in each extract, and their rows."""
    return _union(Q.duplicate_rows(df, S.STAGING[t].unique).agg(F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("repeated_rows"))
                  .select(F.lit(t).alias("table_name"), "repeated_keys", "repeated_rows") for t, df in staged(w).items())


@query("dq_04_duplicate_keys", f"""
SELECT gr_no, source_item_code, source_warehouse_code, lot_no, {CNT} AS row_count FROM gr_src GROUP BY 1,2,3,4 HAVING count(*)>1""")
def _(w):
    return Q.duplicate_rows(staged(w)["goods_receipt_line"], S.STAGING["goods_receipt_line"].unique)


@query("dq_06_movement_types", f"""
SELECT R_S_STATUS, CASE R_S_STATUS WHEN 'R' THEN 'receive' WHEN 'S' THEN 'issue' ELSE 'other' END AS movement_type,
 CAST(count_if(R_S_STATUS NOT IN ('R','S')) AS BIGINT) AS unknown_rows, {CNT} AS row_count FROM card GROUP BY 1,2""")
def _(w):
    raw = F.when(F.col("R_S_STATUS") == "R", "RECEIVE").when(F.col("R_S_STATUS") == "S", "Issue").otherwise(F.concat(F.lit("code "), "R_S_STATUS"))
    known = Q.known_movement_type(raw)
    return w.src.card.groupBy("R_S_STATUS", known.alias("movement_type")).agg(
        F.count_if(known == "other").alias("unknown_rows"), F.count(F.lit(1)).alias("row_count"))


@query("dq_07_date_quarantine", f"""
SELECT CASE WHEN CONFIRM_DATE IS NULL OR length(CONFIRM_DATE)<>8 THEN 'bad format' WHEN CONFIRM_DATE='00000000' THEN 'not a date'
 WHEN try_strptime(CONFIRM_DATE,'%Y%m%d') NOT BETWEEN DATE '1990-01-01' AND DATE '2099-12-31' THEN 'unrealistic' ELSE 'ok' END AS date_state, {CNT} AS row_count
FROM accr_disp GROUP BY 1""")
def _(w):
    return Q.date_quarantine(w.src.accr_disp, "CONFIRM_DATE").groupBy("date_state").agg(F.count(F.lit(1)).alias("row_count"))


def _orphan(kind, code, known):
    return f"SELECT '{kind}' AS reference, CAST(count(DISTINCT {code}) AS BIGINT) AS codes, {CNT} AS row_count FROM card WHERE {code} NOT IN (SELECT {known})"


@query("dq_08_orphans", "\nUNION ALL ".join((
    _orphan("item", "WORKING_CODE", "WORKING_CODE FROM drug_gn"), _orphan("department", "DEPT_ID", "DEPT_ID FROM dept_id"),
    _orphan("trade product", "TRADE_CODE", "TRADE_CODE FROM drug_vn"), _orphan("vendor", "VENDOR_CODE", "COMPANY_CODE FROM company"))))
def _(w):
    return Q.orphan_counts(w.src.card, w.src.drug_gn, w.src.dept_id, w.src.drug_vn, w.src.company)


@query("dq_09_quantity_without_cost", """
SELECT WORKING_CODE, TRADE_CODE, DEPT_ID, LOT_NO, CAST(QTY_ON_HAND AS DOUBLE) AS QTY_ON_HAND FROM inv_md_c
WHERE QTY_ON_HAND>0 AND LOT_COST IS NULL AND PACK_COST IS NULL AND LOT_VALUE IS NULL""")
def _(w):
    return Q.quantity_without_cost(w.src.inv_md_c).select("WORKING_CODE", "TRADE_CODE", "DEPT_ID", "LOT_NO", "QTY_ON_HAND")


@query("dq_10_value_mismatch", """
SELECT WORKING_CODE, TRADE_CODE, DEPT_ID, LOT_NO, CAST(e AS DOUBLE) AS expected_value, CAST(abs(LOT_VALUE-e) AS DOUBLE) AS gap FROM (
 SELECT *, CAST(QTY_ON_HAND*LOT_COST AS DECIMAL(24,2)) AS e FROM inv_md_c) WHERE abs(LOT_VALUE-e)>0.01""")
def _(w):
    return Q.value_mismatch(w.src.inv_md_c).select("WORKING_CODE", "TRADE_CODE", "DEPT_ID", "LOT_NO", "expected_value", "gap")


@query("dq_12_unresolved_codes", f"""
SELECT MED_CODE, {CNT} AS row_count, CAST(sum(DISP_QTY) AS DOUBLE) AS disp_qty, CAST(min(strptime(DISP_DATE,'%Y%m%d')) AS DATE) AS first_date,
 CAST(max(strptime(DISP_DATE,'%Y%m%d')) AS DATE) AS last_date FROM dispensed WHERE MED_CODE NOT IN (SELECT WORKING_CODE FROM drug_gn) GROUP BY 1""")
def _(w):
    return Q.unresolved_codes(w.src.dispensed, w.src.drug_gn)


@query("dq_13a_row_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT {CNT} FROM {a}) AS source_rows, (SELECT {CNT} FROM {b}) AS target_rows" for t, a, b in (
        ("fact_stock_snapshot", "balance_src", "f_stock"), ("fact_stock_lot_snapshot", "lot_balance_src", "f_lot"),
        ("fact_inventory_movement", "movement_src", "f_move"), ("fact_purchase_order_line", "po_src", "f_po"), ("fact_goods_receipt_line", "gr_src", "f_gr"))))
def _(w):
    s = staged(w)
    return Q.row_count_check({
        "fact_stock_snapshot": (s["stock_balance"], w.fact_stock_snapshot), "fact_stock_lot_snapshot": (s["stock_lot_balance"], w.fact_stock_lot_snapshot),
        "fact_inventory_movement": (s["inventory_movement"], w.fact_inventory_movement),
        "fact_purchase_order_line": (s["purchase_order_line"], w.fact_purchase_order_line),
        "fact_goods_receipt_line": (s["goods_receipt_line"], w.fact_goods_receipt_line)})


@query("dq_13b_value_by_day", """
WITH a AS (SELECT OPERATE_DATE AS d, sum(VALUE) AS v FROM card_live GROUP BY 1), b AS (SELECT txn_date AS d, sum(abs(signed_value)) AS v FROM f_move GROUP BY 1)
SELECT coalesce(a.d,b.d) AS summary_date, CAST(coalesce(a.v,0) AS DOUBLE) AS source_value, CAST(coalesce(b.v,0) AS DOUBLE) AS target_value,
 CAST(coalesce(b.v,0)-coalesce(a.v,0) AS DOUBLE) AS difference FROM a FULL JOIN b ON a.d=b.d""")
def _(w):
    source = extract.live_card(w.src.card).select(F.col("OPERATE_DATE").alias("summary_date"), F.col("VALUE").alias("v"))
    target = marts.movement_daily(w.fact_inventory_movement).select("summary_date", F.col("movement_value").alias("v"))
    return Q.compare_by(source, target, "summary_date", "v")


@query("dq_13c_dispensed_by_day", """
WITH a AS (SELECT CAST(strptime(DISP_DATE,'%Y%m%d') AS DATE) AS d, sum(DISP_QTY) AS v FROM dispensed GROUP BY 1),
 b AS (SELECT txn_date AS d, sum(qty) AS v FROM f_move WHERE movement_type='issue' GROUP BY 1)
SELECT coalesce(a.d,b.d) AS summary_date, CAST(coalesce(a.v,0) AS DOUBLE) AS source_value, CAST(coalesce(b.v,0) AS DOUBLE) AS target_value,
 CAST(coalesce(b.v,0)-coalesce(a.v,0) AS DOUBLE) AS difference FROM a FULL JOIN b ON a.d=b.d""")
def _(w):
    from stockloom.functions.dates import parse_date8
    source = w.src.dispensed.select(parse_date8("DISP_DATE").alias("summary_date"), F.col("DISP_QTY").alias("v"))
    target = w.fact_inventory_movement.filter("movement_type = 'issue'").select(F.col("txn_date").alias("summary_date"), F.col("qty").alias("v"))
    return Q.compare_by(source, target, "summary_date", "v")


@query("dq_13d_budget_against_source", """
WITH a AS (SELECT category AS k, sum(amount) AS v FROM bdg_use GROUP BY 1), b AS (SELECT BUDGET_TYPE AS k, sum(TOTAL_BUY) AS v FROM bdg_amt GROUP BY 1)
SELECT coalesce(a.k,b.k) AS category, CAST(coalesce(a.v,0) AS DOUBLE) AS source_value, CAST(coalesce(b.v,0) AS DOUBLE) AS target_value,
 CAST(coalesce(b.v,0)-coalesce(a.v,0) AS DOUBLE) AS difference FROM a FULL JOIN b ON a.k=b.k""")
def _(w):
    source = w.src.bdg_use.select("category", F.col("amount").alias("v"))
    target = w.src.bdg_amt.select(F.col("BUDGET_TYPE").alias("category"), F.col("TOTAL_BUY").alias("v"))
    return Q.compare_by(source, target, "category", "v")


@query("dq_14_invoice_fan_out", """
SELECT CAST(count(*) AS BIGINT) AS invoices, CAST(coalesce(sum((h-1)*coalesce(n,0)),0) AS BIGINT) AS extra_lines FROM (
 SELECT INVOICE_NO, count(*) AS h FROM (SELECT INVOICE_NO FROM ms_ivo UNION ALL SELECT INVOICE_NO FROM ms_ivo WHERE RCV_FLAG='N') GROUP BY 1 HAVING count(*)>1) a
LEFT JOIN (SELECT INVOICE_NO, count(*) AS n FROM ms_ivo_c GROUP BY 1) b ON b.INVOICE_NO=a.INVOICE_NO""")
def _(w):
    """Headers not yet received are entered twice here, so that there is fan-out to find."""
    heads = w.src.ms_ivo.unionByName(w.src.ms_ivo.filter("RCV_FLAG = 'N'"))
    return Q.invoice_fan_out(heads, w.src.ms_ivo_c)


# Sinks --------------------------------------------------------------------------

def _store(w, name):
    return Store(w.spark, work_folder(w.spark, name), grain="month")


_MOVE_BY_TYPE = f"SELECT CAST({{b}} AS BIGINT) AS etl_batch_id, movement_type, {CNT} AS row_count, CAST(sum(qty) AS DOUBLE) AS qty FROM movement_src GROUP BY 2"


@query("snk_01_stage_append", "\nUNION ALL ".join(_MOVE_BY_TYPE.replace("{b}", str(b)) for b in (1, 2)))
def _(w):
    """Two batches staged side by side."""
    store, table = _store(w, "stage"), "stg.inventory_movement"
    for batch in (1, 2):
        store.write_batch(extract.stage(staged(w)["inventory_movement"], "inventory_movement", batch, CLOCK), table, batch)
    return store.read(table).groupBy("etl_batch_id", "movement_type").agg(F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty")).select(
        F.col("etl_batch_id").cast("bigint").alias("etl_batch_id"), "movement_type", "row_count", "qty")


@query("snk_02_stage_reload", _MOVE_BY_TYPE.replace("{b}", "1"))
def _(w):
    """The same batch staged twice is held once."""
    store, table = _store(w, "stage"), "stg.inventory_movement"
    for _ in range(2):
        store.write_batch(extract.stage(staged(w)["inventory_movement"], "inventory_movement", 1, CLOCK), table, 1)
    return store.read_batch(table, 1).groupBy("etl_batch_id", "movement_type").agg(F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty"))


@query("snk_15_freshness", """
SELECT CASE WHEN table_name LIKE '%fact_purchase%' OR table_name LIKE '%fact_goods%' THEN 'procurement' ELSE 'inventory' END AS data_domain, table_name,
 CAST(7 AS BIGINT) AS last_success_batch_id, last_updated AS last_data_date,
 CASE WHEN last_updated IS NULL THEN 'unknown' WHEN DATE '2001-12-01' - last_updated > 2 THEN 'stale' ELSE 'fresh' END AS freshness_status FROM r_fresh""")
def _(w):
    return freshness.freshness(freshness.newest_dates(w), 7, CLOCK).drop("last_checked_ts")


@query("snk_16_csv_export", f"SELECT summary_date, movement_type, {CNT} AS row_count, CAST(sum(movement_qty) AS DOUBLE) AS qty FROM (SELECT txn_date AS summary_date, movement_type, dim_item_id, dim_warehouse_id, sum(abs(qty)) AS movement_qty FROM f_move GROUP BY 1,2,3,4) GROUP BY 1,2")
def _(w):
    """A mart written as CSV with a header, read back and summed."""
    mart = marts.movement_daily(w.fact_inventory_movement)
    path = _store(w, "export").export_csv(mart, "movement_daily")
    back = w.spark.read.option("header", True).schema(mart.schema).csv(path)
    return back.groupBy("summary_date", "movement_type").agg(F.count(F.lit(1)).alias("row_count"), F.sum("movement_qty").alias("qty"))


def _loaded_movements(w, store):
    store.append(w.fact_inventory_movement, "core.fact_inventory_movement", "txn_date")
    return "core.fact_inventory_movement"


_BY_YEAR = f"SELECT year(txn_date) AS year, {CNT} AS row_count, CAST(sum(qty) AS DOUBLE) AS qty FROM f_move WHERE txn_date {{w}} DATE '1998-01-01' GROUP BY 1"


@query("snk_17_retention", _BY_YEAR.replace("{w}", ">="))
def _(w):
    store = _store(w, "retention")
    table = _loaded_movements(w, store)
    store.drop_before(table, dt.date(1998, 1, 1))
    return store.read(table).groupBy(F.year("txn_date").alias("year")).agg(F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty"))


@query("snk_18_archive", _BY_YEAR.replace("{w}", "<"))
def _(w):
    store = _store(w, "archive")
    table = _loaded_movements(w, store)
    store.archive_before(table, "archive.movement", "txn_date", dt.date(1998, 1, 1))
    return store.read("archive.movement").groupBy("year").agg(F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty"))


# Jobs -----------------------------------------------------------------------------

MASTERS = ("ETL-001", "ETL-002", "ETL-003")


def _runner(w, name, jobs=None):
    return Runner(w.spark, w.src.data_dir, _store(w, name), "quarantine", jobs, clock=CLOCK)


_NAMED_ITEM = "(SELECT source_item_code FROM item_src WHERE trim(item_name)<>'')"


def _key_id(code, known):
    from stockloom.catalog.views import _id
    return f"CASE WHEN {code} IN {known} THEN {_id(code)} ELSE 0 END"


_LOADED_MOVE = f"""SELECT s.*, {_key_id('s.source_item_code', _NAMED_ITEM)} AS item_id,
 {_key_id('s.source_warehouse_code', '(SELECT source_warehouse_code FROM warehouse_src)')} AS wh_id FROM movement_src s"""


@query("job_01_daily", f"""
WITH m AS ({_LOADED_MOVE})
SELECT txn_date AS summary_date, item_id AS dim_item_id, wh_id AS dim_warehouse_id, movement_type, CAST(sum(abs(qty)) AS DOUBLE) AS movement_qty,
 CAST(sum(abs(line_value)) AS DOUBLE) AS movement_value, {CNT} AS txn_count FROM m GROUP BY 1,2,3,4""")
def _(w):
    """All ten jobs over the whole history; the movement mart afterwards."""
    runner = _runner(w, "daily")
    runner.run_daily(AS_OF, "full")
    return runner.store.read("mart.sum_movement_daily")


@query("job_02_single_job", f"SELECT source_item_code, item_name, is_active FROM d_item WHERE trim(item_name)<>''")
def _(w):
    runner = _runner(w, "single")
    runner.run_job("ETL-001")
    return runner.store.read_version("core.dim_item").select("source_item_code", "item_name", "is_active")


@query("job_03_repair", f"""
SELECT txn_date, movement_type, {CNT} AS row_count, CAST(sum(qty) AS DOUBLE) AS qty FROM movement_src
WHERE txn_date BETWEEN DATE '1999-05-01' AND DATE '1999-06-30' GROUP BY 1,2""")
def _(w):
    """A movement load that missed days, then repaired over the range."""
    runner = _runner(w, "repair", {c: j for c, j in JOBS.items() if c in (*MASTERS, "ETL-006")})
    for code in MASTERS:
        runner.run_job(code)
    runner.run_job("ETL-006", "repair", dt.date(1999, 5, 1), dt.date(1999, 5, 20))
    runner.run_job("ETL-006", "repair", dt.date(1999, 5, 11), dt.date(1999, 6, 30))
    return runner.store.read("core.fact_inventory_movement").groupBy("txn_date", "movement_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty"))


def _receipts_runner(w, name):
    """A store with all receipts, a month of which it then holds at three times their value, and its marts."""
    runner = _runner(w, name, {c: j for c, j in JOBS.items() if c in (*MASTERS, "ETL-008", "ETL-009")})
    for code in (*MASTERS, "ETL-008"):
        runner.run_job(code)
    store, table = runner.store, "core.fact_goods_receipt_line"
    wrong = store.read_range(table, "gr_date", *OLD_MONTH).withColumn("received_value", (F.col("received_value") * 3).cast("decimal(18,2)"))
    store.replace_keys(wrong, table, ["gr_no", "dim_item_id", "dim_warehouse_id"], "gr_date")
    runner.run_job("ETL-009")
    return runner


OLD_MONTH = (dt.date(1998, 5, 1), dt.date(1998, 5, 31))


@query("job_03b_repair_running_totals", BURN_SQL)
def _(w):
    """Spend and running totals of all months after an old month of receipts was repaired."""
    runner = _receipts_runner(w, "totals")
    runner.run_job("ETL-008", "repair", *OLD_MONTH)
    runner.run_job("ETL-009", "repair", *OLD_MONTH)
    return runner.store.read("mart.sum_budget_burn_monthly").drop("month_start")


@query("job_04b_backfill_running_totals", BURN_SQL)
def _(w):
    """The same after a backfill of three old months."""
    runner = _receipts_runner(w, "totals")
    runner.backfill(dt.date(1998, 4, 1), dt.date(1998, 6, 30))
    return runner.store.read("mart.sum_budget_burn_monthly").drop("month_start")


@query("job_04_backfill", f"""
SELECT CAST(strftime(txn_date,'%Y%m') AS BIGINT) AS year_month, {CNT} AS row_count, CAST(sum(qty) AS DOUBLE) AS qty FROM movement_src
WHERE txn_date BETWEEN DATE '1999-04-15' AND DATE '1999-06-30' GROUP BY 1""")
def _(w):
    """Month chunks; the first and the last may be part of a month."""
    from stockloom.functions.keys import month_key
    runner = _runner(w, "backfill", {c: j for c, j in JOBS.items() if c in (*MASTERS, "ETL-006")})
    runner.backfill(dt.date(1999, 4, 15), AS_OF)
    return runner.store.read("core.fact_inventory_movement").groupBy(month_key("txn_date").alias("year_month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty"))


def _broken(_run):
    raise RuntimeError("broken on purpose")


@query("job_05_failure_policy", f"""
SELECT pipeline_name, batch_status, CAST(jobs AS BIGINT) AS jobs, items FROM (VALUES ('daily','failed',3), ('job ETL-002','success',1), ('job ETL-009','partial',1)) AS t(pipeline_name, batch_status, jobs),
 (SELECT {CNT} AS items FROM warehouse_src)""")
def _(w):
    """A failed dimension stops a batch after the dimensions, a failed mart makes it partial; the ledger tells."""
    jobs = dict(JOBS)
    jobs["ETL-001"] = Job("ETL-001", "load_item_master", "dimension", "core.dim_item", _broken)
    jobs["ETL-009"] = Job("ETL-009", "refresh_marts", "mart", "mart.*", _broken)
    runner = _runner(w, "policy", jobs)
    try:
        runner.run_daily(AS_OF, "full")
    except JobFailed:
        pass  # the ledger says so
    runner.run_job("ETL-002")
    runner.run_job("ETL-009")
    runs = runner.ledger.runs().groupBy("etl_batch_id").agg(F.count(F.lit(1)).alias("jobs"))
    loaded = runner.store.read_version("core.dim_warehouse").filter("dim_warehouse_id <> 0").agg(F.count(F.lit(1))).scalar()
    return runner.ledger.batches().join(runs, "etl_batch_id").select("pipeline_name", "batch_status", "jobs", loaded.alias("items"))


@query("snk_13_batch_ledger", f"""
SELECT CAST(b AS BIGINT) AS etl_batch_id, 'job ' || j AS pipeline_name, 'full' AS batch_type, 'success' AS batch_status,
 (SELECT {CNT} FROM warehouse_src) AS warehouses FROM (VALUES (1,'ETL-002'),(2,'ETL-003')) AS t(b,j)""")
def _(w):
    runner = _runner(w, "ledger")
    for code in ("ETL-002", "ETL-003"):
        runner.run_job(code)
    loaded = runner.store.read_version("core.dim_warehouse").filter("dim_warehouse_id <> 0").agg(F.count(F.lit(1))).scalar()
    return runner.ledger.batches().select("etl_batch_id", "pipeline_name", "batch_type", "batch_status", loaded.alias("warehouses"))


@query("snk_14_table_runs", f"""
SELECT 'ETL-001' AS job_code, 'core.dim_item' AS target_table, 'success' AS run_status, {CNT} AS row_extracted,
 CAST(count_if(trim(item_name)<>'')+1 AS BIGINT) AS row_inserted, CAST(count_if(trim(item_name)='') AS BIGINT) AS row_rejected FROM item_src
UNION ALL SELECT 'ETL-002', 'core.dim_warehouse', 'success', {CNT}, CAST(count(*)+1 AS BIGINT), CAST(0 AS BIGINT) FROM warehouse_src
UNION ALL SELECT 'ETL-003', 'core.dim_vendor', 'success', {CNT}, CAST(count(*)+1 AS BIGINT), CAST(0 AS BIGINT) FROM vendor_src""")
def _(w):
    runner = _runner(w, "runs")
    for code in MASTERS:
        runner.run_job(code)
    return runner.ledger.runs().select("job_code", "target_table", "run_status", "row_extracted", "row_inserted", "row_rejected")


@query("snk_14b_second_runs", f"""
WITH n AS (SELECT 'ETL-002' AS job_code, 'dept_id' AS source_table, {CNT} AS row_count FROM warehouse_src UNION ALL SELECT 'ETL-003', 'company', {CNT} FROM vendor_src)
SELECT CAST(b + CASE job_code WHEN 'ETL-003' THEN 1 ELSE 0 END AS BIGINT) AS etl_batch_id, job_code, source_table, row_count + 1 AS row_inserted,
 CASE WHEN b = 1 THEN 0 ELSE row_count END AS row_updated, CAST(0 AS BIGINT) AS row_deleted FROM n, (VALUES (1),(3)) AS t(b)""")
def _(w):
    """Masters loaded twice: the second run finds every code held."""
    runner = _runner(w, "again")
    for code in ("ETL-002", "ETL-003") * 2:
        runner.run_job(code)
    return runner.ledger.runs().select("etl_batch_id", "job_code", "source_table", "row_inserted", "row_updated", "row_deleted")


# Streaming --------------------------------------------------------------------------

def _stream(w):
    return T.event_stream(w.spark, w.src.data_dir, "events.parquet")


@query("str_01_movement_ingest", "SELECT event_id, CAST(ts AS DATE) AS txn_date, source_item_code, source_warehouse_code, movement_type, CAST(qty AS DOUBLE) AS qty FROM movement_event")
def _(w):
    store = _store(w, "ingest")
    moves = T.with_hash(_stream(w)).withColumn("txn_date", F.to_date("ts"))
    T.run_to_store(moves, store, "core.movement_event", T.EVENT_KEY, "txn_date")
    return store.read("core.movement_event").select("event_id", "txn_date", "source_item_code", "source_warehouse_code", "movement_type", "qty")


_DAY = f"SELECT CAST(ts AS DATE) AS summary_date, movement_type, {CNT} AS txn_count, CAST(sum(abs(qty)) AS DOUBLE) AS movement_qty FROM movement_event GROUP BY 1,2"


@query("str_02_late_arrivals", _DAY)
def _(w):
    """The daily summary with the three-day delay: nothing in one ordered file is late."""
    store = _store(w, "late")
    T.run_to_store(T.daily_summary(_stream(w), "3 days"), store, "mart.event_daily", ["summary_date", "movement_type"], "summary_date", "update")
    return store.read("mart.event_daily")


_FILE = "CASE WHEN CAST(ts AS DATE) < lo + 10 THEN CASE WHEN event_id % 7 = 0 THEN 1 WHEN event_id % 7 = 1 THEN 2 ELSE 0 END WHEN CAST(ts AS DATE) < lo + 20 THEN 1 ELSE 2 END"


@query("str_02b_late_counted", f"""
WITH e AS (SELECT event_id, ts, movement_type, {_FILE} AS file FROM movement_event, (SELECT CAST(min(ts) AS DATE) AS lo FROM movement_event)),
 newest AS (SELECT f.file, (SELECT max(ts) FROM e WHERE e.file < f.file) AS seen FROM (SELECT DISTINCT file FROM e) f)
SELECT movement_type, CAST(count(*) FILTER (WHERE NOT coalesce(ts < seen - INTERVAL 3 DAY, false)) AS BIGINT) AS kept,
 CAST(count(*) FILTER (WHERE coalesce(ts < seen - INTERVAL 3 DAY, false)) AS BIGINT) AS late FROM e JOIN newest USING (file) GROUP BY 1""")
def _(w):
    """Events in three files, two sevenths of the first ten days in the second and third: what is kept and what comes too late."""
    store = _store(w, "late")
    events = w.spark.read.parquet(f"{w.src.data_dir}/events.parquet")
    lo = F.to_date(events.agg(F.min("ts")).scalar())
    day, seventh = F.to_date("ts"), F.col("event_id") % 7
    file = (F.when(day < F.date_add(lo, 10), F.when(seventh == 0, 1).when(seventh == 1, 2).otherwise(0)).when(day < F.date_add(lo, 20), 1).otherwise(2))
    folder = f"{store.root}/in"
    for i in range(3):  # files are taken in the order in which they were written
        events.filter(file == i).coalesce(1).write.mode("append").parquet(folder)
    moves = T.with_hash(T.event_stream(w.spark, folder, files_per_trigger=1)).withColumn("txn_date", F.to_date("ts"))
    T.counting_late(moves, store, "core.movement_event", T.EVENT_KEY, "txn_date")
    kept, late = (store.read(t).groupBy("movement_type").agg(F.count(F.lit(1)).alias(n)) for t, n in (("core.movement_event", "kept"), ("late.movement_event", "late")))
    return kept.join(late, "movement_type", "full_outer").select("movement_type", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("late", F.lit(0)).alias("late"))


@query("str_03_exactly_once", "SELECT movement_type, CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT event_id) AS BIGINT) AS events FROM movement_event GROUP BY 1")
def _(w):
    """Every event sent twice in the stream is stored once."""
    store = _store(w, "once")
    moves = _stream(w)
    twice = T.once(moves.unionByName(moves)).withColumn("txn_date", F.to_date("ts"))
    T.run_to_store(twice, store, "core.movement_event", T.EVENT_KEY, "txn_date")
    return store.read("core.movement_event").groupBy("movement_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("event_id").alias("events"))


@query("str_04_daily_summary", _DAY)
def _(w):
    """The daily summary without a delay: no row is late."""
    store = _store(w, "summary")
    T.run_to_store(T.daily_summary(_stream(w)), store, "mart.event_daily", ["summary_date", "movement_type"], "summary_date", "update")
    return store.read("mart.event_daily")


@query("str_05_alert_stream", """
SELECT event_id, CAST(ts AS DATE) AS alert_date, source_item_code, source_warehouse_code, movement_type, CAST(qty AS DOUBLE) AS qty, 'large issue' AS alert
FROM movement_event WHERE movement_type IN ('issue','transfer_out') AND qty>=20""")
def _(w):
    store = _store(w, "alerts")
    T.run_to_store(T.alert_rows(_stream(w), 20), store, "mart.event_alert", ["event_id"], "alert_date")
    return store.read("mart.event_alert")
