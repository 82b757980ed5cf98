"""Registered queries: scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stockloom.catalog.registry import query
from stockloom.functions import dates as D, measures as M
from stockloom.operators import relational as R

AS_OF = dt.date(1999, 6, 30)
CNT = "CAST(count(*) AS BIGINT) AS row_count"

# Month names and code labels, written out for checking.
SHORT = "['ม.ค.','ก.พ.','มี.ค.','เม.ย.','พ.ค.','มิ.ย.','ก.ค.','ส.ค.','ก.ย.','ต.ค.','พ.ย.','ธ.ค.']"
LONG = "['มกราคม','กุมภาพันธ์','มีนาคม','เมษายน','พฤษภาคม','มิถุนายน','กรกฎาคม','สิงหาคม','กันยายน','ตุลาคม','พฤศจิกายน','ธันวาคม']"


def count_rows():
    return F.count(F.lit(1)).alias("row_count")


@query("fn_01_case_coalesce_nullif", """
SELECT WORKING_CODE, coalesce(REORDER_QTY,MIN_LEVEL,0) AS threshold, nullif(VEN_FLAG,'N') AS ven,
 CASE WHEN REORDER_QTY IS NULL THEN 'unset' WHEN REORDER_QTY>20 THEN 'high' ELSE 'low' END AS band FROM drug_gn""")
def _(w):
    r = F.col("REORDER_QTY")
    return w.src.drug_gn.select("WORKING_CODE", F.coalesce(r, "MIN_LEVEL", F.lit(0.0)).alias("threshold"),
                                F.nullif(F.col("VEN_FLAG"), F.lit("N")).alias("ven"),
                                F.when(r.isNull(), "unset").when(r > 20, "high").otherwise("low").alias("band"))


@query("fn_02_text_functions", """
SELECT WORKING_CODE, lower(GROUP_CODE) AS low, upper(DRUG_NAME) AS up, trim(DRUG_NAME) AS trimmed,
 GROUP_CODE || '/' || GROUP_KEY AS path FROM drug_gn""")
def _(w):
    return w.src.drug_gn.select("WORKING_CODE", F.lower("GROUP_CODE").alias("low"), F.upper("DRUG_NAME").alias("up"),
                                F.trim("DRUG_NAME").alias("trimmed"), F.concat("GROUP_CODE", F.lit("/"), "GROUP_KEY").alias("path"))


@query("fn_03_numeric_functions", """
SELECT RECORD_NUMBER, CAST(abs(REMAIN_QTY) AS DOUBLE) AS a, CAST(round(COST,2) AS DOUBLE) AS r,
 CAST(floor(COST) AS BIGINT) AS f, CAST(REMAIN_QTY % 7 AS DOUBLE) AS m, CAST(-ACTIVE_QTY AS DOUBLE) AS neg FROM card""")
def _(w):
    return w.src.card.select("RECORD_NUMBER", F.abs("REMAIN_QTY").alias("a"), F.round("COST", 2).alias("r"),
                             F.floor("COST").cast("bigint").alias("f"), (F.col("REMAIN_QTY") % 7).alias("m"),
                             (-F.col("ACTIVE_QTY")).alias("neg"))


@query("fn_04_safe_divide", """
SELECT REQ_NO, CASE WHEN QTY_REQ=0 THEN 0.0::DOUBLE ELSE CAST(QTY_DIST AS DOUBLE)/CAST(QTY_REQ AS DOUBLE) END AS fill,
 round(100.0::DOUBLE*CAST(QTY_DIST AS DOUBLE)/nullif(CAST(QTY_REQ AS DOUBLE),0),2) AS pct FROM accr_disp""")
def _(w):
    d, r = F.col("QTY_DIST"), F.col("QTY_REQ")
    return w.src.accr_disp.select("REQ_NO", M.safe_divide(d, r).alias("fill"), M.percent(d, r).alias("pct"))


@query("fn_05_days_between", """
SELECT RECORD_NUMBER, CAST(EXPIRED_DATE-OPERATE_DATE AS BIGINT) AS days_left, CAST(EXPIRED_DATE-DATE '1999-06-30' AS BIGINT) AS days_until
FROM card""")
def _(w):
    return w.src.card.select("RECORD_NUMBER", F.datediff("EXPIRED_DATE", "OPERATE_DATE").alias("days_left"),
                             F.datediff("EXPIRED_DATE", F.lit(AS_OF)).alias("days_until"))


@query("fn_06_date_parts", f"""
SELECT OPERATE_DATE + 90 AS plus90, OPERATE_DATE - 30 AS minus30, last_day(OPERATE_DATE) AS month_end,
 month(OPERATE_DATE) AS m, year(OPERATE_DATE) AS y, day(OPERATE_DATE) AS d, quarter(OPERATE_DATE) AS q, {CNT} FROM card GROUP BY ALL""")
def _(w):
    d = F.col("OPERATE_DATE")
    return w.src.card.groupBy(F.date_add(d, 90).alias("plus90"), F.date_sub(d, 30).alias("minus30"),
                              F.last_day(d).alias("month_end"), F.month(d).alias("m"), F.year(d).alias("y"),
                              F.dayofmonth(d).alias("d"), F.quarter(d).alias("q")).agg(count_rows())


@query("fn_07_parse_date8", f"""
SELECT CAST(try_strptime(CONFIRM_DATE,'%Y%m%d') AS DATE) AS confirm_date,
 CAST(try_strptime(CASE WHEN right(CONFIRM_DATE,4)='0000' THEN left(CONFIRM_DATE,4)||'0101' ELSE CONFIRM_DATE END,'%Y%m%d') AS DATE)
  AS lenient_date, {CNT} FROM accr_disp WHERE CONFIRM_DATE<>'00000000' GROUP BY ALL
UNION ALL SELECT NULL, NULL, {CNT} FROM accr_disp WHERE CONFIRM_DATE='00000000'""")
def _(w):
    strict = D.parse_date8("CONFIRM_DATE")
    lenient = D.parse_date8_lenient("CONFIRM_DATE")
    return w.src.accr_disp.groupBy(strict.alias("confirm_date"), lenient.alias("lenient_date")).agg(count_rows())


@query("fn_08_format_date8", f"SELECT strftime(OPERATE_DATE,'%Y%m%d') AS text8, {CNT} FROM card GROUP BY 1")
def _(w):
    return w.src.card.groupBy(D.format_date8("OPERATE_DATE").alias("text8")).agg(count_rows())


_FY = "(year(OPERATE_DATE) + CASE WHEN month(OPERATE_DATE)>=10 THEN 1 ELSE 0 END)"


@query("fn_09_fiscal_year_start", f"SELECT OPERATE_DATE, make_date({_FY}-1,10,1) AS begin_fy, {CNT} FROM card GROUP BY ALL")
def _(w):
    return w.src.card.groupBy("OPERATE_DATE", D.fiscal_year_start("OPERATE_DATE").alias("begin_fy")).agg(count_rows())


@query("fn_10_thai_fiscal_year", f"""
SELECT OPERATE_DATE, CAST({_FY}+543 AS BIGINT) AS thai_fy, 'ปีงบประมาณ ' || CAST({_FY}+543 AS VARCHAR) AS thai_fy_text, {CNT}
FROM card GROUP BY ALL""")
def _(w):
    return w.src.card.groupBy("OPERATE_DATE", D.thai_fiscal_year("OPERATE_DATE").alias("thai_fy"),
                              D.thai_fiscal_year_text("OPERATE_DATE").alias("thai_fy_text")).agg(count_rows())


@query("fn_11_fiscal_quarter", f"SELECT OPERATE_DATE, CAST(quarter(OPERATE_DATE)%4+1 AS BIGINT) AS fq, {CNT} FROM card GROUP BY ALL")
def _(w):
    return w.src.card.groupBy("OPERATE_DATE", D.fiscal_quarter("OPERATE_DATE").alias("fq")).agg(count_rows())


@query("fn_12_current_fiscal_year", f"""
SELECT CAST(1999 AS BIGINT) AS fy, CAST(2542 AS BIGINT) AS thai_fy, {CNT}, CAST(sum(VALUE) AS DOUBLE) AS fy_value
FROM card WHERE OPERATE_DATE >= DATE '1998-10-01' AND OPERATE_DATE < DATE '1999-10-01'""")
def _(w):
    fy = D.current_fiscal_year(AS_OF)
    rows = w.src.card.filter(F.col("OPERATE_DATE").between(F.lit(dt.date(fy - 1, 10, 1)), F.lit(dt.date(fy, 9, 30))))
    return rows.agg(count_rows(), F.sum("VALUE").alias("fy_value")).select(
        F.lit(fy).alias("fy"), F.lit(D.current_fiscal_year(AS_OF, "B")).alias("thai_fy"), "row_count", "fy_value")


@query("fn_13_thai_date_text", f"""
SELECT OPERATE_DATE, CAST(day(OPERATE_DATE) AS VARCHAR) || ' ' || {SHORT}[month(OPERATE_DATE)] || ' ' || CAST(year(OPERATE_DATE)+543 AS VARCHAR) AS short_text,
 CAST(day(OPERATE_DATE) AS VARCHAR) || '/' || CAST(month(OPERATE_DATE) AS VARCHAR) || '/' || CAST(year(OPERATE_DATE)+543 AS VARCHAR) AS numeric_text,
 {LONG}[month(OPERATE_DATE)] || ' ' || CAST(year(OPERATE_DATE)+543 AS VARCHAR) AS month_text, {CNT} FROM card GROUP BY ALL""")
def _(w):
    return w.src.card.groupBy("OPERATE_DATE", D.thai_date_short("OPERATE_DATE").alias("short_text"),
                              D.thai_date_numeric("OPERATE_DATE").alias("numeric_text"),
                              D.thai_month_year("OPERATE_DATE").alias("month_text")).agg(count_rows())


@query("fn_14_code_labels", """
WITH ed(code, ed_class) AS (VALUES (1,'ED'),(2,'NED'),(3,'NDMS'),(4,'CM'),(5,'PS')),
 list(code, ed_list) AS (VALUES (1,'ก'),(2,'ข'),(3,'ค'),(4,'ง'),(5,'จ (1)'),(6,'จ (2)')),
 class(code, item_class) AS (VALUES (1,'ยาในบัญชียาหลักแห่งชาติ'),(2,'ยานอกบัญชียาหลักแห่งชาติ'),(3,'เวชภัณฑ์มิใช่ยา'),(4,'เคมีภัณฑ์'),
  (5,'วัสดุห้องปฏิบัติการ'),(6,'วัสดุเภสัชกรรม'),(7,'วัสดุทางทันตกรรม'),(8,'วัสดุการแพทย์ทั่วไป'),(9,'วัสดุทางรังสี'),(10,'วัสดุทั่วไป'),
  (11,'ครุภัณฑ์'),(12,'ครุภัณฑ์การแพทย์'))
SELECT WORKING_CODE, ed_class, coalesce(ed_list,'') AS ed_list, coalesce(item_class,'') AS item_class FROM drug_gn
LEFT JOIN ed ON ed.code=IS_ED LEFT JOIN list ON list.code=ED_LIST_NO LEFT JOIN class ON class.code=CLASS_NO""")
def _(w):
    return w.src.drug_gn.select("WORKING_CODE", M.label(F.col("IS_ED"), M.ED_CLASS).alias("ed_class"),
                                M.label(F.col("ED_LIST_NO"), M.ED_LIST, "").alias("ed_list"),
                                M.label(F.col("CLASS_NO"), M.ITEM_CLASS, "").alias("item_class"))


@query("fn_15_period_diff", f"""
SELECT CAST(strftime(OPERATE_DATE,'%Y%m') AS BIGINT) AS ym,
 CAST((1999*12+6) - (year(OPERATE_DATE)*12+month(OPERATE_DATE)) AS BIGINT) AS months_back, {CNT} FROM card GROUP BY ALL""")
def _(w):
    from stockloom.functions.keys import month_key
    ym = month_key("OPERATE_DATE")
    return w.src.card.groupBy(ym.alias("ym"), D.months_between_keys(F.lit(199906), ym).cast("bigint").alias("months_back")).agg(count_rows())


@query("fn_16_hours_between", """
SELECT event_id, CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(ts)) AS DOUBLE)/3600.0::DOUBLE AS hours_ago FROM events""")
def _(w):
    return w.src.events.select("event_id", D.hours_between(F.lit("2024-01-31 00:00:00"), F.col("ts")).alias("hours_ago"))


@query("fn_17_display_text", """
SELECT event_id, '฿' || format('{:,.2f}', value) AS amount, format('{:,}', CAST(trunc(value) AS BIGINT)) AS whole,
 strftime(ts,'%d/%m/%Y') AS day_text, strftime(ts,'%d/%m/%Y %H:%M') AS time_text FROM events""")
def _(w):
    return w.src.events.select("event_id", M.currency_text(F.col("value")).alias("amount"),
                               M.number_text(F.col("value")).alias("whole"), M.date_text(F.col("ts")).alias("day_text"),
                               M.date_text(F.col("ts"), "dd/MM/yyyy HH:mm").alias("time_text"))


_MONTHLY = """SELECT year(OPERATE_DATE) AS y, month(OPERATE_DATE) AS m, sum(ACTIVE_QTY) AS q FROM card GROUP BY 1,2"""


@query("fn_18_trend", f"""
WITH t AS (SELECT y, m, CAST(q AS DOUBLE) AS q, CAST(lag(q) OVER (ORDER BY y,m) AS DOUBLE) AS p FROM ({_MONTHLY})),
 s AS (SELECT *, (q-p)/nullif(abs(p),0)*100 AS pct FROM t)
SELECT y, m, q, CASE WHEN pct>0 THEN '↑ ' || printf('%+.1f',pct) || '%' WHEN pct<0 THEN '↓ ' || printf('%+.1f',pct) || '%'
 WHEN pct=0 THEN '→ 0%' END AS trend FROM s""")
def _(w):
    from pyspark.sql import Window
    monthly = w.src.card.groupBy(F.year("OPERATE_DATE").alias("y"), F.month("OPERATE_DATE").alias("m")).agg(
        F.sum("ACTIVE_QTY").alias("q"))
    previous = F.lag("q").over(Window.orderBy("y", "m"))  # one row per month
    return monthly.withColumn("p", previous).select("y", "m", "q", M.trend_text(F.col("q"), F.col("p")).alias("trend"))


@query("fn_19_month_label", f"SELECT CAST(m AS VARCHAR) || '/' || CAST(y AS VARCHAR) AS label, CAST(q AS DOUBLE) AS q FROM ({_MONTHLY})")
def _(w):
    y, m = F.year("OPERATE_DATE"), F.month("OPERATE_DATE")
    return w.src.card.groupBy(D.month_label(y, m).alias("label")).agg(F.sum("ACTIVE_QTY").alias("q"))
