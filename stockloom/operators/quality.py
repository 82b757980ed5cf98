"""Data quality: row rules per table, duplicate keys, orphans, reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.functions import dates as D, keys
from stockloom.operators.relational import orphans

ERROR, WARN, INFO = "ERROR", "WARN", "INFO"


class DataQualityError(ValueError):
    """A rule of severity ERROR failed, or a required column is missing."""


@dataclass(frozen=True)
class Rule:
    """A row fails the rule where ``failed`` (a SQL condition) is true."""

    name: str
    severity: str
    failed: str


def _required(*columns: str) -> list[Rule]:
    return [Rule(f"{c} missing", ERROR, f"{c} IS NULL") for c in columns]


_KNOWN = ", ".join(f"'{t}'" for t in S.MOVEMENT_TYPES)

RULES: dict[str, list[Rule]] = {
    "item_master": [*_required("source_item_code", "item_name"), Rule("item_name blank", ERROR, "trim(item_name) = ''")],
    "warehouse_master": _required("source_warehouse_code", "warehouse_name"),
    "vendor_master": [Rule("source_vendor_code missing", WARN, "source_vendor_code IS NULL"), *_required("vendor_name")],
    "stock_balance": [*_required(*S.STAGING["stock_balance"].required), Rule("negative quantity", WARN, "qty_on_hand < 0")],
    "stock_lot_balance": [*_required(*S.STAGING["stock_lot_balance"].required), Rule("negative quantity", WARN, "qty_on_hand < 0"),
                          Rule("unrealistic expiry", WARN, "expiry_date < DATE '2000-01-01'")],
    "inventory_movement": [*_required(*S.STAGING["inventory_movement"].required), Rule("zero quantity", WARN, "qty = 0"),
                           Rule("unknown movement type", WARN, f"lower(movement_type) NOT IN ({_KNOWN})"),
                           Rule("quantity without cost", WARN, "qty > 0 AND unit_cost IS NULL"),
                           Rule("value off quantity times cost", WARN, "abs(line_value - qty * unit_cost) > 0.01")],
    "purchase_order_line": [*_required(*S.STAGING["purchase_order_line"].required), Rule("vendor missing", INFO, "source_vendor_code IS NULL")],
    "goods_receipt_line": [*_required(*S.STAGING["goods_receipt_line"].required), Rule("vendor missing", INFO, "source_vendor_code IS NULL")],
}

# Tables whose business key must be unique within a batch.  Lines of orders and receipts may repeat theirs.
UNIQUE_TABLES = ("item_master", "warehouse_master", "vendor_master", "stock_balance", "stock_lot_balance")


def missing_columns(df: DataFrame, table: str) -> list[str]:
    return [c for c in S.STAGING[table].required if c not in df.columns]


def duplicate_rows(df: DataFrame, key: tuple[str, ...] | list[str]) -> DataFrame:
    """Keys held by several rows, with how many."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def repeated_keys(df: DataFrame, table: str) -> DataFrame:
    """Business keys that break a table's uniqueness.  A master without a code is another rule's case, not a repeated one."""
    key = S.STAGING[table].unique
    return duplicate_rows(df.dropna(subset=list(key)) if table.endswith("_master") else df, key)


def report(df: DataFrame, table: str, rules: list[Rule] | None = None) -> DataFrame:
    """One row per rule with checked and failed rows; all rules in a single aggregation."""
    rules = RULES[table] if rules is None else rules
    counts = df.agg(F.count(F.lit(1)).alias("checked"), *[F.count_if(F.expr(r.failed)).alias(f"r{i}") for i, r in enumerate(rules)])
    lines = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"r{i}").alias("failed"))
                      for i, r in enumerate(rules)])
    return counts.select("checked", F.explode(lines).alias("l")).select(
        F.lit(table).alias("table_name"), "l.rule", "l.severity", "checked", F.col("l.failed").alias("failed"))


def split(df: DataFrame, table: str, rules: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the ERROR rules they break."""
    rules = [r for r in (RULES[table] if rules is None else rules) if r.severity == ERROR]
    broken = F.array_compact(F.array(*[F.when(F.expr(r.failed), F.lit(r.name)) for r in rules]))
    marked = df.withColumn("rejected_for", broken)
    return (marked.filter(F.size("rejected_for") == 0).drop("rejected_for"),
            marked.filter(F.size("rejected_for") > 0).withColumn("rejected_for", F.concat_ws("; ", "rejected_for")))


def split_duplicates(df: DataFrame, table: str, repeated: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of keys held once, and all rows of keys held several times, where the table's key must be unique.

    ``repeated`` are the keys of ``repeated_keys``, where they have been stored.
    """
    key = list(S.STAGING[table].unique) if table in UNIQUE_TABLES else []
    marked = df.withColumn("rejected_for", F.lit("duplicate business key"))
    if not key:
        return df, marked.limit(0)
    repeated = repeated_keys(df, table) if repeated is None else repeated
    again = repeated.select(*[F.col(c).alias(f"_{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    return df.join(again, same, "left_anti"), marked.join(again, same, "left_semi")


def enforce(df: DataFrame, table: str) -> None:
    """Raise if a required column is missing, an ERROR rule fails or a unique key repeats."""
    missing = missing_columns(df, table)
    if missing:
        raise DataQualityError(f"{table}: missing required columns: {missing}")
    failed = report(df, table).filter((F.col("severity") == ERROR) & (F.col("failed") > 0)).collect()
    if failed:
        raise DataQualityError(f"{table}: " + "; ".join(f"{r['rule']} ({r['failed']} rows)" for r in failed))
    if table in UNIQUE_TABLES and not repeated_keys(df, table).isEmpty():
        raise DataQualityError(f"{table}: duplicate business key {S.STAGING[table].unique}")


def known_movement_type(movement_type: Column) -> Column:
    t = F.lower(movement_type)
    return F.when(t.isin(*S.MOVEMENT_TYPES), t).otherwise("other")


def date_quarantine(df: DataFrame, column: str, earliest: str = "1990-01-01", latest: str = "2099-12-31") -> DataFrame:
    """Marks 8-character dates: ok, bad format, not a date, unrealistic."""
    text = F.col(column)
    day = D.parse_date8(column)
    return df.withColumn("date_state", F.when(text.isNull() | (F.length(text) != 8), "bad format").when(day.isNull(), "not a date")
                         .when(~day.between(F.lit(earliest).cast("date"), F.lit(latest).cast("date")), "unrealistic").otherwise("ok"))


def orphan_counts(card: DataFrame, drug_gn: DataFrame, dept: DataFrame, drug_vn: DataFrame, company: DataFrame) -> DataFrame:
    """Card rows whose item, department, trade product or vendor is not on file.

    Each reference is reduced to its distinct codes before the check.
    """
    vendor = keys.normal_code("VENDOR_CODE")
    checks = (("item", F.col("WORKING_CODE"), drug_gn, F.col("WORKING_CODE")), ("department", F.col("DEPT_ID"), dept, F.col("DEPT_ID")),
              ("trade product", F.col("TRADE_CODE"), drug_vn, F.col("TRADE_CODE")), ("vendor", vendor, company, keys.normal_code("COMPANY_CODE")))
    out = None
    for kind, code, parent, parent_code in checks:
        per_code = card.groupBy(code.alias("_code")).agg(F.count(F.lit(1)).alias("_n"))
        lost = orphans(per_code, "_code", parent.select(parent_code.alias("_p")), "_p")
        row = lost.agg(F.count(F.lit(1)).alias("codes"), F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("row_count")
                       ).select(F.lit(kind).alias("reference"), "codes", "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def quantity_without_cost(lots: DataFrame) -> DataFrame:
    return lots.filter("QTY_ON_HAND > 0 AND LOT_COST IS NULL AND PACK_COST IS NULL AND LOT_VALUE IS NULL")


def value_mismatch(lots: DataFrame, tolerance: float = 0.01) -> DataFrame:
    product = (F.col("QTY_ON_HAND") * F.col("LOT_COST")).cast("decimal(24,2)")
    gap = F.abs(F.col("LOT_VALUE") - product)
    return lots.withColumn("expected_value", product).withColumn("gap", gap).filter(F.col("gap") > F.lit(tolerance).cast("decimal(24,2)"))


def unresolved_codes(dispensed: DataFrame, drug_gn: DataFrame) -> DataFrame:
    day = D.parse_date8("DISP_DATE")
    per_code = dispensed.groupBy("MED_CODE").agg(F.count(F.lit(1)).alias("row_count"), F.sum("DISP_QTY").alias("disp_qty"),
                                                 F.min(day).alias("first_date"), F.max(day).alias("last_date"))
    return orphans(per_code, "MED_CODE", drug_gn, "WORKING_CODE")


# Reconciliation ---------------------------------------------------------------------

def compare_by(source: DataFrame, target: DataFrame, key: str, measure: str) -> DataFrame:
    """Sums of both sides per key with their difference; a key on one side only counts as zero on the other."""
    a = source.groupBy(key).agg(F.sum(measure).alias("source_value"))
    b = target.groupBy(key).agg(F.sum(measure).alias("target_value"))
    zero = F.lit(0).cast("decimal(30,4)")
    left, right = F.coalesce("source_value", zero), F.coalesce("target_value", zero)
    return a.join(b, key, "full_outer").select(key, left.alias("source_value"), right.alias("target_value"), (right - left).alias("difference"))


def row_count_check(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Source and target row counts per table."""
    out = None
    for name, (source, target) in pairs.items():
        side = (source.agg(F.count(F.lit(1)).alias("source_rows")).withColumn("target_rows", F.lit(0).cast("bigint"))
                .unionByName(target.agg(F.count(F.lit(1)).alias("target_rows")).withColumn("source_rows", F.lit(0).cast("bigint"))))
        row = side.agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows")).select(
            F.lit(name).alias("table_name"), "source_rows", "target_rows")
        out = row if out is None else out.unionByName(row)
    return out


def invoice_fan_out(ms_ivo: DataFrame, ms_ivo_c: DataFrame) -> DataFrame:
    """Invoices whose number stands on several headers, and the extra lines the join yields."""
    heads = ms_ivo.groupBy("INVOICE_NO").agg(F.count(F.lit(1)).alias("headers"))
    lines = ms_ivo_c.groupBy("INVOICE_NO").agg(F.count(F.lit(1)).alias("line_count"))
    many = heads.join(lines, "INVOICE_NO", "left").filter("headers > 1")
    return many.agg(F.count(F.lit(1)).alias("invoices"),
                    F.coalesce(F.sum((F.col("headers") - 1) * F.coalesce("line_count", F.lit(0))), F.lit(0).cast("bigint")).alias("extra_lines"))
