"""The warehouse as lazy plans: staged extracts, dimensions, facts.

Nothing is read until an action runs; a report over one mart only ever scans
the columns that mart needs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.functions import keys
from stockloom.operators import dims, facts
from stockloom.sources import extract
from stockloom.sources.tables import SourceTables


class Warehouse:
    """Conformed tables over one set of source tables."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.src = SourceTables(spark, data_dir)

    # narrow key tables used by the fact lookups
    @cached_property
    def item_keys(self) -> DataFrame:
        return dims.dimension_keys(self.src.drug_gn, "WORKING_CODE", "dim_item")

    @cached_property
    def warehouse_keys(self) -> DataFrame:
        return dims.dimension_keys(self.src.dept_id, "DEPT_ID", "dim_warehouse")

    @cached_property
    def vendor_keys(self) -> DataFrame:
        vendors = self.src.company.select(keys.normal_code("COMPANY_CODE").alias("c"))
        return dims.dimension_keys(vendors, "c", "dim_vendor")

    # dimension attributes; the unknown member included
    def _dim(self, rows: DataFrame, dim: str) -> DataFrame:
        code, id_col, _, _ = dims.DIMENSIONS[dim]
        return dims.with_unknown(rows.select(keys.surrogate_id(code).alias(id_col), *rows.columns), dim)

    @cached_property
    def item_master(self) -> DataFrame:
        return extract.item_master(self.src.drug_gn, self.src.company)

    @cached_property
    def warehouse_master(self) -> DataFrame:
        return extract.warehouse_master(self.src.dept_id)

    @cached_property
    def vendor_master(self) -> DataFrame:
        return extract.vendor_master(self.src.company)

    @cached_property
    def dim_item(self) -> DataFrame:
        return self._dim(dims.PREPARE["dim_item"](self.item_master), "dim_item")

    @cached_property
    def items(self) -> DataFrame:
        """Id, code, name and flag of every item, without the manufacturer join."""
        rows = self.src.drug_gn.select(
            F.col("WORKING_CODE").alias("source_item_code"), F.col("DRUG_NAME").alias("item_name"),
            F.coalesce(F.col("HIDE") == "N", F.lit(False)).alias("is_active"))
        return self._dim(rows, "dim_item")

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        return self._dim(self.warehouse_master, "dim_warehouse")

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return self._dim(self.vendor_master, "dim_vendor")

    @cached_property
    def reorder_points(self) -> DataFrame:
        return self.src.drug_gn.select(
            keys.surrogate_id("WORKING_CODE").alias("dim_item_id"), F.col("REORDER_QTY").alias("reorder_point"))

    # facts
    @cached_property
    def fact_stock_snapshot(self) -> DataFrame:
        return facts.stock_snapshot(extract.stock_balance(self.src.card), self.item_keys, self.warehouse_keys)

    @cached_property
    def fact_stock_lot_snapshot(self) -> DataFrame:
        return facts.stock_lot_snapshot(extract.stock_lot_balance(self.src.card), self.item_keys, self.warehouse_keys)

    @cached_property
    def fact_inventory_movement(self) -> DataFrame:
        return facts.movement(extract.inventory_movement(self.src.card), self.item_keys, self.warehouse_keys,
                              self.vendor_keys)

    @cached_property
    def fact_purchase_order_line(self) -> DataFrame:
        return facts.purchase_order_line(extract.purchase_order_line(self.src.ms_po, self.src.ms_po_c),
                                         self.item_keys, self.vendor_keys)

    @cached_property
    def fact_goods_receipt_line(self) -> DataFrame:
        return facts.goods_receipt_line(extract.goods_receipt_line(self.src.ms_ivo, self.src.ms_ivo_c),
                                        self.item_keys, self.warehouse_keys, self.vendor_keys)
