"""Declared contracts: staging columns, business keys, vocabularies, write layout."""

from __future__ import annotations

from dataclasses import dataclass, field

# Decimal scales of the warehouse.
QTY = "decimal(18,4)"
VALUE = "decimal(18,2)"
UNIT_COST = "decimal(18,6)"

# Controlled vocabularies.
MOVEMENT_IN = ("receive", "transfer_in", "return_in", "adjust_in")
MOVEMENT_OUT = ("issue", "transfer_out", "return_out", "adjust_out")
MOVEMENT_TYPES = MOVEMENT_IN + MOVEMENT_OUT + ("other",)
EXPIRY_STATUSES = ("expired", "near_expiry", "healthy", "no_expiry")
STOCK_STATUSES = ("normal", "zero", "negative", "overstock_candidate")

# Card status codes per direction preset.
DIRECTION_PRESETS = {
    "balance": {"IN": ("R",), "OUT": ("S",), "ADJ": ()},
    "mapping": {"IN": ("R", "I", "B"), "OUT": ("S", "D", "O"), "ADJ": ("A", "C", "X")},
    "planning": {"IN": (), "OUT": ("T", "S", "P", "D", "O"), "ADJ": ("C",)},
}

# Thresholds in days and percent.
NEAR_EXPIRY_DAYS = 90
DEAD_STOCK_DAYS = 180
SLOW_STOCK_DAYS = 90
BUDGET_ALERT_PCT = 85
DAILY_REFRESH_DAYS = 120
MONTHLY_REFRESH_DAYS = 730

# Days re-read behind the last watermark, per domain.
LOOKBACK_DAYS = {"movement": 3, "purchase_order": 7, "goods_receipt": 7, "master": 7, "snapshot": 1}

# Days after which a table counts as stale, per domain.
STALE_AFTER_DAYS = {"snapshot": 2, "movement": 2, "master": 7}


@dataclass(frozen=True)
class Staging:
    """One staging table: required columns, hash parts, landing partition."""

    name: str
    required: tuple[str, ...]
    hash_parts: tuple[str, ...]
    unique: tuple[str, ...] = field(default=())


STAGING = {
    s.name: s
    for s in (
        Staging("item_master", ("source_item_code", "item_name"), ("source_item_code",), ("source_item_code",)),
        Staging("warehouse_master", ("source_warehouse_code", "warehouse_name"), ("source_warehouse_code",),
                ("source_warehouse_code",)),
        Staging("vendor_master", ("source_vendor_code", "vendor_name"), ("source_vendor_code",),
                ("source_vendor_code",)),
        Staging("stock_balance", ("snapshot_date", "source_item_code", "source_warehouse_code", "qty_on_hand"),
                ("snapshot_date", "source_item_code", "source_warehouse_code"),
                ("snapshot_date", "source_item_code", "source_warehouse_code")),
        Staging("stock_lot_balance", ("snapshot_date", "source_item_code", "source_warehouse_code", "qty_on_hand"),
                ("snapshot_date", "source_item_code", "source_warehouse_code", "lot_no", "expiry_date"),
                ("snapshot_date", "source_item_code", "source_warehouse_code", "lot_no", "expiry_date")),
        Staging("inventory_movement",
                ("source_txn_id", "txn_date", "source_item_code", "source_warehouse_code", "movement_type", "qty"),
                ("source_txn_id", "source_item_code", "source_warehouse_code", "lot_no", "movement_type"),
                ("source_txn_id",)),
        Staging("purchase_order_line", ("po_no", "po_date", "source_item_code", "ordered_qty"),
                ("po_no", "source_item_code"), ("po_no", "source_item_code")),
        Staging("goods_receipt_line", ("gr_no", "gr_date", "source_item_code", "source_warehouse_code", "received_qty"),
                ("gr_no", "source_item_code", "source_warehouse_code", "lot_no"),
                ("gr_no", "source_item_code", "source_warehouse_code", "lot_no")),
    )
}

# Event-date column each fact is partitioned by (as a month), and the key a reload replaces.
FACT_DATE = {
    "fact_stock_snapshot": "snapshot_date",
    "fact_stock_lot_snapshot": "snapshot_date",
    "fact_inventory_movement": "txn_date",
    "fact_purchase_order_line": "po_date",
    "fact_goods_receipt_line": "gr_date",
}
FACT_KEY = {
    "fact_inventory_movement": ("source_row_hash",),
    "fact_purchase_order_line": ("po_no", "dim_item_id"),
    "fact_goods_receipt_line": ("gr_no", "dim_item_id", "dim_warehouse_id"),
}
FACT_DOMAIN = {
    "fact_stock_snapshot": ("inventory", "snapshot"),
    "fact_stock_lot_snapshot": ("inventory", "snapshot"),
    "fact_inventory_movement": ("inventory", "movement"),
    "fact_purchase_order_line": ("procurement", "movement"),
    "fact_goods_receipt_line": ("procurement", "movement"),
}
