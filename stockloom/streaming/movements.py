"""Streaming movements: exactly-once ingest, daily summary, alerts.

The daily summary loses no row; ``once``, and a summary that is given a delay,
drop rows that are later than the watermark delay, as the batch path drops rows
older than its look-back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom import schemas as S
from stockloom.functions import keys, measures as M
from stockloom.plans.store import Store
from stockloom.sources.adapters import ADAPTERS

LATE_DAYS = 3  # fixed value: look-back of the movement domain
EVENT_KEY = ["row_hash"]


def event_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Movement events from a growing parquet folder, in event time."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    events = reader.parquet(folder)
    rows = spark.sql(ADAPTERS["movement_event"], events=events)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def with_hash(moves: DataFrame) -> DataFrame:
    return moves.withColumn("row_hash", keys.business_hash("event_id", "source_item_code", "source_warehouse_code", "movement_type"))


def once(moves: DataFrame, delay: str = f"{LATE_DAYS} days") -> DataFrame:
    """Drop repeats of a business key that arrive within the delay."""
    return with_hash(moves).withWatermark("ts", delay).dropDuplicatesWithinWatermark(EVENT_KEY)


def daily_summary(moves: DataFrame, delay: str | None = None) -> DataFrame:
    """Quantity and count per day and type, however late a row is: the state holds one row per day and type.

    With a ``delay`` a day is closed that long after the newest row, and later
    rows for it are dropped.
    """
    rows = moves if delay is None else moves.withWatermark("ts", delay)
    return (rows.groupBy(F.window("ts", "1 day"), "movement_type")
            .agg(F.count(F.lit(1)).alias("txn_count"), F.sum(F.abs("qty")).alias("movement_qty"))
            .select(F.to_date("window.start").alias("summary_date"), "movement_type", "txn_count", "movement_qty"))


def alert_rows(moves: DataFrame, limit: float) -> DataFrame:
    """Outgoing movements of at least ``limit`` units."""
    out = M.movement_direction(F.col("movement_type")) == "out"
    return moves.filter(out & (F.col("qty") >= limit)).select(
        "event_id", F.to_date("ts").alias("alert_date"), "source_item_code", "source_warehouse_code", "movement_type", "qty",
        F.lit("large issue").alias("alert"))


def run_to_store(stream: DataFrame, store: Store, table: str, key: list[str], date: str, mode: str = "append") -> None:
    """Drain what is available into a table, each micro-batch by key.

    ``append`` inserts keys the table lacks, ``update`` replaces the keys of the
    micro-batch; both leave the table unchanged when a micro-batch is repeated.
    """
    def sink(batch: DataFrame, _epoch: int) -> None:
        if mode == "append":
            store.insert_absent(batch, table, key, date)
        else:
            store.replace_keys(batch, table, key, date)

    query = (stream.writeStream.outputMode(mode).foreachBatch(sink).trigger(availableNow=True)
             .option("checkpointLocation", f"{store.root}/_stream/{table}").start())
    query.awaitTermination()


def counting_late(stream: DataFrame, store: Store, table: str, key: list[str], date: str, days: int = LATE_DAYS) -> None:
    """Drain what is available into a table, rows that come later than ``days`` after the newest seen before into ``late.<table>``.

    The newest event time before a micro-batch comes from what earlier ones
    recorded, not from memory, so a repeated micro-batch judges its rows alike.
    Each one records how many rows it kept and how many were late.  A row
    without an event time is never late.
    """
    name = table.split(".")[-1]
    late_table, count_table = f"late.{name}", f"ops.{name}_late"

    def sink(batch: DataFrame, epoch: int) -> None:
        newest = None
        if store.exists(count_table):
            newest = store.read(count_table).filter(F.col("epoch") < epoch).agg(F.max("newest")).first()[0]
        late = F.lit(False) if newest is None else F.coalesce(F.col("ts") < F.lit(newest) - F.expr(f"INTERVAL {days} DAYS"), F.lit(False))
        marked = batch.withColumn("_late", late)
        store.write_part(marked.filter("_late").drop("_late"), late_table, f"epoch={epoch}")
        store.insert_absent(marked.filter("not _late").drop("_late"), table, key, date)
        counts = marked.agg(F.count_if(~F.col("_late")).alias("kept"), F.count_if("_late").alias("late"), F.max("ts").alias("newest"))
        store.write_part(counts, count_table, f"epoch={epoch}")

    query = (stream.writeStream.foreachBatch(sink).trigger(availableNow=True)
             .option("checkpointLocation", f"{store.root}/_stream/{table}").start())
    query.awaitTermination()
