"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # a hot key is split even where that costs the following step a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # runtime choice of a hash join where the built side proves small enough per partition
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def local_session(cpus: str = "8", name: str = "stockloom") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(name).config("spark.sql.shuffle.partitions", cpus)
               .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    spark = apply_settings(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
