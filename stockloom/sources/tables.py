"""Lazy access to the source tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .adapters import ADAPTERS, PARQUET_TABLES, inputs_of, plan_text


class SourceTables:
    """Source tables by name; every table is a lazy plan over parquet."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir
        self._plans: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._plans:
            self._plans[name] = self._load(name)
        return self._plans[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in ADAPTERS and name not in PARQUET_TABLES):
            raise AttributeError(name)
        return self[name]

    def _load(self, name: str) -> DataFrame:
        if name in PARQUET_TABLES:
            return self._read(name)
        sql = plan_text(name)
        return self.spark.sql(sql, **{n: self[n] for n in inputs_of(sql)})

    def _read(self, name: str) -> DataFrame:
        """A parquet table as it was delivered."""
        return self.spark.read.parquet(f"{self.data_dir}/{name}.parquet")
