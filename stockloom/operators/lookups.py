"""Lookups: newest row per key, value bands, closest cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Octaves of the 18-digit money range; a band is copied once per octave it touches.
_OCTAVES = 64


def latest(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Newest row per key.  One aggregation that combines before the shuffle, so a
    key holding most rows costs no more than any other."""
    row = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in columns])


def _octave(value: Column) -> Column:
    v = value.cast("double")
    return F.when(v < 1, F.lit(0)).otherwise(F.least(F.floor(F.log2(v)).cast("int") + 1, F.lit(_OCTAVES)))


def band_lookup(df: DataFrame, value: str, bands: DataFrame, low: str, high: str, code: str, out: str) -> DataFrame:
    """Lowest ``code`` among the bands with ``low <= value <= high``; NULL if none.

    The bands (a price list, not data) are listed per power of two they touch;
    an equality join on it gives each row one short list to search, so no row
    is ever repeated and there is no theta join.
    """
    spans = (bands.select(F.explode(F.sequence(_octave(F.col(low)), _octave(F.col(high)))).alias("_oct"),
                          F.struct(F.col(low).alias("low"), F.col(high).alias("high"), F.col(code).alias("code")).alias("_band"))
             .groupBy("_oct").agg(F.collect_list("_band").alias("_bands")))
    v = F.col(value)
    fits = F.filter("_bands", lambda b: (b["low"] <= v) & (b["high"] >= v))
    return (df.withColumn("_oct", _octave(v)).join(spans, "_oct", "left")
            .withColumn(out, F.array_min(F.transform(fits, lambda b: b["code"]))).drop("_oct", "_bands"))
