"""Queries that keep to one item, slice by slice of the items, so that the shuffle files of one slice at a time lie on disk.

A slice takes the rows of every table whose item falls into it; rows without an
item are in one slice as well, and tables without items are whole in each.  So
a build whose joins and groups all hold the item gives, over all slices, the
rows that it gives at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.plans.store import CODEC, short_lived_shuffles, work_folder

#: Names of the item's code in the tables.
ITEM = ("WORKING_CODE", "MED_CODE", "working_code")
#: Bytes of the files that are read for one slice's share; smaller inputs are not cut.
SLICE_BYTES = 512 << 20


class Slice:
    """The tables of ``tables``, of one slice of the items."""

    def __init__(self, tables, number: int, of: int):
        self._tables, self._number, self._of = tables, number, of

    def _cut(self, df: DataFrame) -> DataFrame:
        key = next((c for c in ITEM if c in df.columns), None)
        return df if key is None else df.filter(F.pmod(F.xxhash64(key), F.lit(self._of)) == self._number)

    def stored(self, table: str) -> DataFrame:
        return self._cut(self._tables.stored(table))

    def __getattr__(self, name: str):
        found = getattr(self._tables, name)
        return self._cut(found) if isinstance(found, DataFrame) else found


def number(df: DataFrame) -> int:
    """Slices for the files that ``df`` reads."""
    spark = df.sparkSession
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    read = 0
    for f in df.inputFiles():
        p = path(spark.sparkContext._jvm.java.net.URI(f))
        read += p.getFileSystem(conf).getFileStatus(p).getLen()
    return max(1, -(-read // SLICE_BYTES))


def cut(tables, build: Callable[..., DataFrame]) -> Iterator[DataFrame]:
    """``build`` of the tables, whole where they are small, else slice by slice."""
    whole = build(tables)
    n = number(whole)
    if n == 1:
        yield whole
    else:
        yield from (build(Slice(tables, i, n)) for i in range(n))


def in_slices(tables, build: Callable[..., DataFrame], name: str) -> DataFrame:
    """``build`` of the tables: as a plan where they are small, else written slice by slice to a folder of the run and read from there."""
    whole = build(tables)
    if number(whole) == 1:
        return whole
    path = work_folder(whole.sparkSession, name)
    with short_lived_shuffles(whole.sparkSession):
        for part in cut(tables, build):
            part.write.mode("append").parquet(path, compression=CODEC)
    return whole.sparkSession.read.schema(whole.schema).parquet(path)
