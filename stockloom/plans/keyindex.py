"""Which partitions of a fact hold a key: a narrow table of keys beside the fact, dealt into buckets by hash.

A load looks only at the buckets its own keys fall into, then reads only the
partitions found there.  Entries are added before the fact is written and never
taken away by a load, so the index always covers the fact; an entry whose row
has moved on costs a look at a partition and is dropped when the index is
rebuilt.  Only a fact's first load makes the index after it, from the fact; a
load that finds a fact without an index makes it first, so a crash between the
two is mended by the next load.
"""

from __future__ import annotations

import datetime as dt
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from stockloom.plans.store import Store

BUCKET = "key_bucket"
#: Keys per bucket that a rebuild aims at, and the fewest buckets.
KEYS_PER_BUCKET, LEAST_BUCKETS = 1_000_000, 64


class KeyIndex:
    """Index of one fact; the folder names its number of buckets and is used once it is whole."""

    def __init__(self, store: Store, table: str, key: list[str], part: str):
        self.store, self.table, self.key, self.part = store, table, list(key), part
        self.name = f"index.{table}"

    def buckets(self) -> int | None:
        """Buckets of the newest whole version; None without one."""
        whole = [int(n.split("=")[1]) for n in self.store._children(self.store.path(self.name))
                 if n.startswith("of=") and "_SUCCESS" in self.store._children(f"{self.store.path(self.name)}/{n}")]
        return max(whole, default=None)

    def _path(self, n: int) -> str:
        return f"{self.store.path(self.name)}/of={n}"

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(n)).cast("int").alias(BUCKET)

    def _write(self, entries: DataFrame, n: int, mode: str, distinct: bool = False) -> None:
        dealt = entries.select(*self.key, self.part, self._bucket(n)).repartition(BUCKET)
        ((dealt.distinct() if distinct else dealt)  # equal entries share a bucket, so this costs no shuffle more
         .write.mode(mode).partitionBy(BUCKET).parquet(self._path(n), compression="zstd"))

    def rebuild(self) -> int:
        """Index of what the fact holds now, with buckets for its size; older versions go after it is whole."""
        rows = self.store.spark.read.parquet(self.store.path(self.table))
        # a fact whose rows all lack a date has a partition column without a type
        entries = rows.select(*self.key, F.col(self.part).cast("date").alias(self.part))
        n, old = LEAST_BUCKETS, self.buckets()
        held = rows.count()  # from the file footers; no fewer than the keys
        while n * KEYS_PER_BUCKET < held or (old is not None and n <= old):
            n *= 2
        self._write(entries, n, "overwrite", distinct=True)
        for name in self.store._children(self.store.path(self.name)):
            if name.startswith("of=") and name != f"of={n}":
                fs, p = self.store._fs(f"{self.store.path(self.name)}/{name}")
                fs.delete(p, True)
        return n

    def ensure(self) -> int:
        """Buckets of the index, which is made from the fact where there is none yet."""
        n = self.buckets()
        if n is None and self.store.exists(self.table):
            return self.rebuild()
        return n or LEAST_BUCKETS

    def _touched(self, wanted: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        """The index's buckets that the keys in ``wanted`` fall into, and these keys in its types."""
        n = self.buckets()
        if n is None:
            return None
        index = self.store.spark.read.parquet(self._path(n))
        same_types = wanted.select(*(F.col(c).cast(index.schema[c].dataType) for c in self.key))
        touched = [r[0] for r in same_types.select(self._bucket(n)).distinct().collect()]  # at most one value per bucket
        return (index.filter(F.col(BUCKET).isin(touched)) if len(touched) < n else index), same_types

    def entries(self, wanted: DataFrame) -> DataFrame | None:
        """Entries of the keys in ``wanted``, from the buckets they fall into."""
        found = self._touched(wanted)
        return None if found is None else found[0].join(found[1], self.key, "left_semi").select(*self.key, self.part)

    def parts(self, wanted: DataFrame) -> set[dt.date | None]:
        """Partitions that may hold a key of ``wanted``."""
        self.ensure()
        return self.parts_of(self.entries(wanted))

    def parts_of(self, entries: DataFrame | None) -> set[dt.date | None]:
        return set() if entries is None else {r[0] for r in entries.select(self.part).distinct().collect()}

    def add(self, rows: DataFrame, known: DataFrame | None = None) -> None:
        """Note different (key, partition) of rows about to be written; the pairs in ``known``, the entries of their keys, aren't repeated."""
        n, new = self.buckets() or LEAST_BUCKETS, rows.select(*self.key, self.part)
        if known is not None:
            same = [F.col(f"n.{c}") == F.col(f"k.{c}") for c in self.key] + [F.col(f"n.{self.part}").eqNullSafe(F.col(f"k.{self.part}"))]
            on = same[0]
            for s in same[1:]:
                on = on & s
            new = new.alias("n").join(known.alias("k"), on, "left_anti")
        self._write(new, n, "append")
