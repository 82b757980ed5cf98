"""Warehouse tables as partitioned parquet, with idempotent reloads.

Facts and daily marts are partitioned by a ``part`` column: the event date cut
to the store's grain (``day`` or ``month``).  A reload rewrites only the
partitions it touches, by dynamic partition overwrite: Spark stages the new
files and moves them in when the job commits, so the plan may read the table it
replaces and a failed job leaves the old partitions.  Dimensions are written
whole to a new version folder and committed by a manifest of their own.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockloom.plans.keyindex import KeyIndex

PART = "part"
MANIFEST = "_manifest-"
#: Rows carry hashes in hex and repeated codes; zstd stores them in about half of what snappy takes.
CODEC = "zstd"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of rows without a date


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="stockloom-")
    return f"{shared.rstrip('/')}/stockloom/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver collects garbage; so a run of many loads holds one load's files.

    What a query persists stays; a plan that is run once more computes its shuffles once more.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _own_shuffles(write: Callable) -> Callable:
    """A method of ``Store`` whose queries drop their shuffle files as each of them ends."""
    @wraps(write)
    def run(self, *args, **named):
        with short_lived_shuffles(self.spark):
            return write(self, *args, **named)
    return run


def _metric(seen: Observation, name: str, default):
    """Observed value; a plan that proved empty reports none, or a row without columns."""
    try:
        return seen.get.get(name, default)
    except Py4JJavaError as e:
        if "assertion failed" not in str(e.java_exception):
            raise
        return default


class Store:
    """Tables under one root folder, named ``layer.table``."""

    def __init__(self, spark: SparkSession, root: str, grain: str = "day"):
        if grain not in ("day", "month"):
            raise ValueError(f"unknown grain {grain!r}")
        self.spark, self.root, self.grain = spark, root.rstrip("/"), grain

    # paths --------------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def exists(self, table: str) -> bool:
        return any(not n.startswith((".", "_")) for n in self._children(self.path(table)))

    # partition column -----------------------------------------------------------
    def part(self, date: Column) -> Column:
        return (date.cast("date") if self.grain == "day" else F.trunc(date, "month")).alias(PART)

    def part_of(self, day: dt.date) -> dt.date:
        return day if self.grain == "day" else day.replace(day=1)

    # reading ----------------------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        """A partitioned or plain table without its partition column."""
        df = self.spark.read.parquet(self.path(table))
        return df.drop(PART) if PART in df.columns else df

    def read_range(self, table: str, column: str, low: dt.date | None, high: dt.date | None) -> DataFrame:
        """Rows of a date range; the partition filter is implied by the dates."""
        df = self.spark.read.parquet(self.path(table))
        if low is not None:
            df = df.filter((F.col(PART) >= F.lit(self.part_of(low))) & (F.col(column) >= F.lit(low)))
        if high is not None:
            df = df.filter((F.col(PART) <= F.lit(self.part_of(high))) & (F.col(column) <= F.lit(high)))
        return df.drop(PART)

    # writing ------------------------------------------------------------------------
    def append(self, df: DataFrame, table: str, date: str | None = None) -> int:
        """Add rows; returns how many."""
        seen = Observation()
        out = df.observe(seen, F.count(F.lit(1)).alias("n"))
        if date is None:
            out.write.mode("append").parquet(self.path(table), compression=CODEC)
        else:
            out = out.withColumn(PART, self.part(F.col(date))).hint("rebalance", PART)
            out.write.mode("append").partitionBy(PART).parquet(self.path(table), compression=CODEC)
        return _metric(seen, "n", 0)

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> int:
        """Staged rows of one batch; loading the batch again replaces them."""
        seen = Observation()
        (df.drop("etl_batch_id").observe(seen, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").parquet(f"{self.path(table)}/etl_batch_id={batch_id}", compression=CODEC))
        return _metric(seen, "n", 0)

    def write_part(self, df: DataFrame, table: str, folder: str) -> int:
        """Rows of one named part of a table; writing the part again replaces them."""
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.path(table)}/{folder}", compression=CODEC)
        return _metric(seen, "n", 0)

    def read_batch(self, table: str, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path(table)}/etl_batch_id={batch_id}").withColumn(
            "etl_batch_id", F.lit(batch_id).cast("bigint"))

    def _overwrite_parts(self, new: DataFrame, table: str, kept: DataFrame | None = None) -> tuple[int, set[dt.date]]:
        """Replace the partitions present in ``new`` and ``kept``; returns the new rows and the partitions written."""
        loaded, seen = Observation(), Observation()
        df = new.observe(loaded, F.count(F.lit(1)).alias("n"))
        if kept is not None:
            df = df.unionByName(kept.select(*new.columns))
        out = df.hint("rebalance", PART).observe(seen, F.collect_set(PART).alias("parts"), F.count_if(F.col(PART).isNull()).alias("undated"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path(table), compression=CODEC))
        return _metric(loaded, "n", 0), set(_metric(seen, "parts", [])) | ({None} if _metric(seen, "undated", 0) else set())

    def _fill(self, new: DataFrame, table: str) -> int:
        """Write a table that holds nothing yet; a large one some partitions at a time, whose shuffle files then go."""
        from stockloom.plans.slices import number
        n, rows = number(new), 0
        for i in range(n):
            rows += self._overwrite_parts(new if n == 1 else new.filter(F.pmod(F.xxhash64(PART), F.lit(n)) == i), table)[0]
        return rows

    def _drop_parts(self, table: str, parts: set[dt.date | None]) -> None:
        for day in parts:
            fs, p = self._fs(f"{self.path(table)}/{PART}={NO_DATE if day is None else day.isoformat()}")
            if fs.exists(p):
                fs.delete(p, True)

    def parts(self, table: str) -> set[dt.date]:
        """Partitions on disk."""
        names = self._children(self.path(table))
        return {dt.date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{PART}=") and not n.endswith(NO_DATE)}

    @_own_shuffles
    def replace_range(self, df: DataFrame, table: str, date: str, low: dt.date, high: dt.date, counts: dict[str, int] | None = None) -> int:
        """Make the rows of a closed date range exactly ``df``; returns the rows of ``df``.

        ``counts``, here and below, receives the rows taken away as ``deleted``.
        """
        new = df.withColumn(PART, self.part(F.col(date)))
        first, last = self.part_of(low), self.part_of(high)
        held = {p for p in self.parts(table) if first <= p <= last}
        kept = None
        if held:
            current = self.spark.read.parquet(self.path(table)).filter(F.col(PART).between(F.lit(first), F.lit(last)))
            inside = F.coalesce(F.col(date).between(F.lit(low), F.lit(high)), F.lit(False))
            kept = current.filter(~inside)
            if counts is not None:  # before they go; reads the date column alone
                counts["deleted"] = current.filter(inside).count()
        rows, written = self._overwrite_parts(new, table, kept)
        self._drop_parts(table, held - written)  # ranges the recomputation left empty
        return rows

    @_own_shuffles
    def replace_days(self, df: DataFrame, table: str, date: str, counts: dict[str, int] | None = None) -> int:
        """Replace every day present in ``df``."""
        new, kept = df.withColumn(PART, self.part(F.col(date))), None
        if not self.exists(table):
            return self._fill(new, table)
        current = self.spark.read.parquet(self.path(table))
        # one number per partition, from the file footers
        held = {} if counts is None else dict(current.groupBy(PART).agg(F.count(F.lit(1))).collect())
        left = Observation()
        if self.grain == "month":
            months = new.select(PART).distinct()
            kept = (current.join(months, PART, "left_semi").join(new.select(date).distinct(), date, "left_anti")
                    .observe(left, F.count(F.lit(1)).alias("n")))
        rows, written = self._overwrite_parts(new, table, kept)
        if counts is not None:
            counts["deleted"] = sum(held.get(p, 0) for p in written) - (_metric(left, "n", 0) if kept is not None else 0)
        return rows

    @_own_shuffles
    def replace_keys(self, df: DataFrame, table: str, key: list[str], date: str,
                     before: Callable[[set[dt.date | None]], None] | None = None, counts: dict[str, int] | None = None) -> int:
        """Delete the rows that share a key with ``df`` wherever they are, then add ``df``.

        The key index tells which partitions hold such a row; they and the ones
        that receive a new row are rewritten, no other is read.  ``before``
        hears of them first.  A large load writes some of them at a time; one
        that breaks off in between is repeated, as any other.
        """
        new = df.withColumn(PART, self.part(F.col(date)))
        if not self.exists(table):
            return self._first_load(new, table, key, before)
        with self._indexed(new, table, key) as (wanted, hit, add):
            arriving = {r[0] for r in wanted.select(PART).distinct().collect()}
            if before is not None:
                before(hit | arriving)
            add()
            touched = hit | arriving
            rows, written, deleted = 0, set(), 0
            for some in self._portions(new, touched):
                held, left = Observation(), Observation()
                current = self.read_parts(table, some).observe(held, F.count(F.lit(1)).alias("n"))
                kept = current.join(wanted.select(*key).distinct(), key, "left_anti").observe(left, F.count(F.lit(1)).alias("n"))
                loaded, there = self._overwrite_parts(new if some == touched else new.filter(self._within(some)), table, kept)
                rows, written = rows + loaded, written | there
                if counts is not None:
                    deleted += _metric(held, "n", 0) - _metric(left, "n", 0)
            if counts is not None:
                counts["deleted"] = deleted
            self._drop_parts(table, touched - written)
            return rows

    @_own_shuffles
    def insert_absent(self, df: DataFrame, table: str, key: list[str], date: str,
                      before: Callable[[set[dt.date | None]], None] | None = None) -> int:
        """Add the rows whose key the table does not hold, whatever its date there.

        Only partitions that the key index names are read.  ``before`` hears of
        the partitions that may receive rows.
        """
        from stockloom.operators.facts import insert_absent
        new = df.withColumn(PART, self.part(F.col(date)))
        if not self.exists(table):
            return self._first_load(new, table, key, before)
        with self._indexed(new, table, key) as (wanted, hit, add):
            if before is not None:
                before({r[0] for r in wanted.select(PART).distinct().collect()})
            add()
            if hit:
                df = insert_absent(self.read_parts(table, hit), df, key)
            return self.append(df, table, date)

    def _first_load(self, new: DataFrame, table: str, key: list[str], before: Callable[[set[dt.date | None]], None] | None) -> int:
        """Write a fact that holds nothing yet, then make its key index from it: no row's keys are resolved twice."""
        if before is not None:
            before({r[0] for r in new.select(PART).distinct().collect()})
        rows = self._fill(new, table)
        if self.exists(table):
            KeyIndex(self, table, key, PART).rebuild()
        return rows

    @contextmanager
    def _indexed(self, new: DataFrame, table: str, key: list[str]) -> Iterator[tuple[DataFrame, set[dt.date | None], Callable[[], None]]]:
        """The different (key, partition) of a load, the partitions that the index names for its keys, and how to note the new pairs.

        The index is met once: its entries of these keys serve both.
        """
        index = KeyIndex(self, table, key, PART)
        layer = f"work.{uuid.uuid4().hex[:12]}"
        try:
            # written rather than kept: what is kept holds its shuffle files as well
            wanted = self._noted(new.select(*key, PART).distinct(), f"{layer}.wanted")
            index.ensure()
            known = index.entries(wanted)
            if known is not None:
                known = self._noted(known, f"{layer}.known")
            yield wanted, index.parts_of(known), lambda: index.add(wanted, known)
        finally:
            self.drop(layer)

    def _noted(self, df: DataFrame, table: str) -> DataFrame:
        df.write.parquet(self.path(table), compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def read_parts(self, table: str, parts: set[dt.date | None]) -> DataFrame:
        """Rows of these partitions (with their partition column); no other is read."""
        return self.spark.read.parquet(self.path(table)).filter(self._within(parts))

    def _within(self, parts: set[dt.date | None]) -> Column:
        days = sorted(p for p in parts if p is not None)
        chosen = F.col(PART).isin(days) if days else F.lit(False)
        return chosen | F.col(PART).isNull() if None in parts else chosen

    def _portions(self, new: DataFrame, parts: set[dt.date | None]) -> list[set[dt.date | None]]:
        """The partitions of a load, those of a large one dealt into portions whose shuffle files go before the next is written."""
        from stockloom.plans.slices import number
        n = min(number(new), max(1, len(parts)))
        ordered = sorted(parts, key=str)
        return [set(ordered[i::n]) for i in range(n)]

    def read_ranges(self, table: str, column: str, ranges: list[tuple[dt.date, dt.date]]) -> DataFrame:
        """Rows of closed date ranges that don't overlap; the partition filter is implied by them."""
        df, chosen = self.spark.read.parquet(self.path(table)), F.lit(False)
        for low, high in ranges:
            chosen = chosen | (F.col(PART).between(F.lit(self.part_of(low)), F.lit(self.part_of(high))) & F.col(column).between(F.lit(low), F.lit(high)))
        return df.filter(chosen).drop(PART)

    def replace_parts(self, df: DataFrame, table: str, date: str, parts: set[dt.date]) -> int:
        """Make these partitions exactly ``df``, whose rows lie in them; emptied ones go."""
        rows, written = self._overwrite_parts(df.withColumn(PART, self.part(F.col(date))), table)
        self._drop_parts(table, (self.parts(table) & parts) - written)
        return rows

    def reindex(self, table: str, key: list[str]) -> int:
        """Rebuild the key index of a fact without entries of rows that moved or were archived."""
        return KeyIndex(self, table, key, PART).rebuild()

    # versioned tables -------------------------------------------------------------------
    def _manifests(self, table: str) -> dict[int, list[str]]:
        """Committed versions, each with its folder and note; a manifest is written once and never changed."""
        fs, _ = self._fs(self.path(table))
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        out = {}
        for name in self._children(self.path(table)):
            if name.startswith(MANIFEST) and name[len(MANIFEST):].isdigit():
                stream = fs.open(path(f"{self.path(table)}/{name}"))
                try:
                    out[int(name[len(MANIFEST):])] = stream.readUTF().split("\n", 1)
                finally:
                    stream.close()
        return out

    def version_note(self, table: str) -> str | None:
        """What the newest version was committed with."""
        held = self._manifests(table)
        return held[max(held)][1] or None if held else None

    def fingerprint(self, path: str) -> str:
        """Digest of the names, sizes and times of all files below a path."""
        fs, p = self._fs(path)
        files, lines = fs.listFiles(p, True), []
        while files.hasNext():
            f = files.next()
            lines.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        return hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()

    def current_version(self, table: str) -> int | None:
        """The newest committed version."""
        return max((int(n[len(MANIFEST):]) for n in self._children(self.path(table)) if n.startswith(MANIFEST) and n[len(MANIFEST):].isdigit()), default=None)

    def read_version(self, table: str, version: int | None = None) -> DataFrame | None:
        """A version of a table, the newest one unless told; None if nothing is committed."""
        version = self.current_version(table) if version is None else version
        if version is None:
            return None
        return self.spark.read.parquet(f"{self.path(table)}/{self._manifests(table)[version][0]}")

    def swap(self, df: DataFrame | list[DataFrame], table: str, check: Callable[[DataFrame], None] | None = None, note: str = "") -> int:
        """Write a whole table, in one piece or several, beside the current version, then commit it.

        The rows go to a folder of their own, which a piece after the first adds to.  ``check`` sees them and may
        raise.  The commit is one new file that names the folder: it appears by
        a rename, which two writers can't both win, so a crash at any step
        leaves the version before readable and at most a folder to collect.
        """
        version = (self.current_version(table) or 0) + 1
        folder = f"version={version}-{uuid.uuid4().hex[:8]}"
        rows = 0
        for part in [df] if isinstance(df, DataFrame) else df:
            seen = Observation()
            part.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(f"{self.path(table)}/{folder}", compression=CODEC)
            rows += _metric(seen, "n", 0)
        if check is not None:
            check(self.spark.read.parquet(f"{self.path(table)}/{folder}"))
        self._commit(table, version, folder, note)
        return rows

    def _commit(self, table: str, version: int, folder: str, note: str = "") -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        target = path(f"{self.path(table)}/{MANIFEST}{version}")
        fs, draft = self._fs(f"{self.path(table)}/_draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.writeUTF(f"{folder}\n{note}")
        finally:
            stream.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"{table}: version {version} was committed by another writer")

    def collect_versions(self, table: str, keep: int = 2, older_than: dt.datetime | None = None) -> list[int]:
        """Retire all but the newest ``keep`` versions, and folders no manifest names; both only if older than a term.

        The term leaves time for readers of an old version and for a writer that
        has not committed yet.  A manifest goes before its folder.
        """
        limit = (older_than or dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=7)).timestamp() * 1000
        fs, root = self._fs(self.path(table))
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        held = self._manifests(table)
        changed = {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(root)}
        gone = [v for v in sorted(held)[:-keep] if changed[f"{MANIFEST}{v}"] < limit]
        for v in gone:
            fs.delete(path(f"{self.path(table)}/{MANIFEST}{v}"), False)
        named = {f for v, (f, _) in held.items() if v not in gone}
        for name, when in changed.items():
            if name.startswith(("version=", "_draft-")) and name not in named and when < limit:
                fs.delete(path(f"{self.path(table)}/{name}"), True)
        return gone

    def drop(self, name: str) -> None:
        """Remove a table, or all tables of a layer."""
        fs, p = self._fs(self.path(name))
        if fs.exists(p):
            fs.delete(p, True)

    def drop_batches(self, table: str, before: int) -> list[int]:
        """Remove staged batches with a smaller id; returns them."""
        staged = sorted(int(n.split("=")[1]) for n in self._children(self.path(table)) if n.startswith("etl_batch_id="))
        old = [b for b in staged if b < before]
        for b in old:
            fs, p = self._fs(f"{self.path(table)}/etl_batch_id={b}")
            fs.delete(p, True)
        return old

    # housekeeping -------------------------------------------------------------------------
    def drop_files(self, table: str, old: Column) -> int:
        """Remove the files of an unpartitioned table all of whose rows are ``old``; returns their rows."""
        files = (self.spark.read.parquet(self.path(table)).groupBy(F.col("_metadata.file_path").alias("file"))
                 .agg(F.bool_and(F.coalesce(old, F.lit(False))).alias("gone"), F.count(F.lit(1)).alias("n")).filter("gone").collect())
        jvm = self.spark.sparkContext._jvm
        fs, _ = self._fs(self.path(table))
        for f in files:
            fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f.file)), False)
        return sum(f.n for f in files)

    def drop_before(self, table: str, day: dt.date) -> list[dt.date]:
        """Remove partitions older than ``day``; returns them."""
        old = {p for p in self.parts(table) if p < self.part_of(day)}
        self._drop_parts(table, old)
        return sorted(old)

    def archive_before(self, table: str, archive: str, date: str, day: dt.date) -> int:
        """Move rows older than ``day`` to a table split by year, then drop their partitions.

        The archive keeps the source partition below the year, so repeating an
        interrupted run replaces what it had copied.
        """
        old = self.spark.read.parquet(self.path(table)).filter(F.col(PART) < F.lit(self.part_of(day)))
        seen = Observation()
        (old.withColumn("year", F.year(date)).hint("rebalance", PART).observe(seen, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", PART).parquet(self.path(archive), compression=CODEC))
        rows = _metric(seen, "n", 0)
        self.drop_before(table, day)
        return rows

    def export_csv(self, df: DataFrame, name: str) -> str:
        path = f"{self.root}/export/{name}"
        df.write.mode("overwrite").option("header", True).csv(path)
        return path
