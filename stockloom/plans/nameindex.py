"""Names found by any part of them: stored trigrams beside the names, dealt into buckets, and those into blocks, by hash.

A trigram lists the blocks in which some name has it, not the names: names share most
trigrams, so the lists grow by a fraction of what the names have.  A search reads the
buckets of the rarest trigrams of its pattern, reads the blocks that have all of them, keeps
the names there that have them and matches the pattern itself on those.  So the rows
are those of a scan, and what is read follows the number of blocks with candidates.  A pattern without three fixed
characters in a row has no trigram and reads all names.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.plans.store import Store

BUCKET = "name_bucket"
#: Names per bucket that a build aims at, and the fewest buckets.
NAMES_PER_BUCKET, LEAST_BUCKETS = 200_000, 16
#: Blocks per bucket, so some thousand names in a block of a full bucket.
BLOCKS = 64
#: Trigrams of a pattern that are looked up, the rarest first; all others are left to the match.
LOOKED_UP = 4
SCHEMAS = {"names": f"kind string, code string, text string, block int, {BUCKET} int", "postings": f"gram string, block int, {BUCKET} int",
           "grams": "gram string, n bigint"}


def trigrams(text: Column) -> Column:
    """The different runs of three characters of a text in capitals."""
    t = F.upper(text)
    starts = F.when(F.length(t) >= 3, F.sequence(F.lit(1), F.length(t) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(t, i, F.lit(3))))


def fixed_runs(pattern: str) -> list[str]:
    """The stretches of a LIKE pattern that stand for themselves."""
    runs, now, escaped = [], "", False
    for c in pattern:
        if not escaped and c == "\\":
            escaped = True
        elif not escaped and c in "%_":
            runs.append(now)
            now = ""
        else:
            now, escaped = now + c, False
    return [r for r in (*runs, now) if len(r) >= 3]


class NameIndex:
    """Names of one kind of search.  ``names`` are rows (kind, code, text); a kind says what ``code`` is a key of.

    A build goes to a folder of its own and is used once it is whole; older ones are then deleted.
    """

    def __init__(self, store: Store, name: str):
        self.store, self.name = store, f"index.{name}"

    def _whole(self) -> list[str]:
        """Folders of whole builds, oldest first."""
        root = self.store.path(self.name)
        builds = [n for n in self.store._children(root) if n.startswith("build-") and n.count("-") == 3 and "_SUCCESS" in self.store._children(f"{root}/{n}/grams")]
        return sorted(builds, key=lambda n: int(n.split("-")[1]))

    def build(self, names: DataFrame) -> int:
        """Index ``names``; returns how many there are.  A null text is no name; equal rows are one."""
        root = self.store.path(self.name)
        old = [n for n in self.store._children(root) if n.startswith("build-")]
        number = max((int(n.split("-")[1]) for n in old), default=0) + 1
        rows = names.filter("text IS NOT NULL").select("kind", "code", "text").distinct().persist(StorageLevel.DISK_ONLY)
        try:
            held, buckets = rows.count(), LEAST_BUCKETS
            while buckets * NAMES_PER_BUCKET < held:
                buckets *= 2
            path = f"{root}/build-{number}-{buckets}-{BLOCKS}"
            block = self._bucket(F.xxhash64("kind", "code", "text"), buckets * BLOCKS)
            self._write(rows.withColumn("block", block).withColumn(BUCKET, F.col("block") % buckets), "block", f"{path}/names")
        finally:
            rows.unpersist()
        # the names of a block lie together, so most of what repeats in it goes before the shuffle
        long = self._read(path, "names").select("block", F.upper("text").alias("t"))
        grams = (long.filter(F.length("t") >= 3).select("block", "t", F.explode(F.sequence(F.lit(1), F.length("t") - 2)).alias("i"))
                 .select(F.substr("t", F.col("i"), F.lit(3)).alias("gram"), "block").distinct())
        self._write(grams.withColumn(BUCKET, self._bucket(F.xxhash64("gram"), buckets)), "gram", f"{path}/postings")
        counts = self._read(path, "postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        counts.write.parquet(f"{path}/grams")
        for n in old:
            fs, p = self.store._fs(f"{root}/{n}")
            fs.delete(p, True)
        return held

    @staticmethod
    def _bucket(hashed: Column, buckets: int) -> Column:
        return F.pmod(hashed, F.lit(buckets)).cast("int")

    def _read(self, path: str, part: str) -> DataFrame:
        return self.store.spark.read.schema(SCHEMAS[part]).parquet(f"{path}/{part}")

    @staticmethod
    def _write(df: DataFrame, order: str, path: str) -> None:
        """By bucket, sorted inside, so a filter on ``order`` skips row groups; a bucket with a frequent trigram is split."""
        df.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, order).write.partitionBy(BUCKET).parquet(path)

    def candidates(self, pattern: str) -> DataFrame:
        """Names (kind, code, text) that have the looked-up trigrams of a LIKE pattern: all that match, and some others."""
        whole = self._whole()
        if not whole:
            raise ValueError(f"{self.name} has not been built")
        spark, path, buckets = self.store.spark, f"{self.store.path(self.name)}/{whole[-1]}", int(whole[-1].split("-")[2])
        names = self._read(path, "names")
        runs = fixed_runs(pattern)
        if not runs:
            return names.select("kind", "code", "text")
        wanted = spark.createDataFrame([(r,) for r in runs], "run string").select(F.explode(trigrams(F.col("run"))).alias("gram")).distinct()
        grams = [r.gram for r in wanted.collect()]  # as many as the pattern is long
        known = self._read(path, "grams").filter(F.col("gram").isin(grams)).orderBy("n", "gram").collect()
        if len(known) < len(grams):
            return names.filter(F.lit(False)).select("kind", "code", "text")
        rare = [r.gram for r in known[:LOOKED_UP]]
        picked = spark.createDataFrame([(g,) for g in rare], "gram string").select(self._bucket(F.xxhash64("gram"), buckets)).distinct()
        in_buckets = [r[0] for r in picked.collect()]
        found = (self._read(path, "postings").filter(F.col(BUCKET).isin(in_buckets) & F.col("gram").isin(rare))
                 .groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= len(rare)).select("block"))
        touched = [r[0] for r in found.select(F.col("block") % buckets).distinct().collect()]  # at most one value per bucket
        near = names.filter(F.col(BUCKET).isin(touched)).join(found, "block", "left_semi")
        for gram in rare:
            near = near.filter(F.contains(F.upper("text"), F.lit(gram)))
        return near.select("kind", "code", "text")

    def search(self, pattern: str) -> DataFrame:
        """(kind, code) of the names like ``pattern``, whatever their capitals; each once."""
        like = F.like(F.upper("text"), F.upper(F.lit(pattern)))
        return self.candidates(pattern).filter(like).select("kind", "code").distinct()


def catalogue_names(t) -> DataFrame:
    """Names of items and trade products, and other names by which either is known."""
    return (t.drug_gn.select(F.lit("item").alias("kind"), F.col("WORKING_CODE").alias("code"), F.col("DRUG_NAME").alias("text"))
            .unionByName(t.drug_vn.select(F.lit("trade").alias("kind"), F.col("TRADE_CODE").alias("code"), F.col("TRADE_NAME").alias("text")))
            .unionByName(t.inst_name.select(F.lit("alias").alias("kind"), F.col("REF_CODE").alias("code"), F.col("INST_NAME").alias("text"))))
