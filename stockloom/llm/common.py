"""Helpers the operators share: tables, written intermediate results, running sums, components."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the contracts; a word is a run of anything else.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers that start from another folder find this package; clusters have it installed."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, env.get("PYTHONPATH"))))


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the folder all executors see; the warehouse where none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def again(df: DataFrame) -> DataFrame:
    """A second reading of what ``written`` wrote, for joining it with itself."""
    out = df.sparkSession.read.schema(df.schema).parquet(df._folder)
    out._folder = df._folder
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(df._folder)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def packed(docs: DataFrame, *beside: str, without: tuple[str, ...] = ()) -> DataFrame:
    """All columns but ``without`` as one struct ``_doc``, which no name inside can clash with, and the columns ``beside`` it that an operator works on."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in without)).alias("_doc"), *beside)


def unit(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that hashes the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def running(df: DataFrame, group: str, position: str, order: list[str], weight: str, out: str, per_bucket: int = 8192) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the rows of the group that come earlier by (position, order).

    ``position`` lies in [0, 1] and spreads the rows of a group evenly.  Each
    group is cut into slices of it; the slices' totals give every slice its
    start, and only one slice is sorted in a task, so a group that holds a
    third of all rows is still the work of many tasks.
    """
    n = max(1, df.count() // per_bucket)
    df = df.withColumn("_run_slice", F.least(F.floor(F.col(position) * n), F.lit(n - 1)))
    before = Window.partitionBy("_run_g").orderBy("_run_s").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(F.col(group).alias("_run_g"), F.col("_run_slice").alias("_run_s")).agg(F.sum(weight).alias("_run_sum"))
              .select("_run_g", "_run_s", F.coalesce(F.sum("_run_sum").over(before), F.lit(0)).alias("_run_start")))
    inside = (Window.partitionBy(group, "_run_slice").orderBy(position, *order).rowsBetween(Window.unboundedPreceding, -1))
    return (df.join(starts, same(F.col(group), F.col("_run_g")) & (F.col("_run_slice") == F.col("_run_s")))
            .withColumn(out, F.col("_run_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .drop("_run_slice", "_run_g", "_run_s", "_run_start"))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for the nodes of undirected ``edges(a, b)``: the smallest node that links reach.

    Alternating large and small stars: each round hangs neighbours on the
    smallest one, by grouped minima and joins whose hot keys Spark splits; no
    node's neighbours are gathered.  Every round is a written table.
    """
    def minima(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # large: both directions, hang larger neighbours on the least; small: smaller neighbours and the node itself
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
            pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = minima(both)
        moved = both.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a"))
        moved = moved.where("b > a") if large else moved
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out if large else out.union(least.select("a", F.col("m").alias("b")))

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = None
    for _ in range(rounds):
        new = written(star(star(now, True).where("a <> b").distinct(), False).where("a <> b").distinct())
        discard(now)
        now = new
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
    else:
        raise RuntimeError(f"components not stable after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
