"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, discard, packed, running, same, unit, written

#: Weights of the sources in code-point order, repeating; and how often a source may be repeated.
WEIGHTS, MOST_EPOCHS = (1, 2, 3), 3
#: A source is done within this share of its target.
NEAR = 0.002


def quality_weight(text: Column) -> Column:
    """0.1 to 1: the share of characters that are not digits, signs or symbols, as plain prose has few."""
    n = F.length(text)
    return F.when(n > 0, 0.1 + 0.9 * F.length(F.regexp_replace(text, "[0-9#*$%&|<>!=_{}\\\\]+", "")) / n).otherwise(F.lit(0.1))


def keyed(docs: DataFrame, seed: int = 7, quality: Column | None = None) -> DataFrame:
    """``docs`` with ``size`` in words and the sampling key: an exponential variable divided by the quality weight.

    ``_at`` is the key on [0, 1).  ``_tie`` orders equal keys by content.
    """
    text = F.coalesce("text", F.lit(""))
    u = unit(F.col("doc_id"), text, seed=seed)
    rate = quality_weight(text) if quality is None else quality
    return (docs.withColumn("size", F.regexp_count(text, F.lit(WORD)).cast("long"))
            .withColumn("_at", 1 - F.exp(F.log1p(-u) / rate))
            .withColumn("_tie", F.xxhash64(F.lit(seed + 1), "doc_id", text)))


def targets(rows: DataFrame) -> DataFrame:
    """(source, source_size, target): weights share all words, no source above its limit, the excess shared anew.

    Filling by weight until a source is full is one level for all that are not
    full: with the sources ordered by limit over weight, the level follows from
    running sums.  One row per source.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS) + 1).cast("int"))
    fill = Window.orderBy("_full", F.col("source").asc_nulls_last())
    level = (sizes.withColumn("_weight", w).withColumn("_limit", F.col("source_size") * MOST_EPOCHS).withColumn("_full", F.col("_limit") / F.col("_weight"))
             .withColumn("_total", F.sum("source_size").over(Window.partitionBy()))
             .withColumn("_rest", F.col("_total") - F.coalesce(F.sum("_limit").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("_open", F.sum("_weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
             .withColumn("_level", F.col("_rest") / F.col("_open"))
             .withColumn("_top", F.min(F.when(F.col("_level") <= F.col("_full"), F.struct("_full", "_level"))).over(Window.partitionBy())["_level"]))
    return level.select("source", "source_size", F.least(F.col("_limit").cast("double"), F.col("_weight") * F.col("_top")).alias("target"))


def decided(rows: DataFrame) -> DataFrame:
    """Per source: target, whole epochs, and the stretches of keys that the last, partial epoch takes.

    The partial epoch takes documents by ascending key as long as they fit into
    what is left of the target.  Where the document that stops it is large, the
    next stretch goes on behind it with documents small enough, until the
    source is within ``NEAR`` of its target or nothing fits.  What a stretch
    leaves is less than the document that stopped it, so the rest is about
    halved each time where sizes are mixed: some ten stretches are to be
    expected, whatever the size of the corpus.  Sizes made to resist need more.
    """
    plan = written(targets(rows)
                   .withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
                   .withColumn("_gap", F.col("target") - F.col("_epochs") * F.col("source_size"))
                   .withColumn("_parts", F.array().cast("array<struct<start:struct<_at:double,_tie:bigint>,last:struct<_at:double,_tie:bigint>,fit:double>>"))
                   .withColumn("_last", F.struct(F.lit(-1.0).alias("_at"), F.lit(0).cast("long").alias("_tie"))))
    key = F.struct("_at", "_tie")
    moved = True
    while moved:
        todo = plan.where((F.col("_gap") >= 1) & (F.col("_gap") > NEAR * F.col("target"))).select(F.col("source").alias("_source"), "_gap", F.col("_last").alias("_start"))
        left = (rows.select("source", "size", "_at", "_tie").join(todo, same(F.col("source"), F.col("_source")))
                .where((key > F.col("_start")) & (F.col("size") <= F.col("_gap"))))
        sums = running(left.drop("_source", "_start"), "source", "_at", ["_tie"], "size", "_before")
        took = (sums.where(F.col("_before") + F.col("size") <= F.col("_gap")).groupBy(F.col("source").alias("_source"))
                .agg(F.max(key).alias("_end"), F.sum("size").alias("_took")))
        part = F.struct(F.col("_last").alias("start"), F.col("_end").alias("last"), F.col("_gap").alias("fit"))
        new = written(plan.join(took, same(F.col("source"), F.col("_source")), "left").select(
            "source", "source_size", "target", "_epochs", (F.col("_gap") - F.coalesce("_took", F.lit(0))).alias("_gap"),
            F.when(F.col("_end").isNull(), F.col("_parts")).otherwise(F.concat("_parts", F.array(part))).alias("_parts"),
            F.coalesce("_end", "_last").alias("_last"), F.col("_end").isNotNull().alias("_moved")))
        discard(plan)
        plan, moved = new, not new.where("_moved").isEmpty()
    return plan.select(F.col("source").alias("_plan_source"), "source_size", "target", "_epochs", "_parts")


def mixed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``keyed`` rows with source_size, target, copies (epochs) and taken (words)."""
    joined = rows.join(plan, same(F.col("source"), F.col("_plan_source")))
    key = F.struct("_at", "_tie")
    part = F.exists("_parts", lambda p: (key > p["start"]) & (key <= p["last"]) & (F.col("size") <= p["fit"]))
    return (joined.withColumn("copies", F.col("_epochs") + part.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
            .drop("_plan_source", "_epochs", "_parts", "_at", "_tie"))


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Every document with its copies in a mix whose sources come near their target sizes.

    Null or empty texts have size 0: they are never counted, and follow the
    rule by key.  A null source is the last one.  Exactly repeated rows share
    a key and are taken together.  The same input and seed give the same mix.
    """
    narrow = written(keyed(docs.select("doc_id", "text", "source"), seed).drop("text"))
    return mixed(narrow, decided(narrow))


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: documents as rows, each as often as it is taken, with the columns of ``docs``, whatever their names."""
    narrow = written(keyed(docs.select("doc_id", "text", "source"), seed).drop("text", "doc_id"))
    out = mixed(keyed(packed(docs, "doc_id", "text", "source"), seed), decided(narrow))
    return out.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")
