"""From raw documents to training sequences: quality, near copies, privacy, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockloom.llm import mixing, neardup, packing, privacy, quality
from stockloom.llm.common import read, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the adaptive thresholds."""
    return quality.passed(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the least id, of each class of near copies."""
    return neardup.without_copies(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the text."""
    return privacy.surrogate_texts(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as rows as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def window_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_copies", near_copies), ("surrogates", surrogates),
          ("source_mix", source_mix), ("window_packing", window_packing)]

#: Sketches of near copies, keyed surrogates and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
