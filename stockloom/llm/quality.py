"""Quality rules with thresholds that adapt to each language and source (native)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, packed, same, written

#: Width of the windows that look for repeated words.
WINDOW = 5
#: A document needs so many words, and at most this share of repeated ones.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


@dataclass(frozen=True)
class Rule:
    """Reject above q75 + reach * (q75 - q25) + slack, of the document's own language and source."""
    name: str
    value: str
    reach: int
    slack: int


#: Values are whole numbers: per mille, or hundredths of a character.
RULES = (
    Rule("symbols", "1000 * n_symbols div word_chars", 4, 60),
    Rule("capitals", "1000 * n_capitals div word_chars", 4, 250),
    Rule("marks", "1000 * n_marks div word_chars", 4, 180),
    Rule("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 4, 350),
    Rule("word_length", "100 * word_chars div n_words", 4, 600),
)


def _bound(value: Column, f) -> Column:
    """``f`` on ``value`` computed once: inside a lambda the value is a variable, not a copied expression."""
    return F.element_at(F.transform(F.array(value), f), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the array.

    Windows are compared by 64-bit hashes.  Few texts repeat any, which one
    distinct count tells; the others sort their windows.  Linear memory in the
    text, and n log n time.
    """
    def windows(h: Column) -> Column:
        at = lambda i, k: F.get(h, i + F.lit(k))
        return F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *(at(i, k) for k in range(1, WINDOW))))

    def covered(g: Column) -> Column:
        pairs = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        twice = lambda s: F.array_sort(F.transform(F.filter(
            F.transform(s, lambda e, k: F.struct(e["i"].alias("i"), (
                F.coalesce(e["x"] == F.get(s, k - 1)["x"], F.lit(False)) | F.coalesce(e["x"] == F.get(s, k + 1)["x"], F.lit(False))).alias("t"))),
            lambda e: e["t"]), lambda e: e["i"]))
        total = lambda p: F.aggregate(
            p, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n"), i.alias("last")),
            lambda acc: acc["n"])
        return _bound(pairs, lambda s: _bound(twice(s), total))

    return _bound(F.transform(words, lambda w: F.xxhash64(w)),
                  lambda h: _bound(windows(h), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g))))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of its texts; a null text counts as an empty one.

    Earlier columns of these names are replaced.
    """
    # the separator class is a single regular expression; the empty piece before leading space goes
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), f"[{SPACE}]+"), "")
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    chars = F.array_join(F.col("_w"), "")
    without = lambda c, keep: F.length(F.regexp_replace(c, f"[^{keep}]+", ""))
    return (docs.withColumn("_w", words).withColumn("_l", lines).withColumn("_c", chars)
            .withColumns({
                "n_words": F.size("_w").cast("long"), "word_chars": F.length("_c").cast("long"),
                "n_symbols": without(F.col("_c"), "#*$%&|<>").cast("long"), "n_capitals": without(F.col("_c"), "\\p{Lu}").cast("long"),
                "n_marks": without(F.col("_c"), "!?.,;:").cast("long"), "n_lines": F.size("_l").cast("long"),
                "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
                "n_repeat_words": repeated_words(F.col("_w")).cast("long")})
            .drop("_w", "_l", "_c"))


def bin_of(value: Column) -> Column:
    """A whole number with its top eight bits kept: at most 1/128 off, and a few thousand bins for any range."""
    step = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - 8, F.lit(0))).cast("long")
    return value - value % step


def sketches(values: DataFrame) -> DataFrame:
    """One histogram of fixed bins per (lang, source, rule): a quantile sketch that merges by adding counts."""
    stacked = values.select("lang", "source", F.explode(F.array(*(
        F.struct(F.lit(r.name).alias("rule"), bin_of(F.expr(r.value)).alias("bin")) for r in RULES))).alias("e"))
    return stacked.groupBy("lang", "source", "e.rule", "e.bin").agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, limits per rule) from the quartiles of the histograms, whose rows per group are bounded."""
    group = ["lang", "source", "rule"]
    w = Window.partitionBy(*group)
    up = sketch.select(*group, "bin", F.sum("n").over(w.orderBy("bin")).alias("upto"), F.sum("n").over(w).alias("total"))
    q = up.groupBy(*group).agg(*(F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bin"))).alias(f"q{k}") for k in (1, 3)))
    limit = lambda r: F.max(F.when(F.col("rule") == r.name, F.col("q3") + (F.col("q3") - F.col("q1")) * r.reach + r.slack)).alias(f"_max_{r.name}")
    return q.groupBy("lang", "source").agg(*map(limit, RULES))


def judged(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with counts, ``base_failed`` and ``kept``; all rows stay.

    base_failed: under ten words, or over a fifth of the words repeated.  Other
    documents are kept unless a value passes the threshold of their language
    and source, which quantile sketches of all documents that passed the base
    give; a null language or source is a group of its own.  Null and empty
    texts have no words and fail; repeated rows are judged alike; an empty
    table stays empty.
    """
    counted = measured(docs).withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))
    if keep is not None:
        counted = counted.drop(*(c for c in docs.columns if c not in (*keep, "lang", "source")))
    table = written(counted)
    limits = thresholds(sketches(table.where("not base_failed"))).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = table.join(limits, same(F.col("lang"), F.col("_lang")) & same(F.col("source"), F.col("_source")), "left")
    fits = [bin_of(F.expr(r.value)) <= F.col(f"_max_{r.name}") for r in RULES]
    verdict = fits[0]
    for f in fits[1:]:
        verdict = verdict & f
    return (joined.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(verdict, F.lit(False))))
            .drop("_lang", "_source", *(f"_max_{r.name}" for r in RULES)))


def passed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all of its columns as they were, whatever their names."""
    return judged(packed(docs, "text", "lang", "source"), ("_doc",)).where("kept").select("_doc.*")
