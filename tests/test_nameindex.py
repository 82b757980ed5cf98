"""Searches through the stored trigrams against a plain scan."""

import re

import pytest

from stockloom.plans import nameindex as N

NAMES = [("item", "1", "Blue Ring Widget"), ("item", "2", "ring"), ("item", "3", "String 100%"), ("item", "4", None), ("item", "5", ""), ("item", "6", "ab"),
         ("trade", "1", "RING of steel"), ("alias", "1", "bearing"), ("alias", "1", "The ring"), ("alias", "1", "The ring"), ("item", "7", "a_b%c\\d ring"),
         ("item", "8", "r_ing"), ("item", "9", "Ärztering"), ("item", "10", "ringringring")]


@pytest.fixture
def index(spark, store):
    index = N.NameIndex(store, "test")
    assert index.build(spark.createDataFrame(NAMES, "kind string, code string, text string")) == 12
    return index


def plain(pattern):
    """The rows a scan finds: a LIKE pattern as a regular expression."""
    parts, escaped = [], False
    for c in pattern.upper():
        if c == "\\" and not escaped:
            escaped = True
            continue
        parts.append(re.escape(c) if escaped or c not in "%_" else {"%": ".*", "_": "."}[c])
        escaped = False
    return {(k, c) for k, c, t in NAMES if t is not None and re.fullmatch("".join(parts), t.upper(), re.S)}


@pytest.mark.parametrize("pattern", ["%ring%", "ring%", "%ring", "%RiNg%", "%r_ng%", "%ing%wid%", "%absent%", "%in%", "%", "", "ab", "%\\%", "%a\\_b%", "r\\_ing", "%ärz%",
                                     "%ringring%", "_tring%"])
def test_search_equals_scan(index, pattern):
    assert {tuple(r) for r in index.search(pattern).collect()} == plain(pattern)


def test_only_candidates_are_read(spark, store):
    names = spark.range(4000).selectExpr("'item' AS kind", "CAST(id AS STRING) AS code", "concat('common name ', CAST(id AS STRING), CASE WHEN id = 777 THEN ' zirconia' ELSE '' END) AS text")
    index = N.NameIndex(store, "many")
    index.build(names)
    assert index.candidates("%common%zirconia%").count() == 1
    assert [tuple(r) for r in index.search("%name%ZIRC%").collect()] == [("item", "777")]
    plan = index.candidates("%zirconia%")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [name_bucket" in plan and "name_bucket#" in plan


def test_a_build_replaces_the_last_and_a_broken_one_is_not_used(spark, store):
    index = N.NameIndex(store, "again")
    with pytest.raises(ValueError, match="not been built"):
        index.search("%x%")
    schema = "kind string, code string, text string"
    index.build(spark.createDataFrame([("item", "1", "first name")], schema))
    index.build(spark.createDataFrame([("item", "2", "second name")], schema))
    spark.range(1).write.parquet(f"{store.path('index.again')}/build-9-16/postings")
    assert [r.code for r in index.search("%name%").collect()] == ["2"]
    index.build(spark.createDataFrame([], schema))
    assert index.search("%name%").count() == index.search("%").count() == 0


def test_trigrams_are_listed_per_block_not_per_name(spark, store):
    names = spark.range(20_000).selectExpr("'item' AS kind", "CAST(id AS STRING) AS code", "concat('common name of item ', CAST(id % 10 AS STRING), ' ', CAST(id AS STRING)) AS text")
    index = N.NameIndex(store, "blocks")
    assert index.build(names) == 20_000
    folder = f"{store.path('index.blocks')}/{index._whole()[-1]}"
    held = spark.read.parquet(f"{folder}/postings").count()
    assert held < names.select(N.F.size(N.trigrams(N.F.col("text"))).alias("n")).agg(N.F.sum("n")).first()[0] / 4
    assert index.search("%item 7 %77").count() == names.filter("text LIKE '%item 7 %77'").count() > 0
