"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from stockloom.catalog import QUERIES, full_sql, run
from tests.compare import connect, differences

# rebuilt as golden tests on the store, and checked in full by tests/check.py
SLOW = ("job_01_daily", "job_03_repair", "job_04_backfill")


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_equals_sql(name, spark, data, duck):
    q = QUERIES[name]
    assert differences(run(q, spark, data), duck, full_sql(q.sql)) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
