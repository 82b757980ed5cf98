import datetime as dt

import pytest

from stockloom.plans.store import Store, work_folder
from stockloom.session import local_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "stockloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def store(spark):
    return Store(spark, work_folder(spark, "test"))


@pytest.fixture
def as_of():
    return dt.date(2026, 4, 1)


def values(df, *columns):
    """Rows as tuples, sorted as text so NULLs compare."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=str)
