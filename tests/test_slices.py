"""Queries by item in slices of the items: the same rows as at once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockloom.operators import models as M, serving as V
from stockloom.plans import slices
from stockloom.plans.serving import ServingLayer
from stockloom.sources.tables import SourceTables
from tests.conftest import values

DAY = dt.date(2000, 6, 30)


@pytest.fixture
def source(spark, data, monkeypatch):
    """Tables some of whose lines have no item, in files of several slices."""
    monkeypatch.setattr(slices, "SLICE_BYTES", 100_000)
    t = SourceTables(spark, data)
    t._plans["lineitem"] = t.lineitem.withColumn("l_partkey", F.when(F.col("l_orderkey") % 50 != 0, F.col("l_partkey")))
    return t


def test_slices_give_the_rows_of_the_whole(source):
    builds = {"snapshot": lambda t: M.inventory_snapshot(t, DAY),
              "risk": lambda t: V.inventory_risk(M.inventory_snapshot(t, DAY), M.dispensing(t, M.valued_lots(t)), DAY)}
    for name, build in builds.items():
        whole, parts = build(source), list(slices.cut(source, build))
        assert len(parts) == slices.number(whole) > 1
        counts = [p.count() for p in parts]
        assert sum(c > 0 for c in counts) > 1 and max(counts) < whole.count()
        assert values(slices.in_slices(source, build, name)) == values(whole), name


def test_stored_tables_are_made_in_slices(spark, data, store, monkeypatch):
    whole = SourceTables(spark, data)
    snap = M.inventory_snapshot(whole, DAY)
    want = values(V.exec_dashboard(snap, M.dispensing(whole, snap), M.budget_summary(whole.bdg_amt, whole.bdg_type), DAY))
    monkeypatch.setattr(slices, "SLICE_BYTES", 100_000)
    layer = ServingLayer(spark, data, store, DAY)
    layer.refresh(("serving.exec_dashboard",))
    assert values(layer.read("serving.exec_dashboard")) == want
    assert layer.read("model.dispensing").count() == M.dispensing(whole, snap).count()
    assert layer.refresh(("serving.exec_dashboard",)) == []


def test_a_large_load_is_written_in_portions_and_can_be_repeated(spark, store, tmp_path, monkeypatch):
    day = lambda k: dt.date(2000, 1 + k % 6, 3)
    kind = "k bigint, d date, v bigint"
    saved = lambda name, rows: spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/{name}") or spark.read.parquet(f"{tmp_path}/{name}")
    first = saved("first", [(k, day(k), 1) for k in range(60)] + [(60, None, 1)])
    moved = saved("moved", [(k, day(k + 1), 2) for k in range(0, 70, 3)])
    monkeypatch.setattr(slices, "SLICE_BYTES", sum(f.stat().st_size for f in (tmp_path / "first").glob("*.parquet")) // 3 + 1)
    assert slices.number(first) == 3
    written = []
    monkeypatch.setattr(store, "_overwrite_parts", lambda *x, f=store._overwrite_parts: written.append(1) or f(*x))
    assert store.replace_keys(first, "core.t", ["k"], "d") == 61 and len(written) == 3
    writes, counts = len(written), {}
    broken = lambda *x, f=store._overwrite_parts: f(*x) if len(written) == writes else pytest.fail("broken on purpose")
    with monkeypatch.context() as m:
        m.setattr(store, "_overwrite_parts", broken)
        with pytest.raises(pytest.fail.Exception):
            store.replace_keys(moved, "core.t", ["k"], "d")
    store.replace_keys(moved, "core.t", ["k"], "d", counts=counts)
    assert len(written) >= writes + 3
    want = [(k, day(k), 1) for k in range(60) if k % 3] + [(k, day(k + 1), 2) for k in range(0, 70, 3) if k != 60] + [(60, day(61), 2)]
    assert values(store.read("core.t"), "k", "d", "v") == sorted(want, key=str)
    store.replace_keys(moved, "core.t", ["k"], "d", counts=counts)
    assert counts["deleted"] == 24 and values(store.read("core.t"), "k", "d", "v") == sorted(want, key=str)
    assert not store.exists("work")
