"""The quality classifier: exact sums, calibration, odd rows and held-out rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.llm import fourier

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def stats(spark, documents):
    return fourier.written(fourier.statistics(documents))


def as_train(spark, stats, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    return stats.join(labels, "doc_id").select(*fourier.STATISTICS, (F.col("quality") * fourier.STEPS).cast("long").alias("y"),
                                               F.pmod(F.xxhash64(*fourier.STATISTICS), F.lit(fourier.FOLDS)).cast("int").alias("fold"))


def test_normal_equations_do_not_depend_on_partitions(spark, stats, data):
    train = as_train(spark, stats, data)
    model = fourier.unfitted(train)
    one, many = (fourier.normal_equations(train.repartition(n), model) for n in (1, 13))
    assert all((x == y).all() for x, y in zip(one, many))
    rows = train.toPandas()
    f = model.features(rows[list(fourier.STATISTICS)].to_numpy(float)) / fourier.STEPS
    assert np.allclose(one[0].sum(0), f.T @ f) and np.allclose(one[1].sum(0), f.T @ (rows.y.to_numpy() / fourier.STEPS))


def test_features_approximate_the_gaussian_kernel():
    r = np.random.default_rng(1)
    k, n = len(fourier.STATISTICS), 4000
    z = r.normal(size=(20, k))
    d, p = r.normal(size=(k, n)) / np.sqrt(k), r.uniform(0, 2 * np.pi, n)
    m = fourier.Model(np.zeros(k), np.ones(k), d, p, np.zeros(n + 1), np.zeros(1), np.zeros(1))
    f = m.features(z)[:, :-1] / fourier.STEPS
    want = np.exp(-((z[:, None] - z[None]) ** 2).sum(2) / (2 * k))
    assert np.abs(2 * f @ f.T / n - want).max() < 0.1


def test_isotonic_equals_brute_force():
    r = np.random.default_rng(2)
    for _ in range(50):
        n = int(r.integers(1, 9))
        w, x = r.integers(1, 5, n).astype(float), np.arange(n, dtype=float)
        y = r.integers(0, 4, n) / 3 * w
        at, value = fourier.isotonic(x, y, w)
        # min-max formula: the level at i is the least over j >= i of the greatest mean of any stretch from k <= i to j
        want = [min(max(y[k:j + 1].sum() / w[k:j + 1].sum() for k in range(i + 1)) for j in range(i, n)) for i in range(n)]
        assert sorted(set(np.round(want, 9))) == sorted(set(np.round(value, 9))) and (np.diff(at) > 0).all()


def test_held_out_rows(spark, data):
    big = data.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    out = fourier.classified(spark.read.parquet(f"{big}/documents.parquet"), labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in out)
    held = [r for r in out if r.held_out]
    good, bad = [[r.score for r in held if r.quality == q] for q in (1, 0)]
    auc = np.mean([np.mean([(g > b) + (g == b) / 2 for b in bad]) for g in good])
    accuracy = np.mean([r.predicted == r.quality for r in held])
    print(f"held-out AUC {auc:.4f} accuracy {accuracy:.4f} of {len(held)}")
    assert auc > 0.97 and accuracy > 0.95


def test_labels_of_held_out_rows_change_nothing(spark, documents, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    lies = labels.withColumn("quality", F.when(fourier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = lambda x: sorted(fourier.classified(documents, x).collect())
    assert rows(labels) == rows(lies.repartition(5))


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, 0), (6, 1, 1), (4, 0, 0)], LABELS)
    out = fourier.classified(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (None, 1, 2)}) == 1  # no text, whatever its spelling
    assert fourier.classified(empty, labels).collect() == []
    assert {r.score for r in fourier.classified(odd, labels.limit(0)).collect()} == {0.5}
    assert all(r.predicted == 1 for r in fourier.classified(odd, labels.withColumn("quality", F.lit(1))).collect())
