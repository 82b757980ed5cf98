"""Columns with clashing names come back as they were; vectors without ids, of other lengths and with labels of any type."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stockloom.llm import embeddings, mixing, privacy, quality

NAMES = ("size", "kept", "n", "target", "source_size", "taken", "copies", "_at", "_tie", "n_words", "base_failed", "_hit", "n_entities", "_m", "lines", "_copy")


@pytest.fixture
def clashing(odd):
    more = odd.union(odd.sparkSession.createDataFrame([(9, "Mary Jones wrote to mary.jones@example.org about it. " * 3, "en", "x", 1, "own", "own", 1)], odd.schema))
    return more.drop(*NAMES).withColumns({n: F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for n in NAMES})


def rows(df, *without):
    return Counter(tuple(r) for r in df.drop(*without).collect())


def test_stages_return_clashing_columns_untouched(spark, clashing):
    plain = clashing.drop(*NAMES)
    passed = quality.passed(clashing)
    assert passed.columns == clashing.columns
    assert rows(passed, *NAMES) == rows(quality.judged(plain).where("kept").select(*plain.columns))
    assert rows(passed) <= rows(clashing)
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns == clashing.columns and rows(mixed, *NAMES) == rows(mixing.mixed_documents(plain)) and set(rows(mixed)) <= set(rows(clashing))
    safe = privacy.surrogate_texts(clashing)
    assert safe.columns == clashing.columns
    assert rows(safe, *NAMES, "n_chars") == rows(privacy.replaced(plain).select(*plain.columns), "n_chars")
    assert rows(safe, "text", "n_chars") == rows(clashing, "text", "n_chars")
    assert "mary.jones" not in " ".join(r.text or "" for r in safe.collect())


def test_pipeline_stages_keep_clashing_columns(spark, clashing):
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, clashing, "").columns == clashing.columns


def vectors(spark, data, label="int"):
    return spark.createDataFrame([(i, x, [float(v) for v in e] if e is not None else None) for i, x, e in data], f"vec_id bigint, label {label}, embedding array<double>")


def test_an_id_with_and_without_a_label_keeps_both_rows(spark):
    a, b = [1.0, 0, 0, 0], [0.999, 0.01, 0, 0]
    got = sorted(map(tuple, embeddings.near_copies(vectors(spark, [(1, 0, a), (1, None, a), (2, 0, b)])).collect()))
    assert got == [(1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False)]


def test_vectors_without_an_id(spark):
    a, b, c = [1.0, 0, 0, 0], [0.999, 0.01, 0, 0], [0, 0, 1.0, 0]
    got = Counter(map(tuple, embeddings.near_copies(vectors(spark, [(None, 0, a), (7, 0, b), (None, 0, c), (None, None, None)])).collect()))
    assert got == Counter([(None, 1, 7, False), (7, 1, 7, True), (None, 0, None, True), (None, 0, None, True)])


def test_every_length_links(spark):
    data = [(1, 0, [1, 0, 0, 0]), (2, 0, [1, 0.01, 0, 0]), (3, 0, [1, 0, 0]), (4, 0, [1, 0, 0]), (5, 0, [2.0]), (6, 0, [3.0]), (7, 0, [-1.0]), (8, 1, [1, 0, 0]),
            (9, 0, [1e200, 0, 0]), (10, 0, [0, 0, 0]), (11, 0, []), (12, 0, [1, 0, 0, 0, 0, 0, 0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_copies(vectors(spark, data)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (2, 3), 9: (2, 3), 5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (0, 8), 10: (0, 10), 11: (0, 11), 12: (0, 12)}


@pytest.mark.parametrize("kind, one, two", [("bigint", 1 << 40, (1 << 40) + 1), ("string", "a", "b")])
def test_labels_of_any_type(spark, kind, one, two):
    e = [1.0, 2.0]
    got = {r.vec_id: r.component_id for r in embeddings.near_copies(vectors(spark, [(1, one, e), (2, one, e), (3, two, e)], kind)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_made_up_links_lie_at_the_cosine():
    x = embeddings.unit_rows(np.random.default_rng(0).normal(size=(300, 32)))
    first, second = embeddings.codebook(x[:, :16], 8), embeddings.codebook(x[:, 16:], 8)
    found = embeddings.planted(x, first, second, 0.93)
    assert found.shape == (300, 3) and (found[:, 1] >= 0).all() and (found[:, 1] < 64).all()
    near, far = (np.mean(embeddings.planted(x, first, second, c)[:, 1]) for c in (0.999, 0.5))
    assert near < far


def test_the_index_stays_where_links_are_rare(spark, monkeypatch):
    """Few of many vectors are linked: recall against brute force, with an index of more than one cell."""
    monkeypatch.setattr(embeddings, "QUERIES", 400)
    monkeypatch.setattr(embeddings, "MAX_QUERIES", 400)
    r = np.random.default_rng(4)
    x = embeddings.unit_rows(r.normal(size=(6000, 16)))
    near = embeddings.unit_rows(x[:150] + r.normal(size=(150, 16)) * 0.05)
    every = np.concatenate([x, near])
    seen = []
    real = embeddings.fitted
    monkeypatch.setattr(embeddings, "fitted", lambda *a: seen.append(real(*a)) or seen[-1])
    got = {r.vec_id: r.n_links for r in embeddings.near_copies(vectors(spark, [(i, 0, e) for i, e in enumerate(every.tolist())])).collect()}
    cos = every @ every.T
    np.fill_diagonal(cos, 0)
    want = (cos >= 0.93).sum(axis=1)
    assert len(seen[0][0]) * len(seen[0][1]) > 1
    assert sum(got.values()) >= 0.99 * want.sum() and all(got[i] <= n for i, n in enumerate(want.tolist()))
