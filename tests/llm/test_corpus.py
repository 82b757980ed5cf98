"""Operators that compare or learn from the corpus, against brute force and held-out rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stockloom.llm import common, embeddings, neardup, scoring, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_classes(rows):
    sets, postings, texts, done = Sets([r.doc_id for r in rows]), defaultdict(list), {}, []
    for r in rows:
        own, near = shingles(r.text), set()
        if (r.text or "") in texts:
            sets.join(r.doc_id, texts[r.text or ""])
        texts.setdefault(r.text or "", r.doc_id)
        for s in own:
            near.update(postings[s])
            postings[s].append(len(done))
        for i in near:
            other, theirs = done[i]
            if sum((own & theirs).values()) >= 0.8 * sum((own | theirs).values()):
                sets.join(r.doc_id, other)
        done.append((r.doc_id, own))
    return {r.doc_id: sets.find(r.doc_id) for r in rows}


@pytest.mark.parametrize("in_one_task", [True, False])
def test_near_copies_equal_brute_force(spark, documents, monkeypatch, in_one_task):
    if not in_one_task:
        monkeypatch.setattr(neardup, "TASK_TEXTS", 1)
    rows = documents.collect()
    got = {r.doc_id: r.class_id for r in neardup.classes(documents).collect()}
    assert got == brute_classes(rows)
    assert neardup.without_copies(documents).count() == len(set(got.values()))


def test_links_end_where_a_text_is_alone_in_its_bucket(spark, monkeypatch):
    text = lambda n, last: " ".join(f"w{n}x{k}" for k in range(60)) + f" {last}"
    docs = spark.createDataFrame([(1, text(1, "x")), (2, text(1, "y")), (3, text(2, "x"))], "doc_id bigint, text string")
    texts = neardup.signed(docs).selectExpr("doc_id AS id", "1L AS family", "doc_id % 2 AS block", "total", "sig").join(docs.withColumnRenamed("doc_id", "id"), "id")
    held = spark.createDataFrame([(10, 1), (10, 2), (10, 3), (11, 1), (12, 3)], "bucket bigint, id bigint")
    rounds = []
    monkeypatch.setattr(neardup, "compared", lambda *x, f=neardup.compared: rounds.append(1) or f(*x) if len(rounds) < 9 else pytest.fail("no end"))
    assert [tuple(r) for r in neardup.links(held, texts).collect()] == [(1, 2)]


def test_texts_no_head_is_linked_to_meet_their_family(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TASK_TEXTS", 1)
    monkeypatch.setattr(neardup, "MOST_HEADS", 1)
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", 7)
    draw, rows = random.Random(3), []
    for family in range(3):
        words = [f"f{family}w{k}" for k in range(120)]
        for _ in range(25):  # each text is some words away from the one before, so few are copies of the first
            words = [w if draw.random() > 0.015 else f"x{draw.random()}" for w in words]
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    met = []
    monkeypatch.setattr(neardup, "open_links", lambda *x, f=neardup.open_links: met.append(1) or f(*x))
    assert {r.doc_id: r.class_id for r in neardup.classes(docs).collect()} == brute_classes(docs.collect())
    assert met


def test_near_copies_of_odd_rows(odd, empty):
    got = neardup.classes(odd.drop("kept")).collect()
    assert len(got) == 8
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.class_id)
    assert by[4] == {4} and by[2] == by[1] == by[None] == {1} and by[3] == {3}
    assert neardup.classes(empty).count() == 0
    assert neardup.without_copies(odd).count() == 5


def test_near_copies_without_ids(spark):
    text = lambda name, last: " ".join(f"{name}{k}" for k in range(60)) + f" {last}"
    rows = [(None, text("a", "x")), (None, text("b", "x")), (None, text("b", "y")), (None, text("c", "x")), (None, text("c", "x")), (7, text("d", "x")), (None, text("d", "y")), (7, text("e", "x"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.without_copies(docs).collect()
    assert sorted((str(r.doc_id), r.text[0]) for r in got) == [("7", "d"), ("7", "e"), ("None", "a"), ("None", "b"), ("None", "c")]
    marked = {(r.doc_id, r.key) for r in neardup.classes(docs).collect() if r.kept}
    assert len(marked) == 5


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 140), (140, 120), (7, 7)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 120: 100, 140: 100}


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 16))
    x = np.concatenate([base, base[:120] + rng.standard_normal((120, 16)) * 0.08, base[:40]])
    label = np.concatenate([np.arange(300) % 3, np.arange(120) % 3, np.arange(40) % 3])
    rows = [(int(i), [float(v) for v in x[i]], int(label[i])) for i in range(len(x))]
    got = {r.vec_id: r for r in embeddings.near_copies(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    u = np.float32(x).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    assert all(got[i].n_links <= near[i].sum() for i in range(len(x)))
    assert sum(r.n_links for r in got.values()) >= 0.95 * near.sum()
    sets = Sets(range(len(x)))
    for a, b in zip(*np.nonzero(near)):
        sets.join(int(a), int(b))
    assert np.mean([got[i].component_id == sets.find(i) for i in range(len(x))]) > 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_vectors_of_many_cells(spark, monkeypatch):
    """A large group of near copies beside sparse links, more cells than visits, and queries that are a part of all vectors."""
    monkeypatch.setattr(embeddings, "PER_CELL", 2)
    monkeypatch.setattr(embeddings, "MAX_VISITS", 6)
    monkeypatch.setattr(embeddings, "QUERIES", 64)
    monkeypatch.setattr(embeddings, "ENOUGH", 1000)
    rng = np.random.default_rng(9)
    base = rng.standard_normal((900, 16))
    x = np.concatenate([base, base + rng.standard_normal(base.shape) * 0.33, base[:1] + rng.standard_normal((700, 16)) * 0.02])
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    got = {r.vec_id: r.n_links for r in embeddings.near_copies(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    u = np.float32(x).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    linked = [i for i in range(len(x)) if want[i]]
    assert len(linked) > 1500 and all(got[i] <= want[i] for i in range(len(x)))
    assert np.mean([got[i] / want[i] for i in linked]) >= 0.999


def test_visits_weigh_vectors_alike():
    found = np.array([[0, 0, 10**6], [1, 0, 1], [2, 40, 1]])
    assert embeddings.visits_for(found, 0.9) == 41 and embeddings.visits_for(found[:0], 0.9) == 1


def test_ranks_follow_the_traversal():
    rng = np.random.default_rng(2)
    x, first, second = rng.standard_normal((50, 6)), rng.standard_normal((7, 3)), rng.standard_normal((5, 3))
    cells = embeddings.nearest_cells(x, first, second, 35)
    for k in (0, 6, 34):
        assert (embeddings.ranks(x, cells[:, k], first, second) == k).all()


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [1.0, 0.01], 1),
            (6, [1.0, 0.01], None), (7, [1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_copies(df).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 2, 1), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9)]
    assert embeddings.near_copies(df.limit(0)).count() == 0


def test_traversal_visits_the_nearest_cells():
    rng = np.random.default_rng(1)
    x, first, second = rng.standard_normal((50, 6)), rng.standard_normal((7, 3)), rng.standard_normal((5, 3))
    cost = embeddings.distances(x[:, :3], first)[:, :, None] + embeddings.distances(x[:, 3:], second)[:, None, :]
    want = np.argsort(cost.reshape(50, -1), axis=1)[:, :6]
    assert (embeddings.nearest_cells(x, first, second, 6) == want).all()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, last = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return row[-1]


def test_automaton_equals_edit_distance():
    import random
    rng = random.Random(5)
    terms = {"abcab": (False, 1.0), "bbacc": (False, 1.0), "abcabcabc": (False, 1.0), "ccc": (False, 1.0), "acba": (True, 1.0)}
    a = toxicity.Automaton(terms)
    for _ in range(3000):
        w = "".join(rng.choice("abc") for _ in range(rng.randint(1, 11)))
        fits = [(distance(w, t), t) for t, (stem, _) in terms.items() if not stem and distance(w, t) <= toxicity.allowed_errors(t, stem)]
        fits += [(0, t) for t, (stem, _) in terms.items() if stem and w.startswith(t)]
        assert a.match(w) == (min(fits)[::-1] if fits else None), w


def test_toxicity_learns_and_spares(spark):
    import random
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["ta", "ne", "so", "ri", "mu"]) for _ in range(3))
    text = lambda bad: " ".join([word() for _ in range(20)] + ["scoundrel"] * bad + [word() for _ in range(9)])
    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    extra = [(1000, "you skoundrel now", None), (1001, 'they wrote " scoundrel " there', None), (1002, None, None), (1003, "", None)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows + extra], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(got[i].predicted == y for i, _, y in rows)
    assert got[1000].predicted == 1 and got[1001].score < got[0].score and got[1002].predicted == got[1003].predicted == 0
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_misspelt_terms_that_a_stem_covers(spark):
    import random
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abdegh") for _ in range(6))
    bad = ["scoun", "scoundrel", "scounder", "scounding", "scounly", "scounish"]
    rows = [(i, " ".join([word() for _ in range(12)] + [bad[i // 2 % 6]] * (i % 2)), i % 2) for i in range(240)]
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    assert "scou" in model.terms and model.terms["scou"][0]
    a = toxicity.Automaton(model.terms, model.words)
    assert a.match("skoundrel") == ("scoundrel", 1) and a.match("scoundrels") == ("scou", 0) and a.match("skouxxxndrel") is None
    a = toxicity.Automaton({"idiot": (True, 1.0)}, frozenset({"idiot"}))
    assert a.match("idoot") == ("idiot", 1) and a.match("idiotic") == ("idiot", 0) and a.match("idootic") is None


def test_every_term_that_is_sure_is_learned(spark):
    """Thousands of terms, none left out."""
    r = random.Random(5)
    letters = "bcdfghjklmnpqrstvwxz"
    words = sorted({"".join(r.choice(letters) for _ in range(9)) for _ in range(2600)})
    rows = [(i, " ".join(r.sample(words, len(words))), 1) for i in range(10)] + [(100 + i, " ".join(r.choice("one two three four five six seven".split()) + str(r.randrange(50)) for _ in range(60)), 0) for i in range(90)]
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    assert len(words) > 2500 and set(words) <= set(model.terms)


def test_repeated_ids_learn_alike(spark):
    """However the rows are dealt: the least label and the least text of an id."""
    rows = [(i, f"plain words number {i} here", 0) for i in range(40)] + [(i + 100, f"some foulwordx text {i} there", 1) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(i + 100, f"zz clean other {i}") for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(i, 1) for i in range(40)], "doc_id bigint, toxic int")
    one = sorted(map(str, toxicity.toxicity(docs.coalesce(1), labels.coalesce(1)).select("doc_id", "score", "predicted").collect()))
    assert one == sorted(map(str, toxicity.toxicity(docs.repartition(5, "text"), labels.repartition(3)).select("doc_id", "score", "predicted").collect()))
    assert sum("predicted=1" in x for x in one) == 40


def test_toxic_terms_count_unrelated_texts_each(spark):
    import random
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    common = [word() for _ in range(40)]
    text = lambda: " ".join(w for c in common for w in (c, word()))
    near = text().split()
    rows = [(i, text(), i % 2) for i in range(40)] + [(100 + i, " ".join([*near[:-1], word()]), 1) for i in range(10)]
    by_word, n_pos, n_neg = toxicity._counted(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    assert (n_pos, n_neg) == (21, 20)
    got = {r.word: (r.pos, r.n) for r in by_word.collect()}
    assert all(got[c] == (21, 41) for c in common) and got[near[1]] == (1, 1)


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def test_scores(spark, documents, odd):
    docs = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out_of = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(t for i, x in rows if not out_of(i) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), out_of(i), len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(x)), 4)) for i, x in rows)
    got = scoring.scores(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_rare_beginnings_count_as_well(spark, documents, monkeypatch):
    """Scores do not depend on how many beginnings every task gets."""
    monkeypatch.setattr(scoring, "ROUNDS", 0)
    docs = documents.select("doc_id", "text").limit(60)
    full = {r.doc_id: r.score for r in scoring.scores(docs).collect()}
    monkeypatch.setattr(scoring, "TOP_BEGINNINGS", 100)
    assert {r.doc_id: r.score for r in scoring.scores(docs).collect()} == pytest.approx(full, rel=1e-6)


def test_score_is_the_attention_model_alone(spark, documents, monkeypatch):
    """The sum over pieces and ends of what the trained weights give, and nothing beside it."""
    kept = {}
    trained = scoring.trained
    monkeypatch.setattr(scoring, "ROUNDS", 1)
    monkeypatch.setattr(scoring, "trained", lambda docs, t, path: kept.setdefault("p", trained(docs, kept.setdefault("t", t), path)))
    docs = documents.select("doc_id", "text").limit(60)
    rows = docs.collect()
    docs = spark.createDataFrame(rows, docs.schema)
    got = {r.doc_id: r.score for r in scoring.scores(docs).collect()}
    p, t = kept["p"], kept["t"]
    for r in rows[:20]:
        ids, each, _ = scoring.flattened(pa.array([r.text or ""]), scoring.public_tokenizers.path(scoring.FILE))
        x, want, _ = scoring.windows(t.row[ids], t.of[ids], each, t)
        logits = scoring.forward(x, p, t)["logits"].astype(float)
        logs = np.take_along_axis(logits, np.maximum(want, 0)[:, :, None], 2)[:, :, 0] - np.log(np.exp(logits).sum(axis=2))
        assert got[r.doc_id] == pytest.approx((logs[want >= 0].sum() + t.inside[ids].sum()) / math.log(10), rel=1e-3)


def test_mixed_score_counts_rare_beginnings_as_well(spark, documents, monkeypatch):
    monkeypatch.setattr(scoring, "ROUNDS", 0)
    docs = documents.select("doc_id", "text").limit(60)
    full = {r.doc_id: r.score for r in scoring.scores(docs, mixed=True).collect()}
    monkeypatch.setattr(scoring, "TOP_BEGINNINGS", 100)
    assert {r.doc_id: r.score for r in scoring.scores(docs, mixed=True).collect()} == pytest.approx(full, rel=1e-6)
    assert {r.doc_id: r.score for r in scoring.scores(docs).collect()} != pytest.approx(full, rel=1e-3)


def test_all_training_texts_move_the_weights(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    fit = scoring.fit
    def counted(x, *rest):
        seen.add(len(x))
        fit(x, *rest)
    monkeypatch.setattr(scoring, "fit", counted)
    monkeypatch.setattr(scoring, "ROUNDS", 1)
    t = scoring.Tables(np.ones(32000))
    docs = spark.createDataFrame([(i, "one two three") for i in range(100)], "doc_id bigint, text string")
    weights = scoring.trained(docs, t, scoring.public_tokenizers.path(scoring.FILE))
    assert weights["out"].shape == (scoring.WIDTH, 256) and seen.value == 100


def test_model_is_a_distribution_and_trains():
    rng = np.random.default_rng(0)
    ids = np.tile(np.array([3, 5, 9, 11], np.int32), 400)
    t = scoring.Tables(np.bincount(ids, minlength=300).astype(float))
    mass = np.bincount(t.of, np.exp(t.inside), scoring.CLASSES)
    assert np.allclose(mass[np.unique(t.of)], 1, atol=1e-3)
    sizes = np.full(16, 100, np.int64)
    x, want, per = scoring.windows(t.row[ids], t.of[ids], sizes, t)
    assert (want >= 0).sum() == len(ids) and per.sum() == len(x)
    p = scoring.fresh(t.rows)
    before = scoring.log_probs(scoring.forward(x, p, t)["logits"], want).sum()
    for i in range(8):
        scoring.fit(x, want, p, t, i)
    assert scoring.log_probs(scoring.forward(x, p, t)["logits"], want).sum() > before * 0.5
    slow, fast = scoring.log_probs(scoring.forward(x, p, t)["logits"], want), scoring.scored_windows(x, want, p, t, scoring.projected(p, t))
    assert np.allclose(slow, fast, atol=1e-3)
    # a later token changes nothing before it
    y = x[:1].copy()
    y[0, -1] = 7
    a, b = (scoring.forward(z, p, t)["logits"] for z in (x[:1], y))
    assert np.allclose(a[0, :-1], b[0, :-1]) and not np.allclose(a[0, -1], b[0, -1])
    # gradients by differences
    g = scoring.gradients(x[:4], want[:4], p, t)
    for name in ("query", "value", "out", "place"):
        i = tuple(rng.integers(s) for s in p[name].shape)
        kept, step, loss = p[name][i], 1e-2, []
        for d in (step, -step):
            p[name][i] = kept + d
            loss.append(-scoring.log_probs(scoring.forward(x[:4], p, t)["logits"], want[:4]).sum(dtype=np.float64) / (want[:4] >= 0).sum())
        p[name][i] = kept
        assert abs((loss[0] - loss[1]) / (2 * step) - g[name][i]) < 2e-3 + 0.05 * abs(g[name][i]), name


def test_word_beginnings_are_a_distribution():
    """Shares of what follows a beginning, its end included, add up to one where the tree is whole."""
    words = [np.array(w, np.int32) for w in ([4, 6], [4, 6, 8], [4, 7], [5])]
    c = np.array([3, 2, 1, 4])
    ids, n = np.concatenate(words), np.array([len(w) for w in words])
    node, _ = scoring.Memory.nodes(ids, n)
    last = node[np.cumsum(n) - 1]
    keys = np.concatenate([node, scoring.Memory.child(last, np.full(4, scoring.Memory.END))])
    key, at = np.unique(keys, return_inverse=True)
    m = scoring.Memory(key, np.bincount(at, np.concatenate([np.repeat(c, n), c])), np.ones(len(key)), 12.0)
    share, _, end, _ = m.of_words(ids, n)
    starts = np.cumsum(n) - n
    assert share[starts].tolist() == [6 / 12, 6 / 12, 6 / 12, 4 / 12]
    assert share[starts[:3] + 1].tolist() == [5 / 6, 5 / 6, 1 / 6] and share[starts[1] + 2] == 2 / 5
    assert end.tolist() == [3 / 5, 1.0, 1.0, 1.0]


def test_library_and_merges_cut_words_alike():
    """Words of any characters get the same ids from the library as from the merges, in their order."""
    rng = np.random.default_rng(3)
    signs = [chr(c) for c in (*range(0x21, 0x7f), *range(0x80, 0x24f), *range(0x300, 0x320), *range(0x400, 0x450), 0x3000, *range(0x4e00, 0x4e80), 0x200b, 0xfb01, 0xff21, 0x1f642)]
    words = pa.array(["".join(rng.choice(signs, n)) for n in rng.integers(1, 30, 3000)] + ["▁x", "a\0b", "x" * 500, "</s>", "<0x41>", "straße"])
    tok = scoring.pieces(scoring.public_tokenizers.path(scoring.FILE))
    assert tok.model is not None
    for a, b in zip(tok.encode(words), tok.merged(words)):
        assert np.array_equal(a, b)


def test_runs_share_their_tokens():
    """Windows in runs score and learn as they do one by one, over the borders of texts and with empty texts' ends."""
    rng = np.random.default_rng(4)
    sizes = np.array([1, 70, 16, 3, 100, 33, 1, 17], np.int64)
    ids = rng.integers(0, 300, sizes.sum()).astype(np.int32)
    t = scoring.Tables(np.bincount(ids, minlength=300).astype(float))
    t.follow(rng.integers(0, 9, (scoring.OWN + scoring.SHARED + 1, scoring.CLASSES)).astype(float))
    x, want, per = scoring.windows(t.row[ids], t.of[ids], sizes, t)
    n = len(x) // 4 * 4
    x, want, p = x[:n], want[:n], scoring.fresh(t.rows)
    tables = scoring.projected(p, t)
    one = scoring.scored_windows(x, want, p, t, tables)
    assert np.allclose(one, scoring.scored_windows(x, want, p, t, tables, 4), atol=1e-5)
    assert np.allclose(one, scoring.log_probs(scoring.forward(x, p, t)["logits"], want), atol=1e-4)
    a, b = scoring.gradients(x, want, p, t), scoring.gradients(x, want, p, t, 4)
    assert np.array_equal(a["embed"][0], b["embed"][0])
    for k in a:
        g, h = (a[k][1], b[k][1]) if k == "embed" else (a[k], b[k])
        assert np.allclose(g, h, atol=1e-5), k


def test_pieces_are_cut_once(spark, monkeypatch, tmp_path):
    """Both rounds, the counts and the scores read the ids that were written: each text is cut into pieces a single time."""
    seen = spark.sparkContext.accumulator(0)
    cut = scoring.flattened
    def counted(texts, path):
        seen.add(len(texts))
        return cut(texts, path)
    monkeypatch.setattr(scoring, "flattened", counted)
    docs = spark.createDataFrame([(i, f"one two three w{i}") for i in range(50)], "doc_id bigint, text string")
    assert len(scoring.scores(docs).collect()) == 50
    assert seen.value == 50
