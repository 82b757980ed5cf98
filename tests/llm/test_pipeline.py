"""The pipeline's stages, each judged on its own input."""

import unicodedata
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import Row
from tokenizers import Tokenizer

import corpus_pipeline
from stockloom.llm import packing, quality, queries
from stockloom.llm.common import written

from .test_corpus import brute_classes
from .test_documents import WORD, counts


def test_stages(spark, data, documents):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, data))
        seen[name] = (docs, out)
        if name != "window_packing":
            assert out.columns == documents.columns
        docs = out
    ids = lambda df: [r[0] for r in df.select("doc_id").collect()]
    before, after = seen["near_copies"]
    assert set(ids(after)) <= set(ids(before)) and len(set(ids(after))) == len(ids(after))
    before, after = seen["surrogates"]
    assert sorted(ids(before)) == sorted(ids(after))
    mixed, pieces = seen["window_packing"]
    whole = pieces.groupBy("doc_id").sum("length").count()
    assert whole == mixed.select("doc_id").distinct().count()
    assert pieces.where("start = 0").count() == mixed.count()


def test_run_equals_the_stages(spark, data):
    assert corpus_pipeline.run(spark, data).where("start = 0").count() > 0


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def kept_by_quality(rows):
    """The rows that the rules keep, by brute force."""
    values = {}
    for i, r in enumerate(rows):
        n_words, chars, symbols, dups, repeated = counts(r.text)
        if n_words >= 10 and 100 * repeated <= 20 * n_words:
            lines = [x for x in r.text.split("\n") if WORD.search(x)]
            joined = "".join(WORD.findall(r.text))
            capitals, marks = sum(unicodedata.category(c) == "Lu" for c in joined), sum(c in "!?.,;:" for c in joined)
            whole = [1000 * symbols // chars, 1000 * capitals // chars, 1000 * marks // chars, 1000 * dups // max(len(lines), 1), 100 * chars // n_words]
            values[i] = [v - v % (1 << max(v.bit_length() - 8, 0)) for v in whole]
    groups = defaultdict(list)
    for i in values:
        groups[rows[i].lang, rows[i].source].append(i)
    out = []
    for own in groups.values():
        limits = []
        for k, rule in enumerate(quality.RULES):
            ordered = sorted(values[i][k] for i in own)
            q1, q3 = (ordered[-(-len(own) * q // 4) - 1] for q in (1, 3))
            limits.append(q3 + (q3 - q1) * rule.reach + rule.slack)
        out += [rows[i] for i in own if all(v <= m for v, m in zip(values[i], limits))]
    return out


def test_run_equals_brute_force(spark, documents, tmp_path):
    """Rows of run() against all stages by brute force or the operators' own row counts, unlike texts without ids among the input."""
    base = [r for r in documents.collect() if r.text and len(r.text.split()) >= 40]
    extra = [Row(**{**r.asDict(), "doc_id": None, "text": " ".join(f"{w}{k}" for w in r.text.split()[:60])}) for k, r in enumerate(base[:3])]
    docs = documents.union(spark.createDataFrame(extra, documents.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = docs.collect()
    good = kept_by_quality(rows)
    named = [r for r in good if r.doc_id is not None]
    least = set(brute_classes(named).values())
    clean = [r for r in named if r.doc_id in least] + [r for r in good if r.doc_id is None]
    assert 0 < len(clean) < len(rows) and sum(r.doc_id is None for r in clean) == 3
    as_rows = lambda rows: Counter((r.doc_id, r.text) for r in rows)
    stages = dict(corpus_pipeline.STAGES)
    passed = written(stages["quality_rules"](spark, docs, ""))
    assert as_rows(passed.collect()) == as_rows(good)
    single = written(stages["near_copies"](spark, passed, ""))
    assert as_rows(single.collect()) == as_rows(clean)
    safe = written(stages["surrogates"](spark, single, ""))
    assert Counter(r.doc_id for r in safe.collect()) == Counter(r.doc_id for r in clean)
    # the mix takes rows as often as its law says; run() has their tokens, each as often, and nothing else
    enc, want, tokens = Tokenizer.from_file(public_tokenizers.path(packing.FILE)), Counter(), defaultdict(list)
    for r in stages["source_mix"](spark, safe, "").collect():
        ids = np.array([*enc.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want[r.doc_id] += len(ids)
        tokens[r.doc_id].append(ids)
    got = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert any(len(x) == r.doc_tokens and x[r.start:r.start + r.length].tobytes() == r.ids for x in tokens[r.doc_id])
        got[r.doc_id] += r.length
    assert got == want
