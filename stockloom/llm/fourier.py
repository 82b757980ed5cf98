"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics and features are whole numbers, so that the sums of the normal
equations, and with them the model, are the same however rows are dealt to
partitions.  The equations are kept per fold: leaving a fold out is a
subtraction, which gives scores of rows the fit has not seen for choosing the
penalty and for the calibration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written
from .quality import measured

#: Fourier features, folds of the fit, steps of a feature's value, bins of the calibration over raw scores from -1 to 2.
FEATURES, FOLDS, STEPS, BINS = 192, 4, 1 << 12, 1536
PENALTIES = (1e-5, 1e-4, 1e-3, 1e-2, 1e-1)
#: Statistics are held in this many parts of one; standard scores are cut at REACH.
UNIT, REACH = 1 << 16, 6.0
#: Weight of the raw score beside the calibrated one, so that level stretches keep an order.
TILT = 1e-3
#: Name and SQL of each statistic.
STATISTICS = {
    "words": f"cast(ln(1 + n_words) * {UNIT} as long)", "word_length": f"{UNIT} * word_chars div greatest(n_words, 1)",
    "symbols": f"{UNIT} * n_symbols div greatest(word_chars, 1)", "capitals": f"{UNIT} * n_capitals div greatest(word_chars, 1)",
    "marks": f"{UNIT} * n_marks div greatest(word_chars, 1)", "digits": f"{UNIT} * n_digits div greatest(word_chars, 1)",
    "lines": f"{UNIT} * n_lines div greatest(n_words, 1)", "dup_lines": f"{UNIT} * n_dup_lines div greatest(n_lines, 1)",
    "repeats": f"{UNIT} * n_repeat_words div greatest(n_words, 1)", "space": f"{UNIT} * (n_chars - word_chars) div greatest(n_chars, 1)"}


def held_out(c: str = "doc_id"):
    """The rows labels are never learned from; a null id is none of them."""
    return F.coalesce(F.crc32(F.col(c).cast("string")) % 3 == 1, F.lit(False))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, one column per statistic) of the whole texts; null texts count as empty, which have all of them 0."""
    text = F.coalesce("text", F.lit(""))
    counts = measured(docs.select("doc_id", text.alias("text"))).withColumns({
        "n_chars": F.length("text").cast("long"), "n_digits": F.length(F.regexp_replace("text", "[^0-9]+", "")).cast("long")})
    return counts.select("doc_id", *(F.expr(e).cast("long").alias(n) for n, e in STATISTICS.items()))


@dataclass
class Model:
    """Standardisation, directions and phases of the features, weights, and the calibration's knots."""
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Whole numbers, STEPS for 1; the last is constant."""
        z = np.clip((x - self.mean) / self.scale, -REACH, REACH)
        f = np.rint(np.cos(z @ self.directions + self.phases) * STEPS)
        return np.concatenate([f, np.full((len(f), 1), float(STEPS))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights / STEPS

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return np.clip((1 - TILT) * np.interp(raw, self.at, self.value) + TILT * np.clip((raw + 1) / 3, 0, 1), 0, 1)


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS], axis=1).astype(np.float64)


def unfitted(train: DataFrame, seed: int = 7) -> Model:
    """Mean and spread from exact sums over the labelled rows; directions for a Gaussian kernel as wide as the space."""
    big = lambda c: F.col(c).cast("decimal(38,0)")
    s = train.agg(F.count("*").alias("n"), *(F.sum(big(c)).alias(f"s_{c}") for c in STATISTICS), *(F.sum(big(c) * F.col(c)).alias(f"q_{c}") for c in STATISTICS)).first()
    n = s["n"] or 1
    mean = np.array([float(s[f"s_{c}"] or 0) / n for c in STATISTICS])
    var = np.array([float(s[f"q_{c}"] or 0) / n for c in STATISTICS]) - mean ** 2
    r = np.random.default_rng(seed)
    wide = np.sqrt(len(STATISTICS))
    return Model(mean, np.sqrt(np.maximum(var, 0)) + 1, r.normal(size=(len(STATISTICS), FEATURES)) / wide, r.uniform(0, 2 * np.pi, FEATURES),
                 np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))


def normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over the rows of each fold: features by features, features by label, and squared labels; labels count STEPS for 1.

    Every partition adds up its own and the partial sums are added by a
    shuffle; what reaches the driver has a fixed size.
    """
    width = FEATURES + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, width, width), np.int64)
        for b in batches:
            own, fold = np.concatenate([model.features(matrix(b)), b.column("y").to_numpy().reshape(-1, 1)], axis=1), b.column("fold").to_numpy()
            for k in range(FOLDS):
                part = own[fold == k]
                total[k] += (part.T @ part).astype(np.int64)  # exact: whole numbers below 2**53
        k, i, j = np.nonzero(total)
        if len(k):
            yield pa.RecordBatch.from_arrays([pa.array((k * width + i) * width + j), pa.array(total[k, i, j])], names=["cell", "v"])

    cells = map_arrow(train, run, "cell bigint, v bigint").groupBy("cell").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    both = np.zeros(FOLDS * width * width)
    for r in cells:
        both[r.cell] = float(r.v)
    both = both.reshape(FOLDS, width, width) / STEPS ** 2
    return both[:, :-1, :-1], both[:, :-1, -1], both[:, -1, -1]


def solved(a: np.ndarray, b: np.ndarray, penalty: float) -> np.ndarray:
    """Ridge weights; the constant is not penalised."""
    n = max(a[-1, -1], 1.0)
    return np.linalg.solve(a / n + penalty * np.diag([1.0] * FEATURES + [1e-9]), b / n)


def isotonic(at: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing means by pooling neighbours that violate the order: (centre, mean) of each pool."""
    pools: list[list[float]] = []
    for x, t, w in zip(at, total, weight):
        pools.append([x * w, t, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            x2, t2, w2 = pools.pop()
            pools[-1] = [pools[-1][0] + x2, pools[-1][1] + t2, pools[-1][2] + w2]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fitted(train: DataFrame) -> Model:
    """Model from rows (statistics, y from 0 to STEPS, fold): penalty and calibration from rows left out of the fit."""
    model = unfitted(train)
    a, b, c = normal_equations(train, model)
    if not a.any():
        model.weights[-1] = 0.5
        return model
    rest = [k for k in range(FOLDS) if a[k].any() and (a.sum(0) - a[k]).any()]
    errors = {}
    for p in PENALTIES:
        w = {k: solved(a.sum(0) - a[k], b.sum(0) - b[k], p) for k in rest}
        errors[p] = sum(w[k] @ a[k] @ w[k] - 2 * w[k] @ b[k] + c[k] for k in rest), w
    best = min(PENALTIES, key=lambda p: errors[p][0])
    model.weights = solved(a.sum(0), b.sum(0), best)
    apart = np.stack([errors[best][1].get(k, model.weights) for k in range(FOLDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = (model.features(matrix(batch)) * apart[batch.column("fold").to_numpy()]).sum(1) / STEPS
            yield pa.RecordBatch.from_arrays([pa.array((np.clip((raw + 1) / 3, 0, 1) * BINS).astype(np.int64)), batch.column("y")], names=["bin", "y"])

    bins = map_arrow(train, run, "bin bigint, y bigint").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    model.at, model.value = isotonic(np.array([(r.bin + 0.5) / BINS * 3 - 1 for r in bins]), np.array([r.y / STEPS for r in bins]), np.array([r.n for r in bins], float))
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(matrix(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return map_arrow(stats.withColumn("held_out", held_out()), run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learned from all labelled rows but the held-out ones.  A document whose id
    has several labels counts with their mean, rows that share an id each
    count; null labels and ids teach nothing.  Null and empty texts have
    statistics of 0 and a score of their own; without any label each score is
    0.5; an empty table stays empty; other columns are ignored.
    """
    stats = written(statistics(docs))
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.sum("quality").alias("s"), F.count("*").alias("n"))
    train = written(stats.join(known, "doc_id").select(
        *STATISTICS, F.round(F.col("s") * STEPS / F.col("n")).cast("long").alias("y"), F.pmod(F.xxhash64(*STATISTICS), F.lit(FOLDS)).cast("int").alias("fold")))
    return scored(stats, fitted(train))
