"""Language-model scores: a causal self-attention model over subword ids, trained in numpy, and a word baseline."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import again, map_arrow, written
from .words import Merges, chunks, distinct, ragged, sums, without_empty

FILE, SPACE = "piece_bpe_32k.model", "▁"
#: Rows whose id's CRC leaves HELD_OUT modulo FOLDS are not learned from.
FOLDS, HELD_OUT = 7, 2
#: Words whose counts every task gets; those of all other words come by a join.
TOP_WORDS = 1 << 18
#: Pieces with an embedding of their own; the others share SHARED ones.  Output classes, and width of the model.
OWN, SHARED, CLASSES, WIDTH = 4096, 256, 256, 16
#: The output is given in two steps, a group of classes and the class in it, so that a token costs GROUPS + INSIDE logits.
GROUPS = 8
INSIDE = CLASSES // GROUPS
#: A window scores its last STEP tokens, each with STEP to 2 * STEP tokens before it, itself included.
STEP = 16
#: Windows in a row that are trained or scored together and share the projections of their tokens.
RUN = 8
#: Training: rounds of averaging, tasks whose weights one task adds up, windows of a step, rate.
ROUNDS, FAN_IN, BATCH, RATE = 2, 32, 96, 0.12
LONGEST = 64
#: Windows scored at once: few enough that what they need stays in a core's cache.
AT_ONCE = 96
#: Bytes of piece ids handled at once.
ID_BYTES = 4 << 20
#: Of the mixed score: word beginnings whose counts every task gets, those of all others come by a join; and the least weight of the attention model beside them.
TOP_BEGINNINGS, LEAST_SHARE = 1 << 20, 0.005
LN_10, NOTHING = np.log(10), np.zeros(0, np.int64)


class Pieces:
    """Subword ids of words: the merges of the piece model, for many words at once; very long words go in parts.

    The library cuts the words that it leaves as they are, the rest is merged here; both give the same ids.
    """

    #: Words the library may cut: short, without control characters and its own sign of a space.  A model that changes letters fails at PROBE.
    PLAIN, PROBE = f"^[^\\x00-\\x20\\x7f{SPACE}]{{1,{LONGEST - 1}}}$", ["word", "Ａ①ﬁ", "e\u0301é", "\u00a0x\u200b", "</s>", "漢字🙂"]

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.end = model.get_piece_size(), model.eos_id()
        #: How ids are stored.
        self.kind = np.dtype(np.uint16 if self.size <= 1 << 16 else np.uint32)
        ids = {model.id_to_piece(i): i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        order = {i: r for r, i in enumerate(sorted(ids.values(), key=lambda i: -model.get_score(i)))}
        rows = [(ids[p[:k]], ids[p[k:]], order[i], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        self.merges = Merges(*(np.array(c) for c in zip(*rows)))
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self.first_byte = next(i for i in range(self.size) if model.is_byte(i))
        self.model = model
        probe = pa.array(self.PROBE)
        if not all(np.array_equal(a, b) for a, b in zip(self.listed(probe), self.merged(probe))):
            self.model = None

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and ids per word; a space stands in front of each word."""
        plain = pc.match_substring_regex(words, self.PLAIN).to_numpy(zero_copy_only=False)
        if self.model is None or not plain.any():
            return self.merged(words)
        if plain.all():
            return self.listed(words)
        counts = np.empty(len(words), np.int64)
        (some, counts[plain]), (others, counts[~plain]) = self.listed(words.filter(pa.array(plain))), self.merged(words.filter(pa.array(~plain)))
        starts = np.empty(len(words), np.int64)
        starts[plain] = np.cumsum(counts[plain]) - counts[plain]
        starts[~plain] = len(some) + np.cumsum(counts[~plain]) - counts[~plain]
        return ragged(np.concatenate([some, others]), starts, counts), counts

    def listed(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` by the library."""
        ids = self.model.encode(words.to_pylist(), num_threads=1)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts

    def merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` by the merges."""
        n = len(words)
        text = SPACE + SPACE.join(words.to_pylist()) if n else ""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        symbols = self.of_char[code]
        unknown = np.flatnonzero(symbols < 0)
        if len(unknown):  # characters without a piece, as bytes
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in code[unknown].tolist()]
            many = np.ones(len(symbols), np.int64)
            many[unknown] = [len(r) for r in raw]
            owner = np.repeat(np.arange(n), size)
            size = np.bincount(owner, many, n).astype(np.int64)
            wide = np.repeat(symbols, many)
            wide[wide < 0] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + self.first_byte
            symbols = wide
        parts = np.maximum(-(-size // LONGEST), 1)
        part_size = np.full(int(parts.sum()), LONGEST, np.int64)
        part_size[np.cumsum(parts) - 1] = size - (parts - 1) * LONGEST
        ids, counts = self.merges.encode(symbols, part_size)
        return ids, sums(counts, parts)


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def lowered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words with A-Z in small letters: the different ones, the index of each, and the words per text."""
    values, index, sizes = distinct(pc.ascii_split_whitespace(pc.ascii_lower(texts)))
    return (values, *without_empty(values, index, sizes))


def held_out():
    """True for the held-out fold; a null id is none of it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts: counted per task, then added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch):
                values, index, _ = lowered(texts)
                c = np.bincount(index, minlength=len(values))
                yield pa.RecordBatch.from_arrays([values.cast(pa.string()), pa.array(c.astype(np.int64))], names=["word", "c"]).filter(pa.array(c > 0))

    return map_arrow(docs.select("text"), run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


# the model -----------------------------------------------------------------------------------------------------------

class Tables:
    """What corpus counts fix: embedding row and class of each piece, its share of the class, and class odds after each row."""

    def __init__(self, counts: np.ndarray):
        size = len(counts)
        order = np.argsort(-counts, kind="stable")
        self.row = OWN + np.arange(size, dtype=np.int32) % SHARED
        self.row[order[:OWN]] = np.arange(min(OWN, size), dtype=np.int32)
        self.begin = OWN + SHARED          # before the first token
        self.none = OWN + SHARED + 1       # no token
        self.rows = OWN + SHARED + 2
        # the most frequent pieces are classes; the others are split into classes of equal mass
        single = CLASSES * 3 // 4
        smooth = counts + 0.5
        self.of = np.empty(size, np.int32)
        self.of[order[:single]] = np.arange(single)
        mass = np.cumsum(smooth[order[single:]])
        self.of[order[single:]] = single + np.minimum((mass / mass[-1] * (CLASSES - single)).astype(int), CLASSES - single - 1)
        self.of = self.of % GROUPS * INSIDE + self.of // GROUPS  # dealt to the groups in turn
        self.inside = np.log(smooth / np.bincount(self.of, smooth, CLASSES)[self.of]).astype(np.float32)
        # behind each row and for each group: the odds of all groups, and of the classes in that one
        self.odds = np.zeros((self.rows, GROUPS, GROUPS + INSIDE), np.float32)

    def follow(self, pairs: np.ndarray) -> None:
        """Odds of classes and of groups from counts of (row, class), smoothed by the classes' own share."""
        share = (pairs.sum(axis=0) + 1) / (pairs.sum() + CLASSES)
        odds = ((pairs + 8 * share) / (pairs.sum(axis=1, keepdims=True) + 8)).reshape(-1, GROUPS, INSIDE)
        self.odds[:len(pairs), :, GROUPS:] = np.log(odds)
        self.odds[:len(pairs), :, :GROUPS] = np.log(odds.sum(axis=2))[:, None]
        self.odds[self.none] = 0


def fresh(rows: int, seed: int = 2) -> dict[str, np.ndarray]:
    """First weights; the last row, of no token, stays zero."""
    rng = np.random.default_rng(seed)
    n = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"embed": n(rows, WIDTH) * np.sqrt(rows).astype(np.float32) * 0.3, "query": n(WIDTH, WIDTH), "key": n(WIDTH, WIDTH), "value": n(WIDTH, WIDTH), "last": n(WIDTH, WIDTH),
         "bias": np.zeros(WIDTH, np.float32), "place": np.zeros((STEP, 2 * STEP), np.float32), "out": n(WIDTH, CLASSES) * np.float32(0.1), "groups": n(WIDTH, GROUPS) * np.float32(0.1)}
    p["embed"][-1] = 0
    return p


#: What a query sees: itself and the tokens before it.
CAUSAL = np.where(np.arange(2 * STEP)[None, :] <= np.arange(STEP)[:, None] + STEP, 0, -1e9).astype(np.float32)


def windows(rows: np.ndarray, classes: np.ndarray, sizes: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows of texts: inputs [n, 2 * STEP], wanted classes [n, STEP] (-1: none), and windows per text."""
    per = -(-sizes // STEP)
    ends = np.cumsum(per)
    own = np.full(int(per.sum()) * STEP, t.none, np.int32)
    want = np.full(len(own), -1, np.int32)
    place = np.arange(len(rows)) + np.repeat((ends - per) * STEP - (np.cumsum(sizes) - sizes), sizes)
    want[place] = classes
    first = np.cumsum(sizes) - sizes
    before = np.empty(len(rows), np.int32)
    before[1:] = rows[:-1]
    before[first[sizes > 0]] = t.begin
    own[place] = before
    own, want = own.reshape(-1, STEP), want.reshape(-1, STEP)
    earlier = np.full_like(own, t.none)
    earlier[1:] = own[:-1]
    earlier[(ends - per)[per > 0]] = t.none
    return np.concatenate([earlier, own], axis=1), want, per


def side_by_side(p: dict[str, np.ndarray]) -> np.ndarray:
    """All projections: key, value, a column for the sum of weights, query and what goes past the attention."""
    return np.concatenate([p["key"], p["value"], np.zeros((WIDTH, 1), np.float32), p["query"] * np.float32(WIDTH ** -0.5), p["last"]], axis=1)


def by_group(p: dict[str, np.ndarray]) -> np.ndarray:
    """For each group the weights of all groups and of its classes: [GROUPS, WIDTH, GROUPS + INSIDE]."""
    w = np.empty((GROUPS, WIDTH, GROUPS + INSIDE), np.float32)
    w[:, :, :GROUPS], w[:, :, GROUPS:] = p["groups"], p["out"].reshape(WIDTH, GROUPS, INSIDE).transpose(1, 0, 2)
    return w


def projections(e: np.ndarray, w: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Projections of embeddings; where no token is, there is neither value nor part in the sum of weights."""
    a = e @ w
    a[:, 2 * WIDTH] = there
    return a


def projected(p: dict[str, np.ndarray], t: Tables) -> np.ndarray:
    """The projections of every row, made once for scoring."""
    return projections(p["embed"], side_by_side(p), np.arange(t.rows) != t.none)


def in_runs(x: np.ndarray, run: int) -> np.ndarray:
    """Tokens of each ``run`` windows in a row, those before the first and then each window's own: [n / run, (run + 1) * STEP]."""
    return np.concatenate([x[::run, :STEP], x[:, STEP:].reshape(-1, run * STEP)], axis=1)


def attended(a: np.ndarray, x: np.ndarray, p: dict[str, np.ndarray], t: Tables, run: int) -> dict[str, np.ndarray]:
    """Masked attention of windows over the projections ``a`` of their runs: hidden units, and what their gradients need.

    Weights of attention lie by key and query, which spares the products a transposition.
    """
    n, each, width = a.shape
    # keys and values of a window are a view of its run's; windows overlap
    seen_by = lambda start, many: np.ndarray((n, run, 2 * STEP, many), a.dtype, a, start * 4, (each * width * 4, STEP * width * 4, width * 4, 4))
    key, value = seen_by(0, WIDTH), seen_by(WIDTH, WIDTH + 1)
    own = a.reshape(n, run + 1, STEP, width)[:, 1:]
    query, last = own[..., 2 * WIDTH + 1:3 * WIDTH + 1], own[..., 3 * WIDTH + 1:]
    u = key @ np.ascontiguousarray(query.transpose(0, 1, 3, 2))
    u += np.ascontiguousarray((p["place"] + CAUSAL).T)
    if (top := float(u.max(initial=0))) > 60:
        u -= np.float32(top - 60)
    np.exp(u, out=u)
    if run > 1:  # the first window of a text has nothing before it
        u.reshape(-1, 2 * STEP, STEP)[np.flatnonzero(x[:, STEP - 1] == t.none), :STEP] = 0
    seen = u.transpose(0, 1, 3, 2) @ value
    part = 1 / np.maximum(seen[..., WIDTH:], np.float32(1e-30))
    mean = seen[..., :WIDTH] * part
    h = mean + last
    h += p["bias"]
    return {"key": key, "value": value, "query": query, "u": u, "part": part, "mean": mean, "h": np.tanh(h, out=h)}


def grouped(h: np.ndarray, cur: np.ndarray, want: np.ndarray, w: np.ndarray, t: Tables) -> tuple[np.ndarray, ...]:
    """Tokens with a wanted class, sorted by its group: their places, ends of groups, hidden units, where the wanted group and class
    are in a row, and the exponentials of the logits of groups and of the wanted group's classes, with what the logits were there."""
    group = (want // INSIDE).astype(np.uint8)  # none is 255
    order = np.argsort(group, kind="stable")
    ends = [0, *np.cumsum(np.bincount(group, minlength=GROUPS)[:GROUPS]).tolist()]
    order = order[:ends[-1]]
    h, want = h.take(order, axis=0), want.take(order)
    group = want // INSIDE
    logits = np.empty((len(order), GROUPS + INSIDE), np.float32)
    for k in range(GROUPS):
        np.matmul(h[ends[k]:ends[k + 1]], w[k], out=logits[ends[k]:ends[k + 1]])
    logits += t.odds.reshape(-1, GROUPS + INSIDE).take(cur.take(order) * GROUPS + group, axis=0)
    # odds are at most 0 and the hidden units at most 1, so only large weights could overflow
    if (top := float(logits.max(initial=0))) > 60:
        logits -= np.float32(top - 60)
    row = np.arange(len(order)) * (GROUPS + INSIDE)
    chosen = np.stack([row + group, row + (want % INSIDE + GROUPS)], axis=1)
    were = logits.ravel().take(chosen)
    return order, ends, h, chosen, np.exp(logits, out=logits), were


#: Adds up the exponentials of the groups, and those of the classes.
BOTH = np.repeat(np.eye(2, dtype=np.float32), [GROUPS, INSIDE], axis=0)


def scored_windows(x: np.ndarray, want: np.ndarray, p: dict[str, np.ndarray], t: Tables, tables: np.ndarray, run: int = 1) -> np.ndarray:
    """Log probability of each wanted class, 0 where none is: the same as ``forward`` gives, without the classes of other groups.

    ``run`` windows in a row must follow each other or begin a text.
    """
    h = attended(tables.take(in_runs(x, run), axis=0), x, p, t, run)["h"].reshape(-1, WIDTH)
    order, _, _, _, exps, were = grouped(h, x[:, STEP:].ravel(), want.ravel(), by_group(p), t)
    out = np.zeros(want.size, np.float32)
    out[order] = (were - np.log(exps @ BOTH)).sum(axis=1)
    return out.reshape(want.shape)


def forward(x: np.ndarray, p: dict[str, np.ndarray], t: Tables) -> dict[str, np.ndarray]:
    """Batched masked attention over windows, up to the logits of all classes, which are their log probabilities."""
    cur = x[:, STEP:]
    h = attended(projected(p, t)[x], x, p, t, 1)["h"].reshape(-1, WIDTH)
    odds = t.odds[cur.ravel()]
    tops, logits = h @ p["groups"] + odds[:, 0, :GROUPS], (h @ p["out"]).reshape(-1, GROUPS, INSIDE) + odds[:, :, GROUPS:]
    log_sum = lambda a: np.log(np.exp(a - a.max(axis=-1, keepdims=True)).sum(axis=-1, keepdims=True)) + a.max(axis=-1, keepdims=True)
    logits += (tops - log_sum(tops))[:, :, None] - log_sum(logits)
    return {"h": h, "logits": logits.reshape(*cur.shape, CLASSES)}


def log_probs(logits: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Log probability of each wanted class, 0 where none is; overwrites the logits."""
    flat, w = logits.reshape(-1, CLASSES), want.ravel()
    if (top := float(flat.max(initial=0))) > 60:
        flat -= np.float32(top - 60)
    chosen = flat[np.arange(len(w)), np.maximum(w, 0)]
    np.exp(flat, out=flat)
    return np.where(w >= 0, chosen - np.log(flat @ np.ones(CLASSES, np.float32)), 0).reshape(want.shape)


def gradients(x: np.ndarray, want: np.ndarray, p: dict[str, np.ndarray], t: Tables, run: int = 1) -> dict[str, np.ndarray]:
    """Gradient of the mean loss by each weight; of ``embed`` as the rows that occur and theirs.  ``want`` is -1 where none is; ``run`` as for scores."""
    tokens, w, ends_with = in_runs(x, run), side_by_side(p), by_group(p)
    n, flat = len(tokens), tokens.ravel().astype(np.intp)
    e = p["embed"].take(flat, axis=0)
    f = attended(projections(e, w, flat != t.none).reshape(*tokens.shape, -1), x, p, t, run)
    order, ends, hs, chosen, g, _ = grouped(f["h"].reshape(-1, WIDTH), x[:, STEP:].ravel(), want.ravel(), ends_with, t)
    mean_of = np.float32(1 / max(1, len(order)))
    share = mean_of / (g @ BOTH)
    g[:, :GROUPS] *= share[:, :1]
    g[:, GROUPS:] *= share[:, 1:]
    g.ravel()[chosen.ravel()] -= mean_of
    dh, back, out = np.empty_like(hs), np.ascontiguousarray(ends_with.transpose(0, 2, 1)), np.empty_like(ends_with)
    for k in range(GROUPS):
        part = slice(ends[k], ends[k + 1])
        np.matmul(g[part], back[k], out=dh[part])
        np.matmul(hs[part].T, g[part], out=out[k])
    hs *= hs
    dh *= np.subtract(1, hs, out=hs)
    dz = np.zeros((f["h"].size // WIDTH, WIDTH), np.float32)
    dz[order] = dh
    dz = dz.reshape(f["h"].shape)
    of_mean = dz * f["part"]
    of_seen = np.empty((n, run, WIDTH + 1, STEP), np.float32)
    of_seen[:, :, :WIDTH] = of_mean.transpose(0, 1, 3, 2)
    np.negative(np.einsum("abij,abij->abi", of_mean, f["mean"]), out=of_seen[:, :, WIDTH])
    du = f["value"] @ of_seen
    du *= f["u"]
    # gradients by the projections: a token's as key and value come from its own window and the next
    both = np.empty((n, run, 2 * STEP, 2 * WIDTH), np.float32)
    np.matmul(du, f["query"], out=both[..., :WIDTH])
    np.matmul(f["u"], of_mean, out=both[..., WIDTH:])
    seen = np.empty((n, run + 1, STEP, 2 * WIDTH), np.float32)
    seen[:, :-1] = both[:, :, :STEP]
    seen[:, -1] = 0
    seen[:, 1:] += both[:, :, STEP:]
    own = np.empty((n, run, STEP, 2 * WIDTH), np.float32)
    np.matmul(du.transpose(0, 1, 3, 2), f["key"], out=own[..., :WIDTH])
    own[..., WIDTH:] = dz
    e_own, own, seen = e.reshape(n, -1, WIDTH)[:, STEP:].reshape(-1, WIDTH), own.reshape(-1, 2 * WIDTH), seen.reshape(-1, 2 * WIDTH)
    of_keys, of_own = e.T @ seen, e_own.T @ own
    de = (seen @ np.ascontiguousarray(w[:, :2 * WIDTH].T)).reshape(n, -1, WIDTH)
    de[:, STEP:] += (own @ np.ascontiguousarray(w[:, 2 * WIDTH + 1:].T)).reshape(n, -1, WIDTH)
    there = np.bincount(flat, minlength=t.rows)
    there[t.none] = 0
    there = np.flatnonzero(there)
    embed = np.bincount(CELLS.take(flat, axis=0).ravel(), de.ravel(), t.rows * WIDTH).reshape(-1, WIDTH).take(there, axis=0).astype(np.float32)
    return {"embed": (there, embed), "query": of_own[:, :WIDTH] * np.float32(WIDTH ** -0.5), "key": of_keys[:, :WIDTH], "value": of_keys[:, WIDTH:], "last": of_own[:, WIDTH:],
            "bias": np.ones(len(own), np.float32) @ own[:, WIDTH:], "place": du.sum(axis=(0, 1)).T, "out": out[:, :, GROUPS:].transpose(1, 0, 2).reshape(WIDTH, CLASSES), "groups": out[:, :, :GROUPS].sum(axis=0)}


#: Places of a row's embedding in the flat table of all.
CELLS = np.arange((OWN + SHARED + 2) * WIDTH).reshape(-1, WIDTH)


def fit(x: np.ndarray, want: np.ndarray, p: dict[str, np.ndarray], t: Tables, seed: int, seen: dict[str, np.ndarray] | None = None) -> None:
    """One pass over the windows, which are in the order of the texts, by Adagrad, in place; ``seen`` carries its sums of squares from part to part."""
    rng, seen = np.random.default_rng(seed), {k: np.full_like(v, 1e-6) for k, v in p.items()} if seen is None else seen
    whole = len(x) // RUN
    runs, many = rng.permutation(whole), BATCH // RUN
    steps = [((runs[i:i + many, None] * RUN + np.arange(RUN)).ravel(), RUN) for i in range(0, whole, many)]
    if len(x) % RUN:
        steps.append((np.arange(whole * RUN, len(x)), 1))
    # all weights but the embeddings in one line
    line = [k for k in p if k != "embed"]
    flat, squares = (np.concatenate([a[k].ravel() for k in line]) for a in (p, seen))
    ends = np.cumsum([p[k].size for k in line])
    of = lambda a: {k: part.reshape(p[k].shape) for k, part in zip(line, np.split(a, ends[:-1]))}
    now = {"embed": p["embed"], **of(flat)}
    for rows, run in steps:
        g = gradients(x[rows], want[rows], now, t, run)
        at, embed = g["embed"]  # rows that don't occur stay as they are
        sums_of = seen["embed"].take(at, axis=0) + embed * embed
        seen["embed"][at] = sums_of
        p["embed"][at] -= RATE * embed / np.sqrt(sums_of)
        step = np.concatenate([g[k].ravel() for k in line])
        squares += step * step
        flat -= RATE * step / np.sqrt(squares)
    for k, part in of(flat).items():
        p[k][...] = part
    for k, part in of(squares).items():
        seen[k][...] = part


def flattened(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Piece ids of texts, each with the end behind it; ids per text; and its words."""
    tok, words = pieces(path), lowered(texts)
    values, index, sizes = words
    ids, counts = tok.encode(values)
    starts = np.cumsum(counts) - counts
    each = sums(counts[index], sizes) + 1
    out = np.full(int(each.sum()), tok.end, np.int32)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(each) - 1] = False
    out[inside] = ragged(ids, starts[index], counts[index])
    return out, each, (*words, ids, counts)


def pieced(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids``, the piece ids of the text and the end as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, limit=12 << 20):
                ids, each, _ = flattened(texts, path)
                raw = ids.astype(pieces(path).kind)
                ends = np.append(0, np.cumsum(each) * raw.itemsize).astype(np.int32)
                column = pa.BinaryArray.from_buffers(pa.binary(), len(each), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([*rows.columns, column], names=[*rows.schema.names, "ids"])

    return map_arrow(docs, run, f"{', '.join(f'{c.name} {c.dataType.simpleString()}' for c in docs.schema)}, ids binary")


def ids_of(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of ``pieced`` rows, one after the other, and ids per row."""
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, kind, (ends[-1] - ends[0]) // kind.itemsize, ends[0]).astype(np.int32), np.diff(ends) // kind.itemsize


def remembered(words: tuple, each: np.ndarray, memory: Memory, n_docs: int) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """For every piece of the texts, ends included: its share among what followed in training, and the weight of the attention model.

    Also, of the words with a beginning that the memory was cut of: which they
    are, the places of the pieces that follow their beginnings and themselves, how many
    those are, and the share of the piece behind each as the first of its word.
    """
    _, index, sizes, ids, counts = words
    share, weight, end, behind = memory.of_words(ids, counts)
    starts = np.cumsum(counts) - counts
    total = int(each.sum())
    inside = np.ones(total, bool)
    last = np.cumsum(each) - 1
    inside[last] = False
    p, w = np.empty(total), np.empty(total)
    p[last] = n_docs / max(1.0, memory.words)
    p[inside], w[inside] = ragged(share, starts[index], counts[index]), ragged(weight, starts[index], counts[index])
    # a word's first piece, and the end of the text, come after the end of the word before
    first = np.flatnonzero(inside)[np.cumsum(counts[index]) - counts[index]]
    text_first = (np.cumsum(sizes) - sizes)[sizes > 0]
    before = np.empty(len(index), np.int64)
    before[1:] = index[:-1]
    before[text_first] = -1
    inner = before >= 0
    cut = np.flatnonzero(memory.cut(ids, counts)[index])
    many = counts[index[cut]]
    places = ragged(np.arange(total + 1), first[cut] + 1, many)
    alone = p[first[cut] + many]
    p[first[inner]] *= end[before[inner]]
    w[first] = LEAST_SHARE
    w[first[inner]] = behind[before[inner]]
    w[last] = LEAST_SHARE
    full = sizes > 0
    final = index[(np.cumsum(sizes) - 1)[full]]
    p[last[full]] *= end[final]
    w[last[full]] = behind[final]
    return p, w, (cut, places, many, alone)


def corpus_tables(docs: DataFrame, path: str) -> Tables:
    """Piece statistics of all ``pieced`` training texts; tables of fixed size reach the driver."""
    tok, texts = pieces(path), docs.select("ids")
    size, kind = tok.size, tok.kind

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, part in chunks(batch, "ids", ID_BYTES):
                total += np.bincount(ids_of(part, kind)[0], minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total).astype(np.int32)), pa.array(total[total > 0])], names=["piece", "n"])

    total = np.zeros(size)
    found = map_arrow(texts, singles, "piece int, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    total[found.column("piece").to_numpy()] = found.column("n").to_numpy()
    t = Tables(total)
    row, of, begin = t.row, t.of, t.begin

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What follows what: rows, the one before the first piece included, and classes."""
        seen = np.zeros((begin + 1) * CLASSES, np.int64)
        for batch in batches:
            for _, part in chunks(batch, "ids", ID_BYTES):
                ids, sizes = ids_of(part, kind)
                before = np.empty(len(ids), np.int64)
                before[1:] = row[ids[:-1]]
                before[(np.cumsum(sizes) - sizes)] = begin
                seen += np.bincount(before * CLASSES + of[ids], minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["pair", "n"])

    follow = np.zeros((begin + 1) * CLASSES)
    found = map_arrow(texts, pairs, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    follow[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    t.follow(follow.reshape(-1, CLASSES))
    return t


class Memory:
    """Counts of word beginnings: after the pieces of a beginning, which piece, or the word's end, follows how often.

    It is a tree of pieces, cut to its most frequent nodes and all first pieces; a node is named by
    a hash of its pieces.  Words that reach what the cut removes get their counts by a join.
    """

    ROOT, END = np.uint64(1), np.uint64(0xFFFFFFFF)

    @staticmethod
    def child(node: np.ndarray, piece: np.ndarray) -> np.ndarray:
        x = (node ^ (piece.astype(np.uint64) + np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))

    @classmethod
    def nodes(cls, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node and parent of every piece of every word."""
        node, parent = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint64)
        first, at = np.cumsum(counts) - counts, np.full(len(counts), cls.ROOT)
        rows = np.arange(len(counts))
        for depth in range(int(counts.max(initial=0))):
            rows = rows[counts[rows] > depth]
            place = first[rows] + depth
            parent[place] = at[rows]
            at[rows] = node[place] = cls.child(at[rows], ids[place])
        return node, parent

    def __init__(self, keys: np.ndarray, n: np.ndarray, kinds: np.ndarray, words: float, whole: bool = True):
        order, self.whole = np.argsort(keys), whole
        self.keys, self.n, self.words = keys[order], n[order].astype(np.float64), words
        # the attention model weighs as much as there are different ways to go on (Witten-Bell)
        self.weight = np.maximum(kinds[order] / (self.n + kinds[order]), LEAST_SHARE)

    def look(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each node, 0 for one that isn't kept, and the attention model's weight behind it."""
        if not len(self.keys):
            return np.zeros(len(node)), np.ones(len(node))
        at = np.minimum(np.searchsorted(self.keys, node), len(self.keys) - 1)
        there = self.keys[at] == node
        return np.where(there, self.n[at], 0.0), np.where(there, self.weight[at], 1.0)

    @classmethod
    def path(cls, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The nodes of every word, and behind them that of its end."""
        node, _ = cls.nodes(ids, counts)
        last = np.cumsum(counts) - 1
        return np.insert(node, last + 1, cls.child(node[last], np.full(len(last), cls.END)))

    def cut(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """True for words with a node that may have been cut."""
        if self.whole or not len(counts):
            return np.zeros(len(counts), bool)
        n, _ = self.look(self.path(ids, counts))
        return np.logical_or.reduceat(n == 0, np.cumsum(counts + 1) - counts - 1)

    def of_words(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each piece of each word its share among what followed its beginning, and the attention model's weight there; for
        each word the share of its end, and the weight behind it.  A first piece is shared among all words and ends of texts."""
        node, parent = self.nodes(ids, counts)
        (n, _), (above, weight), root = self.look(node), self.look(parent), parent == self.ROOT
        above, weight = np.where(root, self.words, above), np.where(root, LEAST_SHARE, weight)
        last = np.cumsum(counts) - 1
        whole, behind = self.look(node[last])
        ended, _ = self.look(self.child(node[last], np.full(len(last), self.END)))
        part = lambda a, b: np.divide(a, b, out=np.zeros(len(a)), where=b > 0)
        return part(n, above), weight, part(ended, whole), behind


def beginnings(counts: DataFrame, words: float, path: str) -> tuple[Memory, DataFrame]:
    """Word beginnings and ends, from the counts of all words, with how many different ways they went on: the most frequent, and the table of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, n = pieces(path).encode(batch.column("word"))
            node, parent = Memory.nodes(ids, n)
            last = node[np.cumsum(n) - 1]
            c = batch.column("c").to_numpy()
            key, first, at = np.unique(np.concatenate([node, Memory.child(last, np.full(len(last), Memory.END))]), return_index=True, return_inverse=True)
            above = np.concatenate([parent, last])[first]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(above.view(np.int64)), pa.array(np.bincount(at, np.concatenate([np.repeat(c, n), c])).astype(np.int64))],
                                             names=["key", "above", "n"])

    nodes = written(map_arrow(counts, run, "key bigint, above bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"), F.min("above").alias("above")))
    kinds = again(nodes).groupBy(F.col("above").alias("_key")).agg(F.count("*").alias("kinds"))
    every = written(nodes.join(kinds, F.col("key") == F.col("_key"), "left").select("key", "above", "n", F.coalesce("kinds", F.lit(1)).alias("kinds")))
    top = every.orderBy(F.desc("n"), "key").limit(TOP_BEGINNINGS).union(every.where(F.col("above") == int(Memory.ROOT)))
    found = top.select("key", "n", "kinds").distinct().toArrow()
    return Memory(found.column("key").to_numpy().view(np.uint64), found.column("n").to_numpy(), found.column("kinds").to_numpy(), words, every.count() == found.num_rows), every


def rejoined(first: DataFrame, every: DataFrame, path: str) -> DataFrame:
    """(_of, _score): what the words with cut beginnings add to the score of their text, with the counts of all beginnings.

    ``first`` has them as ``cut``: word, the attention model's probability of
    each piece behind a beginning and behind the word, and ``alone``, the share
    of the piece behind the word as the first of its own.
    """
    words = first.select("_row", F.explode("cut").alias("r")).select(F.col("_row").alias("_of"), "r.word", "r.attention", "r.alone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, n = pieces(path).encode(batch.column("word"))
                at = np.concatenate([np.arange(c + 1) for c in n.tolist()])
                yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(np.repeat(np.arange(len(n)), n + 1))), pa.array(at.astype(np.int32)), pa.array(Memory.path(ids, n).view(np.int64))],
                                                 names=["word", "at", "node"])

    paths = map_arrow(words.select("word").distinct(), run, "word string, at int, node bigint").join(every.select("key", "n", "kinds"), F.col("node") == F.col("key"), "left")
    of_word = paths.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("kinds", F.lit(1)).alias("kinds")))).alias("path"))
    weight = f"if(path[i].n > 0, greatest(path[i].kinds / (path[i].n + path[i].kinds), {LEAST_SHARE}D), 1D)"
    share = "if(path[i].n > 0, path[i + 1].n / path[i].n, 0D) * if(i + 1 = size(attention), alone, 1D)"
    score = f"aggregate(sequence(0, size(attention) - 1), 0D, (s, i) -> s + log10({weight} * attention[i] + (1 - {weight}) * {share}))"
    return words.join(of_word, "word").groupBy("_of").agg(F.sum(F.expr(score)).alias("_score"))


def trained(docs: DataFrame, t: Tables, path: str) -> dict[str, np.ndarray]:
    """Weights from all training texts, ``pieced`` or not: each task trains on the windows of its part, rounds average."""
    texts = (docs if "ids" in docs.columns else pieced(docs.select("text"), path)).select("ids")
    kind = pieces(path).kind
    p = fresh(t.rows)
    shapes = {k: v.shape for k, v in p.items()}
    for turn in range(ROUNDS):
        start = {k: v.copy() for k, v in p.items()}

        def train(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            own, seen, n = {k: v.copy() for k, v in start.items()}, {k: np.full_like(v, 1e-6) for k, v in start.items()}, 0
            for batch in batches:
                for _, part in chunks(batch, "ids", ID_BYTES):
                    ids, sizes = ids_of(part, kind)
                    x, want, _ = windows(t.row[ids], t.of[ids], sizes, t)
                    fit(x, want, own, t, turn, seen)
                    n += len(x)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([b"".join((own[k] * np.float64(n)).tobytes() for k in own)], pa.binary())], names=["n", "weights"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, 0.0
            for batch in batches:
                for m, w in zip(batch.column("n").to_pylist(), batch.column("weights").to_pylist()):
                    n, total = n + m, total + np.frombuffer(w, np.float64)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "weights"])

        schema = "n bigint, weights binary"
        made, tasks = map_arrow(texts, train, schema), texts.rdd.getNumPartitions()
        while tasks > FAN_IN:
            tasks = -(-tasks // FAN_IN)
            made = map_arrow(made.repartition(tasks), add, schema)
        results = made.collect()
        if not results:
            break
        total = sum(r["n"] for r in results)
        mean = (sum(np.frombuffer(r["weights"], np.float64) for r in results) / total).astype(np.float32)
        at = 0
        for k, shape in shapes.items():
            size = int(np.prod(shape))
            p[k], at = mean[at:at + size].reshape(shape).copy(), at + size
    return p


def scores(docs: DataFrame, path: str | None = None, mixed: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Tokens of the base are the words with A-Z in small letters, and the end.
    The model gives the probability of the same sequence, piece by piece: the
    attention model's for every piece and end.  Every word is a run
    of pieces that begins with a space, so no two word sequences share one.  A
    null text is an empty one, whose end is scored; repeated rows score alike;
    an empty table gives no rows.

    ``mixed`` asks for another score: the attention model mixed with counts of
    what followed the same beginning of a word in training, where that was seen often.
    """
    path = path or public_tokenizers.path(FILE)
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").withColumn("held_out", held_out())
    docs = written(pieced(docs, path))
    train = docs.where(~F.col("held_out"))
    counts = written(word_counts(train))
    n_docs = train.count()
    found = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, kinds = found["n"] + n_docs, found["v"] + (n_docs > 0)
    tables = corpus_tables(train, path)
    memory, every = beginnings(counts, float(total), path) if mixed else (None, None)
    weights = trained(train, tables, path)
    top = counts.orderBy(F.desc("c"), "word").limit(TOP_WORDS)
    common = top.toArrow()
    kind = pieces(path).kind
    shared = spark.sparkContext.broadcast((common.column("word").combine_chunks(), common.column("c").to_numpy(), weights, tables, memory))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, c, p, t, memory = shared.value
        c = c.astype(np.float64)
        made = projected(p, t)
        for batch in batches:
            for rows, texts in chunks(batch, limit=12 << 20):
                ids, each = ids_of(rows.column("ids"), kind)
                own_words = lowered(texts) if memory is None else flattened(texts, path)[2]
                values, index, sizes = own_words[:3]
                x, want, _ = windows(t.row[ids], t.of[ids], each, t)
                logs_of = np.empty(want.shape, np.float32)
                whole = len(x) // RUN * RUN
                for start in (*range(0, whole, AT_ONCE), *([whole] if whole < len(x) else [])):
                    part = slice(start, min(start + AT_ONCE, whole) if start < whole else len(x))
                    logs_of[part] = scored_windows(x[part], want[part], p, t, made, RUN if start < whole else 1)
                logs_of = logs_of[want >= 0].astype(np.float64) + t.inside[ids]
                attention = np.exp(logs_of)
                if memory is None:
                    logs_of, cut, places, many, alone = logs_of / LN_10, NOTHING, NOTHING, NOTHING, np.zeros(0)
                else:
                    seen, weight, (cut, places, many, alone) = remembered(own_words, each, memory, n_docs)
                    logs_of = np.log10(weight * attention + (1 - weight) * seen)
                    logs_of[places] = 0  # of words with cut beginnings: see rejoined
                score = sums(logs_of, each)
                open_words = pa.StructArray.from_arrays(
                    [values.cast(pa.string()).take(pa.array(index[cut])), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), pa.array(attention[places])), pa.array(alone)],
                    names=["word", "attention", "alone"])
                open_ends = np.searchsorted(cut, np.append(0, np.cumsum(sizes))).astype(np.int32)
                place = pc.index_in(values.cast(pa.string()), value_set=words)
                known = pc.is_valid(place).to_numpy(zero_copy_only=False)
                count = np.zeros(len(values))
                count[known] = c[pc.drop_null(place).to_numpy()]
                logs = sums(np.log10(count + 1)[index], sizes)
                n_known = sums((count > 0)[index].astype(np.int64), sizes)
                # words outside the common ones, each once per text
                rare = np.flatnonzero(~known[index])
                owner = np.repeat(np.arange(len(sizes)), sizes)[rare]
                pair, times = np.unique(owner * len(values) + index[rare], return_counts=True)
                offsets = np.searchsorted(pair // max(1, len(values)), np.arange(len(sizes) + 1)).astype(np.int32)
                entry = pa.StructArray.from_arrays([values.cast(pa.string()).take(pa.array(pair % max(1, len(values)))), pa.array(times.astype(np.int32))], names=["word", "times"])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(sizes + 1), pa.array(n_known), pa.array(logs), pa.array(score), pa.ListArray.from_arrays(pa.array(offsets), entry),
                     pa.ListArray.from_arrays(pa.array(open_ends), open_words)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "rare", "cut"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    first = written(map_arrow(docs, run, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, logs double, score double, rare array<struct<word:string,times:int>>, "
                              "cut array<struct<word:string,attention:array<double>,alone:double>>")
                    .withColumn("_row", F.monotonically_increasing_id()))
    words = first.select("_row", F.explode("rare").alias("r")).select(F.col("_row").alias("_of"), "r.word", "r.times")
    more = (words.join(counts, "word").groupBy("_of").agg(F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("_logs")))
    out = first.drop("rare", "cut").join(more, F.col("_row") == F.col("_of"), "left").drop("_of")
    score = F.col("score")
    if memory is not None and not memory.whole:
        out = out.join(rejoined(first, every, path), F.col("_row") == F.col("_of"), "left")
        score = score + F.coalesce("_score", F.lit(0.0))
    end = float(np.log10(n_docs + 1))
    known = F.col("n_known") + F.coalesce("_known", F.lit(0)) + int(n_docs > 0)
    base = F.col("logs") + F.coalesce("_logs", F.lit(0.0)) + end - F.col("n_tokens") * float(np.log10(total + kinds + 1))
    return out.select("doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))
