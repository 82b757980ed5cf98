"""Toxic documents: misspelled lexicon terms by Levenshtein automata on a trie, weighed by their context."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, map_arrow, written
from .neardup import classes
from .words import chunks, distinct, without_empty

#: Folds by the CRC of the id; rows of fold 0 are held out.
FOLDS = 5
#: Labelled rows that are learned from, at most; beyond it a hash of the id chooses, evenly.
MAX_LABELLED = 50_000
#: A term is learned from so many toxic texts, at such a share of toxic among the texts that have it.
MIN_TOXIC, MIN_SHARE = 5, 0.8
#: A term's log likelihood must pass that of the luckiest of all words that are frequent enough by so much; a misspelling's log odds must reach CLEAR.
SURE, CLEAR = 0.0, 1.5
#: Shortest stem that stands for all words it begins, and the different words it must begin.
STEM, MIN_WORDS = 4, 5
#: Words on each side that tell quotation from abuse.
WINDOW = 4
QUOTES = "\"'«»„“”‚‘’`"
#: Signs that are written for letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_EDGE = re.compile(r"^[^\w*@$]+|[^\w*@$]+$")


def bare(word: str) -> str:
    """A word in small letters without the signs around it."""
    return _EDGE.sub("", word.lower())


@dataclass
class Trie:
    """Terms by letter; a stem's end also accepts whatever follows."""
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    whole: dict[int, tuple[str, int]] = field(default_factory=dict)
    stem: dict[int, tuple[str, int]] = field(default_factory=dict)

    def add(self, term: str, is_stem: bool, errors: int) -> None:
        node = 0
        for c in term:
            nxt = self.children[node].get(c)
            if nxt is None:
                nxt = self.children[node][c] = len(self.children)
                self.children.append({})
            node = nxt
        (self.stem if is_stem else self.whole)[node] = (term, errors)


def allowed_errors(term: str, is_stem: bool) -> int:
    """Edits that still mean the term: one from five letters on, two from nine; none in a stem, which begins many words."""
    return 0 if is_stem else 2 if len(term) >= 9 else 1 if len(term) >= 5 else 0


class Automaton:
    """Levenshtein automaton of the whole lexicon: its states are sets of (trie node, edits), made when first reached.

    The product of trie and automaton is kept as a table of transitions, so a
    word costs one lookup per letter once the states it meets are known.
    """

    LIMIT = 200_000

    def __init__(self, terms: dict[str, tuple[bool, float]], words: frozenset[str] = frozenset()):
        self.trie, self.terms = Trie(), terms
        for term in words:  # stems that are whole terms too, with the edits of those
            self.trie.add(term, False, allowed_errors(term, False))
        for term, (is_stem, _) in terms.items():
            self.trie.add(term, is_stem, allowed_errors(term, is_stem))
        self.most = max((allowed_errors(t, s and t not in words) for t, (s, _) in terms.items()), default=0)
        # the most edits any term below a node allows: nothing is followed further
        self.room = [-1] * len(self.trie.children)
        for node in range(len(self.trie.children) - 1, -1, -1):
            own = [e for kind in (self.trie.whole, self.trie.stem) if node in kind for e in (kind[node][1],)]
            self.room[node] = max([*own, *(self.room[c] for c in self.trie.children[node].values())], default=-1)
        self.reset()

    def reset(self) -> None:
        self.states: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.steps: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0})

    def _state(self, reach: dict[int, int]) -> int:
        """The number of a set, closed under letters of a term that the word leaves out."""
        todo = list(reach.items())
        while todo:
            node, e = todo.pop()
            if reach[node] < e:
                continue
            for child in self.trie.children[node].values():
                if e + 1 <= self.room[child] and e + 1 < reach.get(child, self.most + 1):
                    reach[child] = e + 1
                    todo.append((child, e + 1))
        key = frozenset(reach.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def step(self, state: int, letter: str) -> int:
        key = (state, letter)
        found = self.steps.get(key)
        if found is None:
            reach: dict[int, int] = {}

            def put(node: int, e: int) -> None:
                if e <= self.room[node] and e < reach.get(node, self.most + 1):
                    reach[node] = e

            for node, e in self.states[state]:
                if node in self.trie.stem and e <= self.trie.stem[node][1]:
                    put(node, e)  # a stem takes any ending
                put(node, e + 1)  # a letter too many
                for c, child in self.trie.children[node].items():
                    put(child, e + (c != letter))
            found = self.steps[key] = self._state(reach)
        return found

    def match(self, word: str) -> tuple[str, int] | None:
        """The term of the fewest edits that the word is, or begins with for a stem; None without one."""
        if len(self.states) > self.LIMIT:
            self.reset()
        state = self.start
        for c in word:
            state = self.step(state, c)
            if not self.states[state]:
                return None
        ends = [(e, kind[n][0]) for n, e in self.states[state] for kind in (self.trie.whole, self.trie.stem) if n in kind and e <= kind[n][1]]
        return min(ends)[::-1] if ends else None


@dataclass
class Model:
    terms: dict[str, tuple[bool, float]]
    #: Share of its weight that a match keeps in plain text, and between quotation marks.
    context: tuple[float, float] = (1.0, 0.2)
    bias: float = -3.0
    #: What a misspelling tells, by (term, edits), as far as labelled texts show it.
    fuzzy: dict[tuple[str, int], float] = field(default_factory=dict)
    #: Stems that are whole terms as well.
    words: frozenset[str] = frozenset()

    def weight(self, term: str, edits: int) -> float:
        """Logarithm of the odds that a match adds; never below nothing."""
        exact = self.terms[term][1]
        return exact if not edits else max(0.0, self.fuzzy.get((term, edits), exact * (1 - 0.25 * edits)))


def _counted(labelled: DataFrame) -> tuple[DataFrame, int, int]:
    """Families of texts with each word, by label.

    Near copies of one text would make all its rare words look toxic, so a
    family, the texts of one class of verified near copies, counts once for a
    word; all other texts count each.
    """
    words = F.array_distinct(F.transform(F.split(F.lower("text"), f"[{SPACE}]+"), lambda w: F.regexp_replace(w, "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", "")))
    families = classes(labelled.select("doc_id", "text")).select(F.col("doc_id").alias("_id"), F.col("class_id").alias("family"))
    texts = written(labelled.join(families, F.col("doc_id") == F.col("_id")).select("toxic", "family", words.alias("words")))
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.countDistinct("family").alias("n")).collect()}
    by_word = (texts.select("toxic", "family", F.explode("words").alias("word")).where("length(word) >= 3").distinct()
               .groupBy("word").agg(F.sum("toxic").cast("long").alias("pos"), F.count("*").alias("n")))
    return by_word, n.get(1, 0), n.get(0, 0)


def learn(labelled: DataFrame) -> Model:
    """Terms and stems whose texts are mostly toxic, from (doc_id, text, toxic).

    Words are counted by Spark; only those with enough toxic texts reach the
    driver, which ``MAX_LABELLED`` rows bound.  A stem is kept where many
    different words begin with it and no shorter one already covers it; whole
    terms stay beside it, as they allow edits.
    """
    by_word, n_pos, n_neg = _counted(labelled)
    if not n_pos:
        return Model({})
    by_word = written(by_word)
    share = F.col("pos") / F.col("n")
    prior, luck = n_pos / (n_pos + n_neg), math.log(max(1, by_word.where(F.col("n") >= MIN_TOXIC).count())) + SURE
    rest = F.col("n") - F.col("pos")
    likelihood = F.col("pos") * F.log(share / prior) + F.when(rest > 0, rest * F.log((1 - share) / max(1e-9, 1 - prior))).otherwise(F.lit(0.0))
    whole = by_word.where((F.col("pos") >= MIN_TOXIC) & (share >= MIN_SHARE) & (likelihood > luck) & (F.length("word") >= STEM))
    stems = (by_word.select("pos", "n", F.explode(F.transform(F.sequence(F.lit(STEM), F.least(F.length("word"), F.lit(9))), lambda k: F.substr("word", F.lit(1), k))).alias("stem"))
             .where(F.length("stem") >= STEM).groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"), F.count("*").alias("words"))
             .where((F.col("pos") >= 2 * MIN_TOXIC) & (F.col("pos") / F.col("n") >= 0.97) & (F.col("words") >= MIN_WORDS)))
    take = lambda df, name: [(r[name], r["pos"], r["n"]) for r in df.orderBy(F.desc("pos"), name).collect()]
    odds = lambda pos, n: math.log((pos + 0.5) / (n - pos + 0.5) * (n_neg + 1) / (n_pos + 1))
    terms: dict[str, tuple[bool, float]] = {}
    for stem, pos, n in sorted(take(stems, "stem"), key=lambda x: len(x[0])):
        if not any(stem.startswith(s) for s in terms):
            terms[stem] = (True, odds(pos, n))
    both = set()
    for word, pos, n in take(whole, "word"):
        if word in terms:
            both.add(word)
        else:
            terms[word] = (False, odds(pos, n))
    return Model(terms, bias=math.log((n_pos + 1) / (n_neg + 1)), words=frozenset(both))


def hits(words: list[str], index: np.ndarray, sizes: np.ndarray, automaton: Automaton, seen: dict[str, tuple[str, int] | None]) -> dict[int, list[tuple[int, str, int]]]:
    """By document: (place, term, edits) of its words that match."""
    found: dict[int, tuple[str, int]] = {}
    for i, w in enumerate(words):
        if w not in seen:
            b = bare(w)
            m = automaton.match(b) if b else None
            if m is None and b and b != (plain := b.translate(LOOKALIKE)):
                m = automaton.match(plain)
            if m is None:
                seen[w] = None
                continue
            seen[w] = m
        if seen[w]:
            found[i] = seen[w]
    if not found:
        return {}
    is_hit = np.zeros(len(words), bool)
    is_hit[list(found)] = True
    places = np.flatnonzero(is_hit[index])
    ends = np.cumsum(sizes)
    owner = np.searchsorted(ends, places, "right")
    out: dict[int, list[tuple[int, str, int]]] = {}
    for p, d in zip(places.tolist(), owner.tolist()):
        out.setdefault(d, []).append((p, *found[int(index[p])]))
    return out


def quoted(words: list[str], index: np.ndarray, place: int, low: int, high: int) -> bool:
    """True if quotation marks open before the word and close behind it, within the window and the text."""
    before = "".join(words[j] for j in index[max(low, place - WINDOW):place].tolist())
    here = words[int(index[place])]
    after = "".join(words[j] for j in index[place + 1:min(high, place + 1 + WINDOW)].tolist())
    opens = any(q in before for q in QUOTES if q != "'") or here[:1] in QUOTES
    closes = any(q in after for q in QUOTES if q != "'") or here[-1:] in QUOTES or here[-2:-1] in QUOTES
    return opens and closes


def score(matches: list[tuple[str, float, bool]], model: Model) -> float:
    """Probability of toxic from (term, weight, quoted) of the matches: the prior odds and those of each term's best match."""
    best: dict[str, float] = {}
    for term, weight, is_quote in matches:
        best[term] = max(best.get(term, 0.0), weight * model.context[is_quote])
    z = model.bias + sum(best.values())
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, and n_hits of every document.

    Whole texts are read.  Null and empty texts have no hit and get the score
    of the prior; repeated rows score alike; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, seen = Automaton(model.terms, model.words), {}
        for batch in batches:
            for rows, texts in chunks(batch):
                values, index, sizes = distinct(pc.ascii_split_whitespace(texts))
                index, sizes = without_empty(values, index, sizes)
                words = values.to_pylist()
                if len(seen) > 1 << 20:
                    seen.clear()
                found = hits(words, index, sizes, automaton, seen)
                ends = np.cumsum(sizes)
                out = np.full(len(sizes), score([], model))
                for d, own in found.items():
                    out[d] = score([(t, model.weight(t, e), quoted(words, index, p, int(ends[d] - sizes[d]), int(ends[d]))) for p, t, e in own], model)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(out), pa.array((out >= 0.5).astype(np.int32)), pa.array([len(found.get(d, ())) for d in range(len(sizes))], pa.int64())],
                    names=["doc_id", "held_out", "score", "predicted", "n_hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    folded = docs.select("doc_id", "text", fold("doc_id").alias("held_out"))
    return map_arrow(folded, run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_hits bigint")


def calibrated(texts: DataFrame, model: Model) -> Model:
    """``model`` with the weights of misspellings, from labelled texts without an exact match.

    Some terms lie near ordinary words, and their misspellings tell nothing;
    those that no labelled text has keep what their length and edits tell.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, seen = Automaton(model.terms, model.words), {}
        for batch in batches:
            for rows, own in chunks(batch):
                values, index, sizes = distinct(pc.ascii_split_whitespace(own))
                index, sizes = without_empty(values, index, sizes)
                toxic = rows.column("toxic").to_pylist()
                out = [(t, e, toxic[d]) for d, m in hits(values.to_pylist(), index, sizes, automaton, seen).items() if all(e for _, _, e in m) for t, e in {x[1:] for x in m}]
                yield pa.RecordBatch.from_pylist([{"term": t, "edits": e, "toxic": x} for t, e, x in out],
                                                 schema=pa.schema([("term", pa.string()), ("edits", pa.int32()), ("toxic", pa.int32())]))

    if not model.terms:
        return model
    seen = map_arrow(texts.select("text", "toxic"), run, "term string, edits int, toxic int")
    found = {(r["term"], r["edits"]): (r["pos"], r["n"]) for r in seen.groupBy("term", "edits").agg(F.sum("toxic").alias("pos"), F.count("*").alias("n")).collect()}
    pooled: dict[tuple[int, int], list[int]] = {}
    for (t, e), (pos, n) in found.items():
        both = pooled.setdefault((len(t), e), [0, 0])
        both[0], both[1] = both[0] + pos, both[1] + n
    odds = lambda pos, n: math.log((pos + 0.1) / (n - pos + 0.5)) - model.bias
    fuzzy = {}
    for t, (is_stem, w) in model.terms.items():
        for e in range(1, allowed_errors(t, is_stem and t not in model.words) + 1):
            seen_here = found.get((t, e)) or pooled.get((len(t), e))
            if seen_here:
                own = min(w, odds(*seen_here))
                fuzzy[t, e] = own if own >= CLEAR else 0.0
    model.fuzzy = fuzzy
    return model


def fold(doc_id: str):
    """True for held-out rows; a null id is none of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows outside the held-out fold, then score all of ``docs``.

    Of an id that repeats, the least label and the least text are learned from.
    """
    train = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isNotNull() & ~fold("doc_id")).groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    total = train.count()
    if total > MAX_LABELLED:
        train = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * MAX_LABELLED / total))
    texts = docs.select("doc_id", "text").where("text is not null").join(train, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")
    texts = written(texts)
    return scored(docs, calibrated(texts, learn(texts)))
