"""Token counts at every prefix of a text by dynamic programming, for counting and truncating without re-encoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_arrow
from .words import chunks, distinct, sums

LIMIT, FILE = 4096, "piece_bpe_32k.model"
#: The sign that stands for a space in pieces.
SPACE = "▁"
#: Pairs and counts a worker remembers between batches.
MEMORY = 3 << 19


class PrefixCounter:
    """Counts of a byte-pair model over pieces.

    The last token of a prefix of length i is the piece t that ends there and
    that the merges leave beside the last token of the prefix without it; there
    is just one, and the count is that of the shorter prefix plus one.  So one
    walk over the characters gives the exact count of every prefix.  Whether
    two tokens stay side by side is found once per pair by merging their text.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.table = {}, {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                self.score[piece] = model.get_score(i)
                self.table[piece] = True
                for k in range(1, len(piece)):
                    self.table.setdefault(piece[:k], False)
        self.stay: dict[tuple[str | None, str], bool] = {}
        self.known: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text by merging the best pair, leftmost first."""
        parts = list(text)
        while True:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def stays(self, last: str | None, t: str) -> bool:
        key = (last, t)
        found = self.stay.get(key)
        if found is None:
            if len(self.stay) >= MEMORY:
                self.stay.clear()
            found = self.stay[key] = self.merged((last or "") + t) == ([last, t] if last else [t])
        return found

    def walk(self, text: str, counts: list[int], lasts: list[str | None], starts: list[tuple[int, ...]], i: int) -> None:
        """Extend the three lists, valid up to prefix ``i``, to all of ``text``."""
        table, stay = self.table, self.stay
        del counts[i + 1:], lasts[i + 1:], starts[i + 1:]
        for i in range(i, len(text)):
            alive, found = [], None
            for s in (*starts[i], i):
                t = text[s:i + 1]
                whole = table.get(t)
                if whole is None:
                    continue
                alive.append(s)
                if whole and found is None:
                    ok = stay.get((lasts[s], t))
                    if ok or ok is None and self.stays(lasts[s], t):
                        found = s
            if found is None:  # a character without a piece is one token per byte, and nothing merges with it
                counts.append(counts[i] + len(text[i].encode("utf-8", "surrogatepass")))
                lasts.append(None)
            else:
                counts.append(counts[found] + 1)
                lasts.append(text[found:i + 1])
            starts.append(tuple(alive))

    def prefixes(self, unit: str) -> list[int]:
        """The count of every prefix of a unit, from the empty one on."""
        counts, lasts, starts = [0], [None], [()]
        self.walk(unit, counts, lasts, starts, 0)
        return counts

    def totals(self, units: list[str]) -> list[int]:
        """Counts of many units: in sorted order, each walk starts behind the prefix it shares with the one before."""
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        counts, lasts, starts, before = [0], [None], [()], ""
        for unit in sorted(u for u in units if u not in known):
            same, n = 0, min(len(unit), len(before))
            while same < n and unit[same] == before[same]:
                same += 1
            self.walk(unit, counts, lasts, starts, same)
            known[unit] = counts[len(unit)]
            before = unit
        return [known[u] for u in units]


def units_of(text: str) -> list[str]:
    """A text as independent units: a run of spaces and what follows it; a space is put in front, as the library does."""
    return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+$", SPACE + text.replace(" ", SPACE)) if text else []


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(text: str, path: str | None = None) -> list[int]:
    """Tokens of text[:k] for every k from 0 to its length."""
    c, out = counter(path or public_tokenizers.path(FILE)), [0]
    for i, unit in enumerate(units_of(text)):
        own = c.prefixes(unit)[1:]
        base = out[-1]
        out += [base + x for x in (own[1:] if i == 0 else own)]  # the space in front is not of the text
    return out


def cut_at(units: list[str], counts: np.ndarray, limit: int, c: PrefixCounter) -> int:
    """Characters of the longest prefix with at most ``limit`` tokens, from the stored counts."""
    ends = np.cumsum(counts)
    k = int(np.searchsorted(ends, limit, "right"))
    chars = sum(map(len, units[:k])) - 1
    if k < len(units):
        base = limit - (int(ends[k - 1]) if k else 0)
        chars += max(i for i, x in enumerate(c.prefixes(units[k])) if x <= base)
    return max(chars, 0)


def token_counts(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and cut_chars: the longest prefix within the limit (null: the text fits).

    No begin, end or added tokens; special strings are ordinary text.  Null
    and empty texts have no bytes and no tokens; every row is counted on its
    own; an empty table gives no rows.
    """
    path = path or public_tokenizers.path(FILE)

    def count(texts: pa.Array, c: PrefixCounter) -> tuple[np.ndarray, list[int | None]]:
        # single spaces: units are what lies between them
        values, index, sizes = distinct(pc.split_pattern(texts, " "))
        odd = pc.or_(pc.equal(values, ""), pc.match_substring(values, SPACE)).to_numpy(zero_copy_only=False)
        each = np.array(c.totals([SPACE + v for v in values.to_pylist()]), np.int64)
        n = sums(each[index], sizes)
        starts = np.cumsum(sizes) - sizes
        own = {}
        for d in np.flatnonzero(sums(odd[index], sizes)).tolist():  # texts with runs of spaces, with spaces at an end, or with their sign
            own[d] = units_of(texts[d].as_py())
            n[d] = sum(c.totals(own[d]))
        cuts: list[int | None] = [None] * len(sizes)
        for d in np.flatnonzero(n > limit).tolist():
            units = own[d] if d in own else [SPACE + u for u in values.take(pa.array(index[starts[d]:starts[d] + sizes[d]])).to_pylist()]
            cuts[d] = cut_at(units, np.array(c.totals(units) if d in own else each[index[starts[d]:starts[d] + sizes[d]]]), limit, c)
        return n, cuts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for rows, texts in chunks(batch):
                n, cuts = count(texts, c)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit), pa.array(cuts, pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_chars bigint")
