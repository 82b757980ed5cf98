"""Words of texts in Arrow and numpy, so that each different word of a batch is handled once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in pieces of about so many bytes; one longer text is a piece of its own.
CHUNK_BYTES = 24 << 20


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES, rows: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The batch in slices of bounded text and rows, each with its texts (null as empty)."""
    texts = pc.fill_null(batch.column(column), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, base + limit, "right"))))
        yield batch.slice(start, stop - start), texts.slice(start, stop - start)
        start = stop


def distinct(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of an array of lists: the different values, each item's index among them, and the items per list."""
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()).astype(np.int64)


def without_empty(values: pa.Array, index: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and sizes without the empty items that splitting leaves at the ends of a text."""
    empty = pc.index(values, "").as_py()
    if empty < 0:
        return index, sizes
    there = index != empty
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return index[there], np.bincount(owner[there], minlength=len(sizes)).astype(np.int64)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of ``sizes`` values."""
    ends = np.cumsum(sizes)
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ends] - total[ends - sizes]


def ragged(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs flat[starts : starts + counts], one after the other."""
    shift = starts - (np.cumsum(counts) - counts)
    return flat[np.repeat(shift, counts) + np.arange(int(counts.sum()))]


class Merges:
    """Byte-pair merges of many short words at once: each round merges the best pair of every word.

    ``keys`` are left * 2**21 + right, sorted, with the rank and the id of the
    merged symbol; the lowest rank goes first, the leftmost of equals.
    """

    NONE = np.iinfo(np.int32).max

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        keys = left.astype(np.int64) << 21 | right.astype(np.int64)
        order = np.argsort(keys)
        self.keys, self.rank, self.merged = keys[order], rank[order].astype(np.int32), merged[order].astype(np.int32)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE where it doesn't merge) and its place in the table."""
        key = left.astype(np.int64) << 21 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.NONE), at

    def apply(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        """Merge the rows of ``symbols``, padded with -1, in place; ``lengths`` shrink."""
        n, width = symbols.shape
        if width < 2 or not n:
            return
        ranks = np.full((n, width), self.NONE, np.int32)
        both = np.arange(width - 1)[None, :] < (lengths - 1)[:, None]
        ranks[:, :-1][both] = self.find(symbols[:, :-1][both], symbols[:, 1:][both])[0]
        rows = np.arange(n)
        while True:
            best = ranks[rows].argmin(axis=1)
            open_ = ranks[rows, best] != self.NONE
            rows, best = rows[open_], best[open_]
            if not len(rows):
                return
            symbols[rows, best] = self.merged[self.find(symbols[rows, best], symbols[rows, best + 1])[1]]
            source = np.arange(width)[None, :] + (np.arange(width)[None, :] > best[:, None])
            source[:, -1] = np.minimum(source[:, -1], width - 1)
            moved = np.take_along_axis(symbols[rows], source, axis=1)
            kept = np.take_along_axis(ranks[rows], source, axis=1)
            lengths[rows] -= 1
            size, k = lengths[rows], np.arange(len(rows))
            moved[np.arange(width)[None, :] >= size[:, None]] = -1
            kept[:, -1] = self.NONE
            for at in (best - 1, best):  # the pairs that the new symbol is part of
                ok = (at >= 0) & (at + 1 < size)
                kept[k[ok], at[ok]] = self.find(moved[k[ok], at[ok]], moved[k[ok], at[ok] + 1])[0]
                off = (at >= 0) & (at + 1 >= size)
                kept[k[off], at[off]] = self.NONE
            symbols[rows], ranks[rows] = moved, kept

    def encode(self, flat: np.ndarray, lengths: np.ndarray, widths: tuple[int, ...] = (8, 12, 16, 24, 40, 64)) -> tuple[np.ndarray, np.ndarray]:
        """Merge runs of symbols (``flat`` cut by ``lengths``, at most the last width): all ids, and ids per run."""
        starts = np.cumsum(lengths) - lengths
        counts = lengths.astype(np.int64).copy()
        out, done, low = [], [], 0
        for width in widths:
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            if len(rows):
                cols = np.arange(width)[None, :]
                inside = cols < lengths[rows][:, None]
                symbols = np.full((len(rows), width), -1, np.int32)
                symbols[inside] = ragged(flat, starts[rows], lengths[rows].astype(np.int64))
                size = lengths[rows].astype(np.int64)
                self.apply(symbols, size)
                counts[rows] = size
                out.append(symbols[cols < size[:, None]])
                done.append(rows)
        if not out:
            return np.zeros(0, np.int32), counts
        ids, rows = np.concatenate(out), np.concatenate(done)
        place = np.zeros(len(lengths), np.int64)
        place[rows] = np.cumsum(counts[rows]) - counts[rows]
        return ragged(ids, place, counts), counts
