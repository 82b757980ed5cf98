"""Concatenate and cut: token sequences of one length, from global offsets by two passes of prefix sums."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, written
from .words import Merges, chunks, distinct, ragged, sums, without_empty

LENGTH, END, FILE = 2048, 1, "word_bpe_49k.json"
#: Words of these letters, with such marks at their end, are plain: no normal form, pattern or special token applies inside.
PLAIN, MARKS = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!,.;:?|*#%&$]*$", "!,.;:?|*#%&$"
LONGEST = 64


class WordTokenizer:
    """Ids of words: plain ones merged in bulk by the file's own merges, all others by the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        if max(vocab.values()) > 0xFFFF:
            raise ValueError("ids must fit into 16 bits")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, merged = (np.array([vocab[f(p)] for p in pairs]) for f in (lambda p: p[0], lambda p: p[1], lambda p: p[0] + p[1]))
        self.merges = Merges(left, right, np.arange(len(pairs)), merged)
        # bytes as the printable characters of byte-level vocabularies
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.inner, self.last = (np.array([vocab[chars[b] + suffix] for b in range(256)], np.int32) for suffix in ("", end))

    def by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.library.encode_batch(words, add_special_tokens=False)] if words else []
        return np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)

    def bodies(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words in lower case."""
        size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        long = np.flatnonzero(size > LONGEST)
        short = words.filter(pa.array(size <= LONGEST)) if len(long) else words
        length = size[size <= LONGEST]
        _, offsets, data = short.buffers()
        offsets = np.frombuffer(offsets, np.int32)[short.offset:short.offset + len(short) + 1] if len(short) else np.zeros(1, np.int32)
        data = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
        symbols = self.inner[data]
        symbols[np.cumsum(length) - 1] = self.last[data[np.cumsum(length) - 1]]
        ids, counts = self.merges.encode(symbols, length)
        if not len(long):
            return ids, counts
        more, more_counts = self.by_library(words.take(pa.array(long)).to_pylist())
        return join_runs(len(words), [(np.flatnonzero(size <= LONGEST), ids, counts), (long, more, more_counts)])

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and ids per word."""
        plain = pc.match_substring_regex(words, PLAIN)
        other, n = pc.invert(plain), len(words)
        w = words.filter(plain)
        body = pc.utf8_rtrim(w, MARKS)
        coded = pc.utf8_lower(body).dictionary_encode()
        ids, counts = self.bodies(coded.dictionary)
        starts, at = np.cumsum(counts) - counts, coded.indices.to_numpy(zero_copy_only=False)
        tail = pc.replace_substring_regex(w, f"^[^{MARKS}]+", "").dictionary_encode()
        mark_ids, mark_counts = self.by_library(tail.dictionary.to_pylist())
        mark_starts, mark_at = np.cumsum(mark_counts) - mark_counts, tail.indices.to_numpy(zero_copy_only=False)
        flat = np.concatenate([ids, mark_ids])
        both_starts = np.stack([starts[at], mark_starts[mark_at] + len(ids)], axis=1).ravel() if len(w) else np.zeros(0, np.int64)
        both_counts = np.stack([counts[at], mark_counts[mark_at]], axis=1).ravel() if len(w) else np.zeros(0, np.int64)
        plain_ids, plain_counts = ragged(flat, both_starts, both_counts), both_counts.reshape(-1, 2).sum(axis=1)
        other_ids, other_counts = self.by_library(words.filter(other).to_pylist())
        plain = plain.to_numpy(zero_copy_only=False)
        return join_runs(n, [(np.flatnonzero(plain), plain_ids, plain_counts), (np.flatnonzero(~plain), other_ids, other_counts)])


def join_runs(n: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several parts in the order of their places: all values, and values per run."""
    flat = np.concatenate([ids for _, ids, _ in parts])
    starts, counts, base = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    for rows, ids, c in parts:
        starts[rows], counts[rows] = base + np.cumsum(c) - c, c
        base += len(ids)
    return ragged(flat, starts, counts), counts


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_ids(texts: pa.Array, tok: WordTokenizer, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text with ``end`` behind them: all ids, and ids per text."""
    values, index, sizes = distinct(pc.ascii_split_whitespace(texts))
    index, sizes = without_empty(values, index, sizes)
    ids, counts = tok.encode(values)
    starts = np.cumsum(counts) - counts
    each = sums(counts[index], sizes)
    out = np.full(int(each.sum()) + len(sizes), end, np.int32)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(each + 1) - 1] = False
    out[inside] = ragged(ids, starts[index], counts[index])
    return out, each + 1


def tokenized(docs: DataFrame, path: str, end: int) -> DataFrame:
    """doc_id, ids (16 bits each), n, and the tokens before it in its partition: the first pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, before = tokenizer(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, texts in chunks(batch):
                flat, n = token_ids(texts, tok, end)
                ends = np.cumsum(n)
                raw = flat.astype("<u2").tobytes()
                binary = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(np.concatenate(([0], ends * 2)).astype(np.int64).tobytes()), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(before + ends - n), pa.array(n), binary.cast(pa.binary())],
                                                 names=["doc_id", "part", "within", "n", "ids"])
                before += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, part int, within bigint, n bigint, ids binary")


def pack(docs: DataFrame, length: int = LENGTH, end: int = END, path: str | None = None) -> DataFrame:
    """Pieces of documents in gapless sequences of ``length`` tokens; only the last sequence is padded.

    Rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    ids (little-endian 32-bit).  Documents follow each other as they are
    stored; one that crosses the end of a window gives a record on each side.
    A null or empty text is the end token alone; repeated rows are packed each;
    an empty table gives no rows.  Token ids are written once, so the cut reads
    the same ids and order the offsets were counted from.
    """
    path = path or public_tokenizers.path(FILE)
    rows = written(tokenized(docs, path, end))
    totals = rows.groupBy("part").agg(F.sum("n").alias("_sum"))
    base = totals.select(F.col("part").alias("_part"), F.coalesce(
        F.sum("_sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    placed = rows.join(base, F.col("part") == F.col("_part")).select("doc_id", (F.col("_base") + F.col("within")).alias("at"), "n", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "n"))
            first, pieces = at // length, (at + n - 1) // length - at // length + 1
            owner = np.repeat(np.arange(len(n)), pieces)
            seq = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.maximum(seq * length, at[owner])
            stop = np.minimum((seq + 1) * length, (at + n)[owner])
            start, size = begin - at[owner], stop - begin
            raw, last, wide = [], -1, b""
            for d, a, k in zip(owner.tolist(), start.tolist(), size.tolist()):
                if d != last:
                    last, wide = d, memoryview(np.frombuffer(batch.column("ids")[d].as_buffer(), "<u2").astype("<u4")).cast("B")
                raw.append(bytes(wide[4 * a:4 * (a + k)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(start), pa.array(size), pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                 pa.array(n[owner]), pa.array(seq), pa.array(begin - seq * length), pa.array(raw, pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(placed, cut, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
