"""Near copies of documents: DartMinHash signatures of weighted shingles, banded joining, exact verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import again, components, discard, importable, map_arrow, written
from .words import chunks, distinct, ragged, without_empty

#: Words of a shingle, and the weighted Jaccard similarity of a link.
SHINGLE, SIMILAR = 5, 0.8
#: Coordinates of a signature; a band is so many of them.
COORDINATES, BAND = 120, 5
#: Signatures of a linked pair agree in this share of coordinates, but for one pair in some 10**6 (five standard deviations).
HOPEFUL = SIMILAR - 5 * (SIMILAR * (1 - SIMILAR) / COORDINATES) ** 0.5
#: Likewise for a pair at twice the distance of a link.
WEAK = (2 * SIMILAR - 1) - 5 * (0.25 / COORDINATES) ** 0.5
#: A group is one task's work up to so many texts and so many texts times words; beyond, ``links`` spreads it.
TASK_TEXTS, TASK_WORK = 4000, 2 * 10**9
#: Texts and words of a block, on average; a task compares the texts of two at a time.
BLOCK_TEXTS, BLOCK_WORDS = 1000, 10**6
#: Heads of a bucket in the last turn of ``links``; texts that none of them is linked to then meet their whole family.
MOST_HEADS = 4
#: Expected darts for a signature: all coordinates are hit with these, but for one text in some thousands, which throws on.
DARTS = COORDINATES * (np.log(COORDINATES) + 8)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers (the finishing steps of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(values: pa.Array) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(v) for v in values.cast(pa.binary()).to_pylist()], np.uint64)


def shingles(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the word hashes of several texts: each text's different shingles, their counts, and how many per text.

    A text shorter than a shingle has one, of all its words; one without words has none.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    windows = np.where(sizes == 0, 0, np.maximum(sizes - SHINGLE + 1, 1))
    owner = np.repeat(np.arange(len(sizes)), windows)
    first = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    x = np.zeros(len(owner), np.uint64)
    for k in range(SHINGLE):
        inside = first + k < ends[owner]
        x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, h[np.minimum(first + k, len(h) - 1)], np.uint64(k + 1))) if len(h) else x
    order = np.lexsort((x, owner))
    x, owner = x[order], owner[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return x[at], np.diff(np.append(at, len(x))), np.bincount(owner[at], minlength=len(sizes)).astype(np.int64)


def signatures(x: np.ndarray, weight: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """DartMinHash: darts are thrown at the area weight by rank of each element; those that land under a
    text's weights count, and each coordinate keeps the one of least rank.

    Darts are a fixed random pattern that the element decides.  On each unit
    of weight they arrive, by rank, with exponential gaps; so the darts of
    rank up to DARTS / total weight number DARTS a text, however long it is,
    and only those are made.  A dart names its coordinate and its value.
    """
    n = len(per_text)
    out = np.zeros((n, COORDINATES), np.uint32)
    if not len(x):
        return out
    owner = np.repeat(np.arange(n), per_text)
    # one strip per unit of weight
    strip_owner = np.repeat(owner, weight)
    unit = np.arange(len(strip_owner)) - np.repeat(np.cumsum(weight) - weight, weight)
    seed = mix64(np.repeat(x, weight) + np.uint64(0xD1B54A32D192ED03) * (unit.astype(np.uint64) + np.uint64(1)))
    total = np.bincount(strip_owner, minlength=n)
    limit = DARTS / np.maximum(total, 1)
    least = np.full(n * COORDINATES, np.inf)
    todo = total > 0
    low = np.zeros(n)
    while todo.any():
        # throw at ranks from low to limit; texts with an empty coordinate go on to twice the rank
        live = np.flatnonzero(todo[strip_owner])
        s, o, rank, step = seed[live], strip_owner[live], np.zeros(len(live)), 0
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(s):
            step += 1
            u = mix64(s + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
            rank = rank - np.log1p(-((u >> np.uint64(11)).astype(np.float64) / (1 << 53)))
            keep = rank <= limit[o]
            s, o, rank, u = s[keep], o[keep], rank[keep], u[keep]
            new = rank > low[o]
            dart = mix64(u[new] ^ np.uint64(0xA0761D6478BD642F))
            found.append((o[new] * COORDINATES + (dart % np.uint64(COORDINATES)).astype(np.int64), rank[new], (dart >> np.uint64(32)).astype(np.uint32)))
        cell, r, value = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.lexsort((value, r, cell))
        cell, r, value = cell[order], r[order], value[order]
        head = np.ones(len(cell), bool)
        head[1:] = cell[1:] != cell[:-1]
        cell, r, value = cell[head], r[head], value[head]
        empty = ~np.isfinite(least[cell])
        least[cell[empty]] = r[empty]
        out.reshape(-1)[cell[empty]] = value[empty]
        todo &= ~np.isfinite(least.reshape(n, COORDINATES)).all(axis=1)
        low[todo], limit[todo] = limit[todo], limit[todo] * 2
    return out


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, total, sig) of every row: the text's own hash, its total weight, its signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, own in chunks(batch, limit=8 << 20, rows=1000):
                values, index, sizes = distinct(pc.ascii_split_whitespace(own))
                index, sizes = without_empty(values, index, sizes)
                x, weight, per = shingles(word_hashes(values)[index], sizes)
                sig = signatures(x, weight, per)
                total = np.where(sizes == 0, 0, np.maximum(sizes - SHINGLE + 1, 1))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("key"), pa.array(total), pa.array([r.tobytes() for r in sig], pa.binary())],
                                                 names=["doc_id", "key", "total", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text", text_key().alias("key")), run, f"doc_id {kind}, key string, total bigint, sig binary")


def text_key():
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def banded(sigs: DataFrame) -> DataFrame:
    """(id, bucket): one bucket per band; texts without words are in none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES).astype(np.uint64)
            bands = COORDINATES // BAND
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
            for k in range(BAND):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, k::BAND][:, :bands])
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(np.repeat(np.arange(len(sig)), bands))), pa.array(key.view(np.int64).ravel())], names=["id", "bucket"])

    return map_arrow(sigs.where("total > 0").select("id", "sig"), run, "id bigint, bucket bigint")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose lengths and signatures leave a distance of twice a link's possible; good: their texts have
    a weighted Jaccard similarity of ``SIMILAR`` or more, counted exactly.

    Pairs are dealt by the blocks of their texts, and a text is sent once to each two blocks that
    compare it, however many of their pairs it is in.
    """
    def run(pairs: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids, total = rows.column("id").to_numpy(), rows.column("total").to_numpy()
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        order = np.argsort(ids)
        a, b = (order[np.searchsorted(ids, pairs.column(c).to_numpy(), sorter=order)] for c in "ab")
        ratio = np.minimum(total[a], total[b]) / np.maximum(total[a], total[b])
        share = np.zeros(len(a))
        for k in range(0, len(a), 50_000):
            share[k:k + 50_000] = (sig[a[k:k + 50_000]] == sig[b[k:k + 50_000]]).mean(axis=1)
        near = (ratio >= 2 * SIMILAR - 1) & (share >= WEAK)
        a, b, hopeful = a[near], b[near], ((ratio >= SIMILAR) & (share >= HOPEFUL))[near]
        good = np.zeros(len(a), bool)
        good[hopeful] = similar(rows.column("text"), a[hopeful], b[hopeful])
        return pa.table({"a": ids[a], "b": ids[b], "good": good})

    at = texts.select("id", "block")
    a, b = (at.select(F.col("id").alias(k), F.col("block").alias(f"block_{k}")) for k in "ab")
    placed = written(pairs.join(a, "a").join(b, "b").select("a", "b", F.least("block_a", "block_b").alias("one"), F.greatest("block_a", "block_b").alias("two")))
    sent = again(placed).select("one", "two", F.explode(F.array("a", "b")).alias("id")).distinct().join(texts.drop("block"), "id")
    importable(pairs.sparkSession)
    return placed.groupBy("one", "two").cogroup(sent.groupBy("one", "two")).applyInArrow(run, "a bigint, b bigint, good boolean")


def similar(texts: pa.ChunkedArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of positions in ``texts`` have a similarity of ``SIMILAR`` or more."""
    out = np.zeros(len(a), bool)
    if not len(a):
        return out
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[:len(a)], place[len(a):]
    if len(np.unique(b)) < len(np.unique(a)):
        a, b = b, a
    reaches = meeting(*shingled(texts.take(pa.array(used)).combine_chunks()))
    order = np.argsort(a, kind="stable")
    for mine in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
        out[mine] = reaches(a[mine[0]], b[mine])
    return out


def shingled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of several texts, as ``shingles`` gives them; a null text counts as an empty one."""
    values, index, sizes = distinct(pc.ascii_split_whitespace(pc.fill_null(texts, "")))
    index, sizes = without_empty(values, index, sizes)
    return shingles(word_hashes(values)[index], sizes)


def meeting(x: np.ndarray, weight: np.ndarray, per: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
    """A function that tells which of several texts are similar to one; all have words."""
    owner, starts = np.repeat(np.arange(len(per)), per), np.cumsum(per) - per
    code = np.unique(x, return_inverse=True)[1]
    total, own = np.bincount(owner, weight, len(per)), np.zeros(len(x), np.int64)

    def reaches(u: int, others: np.ndarray) -> np.ndarray:
        mine = slice(starts[u], starts[u] + per[u])
        own[code[mine]] = weight[mine]
        at = ragged(np.arange(len(x)), starts[others], per[others])
        common = np.add.reduceat(np.minimum(weight[at], own[code[at]]), np.cumsum(per[others]) - per[others])
        own[code[mine]] = 0
        return common >= SIMILAR * (total[others] + total[u] - common) - 1e-9

    return reaches


def both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def as_pairs(meets: DataFrame) -> DataFrame:
    return meets.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()


def links(held: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) enough to connect all similar texts that share a bucket of ``held(bucket, id)``; texts(id, family, total, sig, text, block).

    The texts of a bucket are compared with its heads.  In each turn some of the
    texts that no head is linked to, those with the most company first, become
    heads, twice as many as in the turn before, and meet all texts of the
    bucket, so a large family of near copies costs a few passes.  Texts that
    are alike but no copies stay open for long; those left after the last turn
    are compared with their whole families, block by block (``open_links``).
    Then only two texts linked to heads of different components may still be
    an unseen link.  Each is within twice a link's distance of the other's
    head, so texts that come so near to a head of another component meet the
    whole bucket as well.
    """
    # the text that meets the most others is nearest the middle of its family, and links the most
    crowd = held.groupBy("bucket").agg(F.count("*").alias("n"))
    met_by = held.join(crowd, "bucket").groupBy("id").agg((-F.sum("n")).alias("crowd"))
    open_ = written(held.join(met_by, "id").withColumn("rank", F.xxhash64("id")))
    heads, met, known, close = 1, None, None, None
    add = lambda old, new: new if old is None else old.union(new)
    while True:
        chosen = written(open_.groupBy("bucket", F.pmod("rank", F.lit(heads)).alias("slot")).agg(F.min(F.struct("crowd", "rank", "id")).alias("h"))
                         .select("bucket", F.col("h.id").alias("head")))
        meets = written(held.join(chosen, "bucket").where("id <> head"))
        pairs = as_pairs(meets) if known is None else as_pairs(meets).join(known.select("a", "b"), ["a", "b"], "left_anti")
        pairs = written(pairs)
        near = written(compared(pairs, texts))
        met, known, close = add(met, meets), add(known, pairs), add(close, near.where("good").select("a", "b"))
        linked = meets.join(both_ways(close).select(F.col("a").alias("id"), F.col("b").alias("head")), ["id", "head"], "left_semi")
        # a head is done though it met no one: its bucket may hold no other text of a large family
        done = linked.select("bucket", "id").union(chosen.select("bucket", F.col("head").alias("id"))).distinct()
        open_ = written(open_.join(done, ["bucket", "id"], "left_anti"))
        weak = near.select("a", "b") if heads == 1 else weak.union(near.select("a", "b"))
        if heads == MOST_HEADS or open_.isEmpty():
            break
        heads *= 2
    if not open_.isEmpty():
        close = written(close.union(open_links(texts, open_.select("id").distinct())))
    if close.isEmpty():
        return close
    # texts close to a head of another component than their own
    part = written(components(close))
    of = lambda name: part.select(F.col("node").alias(name), F.col("component").alias(f"c_{name}"))
    across = (met.join(both_ways(weak).select(F.col("a").alias("id"), F.col("b").alias("head")), ["id", "head"], "left_semi")
              .join(of("id"), "id").join(of("head"), "head").where("c_id <> c_head").select("bucket", F.col("id").alias("head"), F.col("c_id").alias("c_head")).distinct())
    border = held.join(across, "bucket").join(of("id"), "id").where("c_id <> c_head")
    pairs = written(as_pairs(border).join(known.select("a", "b"), ["a", "b"], "left_anti"))
    if pairs.isEmpty():
        return close
    return written(close.union(compared(pairs, texts).where("good").select("a", "b")))


def open_links(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """All links (a, b) between the texts of ``ids`` and the texts of their families.

    Both are dealt into blocks, and a task meets one block of either; so a text
    is sent once for each block of the other side, and no pair is a row.
    """
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        group = group.take(np.argsort(~group.column("is_open").to_numpy(zero_copy_only=False), kind="stable"))
        ids, total, n = group.column("id").to_numpy(), group.column("total").to_numpy(), int(pc.sum(group.column("is_open")).as_py() or 0)
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        reaches = meeting(*shingled(group.column("text").combine_chunks()))
        a, b = [], []
        for u in range(n):
            hopeful = n + np.flatnonzero(((sig[n:] == sig[u]).mean(axis=1) >= HOPEFUL) & (ids[n:] != ids[u])
                                         & (np.minimum(total[n:], total[u]) >= SIMILAR * np.maximum(total[n:], total[u])))
            if len(hopeful):
                near = hopeful[reaches(u, hopeful)]
                a.append(np.full(len(near), ids[u]))
                b.append(ids[near])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    opened = ids.join(texts.select("id", "family", "total"), "id")
    size = lambda df: df.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("total") / BLOCK_WORDS)).alias("blocks"))
    sizes = written(size(opened).withColumnRenamed("blocks", "open_blocks").join(size(texts), "family"))
    one, two = (F.pmod(F.xxhash64("id", F.lit(k)), F.col(n)).alias(k) for k, n in (("one", "open_blocks"), ("two", "blocks")))
    every = lambda n, k: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)).alias(k)
    all_ = texts.drop("block").join(sizes, "family")
    columns = ["family", "id", "total", "sig", "text"]
    meet = (all_.join(ids, "id", "left_semi").select(*columns, F.lit(True).alias("is_open"), one, every("blocks", "two"))
            .union(all_.select(*columns, F.lit(False).alias("is_open"), every("open_blocks", "one"), two)))
    importable(texts.sparkSession)
    return meet.groupBy("family", "one", "two").applyInArrow(run, "a bigint, b bigint").distinct()


def spanning(held: DataFrame, sigs: DataFrame) -> DataFrame:
    """Edges (a, b) that connect, in each bucket, what signatures that may be similar connect: at most one per row.

    A bucket too large for a task is connected whole; the next step tells its
    texts apart.
    """
    def run(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        total = group.column("total").to_numpy()
        left, queue, out = np.arange(len(ids)), [], []
        while len(left):
            if not queue:
                queue, left = [left[0]], left[1:]
            u = queue.pop()
            near = ((sig[left] == sig[u]).mean(axis=1) >= HOPEFUL) & (np.minimum(total[left], total[u]) >= SIMILAR * np.maximum(total[left], total[u]))
            out += [(ids[u], ids[v]) for v in left[near]]
            queue += left[near].tolist()
            left = left[~near]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    sizes = held.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    known = held.join(sizes, "bucket")
    importable(held.sparkSession)
    small = known.where(F.col("n") <= TASK_TEXTS).select("bucket", "id").join(sigs, "id").groupBy("bucket").applyInArrow(run, "a bigint, b bigint")
    large = known.where((F.col("n") > TASK_TEXTS) & (F.col("id") != F.col("first"))).select(F.col("first").alias("a"), F.col("id").alias("b"))
    return small.union(large).distinct()


def told_apart(families: DataFrame) -> DataFrame:
    """Edges (a, b) of exact similarity that connect the texts of each family (family, id, text): a search from text to text.

    A text meets only those that no link has reached yet, all at once, by the
    postings of its shingles.
    """
    def run(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        values, index, sizes = distinct(pc.ascii_split_whitespace(group.column("text").combine_chunks()))
        index, sizes = without_empty(values, index, sizes)
        x, weight, per = shingles(word_hashes(values)[index], sizes)
        owner, ends = np.repeat(np.arange(len(ids)), per), np.cumsum(per)
        code = np.unique(x, return_inverse=True)[1]
        order = np.argsort(code, kind="stable")
        begin = np.searchsorted(code[order], np.arange(code.max() + 2)) if len(code) else np.zeros(1, np.int64)
        total = np.bincount(owner, weight, len(ids))
        open_, queue, out = np.ones(len(ids), bool), [], []
        for start in range(len(ids)):
            if open_[start]:
                open_[start] = False
                queue = [start]
            while queue:
                u = queue.pop()
                mine = slice(ends[u] - per[u], ends[u])
                counts = (begin[code[mine] + 1] - begin[code[mine]]).astype(np.int64)
                at = order[ragged(np.arange(len(order)), begin[code[mine]], counts)]
                common = np.bincount(owner[at], np.minimum(weight[at], np.repeat(weight[mine], counts)), len(ids))
                near = np.flatnonzero(open_ & (common >= SIMILAR * (total + total[u] - common) - 1e-9) & (common > 0))
                open_[near] = False
                out += [(ids[u], ids[v]) for v in near]
                queue += near.tolist()
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    importable(families.sparkSession)
    return families.groupBy("family").applyInArrow(run, "a bigint, b bigint")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, class_id, kept) for every row of ``docs``.

    class_id is the least doc_id of all documents that exact copies and links
    of similarity 0.8 or more reach; kept marks the row with that id, and the
    least key among several such texts.  A null text counts as an empty one;
    texts without words are copies of equal texts only; repeated rows share
    their class; a null doc_id is the last choice, and a class without any id
    has a null class_id, but keeps a text of its own; an empty table gives no
    rows.
    """
    rows = written(signed(docs))
    distinct_texts = rows.groupBy("key").agg(F.min("doc_id").alias("least_id"), F.first("total").alias("total"), F.first("sig").alias("sig"))
    sigs = written(distinct_texts.withColumn("id", F.monotonically_increasing_id()))
    members = written(banded(sigs))
    busy = members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("who")).where("n > 1")
    # bands in which the same texts meet are one bucket
    one = busy.groupBy("n", "who").agg(F.min("bucket").alias("bucket")).select("bucket")
    held = written(members.join(one, "bucket", "left_semi"))
    discard(members)
    signs = sigs.select("id", "total", "sig")
    family = components(spanning(held, signs)).select(F.col("node").alias("id"), F.col("component").alias("family"))
    family = written(family.join(sigs.select("id", "key", "total"), "id"))
    size = family.groupBy("family").agg((F.count("*") * F.sum("total")).alias("work"), F.count("*").alias("n"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_TEXTS, F.col("work") / F.col("n") / BLOCK_WORDS))
    family = written(family.join(size, "family").withColumn("large", (F.col("n") > TASK_TEXTS) | (F.col("work") > TASK_WORK))
                     .withColumn("block", F.xxhash64("family", F.pmod(F.xxhash64("id"), blocks))))
    # families grow with the documents: joined by a shuffle at every size, never broadcast
    texts = written(docs.select("text", text_key().alias("key")).join(family.select("id", "key", "family", "large", "block").hint("merge"), "key")
                    .groupBy("id", "family", "large", "block").agg(F.first("text").alias("text")))
    found = told_apart(texts.where("not large").select("family", "id", "text"))
    if not texts.where("large").isEmpty():
        large = written(texts.where("large").select("id", "family", "block", "text").join(signs, "id"))
        found = found.union(links(written(held.join(large.select("id"), "id", "left_semi").select("bucket", "id")), large))
    part = components(found).withColumnRenamed("node", "id")
    whole = written(sigs.select("id", "key", "least_id").join(part, "id", "left").withColumn("component", F.coalesce("component", "id")))
    # nulls sort first in a struct, so an id goes before none by the flag
    first = F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "key")).alias("first")
    least = whole.groupBy("component").agg(first).select("component", F.col("first.least_id").alias("class_id"), F.col("first.key").alias("_first"))
    named = whole.join(least, "component").select(F.col("key").alias("_key"), "class_id", "_first")
    out = rows.select("doc_id", "key").join(named, F.col("key") == F.col("_key"))
    return out.select("doc_id", "key", "class_id", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("_first"))).alias("kept"))


def without_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, with the columns of ``docs``; of repeated rows of one id and text, one."""
    chosen = written(classes(docs).where("kept").groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.count("*").alias("_n")))
    kept = docs.withColumn("_own", text_key()).join(chosen, (F.col("_own") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    once = kept.where("_n = 1").select(*docs.columns)
    return once.union(kept.where("_n > 1").dropDuplicates(["_own", "doc_id"]).select(*docs.columns))
