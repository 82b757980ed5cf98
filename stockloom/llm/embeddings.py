"""Near copies among embeddings: an inverted multi-index over two vector halves, then exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import again, components, importable, map_arrow, written

COSINE = 0.93
#: Vectors that the codebooks are fitted on, at most; every vector is indexed.
SAMPLE = 20_000
#: Mean vectors per cell that the codebooks aim at, the largest codebook, and the cells a query visits at most; where
#: that finds too few links, cells are made larger, up to whole labels.
PER_CELL, MAX_CODES, MAX_VISITS = 64, 256, 128
#: Share of a vector's links that the visits must find, in the mean of the measured vectors.
RECALL = 0.9998
#: Vectors compared with all of their label to measure that, at first and at most, and those with links that are enough.
QUERIES, MAX_QUERIES, ENOUGH = 16_384, 65_536, 5000
#: Bytes of query vectors that tasks share, at most.
QUERY_BYTES = 1 << 26
#: Points and queries that meet in one task at once.
BLOCK = 4096


def unit_rows(flat: np.ndarray) -> np.ndarray:
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def usable() -> Column:
    """Whether a vector may link: with a label, no null or non-finite component, not all zero."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0) & fine & F.exists(e, lambda x: x != 0), F.lit(False))


def codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means centres of the rows, fewer if there are fewer different rows."""
    different = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = different[rng.permutation(len(different))[:k]]
    for _ in range(rounds):
        nearest = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, nearest, x)
        n = np.bincount(nearest, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T, 0)


def nearest_cells(x: np.ndarray, first: np.ndarray, second: np.ndarray, visits: int) -> np.ndarray:
    """Multi-sequence traversal: the ``visits`` cells of the product grid nearest to each row, nearest first.

    With both halves' centres in order of distance, the cell (i, j) has (i+1)(j+1)
    cells that are at least as near, itself included; so the nearest ``visits`` ones lie
    under that hyperbola, and only those are sorted.
    """
    h = x.shape[1] // 2
    d1, d2 = distances(x[:, :h], first), distances(x[:, h:], second)
    o1, o2 = np.argsort(d1, axis=1, kind="stable"), np.argsort(d2, axis=1, kind="stable")
    d1, d2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
    i, j = np.meshgrid(np.arange(len(first)), np.arange(len(second)), indexing="ij")
    under = (i + 1) * (j + 1) <= visits
    i, j = i[under], j[under]
    best = np.argsort(d1[:, i] + d2[:, j], axis=1, kind="stable")[:, :visits]
    return np.take_along_axis(o1, i[best], 1) * len(second) + np.take_along_axis(o2, j[best], 1)


def ranks(x: np.ndarray, cells: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each row, how many cells of the product grid are nearer to it than the given one, or as near."""
    h = x.shape[1] // 2
    d1, d2 = distances(x[:, :h], first), distances(x[:, h:], second)
    at = np.arange(len(x))
    own = d1[at, cells // len(second)] + d2[at, cells % len(second)]
    out = np.empty(len(x), np.int64)
    step = max(1, (1 << 22) // (len(first) * len(second)))
    for start in range(0, len(x), step):
        part = slice(start, start + step)
        out[part] = (d1[part, :, None] + d2[part, None, :] <= own[part, None, None]).sum(axis=(1, 2)) - 1
    return out


def measured(points: DataFrame, queries: list[tuple[int, str, bytes]], first: np.ndarray, second: np.ndarray, cosine: float) -> np.ndarray:
    """(query, rank, links) as rows: to how many points of its label each query is linked whose cell is the rank-th nearest to it.

    Ranks are binned to their top four bits, rounded up, so what comes back is
    bounded by the queries, however many links they have.
    """
    spark = points.sparkSession
    ids, of = np.array([q[0] for q in queries]), np.array([q[1] for q in queries])
    shared = spark.sparkContext.broadcast((ids, of, np.frombuffer(b"".join(q[2] for q in queries), np.float64).reshape(len(ids), -1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, of, q = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float64).reshape(batch.num_rows, -1)
            own, pid, label = nearest_cells(x, first, second, 1)[:, 0], batch.column("id").to_numpy(), np.array(batch.column("label").to_pylist())
            n_cells, bins = len(first) * len(second), []
            for name in np.unique(label):
                mine, theirs = np.flatnonzero(of == name), np.flatnonzero(label == name)
                for start in range(0, len(mine), 256):
                    some = mine[start:start + 256]
                    a, b = np.nonzero((q[some] @ x[theirs].T >= cosine) & (ids[some][:, None] != pid[theirs][None, :]))
                    pair, n = np.unique(some[a] * n_cells + own[theirs[b]], return_counts=True)
                    if len(pair):
                        r = ranks(q[pair // n_cells], pair % n_cells, first, second)
                        width = np.left_shift(1, np.maximum(np.frexp(r.astype(np.float64))[1] - 4, 0))
                        bins.append(np.stack([pair // n_cells, r - r % width + width - 1, n]))
            if bins:
                both = np.concatenate(bins, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in both], names=["query", "rank", "links"])

    found = map_arrow(points.select("id", "label", "x"), run, "query bigint, rank bigint, links bigint").groupBy("query", "rank").agg(F.sum("links").alias("links")).toArrow()
    return np.stack([found.column(c).to_numpy() for c in ("query", "rank", "links")], axis=1).astype(np.int64)


def visits_for(found: np.ndarray, recall: float) -> int:
    """The visits that find the wanted share of a query's links, in the mean of the queries that have any."""
    if not len(found):
        return 1
    query = np.unique(found[:, 0], return_inverse=True)[1]
    weight = found[:, 2] / np.bincount(query, found[:, 2])[query]
    order = np.argsort(found[:, 1], kind="stable")
    upto = np.cumsum(weight[order]) / weight.sum()
    # a link is found from either end, so one end may miss it
    return int(found[order[min(np.searchsorted(upto, 1 - (1 - recall) / 2 - 1e-12), len(order) - 1)], 1]) + 1


def planted(sample: np.ndarray, first: np.ndarray, second: np.ndarray, cosine: float, seed: int = 11) -> np.ndarray:
    """(query, rank, 1) for made-up links at the least cosine that counts: each sampled vector turned by that angle in a random direction."""
    rng = np.random.default_rng(seed)
    away = rng.normal(size=sample.shape)
    away -= (away * sample).sum(axis=1, keepdims=True) * sample
    turned = cosine * sample + np.sqrt(1 - cosine * cosine) * unit_rows(away)
    r = ranks(turned, nearest_cells(sample, first, second, 1)[:, 0], first, second)
    return np.stack([np.arange(len(sample)), r, np.ones(len(sample), np.int64)], axis=1).astype(np.int64)


def fitted(points: DataFrame, sample: np.ndarray, groups: int, n: int, cosine: float, recall: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Codebooks for ``n`` points, and the visits with which the measured vectors' links are found at the wanted recall.

    Queries, chosen by a hash, are compared with all points of their labels;
    there are more where few have links.  Where too few have any to tell, links
    made up at the least cosine that counts, the hardest to find, take their
    place.  Codebooks whose cells would need more than ``MAX_VISITS`` visits
    give way to ones of half the codes; a single cell is the whole label.
    """
    k = int(np.clip(np.sqrt(n / groups / PER_CELL), 1, MAX_CODES))
    h, most = sample.shape[1] // 2, max(1024, min(MAX_QUERIES, QUERY_BYTES // (8 * sample.shape[1])))
    many = min(QUERIES, most, n)
    while k > 1:
        first, second = codebook(sample[:, :h], k), codebook(sample[:, h:], k)
        while True:
            chosen = points.select("id", "label", "x").orderBy(F.xxhash64(F.lit(3), "label", "x"), "id").limit(many).toArrow()
            queries = list(zip(*(chosen.column(c).to_pylist() for c in ("id", "label", "x"))))
            found = measured(points, queries, first, second, cosine)
            known = many >= n or len(np.unique(found[:, 0])) >= ENOUGH
            if known or many >= most:
                break
            many = min(4 * many, most, n)
        visits = visits_for(found, recall)
        if not known:
            visits = max(visits, visits_for(planted(sample, first, second, cosine), recall))
        visits = min(visits, len(first) * len(second))
        if visits <= MAX_VISITS:
            return first, second, visits
        k //= 2
    return codebook(sample[:, :h], 1), codebook(sample[:, h:], 1), 1


def indexed(vectors: DataFrame, first: np.ndarray, second: np.ndarray, visits: int) -> DataFrame:
    """(id, label, x, own, visited): each vector's cell, and the cells it visits, the own one among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float64).reshape(batch.num_rows, -1)
            own = nearest_cells(x, first, second, 1)[:, 0]
            cells = nearest_cells(x, first, second, visits)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "n", "x")), pa.array(own.astype(np.int32)), pa.array(cells.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                                             names=["id", "label", "n", "x", "own", "visited"])

    return map_arrow(vectors, run, "id bigint, label string, n bigint, x binary, own int, visited array<int>")


def compared(points: DataFrame, queries: DataFrame, cosine: float) -> DataFrame:
    """(id, n, edge): by block of a cell, how many vectors each one is linked to, and links that connect them.

    A pair is counted at the query; at the point too, unless the point visits
    the query's cell, as the pair is then met, and counted, there again.
    """
    def run(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "edge": pa.array([], pa.int64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        p, q = (np.frombuffer(b"".join(t.column("x").to_pylist()), np.float64).reshape(t.num_rows, -1) for t in (left, right))
        pid, qid, pn, qn = (t.column(c).to_numpy() for c in ("id", "n") for t in (left, right))
        visited = right.column("own").to_numpy()
        width = len(left.column("visited")[0])
        seen = left.column("visited").combine_chunks().flatten().to_numpy().reshape(-1, width)
        found = (q @ p.T >= cosine) & (qid[:, None] != pid[None, :])
        a, b = np.nonzero(found)
        again = (seen[b] == visited[a][:, None]).any(axis=1)
        at_q = np.bincount(a, pn[b], len(qid)).astype(np.int64)
        at_p = np.bincount(b[~again], qn[a[~again]], len(pid)).astype(np.int64)
        # links that keep the block connected: each query with its first point, each point with its first query
        first_p = np.where(found.any(axis=1), pid[found.argmax(axis=1)], -1)
        edges = [(qid[i], at_q[i], first_p[i]) for i in np.flatnonzero(first_p >= 0)]
        first_q = found.argmax(axis=0)
        rest = [(pid[j], at_p[j], qid[first_q[j]]) for j in np.flatnonzero(found.any(axis=0))]
        both = [*edges, *rest, *_bridges(found, first_p, first_q, pid, qid)]
        return pa.table({k: pa.array([int(r[i]) for r in both], pa.int64()) for i, k in enumerate(("id", "links", "edge"))})

    importable(points.sparkSession)
    key = ["label", "cell", "salt_p", "salt_q"]
    return points.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(run, "id bigint, links bigint, edge bigint")


def _bridges(found: np.ndarray, first_p: np.ndarray, first_q: np.ndarray, pid: np.ndarray, qid: np.ndarray) -> list[tuple[int, int, int]]:
    """Further links (query, 0, point) where first links alone leave apart what the block connects."""
    queries, points = np.flatnonzero(first_p >= 0), np.flatnonzero(found.any(axis=0))
    at = {int(v): i for i, v in enumerate(pid)}
    root = list(range(len(qid) + len(pid)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in queries:
        root[find(int(i))] = find(len(qid) + at[int(first_p[i])])
    for j in points:
        root[find(len(qid) + int(j))] = find(int(first_q[j]))
    out = []
    if len({find(int(i)) for i in queries}) > 1:
        label_q = np.array([find(i) for i in range(len(qid))])
        label_p = np.array([find(len(qid) + j) for j in range(len(pid))])
        for i, j in zip(*np.nonzero(found & (label_q[:, None] != label_p[None, :]))):
            u, v = find(int(i)), find(len(qid) + int(j))
            if u != v:
                root[u] = v
                out.append((int(qid[i]), 0, int(pid[j])))
    return out


def linked(points: DataFrame, cosine: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """((id, links), (node, component)) of points (id, label, x, n), vectors of one width."""
    n = points.count()
    least = int((1 << 30) * min(1.0, SAMPLE / n))
    sample = points.where(F.pmod(F.xxhash64("label", "x"), F.lit(1 << 30)) < least).select("x").orderBy(F.xxhash64("x")).limit(2 * SAMPLE).toArrow()
    if not sample.num_rows:
        sample = points.select("x").orderBy(F.xxhash64("x")).limit(1).toArrow()
    x = np.frombuffer(b"".join(sample.column("x").to_pylist()), np.float64).reshape(sample.num_rows, -1)
    first, second, visits = fitted(points, x, points.select("label").distinct().count(), n, cosine, recall)
    index = written(indexed(points.select("id", "label", "n", "x"), first, second, visits))
    probes = again(index).select("id", "label", "n", "x", "own", F.explode("visited").alias("cell"))
    size = index.groupBy("label", F.col("own").alias("cell")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks_p"))
    asked = probes.groupBy("label", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks_q"))
    blocks = written(size.join(asked, ["label", "cell"]))
    salt = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    p = (index.withColumnRenamed("own", "cell").join(blocks, ["label", "cell"]).withColumn("salt_p", salt("blocks_p"))
         .withColumn("salt_q", every("blocks_q")).select("label", "cell", "salt_p", "salt_q", "id", "n", "x", "visited"))
    q = (probes.join(blocks, ["label", "cell"]).withColumn("salt_q", salt("blocks_q"))
         .withColumn("salt_p", every("blocks_p")).select("label", "cell", "salt_p", "salt_q", "id", "n", "x", "own"))
    met = written(compared(p, q, cosine))
    return met.groupBy("id").agg(F.sum("links").alias("links")), components(met.select(F.col("id").alias("a"), F.col("edge").alias("b")))


def near_copies(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors of one length link within a label, of whatever type, at a cosine,
    in double precision, of ``cosine`` or more.  Equal vectors of a label are
    one point of the index with a count, so a very common vector costs nothing.
    A cell with many points is cut into blocks.  A vector without a label,
    null, zero, or with a null or non-finite component links with nothing.
    Repeated rows are linked copies.  A null vec_id is never the smallest one;
    where there is no other, component_id is null.  An empty table gives no
    rows; other columns are ignored.  Vectors of another length than the most
    common one are filled up with zeros to a power of two, which changes no
    cosine, so that a few indexes serve any lengths.
    """
    size = F.size("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").withColumn("fine", usable())
    common = rows.where("fine").groupBy(size.alias("size")).count().orderBy(F.desc("count"), "size").first()
    even = common["size"] + common["size"] % 2 if common else 2
    width = F.when(size <= (even if common else 0), F.when(size > even - 2, even)).otherwise(F.lit(None))
    width = F.coalesce(width, F.greatest(F.lit(2), F.pow(F.lit(2.0), F.ceil(F.log2(size.cast("double"))))).cast("int")).cast("int")
    rows = rows.select("vec_id", F.when(F.col("fine"), F.concat_ws("|", size, F.col("label").cast("string"))).alias("label"),
                       F.when(F.col("fine"), width).alias("width"), F.when(F.col("fine"), F.col("embedding")).alias("embedding"))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes | None] = [None] * batch.num_rows
            e, widths = batch.column("embedding"), batch.column("width").to_numpy(zero_copy_only=False)
            sizes = e.value_lengths().to_numpy(zero_copy_only=False)
            for w, n in {(w, n) for w, n in zip(widths.tolist(), sizes.tolist()) if w == w and w is not None}:
                at = np.flatnonzero((widths == w) & (sizes == n))
                x = e.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
                x = unit_rows(x / np.abs(x).max(axis=1, keepdims=True))
                x = np.concatenate([x, np.zeros((len(at), int(w) - x.shape[1]))], axis=1)
                for i, r in zip(at.tolist(), x):
                    out[i] = r.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("width"), pa.array(out, pa.binary())], names=["vec_id", "label", "width", "x"])

    rows = written(map_arrow(rows, scaled, "vec_id bigint, label string, width int, x binary"))
    points = written(rows.where("x is not null").groupBy("label", "width", "x").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))
                     .withColumn("id", F.monotonically_increasing_id()))
    links, parts = None, None
    for w in sorted(r[0] for r in points.select("width").distinct().collect()):  # the common length and powers of two
        some = linked(points.where(F.col("width") == w), cosine, recall)
        links, parts = (some[0], some[1]) if links is None else (links.union(some[0]), parts.union(some[1]))
    alone = rows.where("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if links is None:
        return alone
    points = points.join(links, "id", "left").join(parts, points["id"] == parts["node"], "left").withColumn("component", F.coalesce("component", "id"))
    least = points.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    of_point = points.join(least, "component").select("label", "x", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "component_id")
    return rows.where("x is not null").join(of_point, ["label", "x"]).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")).union(alone)
