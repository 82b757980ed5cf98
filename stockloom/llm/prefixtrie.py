"""Prefix trie of rebuilt conversations, from fingerprints that compose like the sequences they stand for.

A sequence of turns t1..tn has the element (n, F) with F = sum of ti * r^i
modulo a prime; (m, F) followed by (n, G) is (m + n, F + r^m * G).  The element
of "the first turns of one conversation, then the rest of another" follows
from stored prefix elements alone, so no rebuilt text is ever made.  Four
lanes with their own r give 124 bits.  All members of a node are then verified
to have the same parent and, by reference to the stored turns, the same last
turn (SHA-256); if any differ, other values of r are drawn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, map_arrow, written

PRIME = (1 << 31) - 1
LANES = range(4)
#: Ids joined in one piece of text before they are hashed.
PIECE = 8192
KEY = ("depth", "k1", "k2")


def radices(seed: int) -> list[int]:
    """The r of each lane; other seeds give other ones."""
    return [int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:8]) % (PRIME - 2) + 2 for i in LANES]


def times(a: Column, b: Column) -> Column:
    return a * b % PRIME


def lanes(name: str) -> list[str]:
    return [f"{name}{i}" for i in LANES]


def per_lane(make) -> dict[str, Column]:
    """Columns of all lanes from a function of the lane's number."""
    return {k: v for i in LANES for k, v in make(i).items()}


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of role and text, told apart by the role's length."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def power(r: int, n: np.ndarray) -> np.ndarray:
    """r^n modulo the prime for many n."""
    out, base, n = np.ones(len(n), np.int64), r, n.copy()
    while n.any():
        out[n & 1 == 1] = out[n & 1 == 1] * base % PRIME
        base, n = base * base % PRIME, n >> 1
    return out


def scan_partition(rs: list[int]):
    """Running elements of each conversation's turns within one sorted partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, n0, f0, w0 = None, 0, [0] * len(rs), 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, size = b.column("conv").to_numpy(), b.column("size").to_numpy()
            d = np.frombuffer(b"".join(b.column("dg").to_pylist()), ">i8").reshape(-1, 4).astype(np.int64)
            first = np.r_[True, ids[1:] != ids[:-1]]
            start = np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))
            more = (start == 0) if ids[0] == conv else np.zeros(len(ids), bool)  # rows that go on with the last batch's conversation
            pos = np.arange(len(ids)) - start + 1 + np.where(more, n0, 0)

            def running(x: np.ndarray, carry: int) -> np.ndarray:
                up = np.cumsum(x)
                return up - (up - x)[start] + np.where(more, carry, 0)

            out = {"part": b.column("part"), "conv": b.column("conv"), "pos": pos, "size": size, "w": running(size, w0)}
            f = []
            for i, r in enumerate(rs):
                # one 64-bit quarter of the digest gives the value of the turn in a lane, never 0
                term = ((d[:, i] >> 1) & (2 ** 62 - 1)) % (PRIME - 1) + 1
                term = term * power(r, pos) % PRIME
                f.append(running(term, f0[i]) % PRIME)
                out |= {f"d{i}": d[:, i], f"t{i}": term, f"f{i}": f[i]}
            conv, n0, f0, w0 = ids[-1], int(pos[-1]), [int(x[-1]) for x in f], int(out["w"][-1])
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out.values()], names=list(out))
    return run


def located(conversations: DataFrame, rs: list[int]) -> DataFrame:
    """(conv, pos, size, w, d, t, f): every turn's place, bytes up to it, digest, term and prefix fingerprint.

    One sort of narrow rows over all conversations (null turns first, ties by
    the turn's digest); running elements inside each partition, and what comes
    before a partition from one summary row for each, so the turns of a single
    conversation may fill many partitions.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", turn_digest(role, text).alias("dg"), F.octet_length(text).cast("long").alias("size"))
    order = ["conv", F.asc_nulls_first("turn"), "dg"]
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row").sortWithinPartitions(*order)
    schema = "part int, conv bigint, pos bigint, size bigint, w bigint, " + ", ".join(f"d{i} bigint, t{i} bigint, f{i} bigint" for i in LANES)
    local = written(map_arrow(rows.select(F.spark_partition_id().alias("part"), "conv", "dg", "size"), scan_partition(rs), schema))

    ends = local.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    tails = (local.join(ends, "part").where("conv = high").groupBy("part", "low", "high")
             .agg(F.count("*").alias("n"), F.sum("size").alias("w"), *(F.sum(f"t{i}").alias(f"f{i}") for i in LANES)).orderBy("part").collect())
    carries, conv, n, w, f = [], None, 0, 0, [0] * len(rs)
    for p in tails:  # one row per partition
        if p.low == conv:
            carries.append((p.part, conv, n, w, *(pow(r, n, PRIME) for r in rs), *f))
        if p.low == p.high == conv:
            f = [(f[i] + pow(r, n, PRIME) * p[f"f{i}"]) % PRIME for i, r in enumerate(rs)]
            n, w = n + p.n, w + p.w
        else:
            conv, n, w, f = p.high, p.n, p.w, [p[f"f{i}"] % PRIME for i in LANES]
    names = ["c_part", "c_conv", "c_n", "c_w", *lanes("s"), *lanes("c")]
    carry = local.sparkSession.createDataFrame(carries, ", ".join(f"{c} {'int' if c == 'c_part' else 'bigint'}" for c in names))
    there = local.join(F.broadcast(carry), (F.col("part") == F.col("c_part")) & (F.col("conv") == F.col("c_conv")), "left")
    shifted = lambda c, i: times(F.col(f"{c}{i}"), F.coalesce(f"s{i}", F.lit(1)))
    return there.select(
        "conv", (F.col("pos") + F.coalesce("c_n", F.lit(0))).alias("pos"), "size", (F.col("w") + F.coalesce("c_w", F.lit(0))).alias("w"), *lanes("d"),
        *(shifted("t", i).alias(f"t{i}") for i in LANES), *(((shifted("f", i) + F.coalesce(f"c{i}", F.lit(0))) % PRIME).alias(f"f{i}") for i in LANES))


def rebuilt(turns: DataFrame, rs: list[int], every: int, heads: int) -> DataFrame:
    """One row per conversation with the elements its rebuilt form is composed of.

    ``h`` turns fall away at its start and ``head`` (at most heads - 1 stored
    turns of conversation c - c % every) takes their place.
    """
    base = F.col("conv") - F.col("conv") % every
    h = F.when(base == F.col("conv"), F.lit(0)).otherwise(F.crc32(F.col("conv").cast("string")) % heads)
    own = turns.groupBy("conv").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes"), F.coalesce(F.sum(F.when(F.col("pos") <= h, F.col("size"))), F.lit(0)).alias("cut"),
        *(F.sum(f"t{i}").alias(f"all{i}") for i in LANES), *(F.coalesce(F.sum(F.when(F.col("pos") <= h, F.col(f"t{i}"))), F.lit(0)).alias(f"h{i}") for i in LANES))
    first = (turns.where((F.col("pos") < heads) & (base == F.col("conv"))).groupBy(F.col("conv").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "size", "w", *lanes("d"), *lanes("t"), *lanes("f")))).alias("head")))
    both = own.withColumn("h", h).withColumn("base", base).join(first, "base", "left").withColumn(
        "head", F.coalesce(F.expr("slice(head, 1, cast(h as int))"), F.array().cast(first.schema["head"].dataType)))
    # one row per conversation; what a rebuilt one starts with
    both = both.withColumns({"take": F.size("head").cast("long"), "last": F.get("head", F.size("head") - 1)})
    back = lambda r: F.array(*(F.lit(pow(r, -k, PRIME)) for k in range(heads)))
    both = both.withColumns({"w0": F.coalesce(F.col("last.w"), F.lit(0))} | per_lane(lambda i: {
        f"b{i}": F.coalesce(F.col(f"last.f{i}"), F.lit(0)), f"s{i}": F.get(back(rs[i]), (F.col("h") - F.col("take")).cast("int"))}))
    rest = F.col("n") > F.col("h")
    end = lambda i: F.when(rest, (F.col(f"b{i}") + times(F.pmod(F.col(f"all{i}") - F.col(f"h{i}"), F.lit(PRIME)), F.col(f"s{i}"))) % PRIME).otherwise(F.col(f"b{i}"))
    return both.withColumns(per_lane(lambda i: {f"e{i}": end(i)}) | {
        "total": F.col("w0") + F.when(rest, F.col("bytes") - F.col("cut")).otherwise(0),
        "end": F.col("take") + F.greatest(F.col("n") - F.col("h"), F.lit(0))}).select(
        "conv", "h", "take", "head", "w0", "cut", *lanes("h"), *lanes("b"), *lanes("s"), *lanes("e"), "total", "end")


def key(name: str, first: str, second: str) -> list[Column]:
    """Two 62-bit halves of a fingerprint."""
    half = lambda a, b: F.col(f"{name}{a}") * (1 << 31) + F.col(f"{name}{b}")
    return [half(0, 1).alias(first), half(2, 3).alias(second)]


def members(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv, depth, k, p, d, before, size): each rebuilt conversation at each of its prefixes, root included.

    k and p are the fingerprints of the prefix and of its parent, d the digest
    of its last turn, ``before`` the bytes of the turns above.
    """
    zero = F.lit(0).cast("long")
    out = ["conv", "depth", *key("f", "k1", "k2"), *key("p", "p1", "p2"), *lanes("d"), "before", "size"]
    minus = lambda a, b: F.pmod(a - b, F.lit(PRIME))
    f, t = (lambda i: F.col(f"f{i}")), (lambda i: F.col(f"t{i}"))
    own = (turns.join(plan.select("conv", "h", "take", "w0", "cut", *lanes("h"), *lanes("b"), *lanes("s")), "conv").where("pos > h")
           .withColumn("depth", F.col("take") + F.col("pos") - F.col("h")).withColumn("before", F.col("w0") + F.col("w") - F.col("size") - F.col("cut")))
    moved = lambda x, i: (F.col(f"b{i}") + times(minus(x, F.col(f"h{i}")), F.col(f"s{i}"))) % PRIME
    own = own.withColumns(per_lane(lambda i: {f"p{i}": moved(minus(f(i), t(i)), i), f"m{i}": moved(f(i), i)})).drop(*lanes("f")).withColumnsRenamed({f"m{i}": f"f{i}" for i in LANES})
    head = (plan.select("conv", F.explode("head").alias("e")).select("conv", "e.*").withColumnRenamed("pos", "depth")
            .withColumn("before", F.col("w") - F.col("size")).withColumns(per_lane(lambda i: {f"p{i}": minus(f(i), t(i))})))
    root = plan.select("conv", *(zero.alias(c) for c in ("depth", "k1", "k2", "p1", "p2", *lanes("d"), "before", "size")))
    return own.select(*out).union(head.select(*out)).union(root)


def end_hashes(plan: DataFrame) -> DataFrame:
    """SHA-256 of the joined ids of the conversations that end at a node.

    Ids are sorted over all nodes at once and joined in pieces; a hash takes
    its node's pieces one after the other, holding one at a time.
    """
    ends = plan.select(F.col("end").alias("depth"), *key("e", "k1", "k2"), "conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).to_numpy() for c in (*KEY, "conv")]
            new = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)]) if b.num_rows else []
            starts = sorted({*new, *range(0, b.num_rows, PIECE)})
            stops = [*starts[1:], b.num_rows]
            texts = [",".join(map(str, cols[3][s:e].tolist())) for s, e in zip(starts, stops)]
            yield pa.RecordBatch.from_arrays([pa.array(c[starts]) for c in cols] + [pa.array(texts, pa.string())], names=[*KEY, "conv", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        done = lambda k, s: pa.RecordBatch.from_pylist([dict(zip(KEY, k), ends_sha256=s.hexdigest())])
        for b in batches:
            out = []
            for *node, ids in zip(*(b.column(c).to_pylist() for c in (*KEY, "ids"))):
                if node != now:
                    if now is not None:
                        out.append(dict(zip(KEY, now), ends_sha256=sha.hexdigest()))
                    now, sha = node, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out)
        if now is not None:
            yield done(now, sha)

    one = "depth bigint, k1 bigint, k2 bigint"
    joined = map_arrow(ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv"), pieces, f"{one}, conv bigint, ids string")
    return map_arrow(joined.repartition(*KEY).sortWithinPartitions(*KEY, "conv").drop("conv"), hashes, f"{one}, ends_sha256 string")


def grouped(rows: DataFrame) -> DataFrame:
    """The nodes: least member, members, and what all members must agree on."""
    agree = [*lanes("d"), "p1", "p2", "before", "size"]
    out = rows.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"),
                                 *(F.min(c).alias(c) for c in agree), *(F.max(c).alias(f"{c}_max") for c in agree))
    apart = F.lit(False)
    for c in agree:
        apart = apart | (F.col(c) != F.col(f"{c}_max"))
    return out.withColumn("apart", apart).drop(*(f"{c}_max" for c in agree), *lanes("d"))


def trie(conversations: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations, with the figures of their subtrees.

    Conversation c is rebuilt from the first h = crc32(c) % heads turns of
    conversation c - c % every (all if it has fewer, none if it is absent) and
    its own turns after the first h.  Turns are ordered by ``turn``, null
    first, rows of one turn by their digest.  A null role or text counts as
    empty; rows without ``conv_id`` belong to no conversation and are left
    out; repeated rows are turns of their own; an empty table has no node, not
    even a root; other columns are ignored.

    A conversation leads a node if it is its least member; it then leads all
    nodes below on its own path, so each one leads its path from some depth on.
    Figures of subtrees come from sums over members and these depths: no pair
    of a node and its ancestor is made.
    """
    for seed in range(16):
        rs = radices(seed)
        turns = located(conversations, rs)
        plan = written(rebuilt(turns, rs, every, heads))
        rows = written(members(turns, plan))
        nodes = written(grouped(rows))
        if not nodes.where("apart").limit(1).count():
            break
        for t in (plan, rows, nodes):
            discard(t)
    else:
        raise RuntimeError("fingerprints of different prefixes coincide for every radix")

    leads = nodes.groupBy("conv").agg(F.min("depth").alias("from"), F.max("depth").alias("to"), F.min("before").alias("above"))
    nodes = nodes.join(leads, "conv")
    # only where a conversation leaves another's path does a node's parent have another leader
    branches = nodes.where("depth = from and depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("conv").alias("child"))
    nodes = written(nodes.join(branches.groupBy(*KEY).agg(F.count("*").alias("n_branches")), [*KEY], "left").withColumn(
        "n_children", F.coalesce("n_branches", F.lit(0)) + (F.col("depth") < F.col("to")).cast("long")))
    parents = branches.join(nodes.select(*KEY, F.col("conv").alias("parent")), [*KEY]).select(F.col("child").alias("conv"), "parent")
    per_conv = written(plan.select("conv", "end", "total").join(leads.select("conv", "from", "above"), "conv", "left")
                       .join(nodes.where("n_children = 0").select("conv", F.lit(1).cast("long").alias("leaf")), "conv", "left")
                       .join(parents, "conv", "left")
                       .select("conv", F.coalesce("from", F.col("end") + 1).alias("from"), F.coalesce("above", "total").alias("above"),
                               F.coalesce("leaf", F.lit(0)).alias("leaf"), "parent"))
    led = (rows.select("conv", *KEY, "before").join(per_conv.select("conv", "from", "above", "leaf"), "conv").where(F.col("depth") < F.col("from"))
           .groupBy(*KEY).agg(F.sum("leaf").alias("leaves"), F.sum(F.col("above") - F.col("before")).alias("saved")))
    return (nodes.join(led, [*KEY], "left").join(end_hashes(plan), [*KEY], "left").join(per_conv.select("conv", "leaf", "parent"), "conv").select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") > F.col("from"), F.col("conv")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", "n_children", (F.coalesce("leaves", F.lit(0)) + F.col("leaf")).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
