"""Shards of nearly equal bytes by a k-d tree over document metadata (native)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import running, same, unit, written

#: Bins of one pass of the median search, and passes: a cut is found to BINS ** -PASSES of a node's extent.
BINS, PASSES = 4096, 3
#: A cut so far off the wanted share of a node's bytes calls for another dimension.
UNEVEN = 0.002
DIMS = ("d_source", "d_lang", "d_size")


@dataclass
class Node:
    """A box of the tree; ``leaves`` shards come of it, from number ``first``."""
    first: int
    leaves: int
    dim: str | None = None
    cut: float | None = None
    low: "Node | None" = None
    high: "Node | None" = None


def sized(docs: DataFrame) -> DataFrame:
    """Identity, bytes and metadata of each document; a null text has no bytes and the CRC of none."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.xxhash64(text).alias("_h"), "source", "lang")


def points(rows: DataFrame) -> DataFrame:
    """One weighted point per distinct text, so copies share a shard.

    A category's place is its share of bytes in code-point order and the point's
    place within it a hash, so a source with a third of the bytes can be cut.
    """
    p = written(rows.groupBy("_h", "text_crc32", "size").agg(F.sum("size").alias("bytes"), F.min("source").alias("source"), F.min("lang").alias("lang")))
    for i, name in enumerate(("source", "lang")):
        order = Window.orderBy(F.col(name).asc_nulls_last())
        part = (p.groupBy(name).agg(F.sum("bytes").alias("_b"))
                .select(F.col(name).alias("_v"), (F.col("_b") / F.sum("_b").over(Window.partitionBy())).alias("_share"),
                        (F.coalesce(F.sum("_b").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) / F.sum("_b").over(Window.partitionBy())).alias("_from")))
        p = p.join(part, same(F.col(name), F.col("_v"))).withColumn(f"d_{name}", F.col("_from") + F.col("_share") * unit(F.col("_h"), seed=i)).drop("_v", "_share", "_from")
    return written(p.withColumn("d_size", F.log2(F.col("size") + unit(F.col("_h"), seed=2)) / 64).drop("source", "lang"))


def _place(node: Node, leaf) -> Column:
    if node.dim is None:
        return F.lit(leaf(node))
    return F.when(F.col(node.dim) < node.cut, _place(node.low, leaf)).otherwise(_place(node.high, leaf))


def _choose(options: dict[int, tuple], column) -> Column:
    """A literal per node number; the open nodes of a level are at most the shards."""
    out = F.lit(None)
    for k, v in options.items():
        out = F.when(F.col("_node") == k, column(v)).otherwise(out)
    return out


def _medians(at: DataFrame, state: dict[int, dict]) -> None:
    """Narrow each node's search by histograms of its bytes, all nodes in one job per pass."""
    for _ in range(PASSES):
        value = _choose(state, lambda s: F.col(s["dim"]))
        low, high, base, want = (_choose(state, lambda s, k=k: F.lit(float(s[k]))) for k in ("low", "high", "base", "want"))
        slot = F.when(high > low, F.least(F.floor((value - low) / (high - low) * BINS), F.lit(BINS - 1))).otherwise(F.lit(0))
        upto = F.sum("_b").over(Window.partitionBy("_node").orderBy("_bin")) + base
        sums = at.where((value >= low) & (value <= high)).groupBy("_node", slot.alias("_bin")).agg(F.sum("bytes").alias("_b"))
        crossing = sums.withColumn("_upto", upto).where(F.col("_upto") >= want).groupBy("_node").agg(F.min(F.struct("_bin", "_upto", "_b")).alias("c"))
        for r in crossing.collect():
            s, c = state[r["_node"]], r["c"]
            width = (s["high"] - s["low"]) / BINS
            s |= {"base": c["_upto"] - c["_b"], "over": c["_upto"], "low": s["low"] + c["_bin"] * width, "high": s["low"] + (c["_bin"] + 1) * width}


def split_level(p: DataFrame, root: Node, nodes: list[Node]) -> None:
    """Cut each open node at the weighted median of its widest dimension; the driver sees a few numbers per node.

    Where one large text lies across that median, the next dimensions are
    tried, and the evenest cut stays.
    """
    by, best = {n.first: n for n in nodes}, {}
    at = p.withColumn("_node", _place(root, lambda n: n.first)).where(F.col("_node").isin(list(by)))
    extent = {r["_node"]: r for r in at.groupBy("_node").agg(*(f(d).alias(f"{f.__name__}_{d}") for d in DIMS for f in (F.min, F.max)), F.sum("bytes").alias("bytes")).collect()}
    widest = {k: sorted(DIMS, key=lambda d, r=r: r[f"min_{d}"] - r[f"max_{d}"]) for k, r in extent.items()}
    for turn in range(len(DIMS)):
        state = {}
        for k, r in extent.items():
            if k not in best or best[k][0] > UNEVEN * r["bytes"]:
                d = widest[k][turn]
                state[k] = {"dim": d, "low": r[f"min_{d}"], "high": r[f"max_{d}"], "want": r["bytes"] * (by[k].leaves // 2) / by[k].leaves, "base": 0, "over": 0}
        if not state:
            break
        _medians(at, state)
        for k, s in state.items():
            below, above = s["want"] - s["base"], s["over"] - s["want"]
            # the nearer edge of the last bin
            best[k] = min(best.get(k, (float("inf"),)), (below, s["dim"], s["low"]) if below <= above else (above, s["dim"], s["high"]))
    for k, (_, dim, cut) in best.items():
        n, left = by[k], by[k].leaves // 2
        n.dim, n.cut, n.low, n.high = dim, cut, Node(k, left), Node(k + left, n.leaves - left)


def grow(p: DataFrame, shards: int) -> Node:
    """The tree for so many leaves, each near the target of total bytes over shards."""
    root = Node(0, shards)
    level = [root]
    while level := [n for n in level if n.leaves > 1]:
        split_level(p, root, level)
        level = [c for n in level if n.dim for c in (n.low, n.high)]
    return root


def sharded(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless in the shard) and grown_shard (null: the law is ``bytes``).

    Equal texts stay together.  Null texts count as empty ones; a null source
    or lang is the last category; repeated rows are rows of their own; an empty
    table gives no rows.
    """
    rows = written(sized(docs))
    p = points(rows)
    placed = p.select(F.col("_h").alias("_ph"), F.col("text_crc32").alias("_pc"), F.col("size").alias("_ps"), _place(grow(p, shards), lambda n: n.first).alias("shard"))
    out = rows.join(placed, (F.col("_h") == F.col("_ph")) & (F.col("text_crc32") == F.col("_pc")) & (F.col("size") == F.col("_ps")))
    out = out.withColumn("_at", unit(F.col("doc_id"), F.col("_h"), seed=3)).withColumn("_one", F.lit(1)).select("doc_id", "size", "text_crc32", "shard", "_at", "_h", "_one")
    out = running(written(out), "shard", "_at", ["doc_id", "_h"], "_one", "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
