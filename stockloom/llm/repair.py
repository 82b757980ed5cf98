"""Cheapest repair of conversations to alternating turns, by Viterbi passes over chunks side by side.

Rows are sorted once and cut into chunks.  A conversation that spans chunks is
swept backwards in all of them at the same time: each chunk but the last starts
from a speculative vector of costs (one per state), and is swept again from
its successor's result until that differs from what it used by a constant
only.  Conversations whose vectors don't settle so (rows that carry a
difference through) are finished by each chunk's answers to the four unit
vectors, which compose exactly.  With the costs stitched, the least audit is
traced forwards, chunks side by side again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, importable, map_arrow, written
from .prefixtrie import turn_digest

#: Rows of a chunk, and fix-up passes before the unit vectors.
CHUNK_ROWS, PASSES = 1 << 16, 2
#: Text of one conversation gathered before it is hashed or passed on.
BLOCK_BYTES = 1 << 20
#: States: nothing yet, after system, after user, after assistant; and the state that an inserted or new role leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Initials s, u, a and any other: from which states a kept row may follow.
KEEPS = {0: (START,), 1: (START, SYSTEM, ASSISTANT), 2: (USER,), 3: ()}
LEGAL = {(0, 1), (1, 2), (2, 1)}
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: Kind of a row that must go; others are 2 * initial + truncated.
FORCED = 8
FAR = 1 << 40
FINAL, ZERO = (0, 4, 2, 0), (0, 0, 0, 0)
UNITS = tuple(tuple(0 if i == s else FAR for i in range(4)) for s in range(4))
CONV, PLACE = ("cn", "cv"), ("cn", "cv", "tn", "tv", "dg")


def row_options(after: tuple, kind: int, state: int) -> list[tuple[int, str, int]]:
    """(cost to the end, letter, next state) of what may happen to a row, given the costs after it."""
    out = [(DELETE + after[state], "D", state)]
    if kind != FORCED:
        initial, truncated = divmod(kind, 2)
        if state in KEEPS[initial]:
            out.append((KEEP + truncated + after[initial + 1], "K", initial + 1))
        out.append((REROLE + truncated + after[NEXT[state]], "R", NEXT[state]))
    return out


class Steps:
    """Remembered steps: cost vectors recur, so a row is one look-up."""

    def __init__(self):
        self.back: dict[tuple, tuple] = {}
        self.ahead: dict[tuple, tuple] = {}

    def before(self, after: tuple, kind: int) -> tuple:
        """Costs to the end from before a row, with insertions, for costs after it; not reduced."""
        if (after, kind) not in self.back:
            own = [min(row_options(after, kind, s))[0] for s in range(4)]
            self.back[after, kind] = tuple(min(own[s], INSERT + own[NEXT[s]], 2 * INSERT + own[NEXT[NEXT[s]]]) for s in range(4))
        return self.back[after, kind]

    def sweep(self, kinds: list[int], end: tuple) -> list[tuple]:
        """Cost vectors before every row and at the end, each less its least."""
        out = [reduced(end)]
        for k in reversed(kinds):
            out.append(out[-1] if k == FORCED else reduced(self.before(out[-1], k)))
        return out[::-1]

    def answers(self, kinds: list[int]) -> list[list[int]]:
        """Costs before the rows for each unit vector at their end."""
        out = []
        for now in UNITS:
            total = 0
            for k in reversed(kinds):
                if k != FORCED:
                    v = self.before(now, k)
                    total, now = total + min(v), reduced(v)
            out.append([total + x for x in now])
        return out

    def step(self, after: tuple, kind: int, state: int) -> tuple[str, int, int]:
        """(letters, cost, next state) of the least audit through one row."""
        key = after, kind, state
        if key not in self.ahead:
            costs, letters, cost, s = self.before(after, kind), "", 0, state
            while True:
                best = {letter: (c, to) for c, letter, to in row_options(after, kind, s) if c == costs[s]}
                if "D" not in best and INSERT + costs[NEXT[s]] == costs[s]:
                    letters, cost, s = letters + "I", cost + INSERT, NEXT[s]
                    continue
                letter = min(best)
                price = {"D": DELETE, "K": KEEP, "R": REROLE}[letter] + (kind % 2 if letter != "D" else 0)
                self.ahead[key] = letters + letter, cost + price, best[letter][1]
                break
        return self.ahead[key]

    def exits(self, kinds: list[int], end: tuple) -> list[int]:
        """State after the rows for each state before them."""
        vectors, states = self.sweep(kinds, end), list(range(4))
        for i, k in enumerate(kinds):
            if k != FORCED:
                states = [self.step(vectors[i + 1], k, s)[2] for s in states]
        return states


def reduced(v: tuple) -> tuple:
    least = min(v)
    return tuple(min(x - least, FAR) for x in v)


def finish(state: int) -> str:
    """Insertions at the end."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def kinds_of(code: np.ndarray, late: np.ndarray) -> np.ndarray:
    """Kinds from codes, 4 * initial + 2 * blank + truncated."""
    return np.where((code & 2 > 0) | (late > 0), FORCED, (code >> 2) * 2 + (code & 1))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the planted damage; a null reads as one space in keys, roles and texts, the turn stays null."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = F.crc32(F.concat_ws(":", name("conv_id"), name("turn"))) % 20
    text = F.when(d == 1, "").when(d == 2, F.regexp_replace(name("text"), "[.!?]", "")).otherwise(name("text"))
    rows = conversations.where(d != 0).select("conv_id", "turn", F.when(d == 4, "user").otherwise(name("role")).alias("role"), text.alias("text"),
                                              F.explode(F.when(d == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with keys free of nulls, whose order is the order of the rows: by turn, nulls first, then by digest."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    there = lambda c, n: [F.col(c).isNotNull().cast("int").alias(f"{n}n"), F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(f"{n}v")]
    return rows.select(*there("conv_id", "c"), *there("turn", "t"), role.alias("role"), text.alias("text"), turn_digest(role, text).alias("dg"))


def code_of(role: Column, text: Column) -> Column:
    """4 * initial + 2 * blank + truncated."""
    initial = F.when(role.startswith("s"), 0).when(role.startswith("u"), 1).when(role.startswith("a"), 2).otherwise(3)
    blank = ~text.rlike(f"[^{SPACE}]")
    end = F.right(F.rtrim(text, F.lit(" \t\n\x0b\f\r")), F.lit(1))
    return (initial * 4 + blank.cast("int") * 2 + (~blank & ~end.isin(".", "!", "?")).cast("int")).cast("int")


def sorted_rows(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Narrow rows in order and in chunks: equal ones as one with their number, ``late`` if the text came in an earlier turn."""
    lean = written(rows.select(*PLACE, code_of(F.col("role"), F.col("text")).alias("code")).groupBy(*PLACE).agg(F.max("code").alias("code"), F.count("*").alias("copies")))
    first = (lean.groupBy(*CONV, "dg").agg(F.min("tn").alias("least"), F.min(F.when(F.col("tn") == 1, F.col("tv"))).alias("v"))
             .select(*CONV, F.col("least").alias("tn"), F.when(F.col("least") == 1, F.col("v")).otherwise(0).alias("tv"), "dg", F.lit(0).alias("late")))
    marked = lean.join(first, [*PLACE], "left").withColumn("late", F.coalesce("late", F.lit(1)))
    chunks = max(1, -(-lean.count() // chunk_rows))
    return written(marked.repartitionByRange(chunks, *PLACE).sortWithinPartitions(*PLACE)
                   .withColumns({"chunk": F.spark_partition_id(), "rid": F.monotonically_increasing_id()}))


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in ("code", "late", "copies")}


SWEPT = pa.schema([("chunk", pa.int32()), ("cn", pa.int32()), ("cv", pa.int64()), ("out", pa.list_(pa.list_(pa.int64()))), ("final", pa.int32())])


def swept(rows: DataFrame, ends: dict | None, mode: str) -> list:
    """One pass over the chunks of ``ends`` (chunk, cn, cv -> cost vector): start vectors, unit answers, or exit states."""
    small = rows.sparkSession.createDataFrame([(*k, list(v)) for k, v in ends.items()], "chunk int, cn int, cv bigint, ends array<bigint>")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rid")
        c, steps, end = _columns(table), Steps(), tuple(table.column("ends")[0].as_py())
        kinds = kinds_of(c["code"], c["late"]).tolist()
        if mode == "start":
            out = [list(steps.sweep(kinds, end)[0])]
        else:
            out = steps.answers(kinds) if mode == "answers" else [steps.exits(kinds, end)]
        lead = {n: table.column(n)[0].as_py() for n in ("chunk", *CONV)}
        return pa.Table.from_pylist([lead | {"out": out, "final": int(c["code"][-1]) >> 2}], SWEPT)

    here = rows.select("chunk", *CONV, "rid", "code", "late", "copies").join(F.broadcast(small), ["chunk", *CONV])
    importable(rows.sparkSession)
    return here.groupBy("chunk", *CONV).applyInArrow(run, "chunk int, cn int, cv bigint, out array<array<bigint>>, final int").collect()


def stitched(rows: DataFrame) -> DataFrame:
    """(chunk, cn, cv, ends, entry, prior, is_last) for conversations in more than one chunk: true costs at the chunk's end, state and last initial before it.

    Two chunks share at most one conversation, so these rows, which are all the
    driver sees, are at most two for each chunk.
    """
    many = rows.groupBy(*CONV).agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).where("lo < hi")
    spans = rows.join(many, [*CONV]).select(*CONV, "chunk").distinct().orderBy("cn", "cv", "chunk").collect()
    chains: dict[tuple, list[int]] = {}
    for r in spans:
        chains.setdefault((r.cn, r.cv), []).append(r.chunk)
    starts, used, matrix = {}, {}, {}

    def now() -> dict:
        """The vector at each chunk's end, from its successor."""
        out = {}
        for conv, chunks in chains.items():
            end = FINAL
            for k in reversed(chunks):
                out[k, *conv] = end
                if (k, *conv) in matrix:
                    end = reduced(tuple(min(m[s] + e for m, e in zip(matrix[k, *conv], end)) for s in range(4)))
                else:
                    end = starts.get((k, *conv), ZERO)
        return out

    todo = {k: FINAL if k[0] == chains[k[1:]][-1] else ZERO for k in now()}
    for _ in range(1 + PASSES):
        if not todo:
            break
        for r in swept(rows, todo, "start"):
            starts[r.chunk, r.cn, r.cv] = tuple(r.out[0])
        used |= todo
        todo = {k: v for k, v in now().items() if used[k] != v}
    if todo:  # differences that rows carry through: exact answers of all chunks, composed here
        for r in swept(rows, {k: FINAL for k in now()}, "answers"):
            matrix[r.chunk, r.cn, r.cv] = [tuple(x) for x in r.out]
    ends, out = now(), []
    through = {(r.chunk, r.cn, r.cv): r for r in swept(rows, ends, "exits")} if ends else {}
    for conv, chunks in chains.items():
        entry, prior = START, None
        for k in chunks:
            r = through[k, *conv]
            out.append((k, *conv, list(ends[k, *conv]), entry, prior, k == chunks[-1]))
            entry, prior = r.out[0][entry], r.final
    return rows.sparkSession.createDataFrame(out, "chunk int, cn int, cv bigint, ends array<bigint>, entry int, prior int, is_last boolean")


INSERTED = {USER: "u", ASSISTANT: "a"}
EDITS = "cn int, cv bigint, chunk int, part int, tn int, tv bigint, dg binary, pre string, role string, cost bigint, audit string, illegal bigint"
SCHEMA = pa.schema([(n, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}[t]) for n, t in (f.split() for f in EDITS.split(", "))])


def edits(rows: DataFrame) -> DataFrame:
    """Per kept row (part 0) the inserted roles before it and its new role; per chunk of a conversation (part 1) cost, audit and illegal pairs.

    ``pre`` of part 1 is null unless the conversation ends there.
    """
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rid").combine_chunks()
        steps, c = Steps(), _columns(table)
        kinds, initial = kinds_of(c["code"], c["late"]), c["code"] >> 2
        cn, cv = table.column("cn").to_numpy(), table.column("cv").to_numpy()
        bounds = np.flatnonzero(np.r_[True, (cn[1:] != cn[:-1]) | (cv[1:] != cv[:-1]), True]).tolist()
        kept, pres, roles = [], [], []  # rows that stay
        tails, costs, audits, illegal = [], [], [], []  # conversations
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            own, copies, row = kinds[lo:hi].tolist(), c["copies"][lo:hi].tolist(), initial[lo:hi].tolist()
            ends, entry, prior, is_last = (table.column(n)[lo].as_py() for n in ("ends", "entry", "prior", "is_last"))
            vectors = steps.sweep(own, FINAL if ends is None else tuple(ends))
            state, cost, audit, pre = entry or START, 0, [], ""
            for i, k in enumerate(own):
                letters, price, to = steps.step(vectors[i + 1], k, state)
                more = copies[i] - 1
                cost += price + DELETE * more
                audit.append(letters + "D" * more)
                for _ in letters[:-1]:
                    state = NEXT[state]
                    pre += INSERTED[state]
                if letters[-1] != "D":
                    kept.append(lo + i)
                    pres.append(pre)
                    roles.append(ROLE[to] if letters[-1] == "R" else None)
                    pre = ""
                state = to
            closes = ends is None or is_last
            if closes:
                for x in finish(state):
                    state, cost = NEXT[state], cost + INSERT
                    pre += INSERTED[state]
                    audit.append(x)
            pairs = [*([] if prior is None else [(prior, row[0])]), *zip(row, row[1:])]
            tails.append(pre if closes else None)
            costs.append(cost)
            audits.append("".join(audit))
            illegal.append(sum(n - 1 for n in copies) + sum(p not in LEGAL for p in pairs))
        lead = ["cn", "cv", "chunk"]
        rest = [n.split()[0] for n in EDITS.split(", ")][3:]
        stay, heads = table.take(pa.array(kept, pa.int64())), table.take(pa.array(bounds[:-1], pa.int64()))
        fill = lambda t, **own: pa.table({n: t.column(n) for n in lead} | {
            n: own.get(n, pa.nulls(t.num_rows, SCHEMA.field(n).type)) for n in rest}).cast(SCHEMA)
        zeros = np.zeros(len(tails), np.int64)
        return pa.concat_tables([
            fill(stay, part=np.zeros(len(kept), np.int32), tn=stay.column("tn"), tv=stay.column("tv"), dg=stay.column("dg"),
                 pre=pa.array(pres, pa.string()), role=pa.array(roles, pa.string())),
            fill(heads, part=zeros + 1, tn=zeros, tv=zeros, dg=pa.array([b""] * len(tails), pa.binary()), pre=pa.array(tails, pa.string()),
                 cost=pa.array(costs, pa.int64()), audit=pa.array(audits, pa.string()), illegal=pa.array(illegal, pa.int64()))])

    importable(rows.sparkSession)
    there = rows.join(F.broadcast(stitched(rows)), ["chunk", *CONV], "left")
    return written(there.groupBy("chunk").applyInArrow(run, EDITS))


def repaired_text(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """(cn, cv, block, seq, text): the repaired ``role:text`` lines of each conversation, in blocks of bounded size; ``whole`` where one block is all."""
    order = [*CONV, "part", "tn", "tv", "dg"]
    nothing = F.lit(None).cast("string")
    start = changes.where("part = 1").select(*CONV).distinct().select(
        *CONV, F.lit(-1).alias("part"), F.lit(0).alias("tn"), F.lit(0).cast("long").alias("tv"), F.lit(b"").alias("dg"), F.lit(0).alias("tag"), F.lit("").alias("pre"), nothing.alias("role"), nothing.alias("text"))
    edit = changes.where("pre is not null").select(*order, F.lit(0).alias("tag"), "pre", "role", nothing.alias("text"))
    text = rows.select(*CONV, F.lit(0).alias("part"), "tn", "tv", "dg", F.lit(1).alias("tag"), nothing.alias("pre"), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, lines, size, begun, seq, waiting, role = None, [], 0, False, 0, False, None
        names = ["cn", "cv", "chunk", "seq", "text", "whole"]

        def block(chunk: int, whole: bool) -> dict:
            return dict(zip(names, (*conv, chunk, seq, "\n".join(lines), whole)))

        chunk, schema = 0, pa.schema([("cn", pa.int32()), ("cv", pa.int64()), ("chunk", pa.int32()), ("seq", pa.int64()), ("text", pa.large_string()), ("whole", pa.bool_())])
        for b in batches:
            out = []
            if b.num_rows:
                chunk = b.column("chunk")[0].as_py()
            for cn, cv, part, tag, pre, new, body in zip(*(b.column(c).to_pylist() for c in ("cn", "cv", "part", "tag", "pre", "role", "text"))):
                if (cn, cv) != conv:
                    if lines:
                        out.append(block(chunk, False))
                    conv, lines, size, begun, seq, waiting = (cn, cv), [], 0, False, 0, False
                if tag == 1:
                    if waiting:
                        lines.append(f"{role or new}:{body}")
                        size, waiting = size + len(lines[-1]), False
                else:
                    begun |= part == -1
                    lines += [f"{ROLE[USER + 'ua'.index(x)]}:" for x in pre]
                    waiting, role = part == 0, new
                    if part == 1:
                        if lines or begun and not seq:
                            out.append(block(chunk, begun and not seq))
                        lines, size = [], 0
                if size > BLOCK_BYTES:
                    out.append(block(chunk, False))
                    lines, size, seq = [], 0, seq + 1
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if lines:
            yield pa.RecordBatch.from_pylist([block(chunk, False)], schema)

    every = start.union(edit).union(text).repartitionByRange(*order).sortWithinPartitions(*order, "tag").withColumn("chunk", F.spark_partition_id())
    return map_arrow(every, run, "cn int, cv bigint, chunk int, seq bigint, text string, whole boolean")


def hashed(blocks: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's text: of one block where that is all, else of its blocks in order, one held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha = None, None
        row = lambda: {"cn": conv[0], "cv": conv[1], "sha": sha.hexdigest()}
        schema = pa.schema([("cn", pa.int32()), ("cv", pa.int64()), ("sha", pa.string())])
        for b in batches:
            out = []
            for cn, cv, text in zip(*(b.column(c).to_pylist() for c in ("cn", "cv", "text"))):
                if (cn, cv) != conv:
                    if conv:
                        out.append(row())
                    conv, sha = (cn, cv), hashlib.sha256(text.encode())
                else:
                    sha.update(b"\n" + text.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if conv:
            yield pa.RecordBatch.from_pylist([row()], schema)

    blocks = written(blocks.withColumn("sha", F.when(F.col("whole"), F.sha2("text", 256))).withColumn("text", F.when(~F.col("whole"), F.col("text"))))
    parts = blocks.where("not whole").repartition(*CONV).sortWithinPartitions(*CONV, "chunk", "seq").select(*CONV, "text")
    return blocks.where("whole").select(*CONV, "sha").union(map_arrow(parts, run, "cn int, cv bigint, sha string"))


def counted(rows: DataFrame) -> DataFrame:
    """Gaps and first faults of each conversation, from its sorted rows."""
    blank, late = F.col("code").bitwiseAND(2) > 0, F.col("late") == 1
    n = lambda when, what: F.sum(F.when(when, what).otherwise(0))
    turns = rows.groupBy(*CONV, "tn", "tv").agg(
        n(blank, F.col("copies")).alias("blank"), n(~blank, F.col("copies") - (~late).cast("int")).alias("duplicate"),
        n(~blank & ~late, F.col("code").bitwiseAND(1).cast("long")).alias("truncated"))
    turn = F.when(F.col("tn") == 1, F.col("tv"))
    return turns.groupBy(*CONV).agg(F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).alias("gaps"),
                                    *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))


def repaired(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Faults and cheapest repair of conversations: (per conversation, edits per row, text in blocks).

    Rows are taken by turn, nulls first, rows of one turn by the digest of role
    and text.  A blank row (no character but white space) or one whose role and
    text came earlier must be deleted (3); others may be kept (0), get the role
    user or assistant (2) or be deleted (3); empty turns of these roles may be
    inserted anywhere (2); a truncated row that stays adds 1.  Initials of the
    roles then read (s?(ua)+)?; of the cheapest repairs the one whose letters
    come first in ASCII is taken.  A null role or text reads as one space, a
    null conv_id is a conversation of its own, repeated rows are duplicates,
    other columns are ignored and an empty table gives empty results.
    """
    keys = keyed(rows)
    order = sorted_rows(keys, chunk_rows)
    changes = edits(order)
    totals = changes.where("part = 1").groupBy(*CONV).agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    blocks = repaired_text(keys.where(code_of(F.col("role"), F.col("text")).bitwiseAND(2) == 0), changes)
    return counted(order).join(totals, [*CONV]), changes, blocks


def repairs(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Faults, cost, audit and hash of the repaired text for every conversation of the table after ``damaged``."""
    table, _, blocks = repaired(damaged(conversations), chunk_rows)
    ids = conversations.select("conv_id", F.col("conv_id").isNotNull().cast("int").alias("cn"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("cv")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return ids.join(table, [*CONV], "left").join(hashed(blocks), [*CONV], "left").select(
        F.col("conv_id").cast("long").alias("conv_id"), *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
