"""The operators on conversations against plain versions of their contracts."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from stockloom.llm import prefixtrie, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, copies string"
EMPTY = hashlib.sha256().hexdigest()


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(*r[1:])))


def brute_trie(table):
    turns = defaultdict(list)
    for c, t, role, text in table:
        if c is not None:
            turns[c].append((t, role or "", text or ""))
    turns = {c: [r[1:] for r in in_order(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        base = c - int(c / 5) * 5
        b, h = c - base, zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(b, [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    return {(min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == p).encode()).hexdigest()) for p, m in nodes.items()}


def trie_rows(df):
    rows = [tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def brute_repair(table):
    """Shortest edits by trying all, least letters first."""
    convs = defaultdict(list)
    for c, t, role, text in table:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(key.encode()) % 20
        convs[c] += []
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            convs[c] += [(t, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = set()
    for c, rows in convs.items():
        rows = in_order(rows)
        seen, faults = set(), []
        for _, role, text in rows:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        best = {}

        def cheapest(i, last):
            """(cost, letters, lines) from row i on after a row with initial ``last``."""
            if (i, last) not in best:
                options, to = [], {"": "u", "s": "u", "u": "a", "a": "u"}[last]
                best[i, last] = None  # an insertion that returns here is no use
                if i == len(rows) and last in "a":
                    options.append((0, "", ()))
                full = {"u": "user", "a": "assistant"}[to]
                if (after := cheapest(i, to)) is not None:
                    options.append((after[0] + 2, "I" + after[1], (full + ":",) + after[2]))
                if i < len(rows):
                    _, role, text = rows[i]
                    after = cheapest(i + 1, last)
                    options.append((after[0] + 3, "D" + after[1], after[2]))
                    if faults[i] not in ("blank", "duplicate"):
                        plus = faults[i] == "truncated"
                        if role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[last] and role:
                            after = cheapest(i + 1, role[0])
                            options.append((after[0] + plus, "K" + after[1], (f"{role}:{text}",) + after[2]))
                        after = cheapest(i + 1, to)
                        options.append((after[0] + 2 + plus, "R" + after[1], (f"{full}:{text}",) + after[2]))
                found = min(options) if options else None
                if found is None:
                    del best[i, last]
                    return None
                best[i, last] = found
            return best[i, last]

        def settled(i, last):
            return cheapest(i, last)

        for i in range(len(rows), -1, -1):  # each state from scratch, so that loops of insertions don't hide a way
            fixed = {}
            for last in ("", "s", "u", "a"):
                for k in [k for k in best if k[0] == i]:
                    del best[k]
                fixed[i, last] = settled(i, last)
            for k in [k for k in best if k[0] == i]:
                del best[k]
            best.update(fixed)
        cost, audit, lines = best[0, ""]
        out.add((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                 illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def repair_rows(df):
    rows = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frame(spark, rows):
    """Rows with two more columns, whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 7, "own") for r in rows], SCHEMA)


ODD = [(None, 0, "user", "none."), (None, None, None, None), (5, None, "user", "null turn."), (5, None, None, None), (5, 2, "user", None), (5, 2, "assistant", "b."),
       (6, 1, None, "x"), (6, 2, "", "y."), (7, 1, "user", "same."), (7, 1, "user", "same."), (7, 2, "user", "same."), (8, 1, "user", "word " * 100000), (-3, 1, "system", "s."),
       (-3, 2, "tool", "É漢🙂 <|x|>\n"), (9, 3, "user", ""), (9, 4, "assistant", " \t\n")]


def random_rows(seed, convs, turns, words=3):
    r = random.Random(seed)
    return [(c, t if r.random() > .03 else None, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None]),
             r.choice([f"w{r.randrange(words)}.", f"w{r.randrange(words)}", "hi!", "", None, " "]))
            for c in range(convs) for t in range(r.randrange(turns)) if r.random() > .1]


@pytest.mark.parametrize("rows", [[], ODD, random_rows(1, 60, 9), random_rows(2, 12, 60, 200)], ids=["empty", "odd", "short", "long"])
def test_trie_equals_brute_force(spark, rows):
    assert trie_rows(prefixtrie.trie(frame(spark, rows))) == brute_trie(rows)


def test_trie_of_a_conversation_over_many_partitions(spark):
    """One conversation holds most rows, so its turns and the ids of equal ones fill many partitions."""
    rows = [(10, t, "user", f"t{t % 7}") for t in range(3000)] + [(c, t, "user", "hello") for c in range(11, 800) for t in range(2)]
    assert trie_rows(prefixtrie.trie(frame(spark, rows).repartition(7))) == brute_trie(rows)


def test_trie_of_the_table(spark, data):
    table = spark.read.parquet(f"{data}/conversations.parquet")
    assert trie_rows(prefixtrie.trie(table)) == brute_trie([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_coinciding_fingerprints_draw_new_radices(spark, monkeypatch):
    rows, real = random_rows(3, 40, 9), prefixtrie.radices
    # r = 1 forgets the order of turns in every lane
    monkeypatch.setattr(prefixtrie, "radices", lambda seed: [1] * 4 if seed == 0 else real(seed))
    swapped = rows + [(100, 0, "user", "a"), (100, 1, "user", "b"), (105, 0, "user", "b"), (105, 1, "user", "a")]
    assert trie_rows(prefixtrie.trie(frame(spark, swapped))) == brute_trie(swapped)


@pytest.mark.parametrize("chunk", [3, 1 << 16])
@pytest.mark.parametrize("rows", [[], ODD, random_rows(4, 40, 12, 40), random_rows(5, 4, 90, 500)], ids=["empty", "odd", "short", "long"])
def test_repair_equals_brute_force(spark, rows, chunk):
    assert repair_rows(repair.repairs(frame(spark, rows), chunk)) == brute_repair(rows)


def test_repair_where_costs_never_settle(spark):
    """Rows of users alone keep a difference alive through every chunk; texts are longer than a block."""
    rows = [(1, t, "user", f"t{t} " + "x" * 30000 + ".") for t in range(90)] + [(2, t, "user", "again.") for t in range(50)]
    assert repair_rows(repair.repairs(frame(spark, rows), 8)) == brute_repair(rows)


def test_repair_of_the_table(spark, data):
    table = spark.read.parquet(f"{data}/conversations.parquet")
    assert repair_rows(repair.repairs(table)) == brute_repair([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
