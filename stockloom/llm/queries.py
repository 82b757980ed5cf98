"""The registered queries of these operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import embeddings, fourier, mixing, neardup, packing, prefixtrie, privacy, quality, repair, scoring, sharding, tokencounts, toxicity
from .common import read


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_copies(read(spark, sf_dir, "embeddings"))


def op5_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "kept")


def op6_toxic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("n_hits")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.replaced(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(read(spark, sf_dir, "documents"))


def op3_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents")).drop("ids")


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"))


def op9_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), ("doc_id",)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(read(spark, sf_dir, "conversations"))


def op12_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fourier.classified(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repairs(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_surrogates, op2_attention_scores, op3_window_packing, op4_near_vectors, op5_near_copies, op6_toxic_terms, op7_source_mix, op8_kd_shards, op9_prefix_counts, op10_quality_rules,
                                op11_prefix_trie, op12_quality_scores, op13_structure_repair)}

SQL: dict[str, str] = {"op10_quality_rules": r"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS body FROM documents),
split AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
 list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
grams AS (SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5)),
twice AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
covered AS (SELECT rid, sum(least(5, next - i)) AS n FROM (SELECT rid, i, lead(i, 1, i + 5) OVER (PARTITION BY rid ORDER BY i) AS next FROM twice) GROUP BY rid),
counted AS (SELECT s.*, CAST(len(words) AS BIGINT) AS n_words, array_to_string(words, '') AS chars, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
 CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines FROM split s LEFT JOIN covered c USING (rid)),
measured AS (SELECT *, CAST(length(chars) AS BIGINT) AS word_chars, CAST(length(regexp_replace(chars, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
 length(regexp_replace(chars, '[^\p{Lu}]+', '', 'g')) AS n_capitals, length(regexp_replace(chars, '[^!?.,;:]+', '', 'g')) AS n_marks,
 n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
valued AS (SELECT rid, lang, source, unnest([
 {'rule': 'symbols', 'v': 1000 * n_symbols // word_chars, 'reach': 4, 'slack': 60}, {'rule': 'capitals', 'v': 1000 * n_capitals // word_chars, 'reach': 4, 'slack': 250},
 {'rule': 'marks', 'v': 1000 * n_marks // word_chars, 'reach': 4, 'slack': 180}, {'rule': 'dup_lines', 'v': 1000 * n_dup_lines // greatest(n_lines, 1), 'reach': 4, 'slack': 350},
 {'rule': 'word_length', 'v': 100 * word_chars // n_words, 'reach': 4, 'slack': 600}], recursive := true) FROM measured WHERE NOT base_failed),
binned AS (SELECT *, v - v % CAST(pow(2, greatest(length(bin(v)) - 8, 0)) AS BIGINT) AS b FROM valued),
ranked AS (SELECT *, count(*) OVER (PARTITION BY lang, source, rule ORDER BY b) AS upto, count(*) OVER (PARTITION BY lang, source, rule) AS total FROM binned),
fences AS (SELECT lang, source, rule, min(CASE WHEN upto * 4 >= total THEN b END) AS q1, min(CASE WHEN upto * 4 >= total * 3 THEN b END) AS q3 FROM ranked GROUP BY 1, 2, 3),
refused AS (SELECT DISTINCT rid FROM binned x JOIN fences f ON x.lang IS NOT DISTINCT FROM f.lang AND x.source IS NOT DISTINCT FROM f.source AND x.rule = f.rule
 WHERE b > q3 + (q3 - q1) * reach + slack)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM refused) AS kept FROM measured"""}

#: CRC-32 of ``{0}``, a text of plain ASCII, bit by bit, the lowest of each byte first.
CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length({0}) + 1),
  lambda i: list_transform(range(8), lambda bit: CAST((ascii(substr({0}, i, 1)) >> bit) & 1 AS BIGINT))))), lambda acc, bit: xor(acc >> 1, 3988292384 * (xor(acc, bit) & 1))), 4294967295)"""
DIGEST = "sha256(strlen({0}) || ':' || {0} || {1})"

SQL["op11_prefix_trie"] = f"""
WITH turns AS (SELECT conv_id AS c, {DIGEST.format("coalesce(role, '')", "coalesce(text, '')")} AS dg, strlen(coalesce(text, '')) AS size,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {DIGEST.format("coalesce(role, '')", "coalesce(text, '')")}) AS pos FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 5 AS b, CASE WHEN c % 5 = 0 THEN 0 ELSE {CRC.format("CAST(c AS VARCHAR)")} % 9 END AS h FROM (SELECT DISTINCT c FROM turns)),
taken AS (SELECT k.c, t.pos AS depth, dg, size FROM convs k JOIN turns t ON t.c = k.b AND t.pos <= k.h
  UNION ALL SELECT k.c, t.pos - k.h + least(k.h, (SELECT count(*) FROM turns x WHERE x.c = k.b)), dg, size FROM convs k JOIN turns t ON t.c = k.c AND t.pos > k.h),
paths AS (SELECT c, depth, size, string_agg(dg, '') OVER (PARTITION BY c ORDER BY depth) AS path FROM taken UNION ALL SELECT c, 0, 0, '' FROM convs),
ends AS (SELECT c, max(depth) AS last FROM paths GROUP BY c),
nodes AS (SELECT path, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) * (count(*) - 1) AS own FROM paths GROUP BY path),
ended AS (SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha FROM paths JOIN ends USING (c) WHERE depth = last GROUP BY path),
kids AS (SELECT left(path, 64 * CAST(depth - 1 AS INTEGER)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
above AS (SELECT DISTINCT n.path AS node, p.path AS top FROM nodes n JOIN paths m ON m.c = n.conv_id AND m.depth = n.depth JOIN paths p ON p.c = m.c AND p.depth <= n.depth),
below AS (SELECT top AS path, sum(n.own) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves FROM above a JOIN nodes n ON n.path = a.node LEFT JOIN kids k ON k.path = a.node GROUP BY top)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN kids k USING (path) LEFT JOIN ended e USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * CAST(n.depth - 1 AS INTEGER))"""

#: One step back through a row: for each state the least (cost, letters, lines) from there on; deleted, kept or with a new role.
STATES = {"n": "u", "s": "u", "u": "a", "a": "u"}
OWN = {x: f"list_sort([{{'c': b.{x}.c + 3, 'l': 'D' || b.{x}.l, 't': b.{x}.t}}]"
          f" || CASE WHEN NOT forced AND initial IN ({', '.join(repr(i) for i, before in (('s', 'n'), ('u', 'nsa'), ('a', 'u')) if x in before) or 'NULL'}) THEN"
          f" [{{'c': trunc + CASE initial WHEN 's' THEN b.s.c WHEN 'u' THEN b.u.c ELSE b.a.c END, 'l': 'K' || CASE initial WHEN 's' THEN b.s.l WHEN 'u' THEN b.u.l ELSE b.a.l END,"
          f" 't': [role || ':' || text] || CASE initial WHEN 's' THEN b.s.t WHEN 'u' THEN b.u.t ELSE b.a.t END}}] ELSE [] END"
          f" || CASE WHEN NOT forced THEN [{{'c': 2 + trunc + b.{to}.c, 'l': 'R' || b.{to}.l, 't': ['{'user' if to == 'u' else 'assistant'}:' || text] || b.{to}.t}}] ELSE [] END)[1]"
       for x, to in STATES.items()}
INSERTED = {"u": "user:", "a": "assistant:"}
WITH_INSERTS = {x: f"list_sort([o.{x}, {{'c': o.{to}.c + 2, 'l': 'I' || o.{to}.l, 't': ['{INSERTED[to]}'] || o.{to}.t}}, "
                   f"{{'c': o.{STATES[to]}.c + 4, 'l': 'II' || o.{STATES[to]}.l, 't': ['{INSERTED[to]}', '{INSERTED[STATES[to]]}'] || o.{STATES[to]}.t}}])[1]"
                for x, to in STATES.items()}

SQL["op13_structure_repair"] = rf"""
WITH RECURSIVE spaced AS (SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
drawn AS (SELECT *, {CRC.format("id")} % 20 AS d FROM spaced),
damaged AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE d WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM drawn),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {DIGEST.format("role", "text")}) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
judged AS (SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) NOT IN ('.', '!', '?') AS open, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM placed),
ready AS (SELECT *, blank OR again AS forced, CAST(open AND NOT blank AND NOT again AS INTEGER) AS trunc FROM judged),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate,
  sum(trunc) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM ready GROUP BY conv_id),
back AS (SELECT DISTINCT conv_id, n + 1 AS i, {{'c': 0, 'l': '', 't': CAST([] AS VARCHAR[])}} AS n, {{'c': 4, 'l': 'II', 't': ['user:', 'assistant:']}} AS s,
  {{'c': 2, 'l': 'I', 't': ['assistant:']}} AS u, {{'c': 0, 'l': '', 't': CAST([] AS VARCHAR[])}} AS a FROM ready
 UNION ALL SELECT conv_id, i, {", ".join(WITH_INSERTS[x] for x in STATES)} FROM
  (SELECT r.conv_id, r.i, {{{", ".join(f"'{x}': {OWN[x]}" for x in STATES)}}} AS o FROM back b JOIN ready r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1))
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(b.n.c, 0) AS BIGINT) AS cost, coalesce(b.n.l, '') AS audit, sha256(coalesce(array_to_string(b.n.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM a.conv_id AND b.i = 1"""
