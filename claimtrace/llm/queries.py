"""The dealt operators as queries over the given tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtrace.llm import bpe, exact, fingerprints, language, near, packing, repair, secrets, sharding, substrings, token_counts, trie, urls
from claimtrace.llm.common import written

WORDS = "word_bpe_49k.json"
# The rules of the URL filter.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
BYTES = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_counts.suffix_sums(token_counts.histogram(docs, public_tokenizers.path(WORDS)))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove(_table(spark, sf_dir, "documents"), texts=False)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("sha").alias("kept_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path(BYTES), public_tokenizers.PATTERN, outputs=False)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = language.held_out("doc_id")
    model = language.fit(docs.where(~held_out))
    return language.predicted(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), RULES)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(_table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(_table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.label(_table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE]
    counts = [F.size(secrets.of_kinds(F.col("spans"), [k])).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(secrets.listed(secrets.of_kinds(F.col("spans"), base)), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = written(trie.turns(_table(spark, sf_dir, "conversations")), "trie-turns")
    return trie.nodes(trie.shared_openings(held))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.reports(repair.repair(repair.damaged(_table(spark, sf_dir, "conversations"))))
    return found.withColumnRenamed("conv", "conv_id")


def _secrets_sql() -> str:
    """Between the pieces that a regex splits a text into lie its matches; their lengths give the places."""

    def hits(i: int, rule: secrets.Rule) -> str:
        find, keep = (x and x.replace("'", "''") for x in (rule.find, rule.keep))
        return f"""
SELECT rid, first + length(hit) AS stop, first AS start, {i} AS rule, '{rule.kind}' AS kind FROM (
  SELECT rid, hit, sum(length(piece)) OVER w + coalesce(sum(length(hit)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM (SELECT rid, unnest(string_split_regex(text, '{find}')) AS piece, unnest(regexp_extract_all(text, '{find}')) AS hit,
    unnest(range(len(string_split_regex(text, '{find}')))) AS n FROM texts)
  WINDOW w AS (PARTITION BY rid ORDER BY n))
WHERE hit IS NOT NULL{f" AND regexp_full_match(hit, '{keep}')" if keep else ""}"""

    base = len(secrets.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    every = " UNION ALL ".join(hits(i, r) for i, r in enumerate(secrets.RULES))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
hits AS (SELECT *, concat(kind, ':', start, ':', stop) AS span FROM ({every}))
SELECT any_value(doc_id) AS doc_id, {counts},
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rule) FILTER (rule < {base}), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rule), '') AS spans
FROM texts LEFT JOIN hits USING (rid) GROUP BY rid
"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of a short ASCII text, bit by bit."""
    byte = "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: xor(r >> 1, (r & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), {byte}), 4294967295)"


_TRIE_SQL = f"""
WITH held AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ranked AS (
  SELECT c, role, text,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, substr(sha256(length(role) || ':' || role || text), 1, 32)) AS place
  FROM held),
convs AS (
  SELECT c, c - ((c % 100) + 100) % 100 AS base, {_crc32_sql("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM held)),
rebuilt AS (
  SELECT v.c, o.place, o.role, o.text FROM convs v JOIN ranked o ON o.c = v.base AND o.place <= v.h
  UNION ALL SELECT v.c, o.place + 6, o.role, o.text FROM convs v JOIN ranked o ON o.c = v.c AND o.place > v.h),
paths AS (
  SELECT c, row_number() OVER w AS depth, length(text) AS chars,
    sha256(string_agg(concat(length(role), ':', role, length(text), ':', text), '') OVER w) AS node
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY place)
  UNION ALL SELECT c, 0, 0, 'root' FROM convs),
marked AS (SELECT *, depth = max(depth) OVER (PARTITION BY c) AS last FROM paths),
nodes AS (
  SELECT node, depth, min(c) AS owner, count(*) AS n, any_value(chars) AS chars, count(*) FILTER (last) AS ends,
    string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last) AS ids
  FROM marked GROUP BY node, depth),
sums AS (
  SELECT a.node, sum((v.n - 1) * v.chars) AS saved, count(*) FILTER (v.n = v.ends) AS leaves, count(*) FILTER (v.depth = a.depth + 1) AS children
  FROM nodes v JOIN paths a ON a.c = v.owner AND a.depth <= v.depth GROUP BY a.node)
SELECT v.owner AS conv_id, v.depth, q.owner AS parent_conv_id, v.n AS n_convs, children AS n_children, leaves AS n_leaves,
  saved AS saved_tokens, sha256(coalesce(v.ids, '')) AS ends_sha256
FROM nodes v JOIN sums USING (node) LEFT JOIN paths p ON p.c = v.owner AND p.depth = v.depth - 1 LEFT JOIN nodes q ON q.node = p.node
"""

def _repair_sql() -> str:
    """Plain dynamic programming, row by row from the end: for each state the cheapest (cost, letters, text)."""

    def option(cost: str, letter: str, to: str, line: str) -> str:
        return f"{{'c': {to}.c + {cost}, 'a': '{letter}' || {to}.a, 't': {line} || {to}.t}}"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    after = {"n": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}  # states: nothing yet, or the last initial
    far = "{'c': 1000000, 'a': '', 't': ''}"
    names = {"u": "user", "a": "assistant"}
    steps, inserts = [], []
    for state, to in after.items():
        options = [option("3", "D", f"g.{state}", "''")]
        wanted = next(i for i in to if i != "s")
        for initial, then in to.items():
            options.append(f"CASE WHEN NOT must AND left(role, 1) = '{initial}' THEN {option('cut', 'K', f'g.{then}', "chr(10) || role || ':' || text")} ELSE {far} END")
        options.append(f"CASE WHEN NOT must THEN {option('2 + cut', 'R', f'g.{wanted}', f"chr(10) || '{names[wanted]}:' || text")} ELSE {far} END")
        steps.append(f"{least(*options)} AS {state}")
    for state, wanted in (("u", "a"), ("a", "u")):
        inserts.append(f"{least(f'b.{state}', option('2', 'I', f'b.{wanted}', f"chr(10) || '{names[wanted]}:'"))} AS {state}")
    opened = [f"{least(f'b.{state}', option('2', 'I', 'u', "chr(10) || 'user:'"))} AS {state}" for state in "ns"]
    last = {
        "n": "{'c': 0, 'a': '', 't': ''}",
        "s": "{'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}",
        "u": "{'c': 2, 'a': 'I', 't': chr(10) || 'assistant:'}",
        "a": "{'c': 0, 'a': '', 't': ''}",
    }
    key = "concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))"
    return f"""
WITH RECURSIVE held AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32_sql(key)} % 20 AS kind
  FROM conversations),
hurt AS (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM held WHERE kind <> 0),
placed AS (
  SELECT c, turn, CASE WHEN role = '' THEN ' ' ELSE role END AS first, role, text,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, substr(sha256(length(role) || ':' || role || text), 1, 32), copy) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM hurt),
judged AS (
  SELECT *, solid = '' AS blank, solid <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS duplicate,
    left(lag(first) OVER (PARTITION BY c ORDER BY i), 1) || left(first, 1) AS pair
  FROM placed),
rows AS (
  SELECT *, blank OR duplicate AS must, (NOT blank AND NOT duplicate AND right(solid, 1) NOT IN ('.', '!', '?'))::INT AS cut FROM judged),
dp AS (
  SELECT c, max(i) + 1 AS i, {{'n': {last["n"]}, 's': {last["s"]}, 'u': {last["u"]}, 'a': {last["a"]}}} AS g FROM rows GROUP BY c
  UNION ALL
  SELECT c, i, {{'n': n, 's': s, 'u': u, 'a': a}} FROM (
    SELECT c, i, {", ".join(opened)}, u, a FROM (
      SELECT c, i, b, {", ".join(inserts)} FROM (
        SELECT c, i, {{'n': n, 's': s, 'u': u, 'a': a}} AS b FROM (
          SELECT r.c, r.i, {", ".join(steps)} FROM dp JOIN rows r ON r.c = dp.c AND r.i = dp.i - 1))))),
best AS (SELECT c, g.n AS b FROM dp WHERE i = 1),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    sum(cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY c)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM held) k LEFT JOIN counts USING (c) LEFT JOIN best USING (c)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_sharding": op5_sharding,
    "op6_language_id": op6_language_id,
    "op7_url_filter": op7_url_filter,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_structure_repair": op13_structure_repair,
}

_WORDS_SQL = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A word is covered if the last repeated window to start at or before it reaches it.
_REPEATS_SQL = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS_SQL.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM docs, unnest(range(1, len(w) - 33)) t(i)),
repeated AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY k) > 1),
words AS (SELECT rid, j, w[j] AS word FROM docs, unnest(range(1, len(w) + 1)) t(j)),
marked AS (
  SELECT rid, j, word, coalesce(max(r.i) OVER (PARTITION BY rid ORDER BY j) >= j - 34, FALSE) AS gone
  FROM words LEFT JOIN (SELECT rid, i AS j, i FROM repeated) r USING (rid, j))
SELECT any_value(doc_id) AS doc_id, count(j) AS n_words, count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY j) FILTER (NOT gone), '')) AS kept_sha256
FROM docs LEFT JOIN marked USING (rid) GROUP BY rid
"""

# All pairs of different sets that share a shingle; what is reachable through links, set by set.
_NEAR_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, row_number() OVER () AS rid, {_WORDS_SQL.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS w FROM documents),
members AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS k FROM docs, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) t(i)),
sets AS (SELECT rid, count(*) AS n, md5(string_agg(k, chr(10) ORDER BY k)) AS node FROM members GROUP BY rid),
nodes AS (SELECT node, any_value(n) AS n, min(rid) AS rid FROM sets GROUP BY node),
parts AS (SELECT node, n, k FROM nodes JOIN members USING (rid)),
links AS (
  SELECT a.node AS a, b.node AS b FROM parts a JOIN parts b ON a.k = b.k AND a.node <> b.node
  GROUP BY a.node, b.node HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT node, min(doc_id) AS least FROM sets JOIN docs USING (rid) GROUP BY node),
names AS (SELECT a AS node, min(least) AS name FROM reach JOIN least ON least.node = b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE name END AS component_id,
  doc_id IS NOT DISTINCT FROM CASE WHEN n IS NULL THEN doc_id ELSE name END AS kept
FROM docs LEFT JOIN sets USING (rid) LEFT JOIN names USING (node)
"""

ORACLES: dict[str, str] = {
    "op3_substring_dedup": _REPEATS_SQL,
    "op10_minhash_near_dedup": _NEAR_SQL,
    "op11_secret_scan": _secrets_sql(),
    "op12_prefix_trie": _TRIE_SQL,
    "op13_structure_repair": _repair_sql(),
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
}
