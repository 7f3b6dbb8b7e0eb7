"""Each stage of the pipeline on what the one before kept, and the whole chain, against SQL and plain Python."""

from __future__ import annotations

import array
import hashlib
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from claimtrace.llm import queries

SF = "/root/testdata/sf0.001"
ODD = [(900_001, None, None, "odd", 0), (900_002, "", "en", "odd", 0), (900_003, "12 34 --", "en", "odd", 8), (None, "Von der und die das ist nicht in den Ungen.", "de", "odd", 43)]


def answers(path, sql: str) -> list[dict]:
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, row)) for row in cursor.fetchall()]


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """The input and the result of every stage but the last, as folders."""
    root = tmp_path_factory.mktemp("chain")
    given = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    docs = given.unionByName(spark.createDataFrame(ODD, given.schema)).unionByName(given.where("doc_id < 5"))  # repeated rows
    docs.write.parquet(f"{root}/sf/documents.parquet")
    made = [f"{root}/sf/documents.parquet"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, spark.read.parquet(made[-1]), f"{root}/sf").write.parquet(f"{root}/{name}")
        made.append(f"{root}/{name}")
    return made


def rows(spark, path) -> Counter:
    return Counter(tuple(r) for r in spark.read.parquet(path).select(*corpus_pipeline.COLUMNS).collect())


def test_language_keeps_clean_texts(spark, chain):
    given, kept = rows(spark, chain[0]), rows(spark, chain[1])
    assert given - kept == Counter({r: 1 for r in ODD[:3]})


def test_exact(spark, chain):
    best = {}
    for row in rows(spark, chain[1]):
        text = row[1] or ""
        if text not in best or (row[0] is not None, row[0]) > (best[text][0] is not None, best[text][0]):
            best[text] = row
    assert rows(spark, chain[2]) == Counter(best.values())


def test_near(spark, chain):
    by_name = answers(chain[2], queries.ORACLES["op10_minhash_near_dedup"])
    keep = {r["doc_id"] for r in by_name if r["kept"]}
    assert rows(spark, chain[3]) == Counter({r: n for r, n in rows(spark, chain[2]).items() if r[0] in keep})
    assert len(keep) < len(by_name)


def test_substrings(spark, chain):
    told = {r["doc_id"]: r for r in answers(chain[3], queries.ORACLES["op3_substring_dedup"])}
    given = {r[0]: r for r in rows(spark, chain[3])}
    found = {r[0]: r for r in rows(spark, chain[4])}
    gone = {k for k, r in told.items() if r["n_removed"] and r["n_removed"] == r["n_words"]}
    assert set(found) == set(given) - gone
    for key, row in found.items():
        if told[key]["n_removed"]:
            assert hashlib.sha256(row[1].encode()).hexdigest() == told[key]["kept_sha256"]
            assert row[2:4] == given[key][2:4] and row[4] == len(row[1])
        else:
            assert row == given[key]


def test_run_packs_what_the_stages_kept(spark, chain):
    known = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text, *_ in rows(spark, chain[4]):
        ids = [*known.encode(text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[doc_id, n, at, len(part), zlib.crc32(array.array("I", part).tobytes())] += 1
    made = corpus_pipeline.run(spark, chain[0].rpartition("/")[0]).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in made) == want
    held = defaultdict(list)
    for r in made:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(held) <= 1.05 * sum(r.length for r in made) / 4096 + 1


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_no_documents(spark, stage):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[stage][1](spark, none, SF).count() == 0


def test_sharding_query(spark):
    made = queries.op5_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in made} == set(texts) and all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40 for r in made)
    shards, slots, place = Counter(), defaultdict(list), defaultdict(set)
    for r in made:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        shards[r.shard] += r.size
        slots[r.shard].append(r.slot)
        place[texts[r.doc_id]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(p) == 1 for p in place.values())
    # Longest processing time: no group could move to the least loaded shard and leave its own still above it.
    groups = Counter()
    for r in made:
        groups[texts[r.doc_id], r.shard] += r.size
    least = min(shards[s] for s in range(40))
    assert all(shards[s] - size <= least for (_, s), size in groups.items() if size == min(z for (_, t), z in groups.items() if t == s))


def test_language_query(spark):
    made = queries.op6_language_id(spark, SF).collect()
    given = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in made} == set(given)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in made)
    held = [r for r in made if r.held_out and given[r.doc_id].lang is not None and r.lang_pred != "und"]
    assert sum(r.lang_pred == given[r.doc_id].lang for r in held) >= 0.95 * len(held) > 0


def test_url_query(spark):
    made = queries.op7_url_filter(spark, SF).collect()
    rules = [r.partition("/") for _, r in queries.RULES]
    for r in made:
        fits = []
        for (verdict, text), (host, _, path) in zip(queries.RULES, rules):
            if (r.host == host or r.host.endswith("." + host)) and r.path.startswith("/" + path):
                fits.append((len(text), text, verdict))
        assert (r.rule, r.verdict) == (max(fits)[1:] if fits else (None, r.verdict)) and r.verdict in ("allow", "block")
    assert made
