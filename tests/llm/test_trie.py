"""The prefix trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from claimtrace.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, id int"


def trie_of(paths: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members = defaultdict(list)
    for conv, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    rows = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(held), len(node), parent, len(held), len(children[node]), leaves[node], saved[node], sha))
    return sorted(rows)


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    def place(row):
        role, text = row[2] or "", row[3] or ""
        return (row[1] is not None, row[1] or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16])

    held = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=place):
        held[row[0]].append((row[2] or "", row[3] or ""))
    made = {}
    for conv, turns in held.items():
        h = zlib.crc32(str(conv).encode()) % 6
        made[conv] = held.get(conv - conv % 100, [])[:h] + turns[h:]
    return made


def answers(frame) -> list[tuple]:
    return sorted(tuple(r) for r in frame.collect())


def conversations(seed: int, many: int = 400) -> list[tuple]:
    r = random.Random(seed)
    rows = []
    for conv in r.sample(range(1000), many):
        for turn in range(r.choice([1, 2, 3, 5, 8, 12])):
            rows.append((conv, turn, r.choice(["user", "assistant", None]), r.choice(["", None, "a", "é", "bb", "日本" * 9]), "x", 1))
    rows += [(c, 0, "user", "same", "x", 1) for c in range(2000, 2150)]  # turnless or alike
    rows += [(c, t, "user", f"long {t}", None, None) for c in (3000, 3001) for t in range(700)]
    rows += [(4000, None, "user", "z", "x", 1), (4000, None, "system", "a", "x", 1), (4000, 3, "user", "z", "x", 1), (4000, 3, "user", "z", "x", 1)]
    rows += [(None, 1, "user", "nobody", "x", 1), (-7, 0, "user", "below", "x", 1), (-100, 0, "user", "below zero", "x", 1), (5000, 0, "", "w" * 100_000, "x", 1)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_nodes(spark, seed):
    rows = conversations(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert answers(trie.nodes(trie.shared_openings(trie.turns(frame)))) == trie_of(rebuilt(rows))


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.nodes(trie.shared_openings(trie.turns(none))).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x", "", 1)], SCHEMA)
    assert trie.nodes(trie.shared_openings(trie.turns(nobody))).count() == 0


def test_query(spark, tmp_path):
    rows = conversations(5, 50)
    spark.createDataFrame(rows, SCHEMA).drop("depth", "id").write.parquet(f"{tmp_path}/conversations.parquet")
    frame = queries.op12_prefix_trie(spark, str(tmp_path))
    assert answers(frame) == trie_of(rebuilt(rows))


@pytest.mark.parametrize("n", [0, 1, 2, 100, 50_000])
def test_slots_are_minimal_perfect_and_verified(n):
    r = np.random.default_rng(n)
    hi, lo = (r.integers(-(1 << 62), 1 << 62, n) for _ in range(2))
    hi[: n // 2] = 7  # half differ in one word only
    table = trie.Slots(np.concatenate([hi, hi]), np.concatenate([lo, lo]))
    at = table.find(hi, lo)
    assert table.size == n and sorted(at) == list(range(n))
    assert (table.hi[at] == hi).all() and (table.lo[at] == lo).all()
    assert (table.find(hi + 1, lo) == -1).all()


@pytest.mark.parametrize("size", [2, 3, 5, 11, 64])
def test_sums_do_not_depend_on_shards(monkeypatch, size):
    """Conversations are cut between shards at every place."""
    monkeypatch.setattr(trie, "SHARD", size)
    r = random.Random(size)
    paths = {c: [("u", r.choice("ab")) for _ in range(r.randrange(9))] for c in range(40)}
    rows = []
    for conv, turns in paths.items():
        rows.append((conv, None, 0))
        rows += [(conv, hashlib.md5(repr(t).encode()).digest(), len(t[1])) for t in turns]
    batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows]), pa.array([x[1] for x in rows], pa.binary()), pa.array([x[2] for x in rows])], names=["conv", "turn", "chars"])
    chain = pa.Table.from_batches(trie._chained(batch.slice(i, 5) for i in range(0, len(rows), 5))).to_pylist()
    known: dict[tuple, dict] = {}
    for part in trie._counted(iter([pa.RecordBatch.from_pylist(chain)])):
        for x in part.to_pylist():
            held = known.setdefault((x["hi"], x["lo"]), {**x, "convs": 0, "ends": 0})
            held["convs"] += x["convs"]
            held["ends"] += x["ends"]
            held["least"] = min(held["least"], x["least"])
    placed = [{**x, "convs": None, "ends": None} for x in chain] + [{**x, "conv": x["least"]} for x in known.values()]
    for x in placed:
        x.pop("last", None), x.pop("least", None)
    placed = [{k: x[k] for k in sorted(x)} for x in sorted(placed, key=lambda x: (x["conv"], -x["depth"]))]
    sums = defaultdict(lambda: np.zeros(3, int))
    for part in trie._summed(iter([pa.RecordBatch.from_pylist(placed)])):
        for x in part.to_pylist():
            sums[x["hi"], x["lo"]] += [x["children"], x["leaves"], x["saved"]]
    got = sorted((x["least"], x["depth"], x["convs"], *sums[key]) for key, x in known.items())
    assert got == sorted((t[0], t[1], t[3], t[4], t[5], t[6]) for t in trie_of(paths))


def test_pieces(monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 10)
    ids = [(1, 1, c) for c in range(95, 130)] + [(1, 2, 5)] + [(2, 1, c) for c in (-3, 7)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*ids[i : i + 4])], names=["hi", "lo", "conv"]) for i in range(0, len(ids), 4)]
    pieces = list(trie._pieces(iter(batches)))
    assert max(len(p) for b in pieces for p in b.column("piece").to_pylist()) < 20
    got = {(x["hi"], x["lo"]): x["sha"] for b in trie._hashed(iter(pieces)) for x in b.to_pylist()}
    for key in {(1, 1), (1, 2), (2, 1)}:
        assert got[key] == hashlib.sha256(",".join(str(c) for a, b, c in ids if (a, b) == key).encode()).hexdigest()
