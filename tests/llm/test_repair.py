"""Structure repair against trying every edit."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from claimtrace.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, place string, gone int, audit string"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows: tuple[tuple[str, bool, bool], ...]) -> tuple[int, str, tuple]:
    """(cost, letters, kept and made turns) of rows (initial, must go, truncated): all edits, all inserts."""

    @lru_cache(None)
    def rest(i: int, state: str, inserted: int):
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            initial, must, cut = rows[i]
            c, a, t = rest(i + 1, state, 0)
            found.append((c + 3, "D" + a, t))
            if not must:
                if initial in NEXT[state]:
                    c, a, t = rest(i + 1, initial, 0)
                    found.append((c + cut, "K" + a, ((i, None), *t)))
                for to in set("ua") & set(NEXT[state]):
                    c, a, t = rest(i + 1, to, 0)
                    found.append((c + 2 + cut, "R" + a, ((i, to), *t)))
        if inserted < 4:
            for to in set("ua") & set(NEXT[state]):
                c, a, t = rest(i, to, inserted + 1)
                found.append((c + 2, "I" + a, ((None, to), *t)))
        return min(found, key=lambda x: x[:2]) if found else (10**9, "", ())

    return rest(0, "", 0)


def expected(rows: list[tuple]) -> dict[object, tuple]:
    """The contract, conversation by conversation."""
    names = {"u": "user", "a": "assistant"}
    white = re.compile(r"[^\x20\x09-\x0D]")
    made = {}
    for conv in {r[0] for r in rows}:
        held = []
        for _, turn, role, text in (r[:4] for r in rows if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            held += [((turn is not None, turn or 0, digest), turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        held.sort(key=lambda x: x[0])
        symbols, seen, counts = [], set(), [0, 0, 0]
        for _, _, role, text in held:
            solid = white.findall(text)
            blank, again = not solid, (role, text) in seen
            cut = not blank and not again and solid[-1] not in ".!?"
            for i, x in enumerate((blank, again and not blank, cut)):
                counts[i] += x
            seen.add((role, text))
            symbols.append(((role or " ")[0], blank or again, cut))
        cost, audit, turns = cheapest(tuple(symbols))
        lines = [f"{held[i][2] if to is None else names[to]}:{held[i][3]}" if i is not None else f"{names[to]}:" for i, to in turns]
        known = [t for _, t, *_ in held if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(symbols))
        made[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return made


def conversations(seed: int) -> list[tuple]:
    r = random.Random(seed)
    texts = ["", " \t\n\x0b\x0c\r", "Yes.", "No", "a ", " ", "Well! \n", "é?", "日本", None, "...", "x."]
    roles = ["user", "assistant", "system", "tool", None, "", "usher", "System", "a"]
    rows = []
    for conv in range(300):
        for turn in range(r.choice([0, 1, 2, 3, 5, 9, 17])):
            role = r.choice(roles) if r.random() < 0.2 else ("user", "assistant")[turn % 2]
            rows.append((conv, r.choice([turn, turn, turn, None, turn // 2]), role, r.choice(texts) if r.random() < 0.4 else f"text {r.random()}."))
    rows += [(None, t, "user", "nobody's.") for t in range(5)] + [(-3, None, "system", "s."), (900, 10**15, "user", "u."), (900, -5, "assistant", "a.")]
    rows += [(901, 7, "user", "same."), (901, 7, "user", "same."), (901, 7, "assistant", "w" * 200_000)]
    r.shuffle(rows)
    return [(*row, "x", 1, "y") for row in rows]


def answers(frame) -> dict[object, tuple]:
    rows = frame.collect()
    made = {r[0]: tuple(r)[1:] for r in rows}
    assert len(made) == len(rows)
    return made


@pytest.mark.parametrize("seed", range(2))
def test_repair(spark, seed):
    rows = conversations(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert answers(repair.reports(repair.repair(repair.damaged(frame)))) == expected(rows)


def test_query_and_no_rows(spark, tmp_path):
    rows = conversations(7)[:200]
    spark.createDataFrame(rows, SCHEMA).drop("place", "gone", "audit").write.parquet(f"{tmp_path}/conversations.parquet")
    frame = queries.op13_structure_repair(spark, str(tmp_path))
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert answers(frame) == expected(rows)
    none = spark.createDataFrame([], SCHEMA)
    assert repair.reports(repair.repair(repair.damaged(none))).count() == 0


def test_repaired_rows(spark):
    rows = [(1, 1, "user", "Hi.", False), (1, 2, "user", "Still there?", False), (1, 3, "assistant", "Yes.", False), (2, 1, "user", "Hi.", True)]
    frame = repair.repair(spark.createDataFrame(rows, "conv long, turn long, role string, text string, gone boolean"))
    got = sorted((r.conv, r.place, r.role, r.text, r.audit) for r in frame.collect() if r.place)
    assert [x[:3] for x in got] == [(1, 1, "user"), (1, 2, "assistant"), (1, 3, "user"), (1, 4, "assistant")]
    reports = {r.conv: (r.cost, r.audit) for r in frame.where("place = 0").collect()}
    assert reports == {1: (2, "KIKK"), 2: (0, "")}


def test_audits_of_every_short_conversation():
    known = repair.tables()
    for n in range(5):
        for symbols in itertools.product(range(repair.SYMBOLS), repeat=n):
            rows = tuple(("sua?"[s % 4] if s < 8 else "?", s == 8, 4 <= s < 8) for s in symbols)
            assert known.audit(bytes(symbols)) == cheapest(rows)[:2]


@pytest.mark.parametrize("seed", range(200))
def test_audits_of_longer_ones(seed):
    r = random.Random(seed)
    symbols = bytes(r.choice([1, 2, r.randrange(repair.SYMBOLS)]) for _ in range(r.randrange(5, 60)))
    rows = tuple(("sua?"[s % 4] if s < 8 else "?", s == 8, 4 <= s < 8) for s in symbols)
    assert repair.tables().audit(symbols) == cheapest(rows)[:2]


def test_a_long_conversation():
    r = random.Random(1)
    symbols = bytes(r.randrange(repair.SYMBOLS) for _ in range(100_003))
    cost, audit = repair.tables().audit(symbols)
    assert len(audit.replace("I", "")) == len(symbols)
    state, paid, rows = 0, 0, iter(symbols)
    for letter in audit:  # the letters give a legal conversation at that cost
        if letter == "I":
            state, paid = repair._wanted(state)[1], paid + 2
            continue
        s = next(rows)
        if letter == "D":
            paid += 3
            continue
        assert s != 8
        paid += (s >= 4) + 2 * (letter == "R")
        state = repair._wanted(state)[1] if letter == "R" else repair._NEXT[state]["sua?"[s % 4]]
    assert paid == cost and state in (0, 3)
