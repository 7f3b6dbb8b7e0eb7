"""Conversation structure repair by Four-Russians block tables.

A repaired conversation's role initials are ``(s?(ua)+)?``: a system turn or none, then user and assistant
in turn. Rows are kept (0), given another role (2) or deleted (3), turns without text are inserted (2); a
truncated row that stays costs 1, a blank or repeated row must go. Of all cheapest ways the one whose letters
(Delete, Insert, Keep, Rerole) sort first is taken.

For the rows after any place, what the rest costs depends on the state of that pattern: a vector of four
numbers. Less their smallest, few vectors are possible. A row is one of nine symbols, so for each
vector behind a block of ``BLOCK`` symbols the vector before it and the cost are computed once, for all
blocks. A conversation is a row of lookups from its end. To trace, the vectors at the block borders are
kept, each block is expanded backward again to its inner vectors, and the letters follow forward: in
a state, before a symbol, with a vector behind it, the first letter that costs no more than the best is
a table entry too. Choosing forward among the cheapest makes ties safe.

Conversations are dealt by id and sorted by turn. The first pass has no texts and holds one byte a row of one
conversation, no more than its audit. The second streams the texts behind the audit.

Nulls: roles, texts, and ids or turns where they are written out, count as one space; null turns come
first; rows without a conversation id are one conversation. An empty role counts as one space in the
initials. Rows of equal turns are ordered by the digest of role and text, so repeated rows are adjacent.
Very long texts go through the second pass one batch at a time. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK = 4
# Costs of the edits, and the white space of the contract.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"

# States: nothing yet, after system, after user, after assistant. By initial: s, u, a.
_NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
_INITIALS = "sua"
_ENDS = (0, 3)
_DROP = 8  # the symbol of a row that must go; others: initial (0 to 3) and 4 if truncated
SYMBOLS = 9
_SEVERAL = 1 << 13  # rows of output gathered


def _wanted(state: int) -> tuple[str, int]:
    """The initial of the turn to insert or rename in a state, and the state after it."""
    return next((i, to) for i, to in _NEXT[state].items() if i != "s")


def _before(behind: tuple[int, ...], symbol: int) -> list[int]:
    """Costs from each state before a row, given those behind it."""
    best = [DELETE + behind[q] for q in range(4)]
    if symbol != _DROP:
        cut, initial = CUT * (symbol >= 4), "sua?"[symbol % 4]
        for q in range(4):
            if initial in _NEXT[q]:
                best[q] = min(best[q], cut + behind[_NEXT[q][initial]])
            best[q] = min(best[q], REROLE + cut + behind[_wanted(q)[1]])
    return _inserted(best)


def _inserted(best: list[int]) -> list[int]:
    for _ in range(3):
        best = [min(best[q], INSERT + best[_wanted(q)[1]]) for q in range(4)]
    return best


class Tables:
    """Vectors, their transitions by block, and the letters of each step."""

    def __init__(self) -> None:
        far = 1 << 20
        last = _inserted([0 if q in _ENDS else far for q in range(4)])
        vectors, number = [tuple(last)], {tuple(last): 0}
        leads, costs = [], []
        for vector in vectors:  # grows
            row, cost = [], []
            for symbol in range(SYMBOLS):
                made = _before(vector, symbol)
                least = min(made)
                made = tuple(x - least for x in made)
                if made not in number:
                    number[made] = len(vectors)
                    vectors.append(made)
                row.append(number[made])
                cost.append(least)
            leads.append(row)
            costs.append(cost)
        self.vectors, self.one, self.one_cost = vectors, leads, costs
        lead, price = np.array(leads), np.array(costs)
        block, total = lead, price
        for _ in range(BLOCK - 1):  # one more symbol in front
            total = (total[:, None, :] + price[block].transpose(0, 2, 1)).reshape(len(vectors), -1)
            block = lead[block].transpose(0, 2, 1).reshape(len(vectors), -1)
        self.block, self.block_cost = block.tolist(), total.tolist()
        self.steps = [[[self._letters(q, v, s) for s in range(SYMBOLS)] for v in vectors] for q in range(4)]
        self.close = []
        for state in range(4):
            text = ""
            while state not in _ENDS:
                text, state = text + "I", _wanted(state)[1]
            self.close.append(text)

    @staticmethod
    def _letters(state: int, behind: tuple[int, ...], symbol: int) -> tuple[str, int]:
        """The inserts before a row and what becomes of it; the state after."""
        best, text = _before(behind, symbol), ""
        cut, initial = CUT * (symbol >= 4), "sua?"[symbol % 4]
        while True:
            to = _wanted(state)[1]
            if DELETE + behind[state] == best[state]:
                return text + "D", state
            if INSERT + best[to] == best[state]:
                text, state = text + "I", to
                continue
            if symbol != _DROP and initial in _NEXT[state] and cut + behind[_NEXT[state][initial]] == best[state]:
                return text + "K", _NEXT[state][initial]
            return text + "R", to

    def audit(self, symbols: bytes | bytearray) -> tuple[int, str]:
        """The least cost of a conversation and the letters of its edits."""
        head = len(symbols) % BLOCK
        vector, cost, borders = 0, 0, []
        for at in range(len(symbols) - BLOCK, head - 1, -BLOCK):
            borders.append(vector)
            code = 0
            for s in symbols[at : at + BLOCK]:
                code = code * SYMBOLS + s
            cost += self.block_cost[vector][code]
            vector = self.block[vector][code]
        start = vector
        for s in reversed(symbols[:head]):
            cost += self.one_cost[vector][s]
            vector = self.one[vector][s]
        cost += self.vectors[vector][0]
        state, text = self._expand(0, start, symbols[:head])
        parts = [text]
        for at in range(head, len(symbols), BLOCK):
            state, text = self._expand(state, borders.pop(), symbols[at : at + BLOCK])
            parts.append(text)
        parts.append(self.close[state])
        return cost, "".join(parts)

    def _expand(self, state: int, vector: int, symbols: bytes | bytearray) -> tuple[int, str]:
        inner = [vector]
        for s in reversed(symbols[1:]):
            inner.append(self.one[inner[-1]][s])
        text = ""
        for s in symbols:
            letters, state = self.steps[state][inner.pop()][s]
            text += letters
        return state, text


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _schema(conv: T.DataType, *fields: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("conv", conv), *fields])


_REPORT = [*(T.StructField(c, T.LongType()) for c in _COUNTS), T.StructField("audit", T.StringType())]
_LINE = [T.StructField(c, t) for c, t in (("place", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))]
_NOBODY = object()


def _audited(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Symbols of whole conversations in order, to one row each."""
    known, rows = tables(), []
    conv, symbols, faults, turns, illegal, before = _NOBODY, bytearray(), [0] * 4, None, 0, None

    def close() -> None:
        cost, audit = known.audit(symbols)
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        rows.append((conv, gaps, faults[2], faults[3], faults[1], illegal, cost, audit))

    for batch in batches:
        for key, turn, initial, fault in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "fault")]):
            if conv is _NOBODY or key != conv:
                if conv is not _NOBODY:
                    close()
                conv, symbols, faults, turns, illegal, before = key, bytearray(), [0] * 4, None, 0, None
            if fault is None:
                continue  # only names its conversation
            faults[fault] += 1
            symbols.append(_DROP if fault > 1 else initial + 4 * fault)
            illegal += before is not None and (before, initial) not in ((0, 1), (1, 2), (2, 1))
            before = initial
            if turn is not None:
                turns = (turn, turn, 1) if turns is None else (turns[0], turn, turns[2] + (turn != turns[1]))
        if len(rows) >= _SEVERAL:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
    if conv is not _NOBODY:
        close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _edited(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A conversation's report, then its rows in order, to the report and the rows of the repaired one."""
    names = {"u": "user", "a": "assistant"}
    letters, at, state, place = "", 0, 0, 0
    nothing = (None,) * len(_REPORT)
    conv = None

    def insert(rows: list) -> None:
        nonlocal at, state, place
        while letters[at : at + 1] == "I":
            initial, state = _wanted(state)
            at, place = at + 1, place + 1
            rows.append((conv, place, names[initial], "", *nothing))

    for batch in batches:
        rows: list[tuple] = []
        for row in zip(*[batch.column(f.name).to_pylist() for f in schema]):
            if row[1] == 0:
                conv, letters, at, state, place = row[0], row[-1], 0, 0, 0
                rows.append(row)
                insert(rows)
                continue
            letter, role = letters[at], row[2]
            at += 1
            if letter != "D":
                initial = role[:1]
                if letter == "R":
                    initial = _wanted(state)[0]
                    role = names[initial]
                state, place = _NEXT[state][initial], place + 1
                rows.append((conv, place, role, row[3], *nothing))
            insert(rows)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _hashed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Reports and repaired rows, to the reports with the hash of the rows."""
    held, state = None, None
    for batch in batches:
        rows = []
        columns = ("conv", "place", "role", "text", *_COUNTS, "audit")
        for conv, place, role, text, *report in zip(*[batch.column(c).to_pylist() for c in columns]):
            if place == 0:
                if held is not None:
                    rows.append((*held, state.hexdigest()))
                held, state = (conv, *report), sha256()
            else:
                state.update(("\n" if place > 1 else "").encode() + f"{role}:{text}".encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*held, state.hexdigest()), schema)], schema=schema)


def _or_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, gone``: each row by a hash of its id and turn dropped, emptied, bared of full
    stops, repeated, given to the user, or left. A dropped row stays as ``gone``, so that its conversation is known.
    """
    kind = F.pmod(F.crc32(F.concat(_or_space(F.col(f"`{conv}`")), F.lit(":"), _or_space(F.col(f"`{turn}`")))), F.lit(20))
    said = _or_space(F.col(f"`{text}`"))
    hurt = rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(_or_space(F.col(f"`{role}`"))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
        (kind == 0).alias("gone"),
        F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("_copies"),
    )
    return hurt.select("conv", "turn", "role", "text", "gone", F.explode("_copies")).drop("col")


def repair(rows: DataFrame) -> DataFrame:
    """Reports and repaired rows of conversations given as ``conv, turn, role, text, gone``.

    In each partition a conversation's report (``place`` 0: gaps, faults, cost and audit) comes before its repaired rows
    (``place`` from 1, ``role``, ``text``). Rows that are ``gone`` only name their conversation.
    """
    role, text = _or_space(F.col("role")), _or_space(F.col("text"))
    place = F.when(~F.col("gone"), F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    given = rows.select("conv", "turn", role.alias("role"), text.alias("text"), "gone", place.alias("digest"))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    solid = F.rtrim(F.col("text"), F.lit(WHITE))
    light = given.select("conv", "turn", "digest", "gone", initial.alias("initial"), (solid == "").alias("blank"), F.right(solid, F.lit(1)).alias("end"))
    seen = F.row_number().over(Window.partitionBy("conv", "digest").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(F.col("blank"), 2).when(F.col("seen") > 1, 3).when(~F.col("end").isin(".", "!", "?"), 1).otherwise(0)
    order = ["conv", F.col("turn").asc_nulls_first(), F.col("digest")]
    light = light.repartition("conv").withColumn("seen", seen)
    light = light.select("conv", "turn", "digest", "initial", F.when(~F.col("gone"), fault).alias("fault")).sortWithinPartitions(*order)
    audit_schema = _schema(rows.schema["conv"].dataType, *_REPORT)
    audit_arrow = to_arrow_schema(audit_schema)
    reports = light.select("conv", "turn", "initial", "fault").mapInArrow(lambda b: _audited(b, audit_arrow), audit_schema)

    schema = _schema(rows.schema["conv"].dataType, *_LINE, *_REPORT)
    arrow = to_arrow_schema(schema)
    lines = given.where(~F.col("gone")).withColumn("place", F.lit(1).cast("long"))
    both = reports.withColumn("place", F.lit(0).cast("long")).unionByName(lines, allowMissingColumns=True)
    both = both.repartition("conv").sortWithinPartitions("conv", "place", F.col("turn").asc_nulls_first(), "digest")
    return both.select(*schema.names).mapInArrow(lambda b: _edited(b, arrow), schema)


def reports(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``: its report and ``repaired_sha256`` of its rows."""
    schema = _schema(repaired.schema["conv"].dataType, *_REPORT, T.StructField("repaired_sha256", T.StringType()))
    arrow = to_arrow_schema(schema)
    return repaired.mapInArrow(lambda b: _hashed(b, arrow), schema)
