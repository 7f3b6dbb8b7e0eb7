"""Document fingerprints: an invertible Bloom lookup sketch of a text's paragraphs.

Paragraphs end at a line break or after a full stop, question or exclamation mark; longer stretches
are cut every ``LONGEST`` characters from their start. Each has a 64-bit number, hashed from its
characters and, for a repeated one, from which repetition it is, so a text is a set of numbers.

A sketch has three parts of cells; a number goes to one cell of each. A cell keeps how many numbers
it has, their exclusive or, and that of their checks. Two versions' sketches subtract cell by cell:
common numbers cancel. Peeling takes a cell with a single number, that is one whose check
matches and which is one of its number's own cells, out of its other cells, again and again, no more often than
there are cells. If cells remain, the sketches are too small;
both are made again with twice the cells, with other hashes, until peeling ends. Likeness is the
share of common numbers in all numbers, so equal sets have 1.

The fingerprint is the smallest sketch. Neighbouring texts come together by one shuffle into
blocks of ids, in order; the first text of each block is also sent to the block before.

Nulls: a null text counts as empty, without paragraphs; two empty texts are alike (1). Null ids come
first. Rows with equal ids are ordered by text. The only row of a table is its own next. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimtrace.llm.common import U64, mix, seed, shuffle_partitions, whole_text

PARTS = 3
SMALLEST = 16  # cells of a part
LONGEST = 400
_PARAGRAPH = regex.compile(rf"[^\n.!?]{{1,{LONGEST}}}[\n.!?]*|[\n.!?]+")
SLICE = 256  # texts compared at once
_MOST = 1 << 22  # characters compared at once


def paragraphs(text: str) -> list[str]:
    return _PARAGRAPH.findall(text)


def numbers(parts: list[str]) -> np.ndarray:
    """The numbers of paragraphs, sorted; repetitions get numbers of their own."""
    if not parts:
        return np.zeros(0, U64)
    raw = np.array([int.from_bytes(hashlib.blake2b(p.encode(), digest_size=8).digest(), "little") for p in parts], U64)
    raw.sort()
    first = np.concatenate([[True], raw[1:] != raw[:-1]])
    at = np.arange(len(raw))
    again = at - np.maximum.accumulate(np.where(first, at, 0))
    return np.where(again > 0, mix(raw + again.astype(U64) * seed(5)), raw)


def _cells(values: np.ndarray, cells: np.ndarray, turn: int) -> list[np.ndarray]:
    """In each part, the cell of each number; ``cells`` says how many a part has."""
    return [((mix(values + seed(100 + PARTS * turn + p)) >> U64(32)) * cells >> U64(32)).astype(np.int64) for p in range(PARTS)]


def _check(values: np.ndarray) -> np.ndarray:
    return mix(values ^ seed(99)) >> U64(32)


class Sketches:
    """One sketch for each of several sets, all of the same size, side by side."""

    def __init__(self, many: int, cells: int, turn: int = 0):
        self.many, self.cells, self.turn = many, cells, turn
        self.width = PARTS * cells
        self.count = np.zeros(many * self.width, np.int64)
        self.value = np.zeros(many * self.width, U64)
        self.check = np.zeros(many * self.width, U64)

    def _at(self, owner: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
        places = _cells(values, U64(self.cells), self.turn)
        return [owner * self.width + p * self.cells + place for p, place in enumerate(places)]

    def add(self, owner: np.ndarray, values: np.ndarray, sign: int | np.ndarray = 1) -> None:
        check = _check(values)
        for at in self._at(owner, values):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.value, at, values)
            np.bitwise_xor.at(self.check, at, check)

    def minus(self, other: Sketches) -> Sketches:
        made = Sketches(self.many, self.cells, self.turn)
        made.count, made.value, made.check = self.count - other.count, self.value ^ other.value, self.check ^ other.check
        return made

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many numbers only the first and only the second set has; which sketches failed.

        Uses the sketches up.
        """
        plus, less = np.zeros(self.many, np.int64), np.zeros(self.many, np.int64)
        for _ in range(self.width):  # true numbers are out sooner: each turn leaves a cell of theirs empty
            single = np.flatnonzero(np.abs(self.count) == 1)
            single = single[_check(self.value[single]) == self.check[single]]
            if len(single):  # a value that only looks right belongs to other cells
                own = self._at(single // self.width, self.value[single])
                single = single[(own[0] == single) | (own[1] == single) | (own[2] == single)]
            if not len(single):
                break
            owner, value, sign = single // self.width, self.value[single], self.count[single]
            order = np.lexsort((value, owner))  # a number may be single in several cells
            owner, value, sign = owner[order], value[order], sign[order]
            once = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])
            owner, value, sign = owner[once], value[once], sign[once]
            plus += np.bincount(owner[sign > 0], minlength=self.many)
            less += np.bincount(owner[sign < 0], minlength=self.many)
            self.add(owner, value, -sign)
        left = (self.count != 0) | (self.value != 0) | (self.check != 0)
        return plus, less, left.reshape(self.many, self.width).any(axis=1)

    def texts(self) -> list[str]:
        """Each sketch as text: compressed cells in base 64."""
        shape = (self.many, self.width)
        columns = (self.count.astype("<i4").reshape(shape), self.value.astype("<u8").reshape(shape), self.check.astype("<u4").reshape(shape))
        return [base64.b64encode(zlib.compress(b"".join(c[i].tobytes() for c in columns), 1)).decode() for i in range(self.many)]


def _flat(sets: list[np.ndarray], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = [sets[i] for i in which]
    sizes = [len(s) for s in chosen]
    return np.repeat(np.arange(len(chosen)), sizes), (np.concatenate(chosen) if chosen else np.zeros(0, U64))


def sketched(sets: list[np.ndarray], which: np.ndarray, cells: int, turn: int) -> Sketches:
    made = Sketches(len(which), cells, turn)
    made.add(*_flat(sets, which))
    return made


def likeness(first: list[np.ndarray], second: list[np.ndarray], a: Sketches, b: Sketches) -> np.ndarray:
    """The likeness of each pair of sets; ``a`` and ``b`` are their smallest sketches."""
    found, open_ = np.ones(len(first)), np.arange(len(first))
    cells, turn = SMALLEST, 0
    while len(open_):
        if turn:
            a, b = sketched(first, open_, cells, turn), sketched(second, open_, cells, turn)
        plus, less, failed = a.minus(b).peel()
        done = open_[~failed]
        sizes = np.array([(len(first[i]), len(second[i])) for i in done], np.int64).reshape(-1, 2)
        union = sizes[:, 1] + plus[~failed]
        common = sizes[:, 0] - plus[~failed]
        found[done] = np.where(union > 0, common / np.maximum(union, 1), 1.0)
        open_, cells, turn = open_[failed], cells * 2, turn + 1
    return found


def _compared(rows: list[tuple[object, str]], schema: pa.Schema) -> pa.RecordBatch:
    """Results for all rows but the last, which is only the next of the one before it."""
    texts = [t for _, t in rows]
    own = [numbers(paragraphs(t)) for t in texts]
    edited = []
    for text, after in zip(texts, texts[1:]):
        part = len(text) // 4
        edited.append(text[: len(text) - part] + after[:part])
    changed = [numbers(paragraphs(t)) for t in edited]
    n = len(edited)
    every, first = np.arange(n + 1), np.arange(n)
    a, b = sketched(own, every, SMALLEST, 0), sketched(changed, first, SMALLEST, 0)
    head, tail = Sketches(n, SMALLEST), Sketches(n, SMALLEST)
    for name in ("count", "value", "check"):
        setattr(head, name, getattr(a, name)[: n * a.width])
        setattr(tail, name, getattr(a, name)[a.width :])
    columns = [
        pa.array([k for k, _ in rows[:-1]], schema.field(0).type),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array(head.texts()),
        pa.array(b.texts()),
        pa.array(likeness(own[:-1], changed, head, b)),
        pa.array(likeness(own[:-1], own[1:], head, tail)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _by_block(schema: pa.Schema):
    """Rows come block by block in order; a block ends with the first row of the next, marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, size, closed = None, [], 0, False
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for b, extra, key, text in zip(*columns):
                if b != block:
                    if len(rows) > 1:
                        yield _compared(rows, schema)
                    block, rows, size, closed = b, [], 0, False
                if closed:
                    continue  # only the least of the next block's first rows counts
                closed = bool(extra)
                rows.append((key, text))
                size += len(text)
                if len(rows) > SLICE or size > _MOST and len(rows) > 1:
                    yield _compared(rows, schema)
                    rows, size = rows[-1:], len(text)
        if len(rows) > 1:
            yield _compared(rows, schema)

    return run


def against_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    # The least id of each of ``parts`` ranges of ids, on a column of ids alone: as many rows.
    ranged = rows.select("id").repartitionByRange(parts, F.asc_nulls_first("id"))
    least = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min("id").alias("id"), F.bool_or(F.col("id").isNull()).alias("nulls"))
    found = least.collect()
    key = rows.schema["id"].dataType
    bounds = sorted({r.id for r in found if r.id is not None and not r.nulls} - ({min((r.id for r in found if r.id is not None), default=None)} if not any(r.nulls for r in found) else set()))
    lows = F.array(*[F.lit(b).cast(key) for b in bounds]) if bounds else F.array().cast(T.ArrayType(key))
    block = F.coalesce(F.size(F.filter(lows, lambda b: b <= F.col("id"))), F.lit(0))
    last = len(bounds)
    placed = rows.withColumn("block", F.when(F.col("id").isNull(), 0).otherwise(block)).withColumn("extra", F.lit(0))
    # Rows with the least id of all are next to the last row; those of a block to the block before.
    nulls = any(r.nulls for r in found)
    lowest = min((r.id for r in found if r.id is not None), default=None)
    is_least = F.col("id").isNull() if nulls else F.col("id") == F.lit(lowest).cast(key)
    firsts = placed.where(is_least | F.array_contains(lows, F.col("id"))) if found else placed.limit(0)
    firsts = firsts.withColumn("block", F.when(is_least, last).otherwise(F.col("block") - 1)).withColumn("extra", F.lit(1))
    both = placed.unionByName(firsts).select("block", "extra", "id", "text")
    ordered = both.repartition(parts, "block").sortWithinPartitions("block", "extra", F.asc_nulls_first("id"), "text")
    made = T.StructType().add("id", key).add("n_chars", T.LongType())
    for name in ("edited_sha256", "fingerprint", "edited_fingerprint"):
        made = made.add(name, T.StringType())
    made = made.add("near_edited", T.DoubleType()).add("near_next", T.DoubleType())
    return ordered.mapInArrow(_by_block(to_arrow_schema(made)), made).withColumnRenamed("id", id_col)
