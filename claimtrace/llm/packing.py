"""Best-fit packing of token sequences, exact complements first.

Documents become pieces of at most ``capacity`` tokens; only longer ones are cut. Packing needs
the pieces' lengths only, and there are at most ``capacity`` of these, so the plan is made on the
driver from the counts of each length and is bounded by the capacity, whatever the input:

1. exact complements: for each length, longest first, the gap it leaves is looked up in the
   indexes of single lengths, of sums of two and of sums of three; a combination that fills the gap
   exactly is used as often as the counts of its lengths allow;
2. the rest goes, longest first, into the fullest sequence with room for it, or a new one.

The plan says which ranks among the pieces of a length go to which sequences and where. Pieces
are ranked in blocks of their length, so a length that many pieces share is spread over tasks.

Nulls: a null text counts as empty, one end token; null ids are allowed. Repeated rows are packed
each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimtrace.llm import tokens
from claimtrace.llm.common import whole_text, written

CAPACITY = 4096
END = 1
BLOCKS = 64  # of each length, for ranking


class Sums:
    """Which sums of one, two or three available lengths there are, under their counts."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.size = len(counts)
        self._index()

    def _index(self) -> None:
        free = (self.counts > 0).astype(np.float64)
        wide = np.fft.rfft(free, 2 * self.size)
        self.pairs = (np.fft.irfft(wide * wide, 2 * self.size) > 0.5)[: self.size]

    def _pair(self, total: int) -> tuple[int, ...]:
        """Two available lengths of that sum, the most unequal first."""
        if total < 2 or not self.pairs[total]:
            return ()
        low = np.arange(1, total // 2 + 1)
        good = (self.counts[low] > 0) & (self.counts[total - low] > 0)
        good &= (low * 2 != total) | (self.counts[low] > 1)
        found = np.flatnonzero(good)
        if not len(found):
            self.pairs[total] = False  # used up since the index was made
            return ()
        return (int(total - low[found[0]]), int(low[found[0]]))

    def filling(self, gap: int) -> tuple[int, ...]:
        """The fewest available lengths, at most three, that add up to the gap; none: empty."""
        if gap < 1:
            return ()
        if self.counts[gap] > 0:
            return (gap,)
        two = self._pair(gap)
        if two:
            return two
        third = np.arange(gap - 2, 0, -1)
        for c in third[(self.counts[third] > 0) & self.pairs[gap - third]]:
            two = self._pair(gap - int(c))
            if two and (two + (int(c),)).count(int(c)) <= self.counts[c]:
                return (int(c), *two)
        return ()


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """What each sequence holds: lengths, and how many sequences are like that."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    made: list[tuple[tuple[int, ...], int]] = []
    sums = Sums(left)
    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1  # the one the gap is for
            rest = sums.filling(capacity - length) if length < capacity else ()
            if length < capacity and not rest:
                left[length] += 1
                break
            one = (length, *rest)
            left[length] += 1
            times = int(min(left[x] // one.count(x) for x in set(one)))
            for x in one:
                left[x] -= times
            made.append((one, times))
    return made + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    room: dict[int, list[list]] = defaultdict(list)  # free tokens: [lengths held, how many sequences]
    for length in (int(x) for x in np.flatnonzero(left)[::-1]):
        n = int(left[length])
        for free in sorted(r for r in room if r >= length) + [capacity]:
            times = free // length
            while n and (room[free] if free < capacity else True):
                held, sequences = room[free].pop() if free < capacity else ((), n // times + (n % times > 0))
                full = min(sequences, n // times)
                if full:
                    room[free - times * length].append([held + (length,) * times, full])
                    n -= full * times
                if full < sequences:
                    if n:  # fewer than would fill one more
                        room[free - n * length].append([held + (length,) * n, 1])
                        n, full = 0, full + 1
                    if full < sequences:
                        room[free].append([held, sequences - full])
            if not n:
                break
    return [(held, n) for groups in room.values() for held, n in groups if held]


def _pieces(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tail = tokens.words(path), array("I", [end]).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = known.ids(text.as_py()) + tail
                for n, at in enumerate(range(0, len(ids), capacity * 4)):
                    part = ids[at : at + capacity * 4]
                    rows.append((key, n, at // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                kinds = (batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "crc"])

    return run


def _placed(first: np.ndarray, starts: np.ndarray, ranges: np.ndarray, schema: pa.Schema):
    """Adds the sequence and the place in it; ``ranges`` has key, first sequence, offset by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, block, at = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "block", "at"))
            key = (length << 40) + starts[length, block] + at - 1
            i = np.searchsorted(first, key, "right") - 1
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("id", "piece", "start", "length", "crc")]
            columns += [pa.array(ranges[i, 0] + key - first[i]), pa.array(ranges[i, 1])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``id, piece, start, length, ids_crc32, sequence_id, offset``."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    pieces = rows.mapInArrow(_pieces(path, capacity, end), f"id {kind}, piece int, start long, length long, crc long")
    pieces = written(pieces, "pack-pieces").withColumn("block", F.pmod(F.xxhash64("id", "piece"), F.lit(BLOCKS)).cast("int"))
    counts = np.zeros((capacity + 1, BLOCKS), np.int64)  # at most capacity * BLOCKS rows
    for r in pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.length, r.block] = r.n
    starts = np.cumsum(counts, axis=1) - counts
    totals = counts.sum(axis=1)
    used, sequence, entries = np.zeros(capacity + 1, np.int64), 0, []
    for held, n in plan({int(x): int(totals[x]) for x in np.flatnonzero(totals)}, capacity):
        offset = 0
        for length in held:
            entries.append(((length << 40) + int(used[length]), sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    table = np.array(sorted(entries), np.int64).reshape(-1, 3)
    ranked = pieces.withColumn(
        "at", F.row_number().over(Window.partitionBy("length", "block").orderBy(F.asc_nulls_first("id"), "piece", "start", "crc")).cast("long")
    )
    schema = f"id {kind}, piece int, start long, length long, crc long, sequence_id long, offset long"
    arrow = pa.schema([("id", _arrow(kind)), ("piece", pa.int32()), *[(c, pa.int64()) for c in ("start", "length", "crc", "sequence_id", "offset")]])
    placed = ranked.select("id", "piece", "start", "length", "crc", F.col("block").cast("long").alias("block"), "at")
    placed = placed.mapInArrow(_placed(table[:, 0].copy(), starts, table[:, 1:].copy(), arrow), schema)
    return placed.withColumnsRenamed({"id": id_col, "crc": "ids_crc32"})


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
