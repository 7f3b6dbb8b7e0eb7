"""Substring dedup by recompression: words that long repeated passages cover go.

A window is ``WIDTH`` consecutive words of one text. A word is removed if a window that covers it
starts anywhere else too, in the same text or another; all windows are judged on the input.

Parsing. Rounds of recompression name maximal runs of a symbol and pairs of a left and a right
symbol, where a hash of its name says which side a symbol is of. A name is a hash of what it
stands for, so all tasks give equal runs and pairs the same name without asking each other. What a
symbol became depends on a few neighbours; each symbol carries the range of words that decided
it, and when that range lies inside two equal windows, both hold the same symbol there.

Three jobs that shuffle packed 64-bit numbers:

1. each window picks, among the symbols of the highest level decided inside it, the one whose range
   has the least hash: its anchor. About one word in nine is one. Anchors that occur once in the
   corpus prove all their windows unique; the others are sent back to the blocks of texts they
   came from.
2. texts with repeated anchors send the numbers of the windows on them; those that occur
   twice are sent back.
3. words that repeated windows cover are removed.

A task sends a number once for each block of texts, so a passage in a third of all texts never
meets in one task more than once from each. Answers go back through relays. Window numbers are
64-bit hashes of all their words.

Nulls: a null text has no words; null ids are allowed. A word of any length is one word. Texts
that occur twice and have ``WIDTH`` words or more lose all words; repeated rows are such texts. An
empty table gives no rows. Other columns are ignored, or carried along in ``rest``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimtrace.llm import shingles
from claimtrace.llm.common import U64, blobs, mix, pair, seed, shuffle_partitions, slices, whole_text, written

WIDTH = 35
ROUNDS = 4
SLICE = 1 << 20
FLUSH = 1 << 20  # numbers a task gathers before it sends them
KEYS = "bucket int, keys binary, blocks binary, many binary"


def joined(numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words in one row with a barrier, a word of its own, before each and at the end.

    Returns the row and where each text begins in it.
    """
    n = len(ends)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) + np.arange(1, n + 1)
    row = np.empty(len(numbers) + n + 1, U64)
    walls = np.concatenate([starts - 1, [len(row) - 1]])
    inner = np.ones(len(row), bool)
    inner[walls] = False
    row[inner] = numbers
    row[walls] = mix(np.arange(len(walls), dtype=U64) + seed(77))
    return row, starts


def windows(starts: np.ndarray, sizes: np.ndarray, total: int, width: int) -> np.ndarray:
    """Where in the row a window of one text starts, as a mask."""
    edge = np.zeros(total + 1, np.int32)
    many = sizes >= width
    edge[starts[many]] += 1
    edge[starts[many] + sizes[many] - width + 1] -= 1
    return np.cumsum(edge[:-1]) > 0


def _compress(name, low, high, turn: int):
    """One round: runs, then pairs. ``low`` and ``high`` bound the words that decided a symbol."""
    head = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    count = np.diff(np.concatenate([head, [len(name)]]))
    last = head + count - 1
    low, high = low[np.maximum(head - 1, 0)], high[np.minimum(last + 1, len(name) - 1)]
    name = name[head]
    runs = count > 1
    name[runs] = pair(name[runs], count[runs].astype(U64), 10 + turn)
    right = (mix(name + seed(20 + turn)) >> U64(63)).astype(bool)
    starts = np.concatenate([~right[:-1] & right[1:], [False]])
    second = np.concatenate([[False], starts[:-1]])
    next_high, back_low = np.concatenate([high[1:], high[-1:]]), np.concatenate([low[:1], low[:-1]])
    high = np.where(right, high, next_high)  # a left symbol has looked at the next
    low = np.where(right & ~second, back_low, low)  # a right one at the one before
    name = name.copy()
    name[starts] = pair(name[starts], name[1:][starts[:-1]], 40 + turn)
    return name[~second], low[~second], high[~second]


def anchors(row: np.ndarray, valid: np.ndarray, width: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchor number of each window; the numbers of all anchors, one for each place; the places."""
    total = len(row)
    place = np.arange(total)
    levels = [(row, place, place + 1)]
    for turn in range(rounds):
        levels.append(_compress(*levels[-1], turn))
    power, content = _prefix(row)
    best = np.full(total, np.iinfo(U64).max, U64)
    used: list[np.ndarray] = []
    places: list[np.ndarray] = []
    missing = valid
    for level in range(rounds, -1, -1):
        _, low, high = levels[level]
        slack = width - (high - low)
        fits = slack >= 0
        if level < rounds:  # only symbols that some window without an anchor can take
            before = np.concatenate([[0], np.cumsum(missing)])
            fits &= before[low + 1] > before[np.maximum(high - width, 0)]
        low, high, slack = low[fits], high[fits], slack[fits]
        number = mix((content[high] - content[low]) * power[low] + seed(60) * (high - low).astype(U64))
        number = (U64(rounds - level) << U64(60)) | (number >> U64(4))
        order = np.argsort(slack, kind="stable")[::-1]
        low, slack, number = low[order], slack[order], number[order]
        reach = np.searchsorted(-slack, -np.arange(width + 1), "right")  # how many have that slack
        taken = np.zeros(len(low), bool)
        for back in range(width + 1):
            n = reach[back]
            if not n:
                break
            at = low[:n] - back
            inside = at >= 0
            np.minimum.at(best, at[inside], number[:n][inside])
        for back in range(width + 1):
            n = reach[back]
            if not n:
                break
            at = np.maximum(low[:n] - back, 0)
            taken[:n] |= valid[at] & (best[at] == number[:n]) & (low[:n] >= back)
        used.append(number[taken])
        places.append(low[taken])
        missing = valid & (best == np.iinfo(U64).max)
        if not missing.any():
            break
    return best, np.concatenate(used), np.concatenate(places)


_BASE = 0xD1342543DE82EF95  # fixed value: an odd multiplier


def _prefix(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from the start of word times power, and the powers that make their differences alike."""
    n = len(row) + 1
    up, down = np.empty(n, U64), np.empty(n, U64)
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up[0] = down[0] = 1
        up[1:], down[1:] = U64(_BASE), U64(inverse)
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return down, np.concatenate([np.zeros(1, U64), np.cumsum(mix(row) * up[:-1], dtype=U64)])


def window_numbers(row: np.ndarray, width: int) -> np.ndarray:
    """A number for the words of the window at each place, by doubling; the last ones are void."""
    made, length, held = None, 0, row
    size = 1
    padded = lambda x, by: np.concatenate([x[by:], x[: min(by, len(x))]])
    while size <= width:
        if width & size:
            made = held if made is None else pair(made, padded(held, length), 70)
            length += size
        held = pair(held, padded(held, size), 71)
        size *= 2
    return mix(made)


def _packed(numbers: np.ndarray, blocks: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket: the distinct numbers of each block, and which occur more than once."""
    bucket = (mix(numbers) % U64(buckets)).astype(np.int64)
    order = np.lexsort((numbers, blocks, bucket))
    numbers, blocks, bucket = numbers[order], blocks[order], bucket[order]
    first = np.flatnonzero(np.concatenate([[True], (numbers[1:] != numbers[:-1]) | (blocks[1:] != blocks[:-1])]))
    many = (np.diff(np.concatenate([first, [len(numbers)]])) > 1).astype(np.uint8)
    numbers, blocks, bucket = numbers[first], blocks[first].astype(np.int32), bucket[first]
    last = np.flatnonzero(np.concatenate([bucket[1:] != bucket[:-1], [True]]))
    parts = [blobs(x, last + 1) for x in (numbers, blocks, many)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[last].astype(np.int32)), *parts], ["bucket", "keys", "blocks", "many"])


class _Sender:
    """Gathers numbers by block and packs them when there are enough."""

    def __init__(self, buckets: int):
        self.buckets, self.numbers, self.blocks, self.n = buckets, [], [], 0

    def add(self, numbers: np.ndarray, blocks: np.ndarray) -> None:
        self.numbers.append(numbers)
        self.blocks.append(blocks)
        self.n += len(numbers)

    def rows(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if self.n >= least:
            yield _packed(np.concatenate(self.numbers), np.concatenate(self.blocks), self.buckets)
            self.numbers, self.blocks, self.n = [], [], 0


def _sizes(ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], ends])).astype(np.int64)


def _anchor_rows(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(buckets)
        for batch in slices(batches, "text", SLICE):
            block = batch.column(0).to_numpy()
            numbers, ends = shingles.word_numbers(batch.column(1), False)
            sizes = _sizes(ends)
            row, starts = joined(numbers, ends)
            valid = windows(starts, sizes, len(row), width)
            if valid.any():
                _, keys, at = anchors(row, valid, width)
                sender.add(keys, block[np.searchsorted(starts, at, "right") - 1].astype(np.int64))
            yield from sender.rows(FLUSH)
        yield from sender.rows()

    return run


def _split(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values ends."""
    return np.flatnonzero(np.concatenate([values[1:] != values[:-1], [True]])) + 1 if len(values) else np.zeros(0, np.int64)


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])


def _repeated(side: int):
    """Of one bucket, the numbers that occur more than once in all rows together and their blocks, by region."""

    def run(table: pa.Table) -> pa.Table:
        keys, blocks, many = (_column(table, c, kind) for c, kind in (("keys", U64), ("blocks", np.int32), ("many", np.uint8)))
        order = np.lexsort((blocks, keys))
        keys, blocks, many = keys[order], blocks[order], many[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        weight = np.add.reduceat(1 + many.astype(np.int64), first)
        good = np.repeat(weight > 1, np.diff(np.concatenate([first, [len(keys)]])))
        keys, blocks = keys[good], blocks[good]
        order = np.argsort(blocks, kind="stable")
        keys, blocks = keys[order], blocks[order]
        region = blocks // side
        ends = _split(region)
        relay = np.full(len(ends), table.column("bucket")[0].as_py() % side, np.int32)
        made = {"region": pa.array(region[ends - 1].astype(np.int32)), "relay": pa.array(relay)}
        return pa.table(made | {"keys": blobs(keys, ends), "blocks": blobs(blocks, ends)})

    return run


def _handed_on(table: pa.Table) -> pa.Table:
    """The numbers of one region that some buckets found, one row for each of its blocks."""
    keys, blocks = _column(table, "keys", U64), _column(table, "blocks", np.int32)
    order = np.argsort(blocks, kind="stable")
    keys, blocks = keys[order], blocks[order]
    ends = _split(blocks)
    return pa.table({"block": pa.array(blocks[ends - 1]), "keys": blobs(keys, ends)})


def _answers(sent: DataFrame, count: int) -> DataFrame:
    """The repeated numbers of each block, from all buckets.

    There are as many buckets as blocks, and a bucket may answer all of them. Sent straight, the rows
    would grow with the square of their number; through relays, each for some buckets and a region of
    blocks, they grow with its power 1.5, and a relay holds no more than a bucket on average.
    """
    side = math.isqrt(count - 1) + 1
    found = sent.groupBy("bucket").applyInArrow(_repeated(side), "region int, relay int, keys binary, blocks binary")
    return found.groupBy("region", "relay").applyInArrow(_handed_on, "block int, keys binary")


def _by_block(docs: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """The texts after the numbers of their block, block by block."""
    asked = answers.select("block", F.lit(0).alias("kind"), "keys")
    both = docs.withColumn("kind", F.lit(1)).unionByName(asked, allowMissingColumns=True)
    return both.repartition(parts, "block").sortWithinPartitions("block", "kind").withColumn("text", F.coalesce("text", F.lit(b"")))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """The block, its sorted numbers, and a slice of its texts, for rows as ``_by_block`` makes them."""
    block, known, fresh = None, np.zeros(0, U64), []
    for batch in slices(batches, "text", SLICE):
        blocks, kinds = batch.column(batch.schema.get_field_index("block")).to_numpy(), batch.column(batch.schema.get_field_index("kind")).to_numpy()
        keys = batch.column(batch.schema.get_field_index("keys"))
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(blocks)]):
            if blocks[a] != block:
                block, known, fresh = blocks[a], np.zeros(0, U64), []
            if kinds[a] == 0:
                fresh += [np.frombuffer(keys[i].as_py(), U64) for i in range(a, b)]
            else:
                if fresh:
                    known, fresh = np.sort(np.concatenate([known, *fresh])), []
                yield int(block), known, batch.slice(a, b - a)


def _among(known: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(numbers), bool)
    return known[np.minimum(np.searchsorted(known, numbers), len(known) - 1)] == numbers


DOC = ("id", "rest")
RESULT = T.StructType().add("n_words", T.LongType()).add("n_removed", T.LongType()).add("sha", T.StringType()).add("text", T.BinaryType())
# What a row is: null a result, 1 a text to look at again, 2 numbers.
SENT = T.StructType(
    [*(T.StructField(c, T.IntegerType()) for c in ("kind", "bucket", "block")), *(T.StructField(c, T.BinaryType()) for c in ("keys", "blocks", "many"))]
)


def _kept_rows(part: pa.RecordBatch, words: list[list[bytes]], kept: list[list[bytes] | None], texts: bool, schema: pa.Schema) -> pa.RecordBatch:
    """Result rows; ``kept`` is None for a text that stays as it is."""
    made = [b" ".join(w if k is None else k) for w, k in zip(words, kept)]
    text = part.column(part.schema.get_field_index("text"))
    columns = {c: part.column(part.schema.get_field_index(c)) for c in DOC}
    columns["n_words"] = pa.array([len(w) for w in words], pa.int64())
    columns["n_removed"] = pa.array([0 if k is None else len(w) - len(k) for w, k in zip(words, kept)], pa.int64())
    columns["sha"] = pa.array([hashlib.sha256(m).hexdigest() for m in made])
    columns["text"] = pa.array([(t.as_py() if k is None else m) if texts else None for t, k, m in zip(text, kept, made)], pa.binary())
    return _filled(columns, part.num_rows, schema)


def _filled(columns: dict, n: int, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _window_rows(width: int, buckets: int, texts: bool, schema: pa.Schema):
    """Results of texts without repeated anchors; the others, and their windows' numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(buckets)
        for block, known, part in _blocks(batches):
            values = part.column(part.schema.get_field_index("text"))
            split = [t.as_py().split() for t in values]
            sizes = np.array([len(w) for w in split], np.int64)
            hit = np.zeros(len(split), bool)
            if len(known) and (sizes >= width).any():
                numbers, ends = shingles.word_numbers(values, False)
                row, starts = joined(numbers, ends)
                valid = windows(starts, sizes, len(row), width)
                best = anchors(row, valid, width)[0]
                marked = np.zeros(len(row), bool)
                marked[valid] = _among(known, best[valid])
                sums = np.concatenate([[0], np.cumsum(marked)])
                hit = sums[starts + sizes] > sums[starts]
                if hit.any():
                    numbers = window_numbers(row, width)[marked]
                    sender.add(numbers, np.full(len(numbers), block, np.int64))
            calm = np.flatnonzero(~hit)
            rest = part.take(pa.array(calm))
            yield _kept_rows(rest, [split[i] for i in calm], [None] * len(calm), texts, schema)
            if hit.any():
                chosen = part.take(pa.array(np.flatnonzero(hit)))
                columns = {c: chosen.column(chosen.schema.get_field_index(c)) for c in (*DOC, "block", "text")}
                yield _filled(columns | {"kind": pa.array([1] * chosen.num_rows)}, chosen.num_rows, schema)
            for sent in sender.rows(FLUSH):
                yield _filled(dict(zip(sent.schema.names, sent.columns)) | {"kind": pa.array([2] * sent.num_rows)}, sent.num_rows, schema)
        for sent in sender.rows():
            yield _filled(dict(zip(sent.schema.names, sent.columns)) | {"kind": pa.array([2] * sent.num_rows)}, sent.num_rows, schema)

    return run


def _removed_rows(width: int, texts: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, known, part in _blocks(batches):
            values = part.column(part.schema.get_field_index("text"))
            split = [t.as_py().split() for t in values]
            sizes = np.array([len(w) for w in split], np.int64)
            numbers, ends = shingles.word_numbers(values, False)
            row, starts = joined(numbers, ends)
            valid = windows(starts, sizes, len(row), width)
            repeated = np.zeros(len(row) + width, np.int32)
            at = np.flatnonzero(valid)
            at = at[_among(known, window_numbers(row, width)[at])]
            repeated[at] += 1
            repeated[at + width] -= 1
            covered = np.cumsum(repeated) > 0
            kept: list[list[bytes] | None] = []
            for words, start in zip(split, starts):
                own = covered[start : start + len(words)]
                kept.append([w for w, c in zip(words, own.tolist()) if not c] if own.any() else None)
            yield _kept_rows(part, split, kept, texts, schema)

    return run


def remove(
    docs: DataFrame, width: int = WIDTH, texts: bool = True, carry: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: ``id, rest, n_words, n_removed, sha, text``.

    ``sha`` is the SHA-256 of the kept words joined by one space. ``text`` is the unchanged text
    if nothing was removed, else those words; it is null without ``texts``. ``rest`` has ``carry``.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    count = 2 * parts
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("int")
    text = whole_text(text_col).cast("binary")
    rows = docs.select(F.pmod(F.xxhash64(F.col(id_col), text), F.lit(count)).cast("int").alias("block"), F.col(id_col).alias("id"), rest.alias("rest"), text.alias("text"))
    sent = rows.select("block", "text").mapInArrow(_anchor_rows(width, count), KEYS)
    found = written(_answers(sent, count), "substring-anchors")
    shape = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.select("id", "rest").schema), *RESULT])
    full = T.StructType([*shape, *SENT])
    second = _by_block(rows, found, parts).mapInArrow(_window_rows(width, count, texts, to_arrow_schema(full)), full)
    second = written(second, "substring-windows")
    again = second.where("kind = 2").select("bucket", "keys", "blocks", "many")
    repeated = written(_answers(again, count), "substring-repeats")
    hit = second.where("kind = 1").select("block", "id", "rest", "text")
    third = _by_block(hit, repeated, parts).mapInArrow(_removed_rows(width, texts, to_arrow_schema(shape)), shape)
    calm = second.where("kind IS NULL").select(*shape.names)
    return calm.unionByName(third).withColumn("text", F.col("text").cast("string"))
