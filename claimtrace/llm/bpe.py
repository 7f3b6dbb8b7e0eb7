"""Byte-level BPE encoding with higher-order functions over distinct words, and decoding.

A vocabulary file gives each token's bytes and rank; the rank is the id. In a word, the adjacent
tokens whose joined bytes have the lowest rank are merged, the leftmost first, until no joined
bytes have a rank.

The fold's state is the word's token ids. A turn looks up the rank of each neighbouring pair and
merges the best. The literal map from pairs to ranks is hashed without collisions: one array
shifts the pairs of a remainder, the other has, at the shifted place, the pair and its rank.

A turn of that fold reads the whole word, so words beyond ``LONG`` bytes are folded as strings of
one character per token, where a turn merges a pair at all its places, leftmost first, with
``replace``. That equals merging one at a time unless the new token makes a pair of a lower rank;
then, and only then, the first place alone is merged. The turns are thus as many as there are
different merges, not places.

Each distinct word is folded once for all tasks. A task reads its rows in portions of at most
``PORTION`` bytes of text (or one text), numbers the portion's words, frequent ones first, and writes its texts as
numbers and its words by buckets of their hashes. The task of a bucket finds the words that differ, folds them, and
answers each portion with the tokens of its own, in its order. The texts as numbers are written once, bucketed by
portion, and meet the answers there without a shuffle. Numbers move as packed bytes, so a word costs a few bytes, not a row. A bucket holds a word
at most once from each portion, and memory is bounded by a portion or a bucket. Decoding joins the tokens' bytes, once for
each word of a portion.

Nulls: a null text counts as empty and has no tokens; null ids pass through. Repeated rows are
encoded each. An empty table gives no rows. Words of any length are folded whole. Other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimtrace.llm.common import shared_folder, shuffle_partitions, whole_text, written

PORTION = 14 << 20
MOST_TEXTS, MOST_NUMBERS = 1000, 1 << 18  # of a row of texts: what ends it
LONG = 48
NONE = 1 << 30  # the rank of what has none
_BITS = 17  # of a token id
_GROUPS, _PLACES = 65_537, 393_241  # primes: groups of pairs that are shifted alike, and places
_FIRST = 0x100  # the character of token 0
_GAP = 0xD800  # fixed value: the first code point that is no character
_GAP_SIZE = 0x800


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _character(token: int) -> str:
    code = token + _FIRST
    return chr(code if code < _GAP else code + _GAP_SIZE)


def _hashed(pairs: dict[int, int]) -> tuple[list[int], list[int]]:
    """Shifts and places such that each pair has a place of its own."""
    groups: dict[int, list[int]] = {}
    for key in pairs:
        groups.setdefault(key % _GROUPS, []).append(key)
    shifts, places = [0] * _GROUPS, [-1] * _PLACES
    for group, keys in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
        shift = 0
        while any(places[(key + shift) % _PLACES] >= 0 for key in keys):
            shift += 1 + shift % 1021
        shifts[group] = shift
        for key in keys:
            places[(key + shift) % _PLACES] = (key << _BITS) + pairs[key]
    return shifts, places


class Vocabulary:
    """The ranks as literals for the folds."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >> _BITS:
            raise ValueError(f"token ids must be below {1 << _BITS}")
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values()) + 1)
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            self.pieces[rank] = token
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[(a << _BITS) + b] = rank
        self._shifts, self._places = map(json.dumps, _hashed(pairs))
        self._signs = json.dumps([_character(i) for i in range(len(self.pieces))])
        self._bytes = json.dumps([ranks[bytes([b])] for b in range(256)])

    def encoded(self, word: Column) -> Column:
        """The word as a string of token characters."""
        shifts, places = F.from_json(F.lit(self._shifts), "array<int>"), F.from_json(F.lit(self._places), "array<long>")
        signs, singles = F.from_json(F.lit(self._signs), "array<string>"), F.from_json(F.lit(self._bytes), "array<long>")

        def place(key: Column) -> Column:
            return F.get(places, ((key + F.get(shifts, key % _GROUPS)) % _PLACES).cast("int")) - key * (1 << _BITS)

        def ranks(ids: Column) -> Column:
            """The rank of each token with the next; at places of other pairs the difference is none."""
            keys = F.zip_with(ids, F.slice(ids, 2, F.size(ids)), lambda a, b: a * (1 << _BITS) + b)
            return F.transform(F.transform(keys, place), lambda r: F.when((r >= 0) & (r < 1 << _BITS), r))

        def let(value: Column, use: Callable[[Column], Column]) -> Column:
            return F.get(F.transform(F.array(value), use), F.lit(0))

        def turn(old: Column) -> Column:
            ids = old["ids"]

            def merged(at: Column, low: Column) -> Column:
                return F.concat(F.slice(ids, 1, at - 1), F.array(low), F.slice(ids, at + 2, F.size(ids)))

            def chosen(found: Column, low: Column) -> Column:
                new = let(F.array_position(found, low).cast("int"), lambda at: merged(at, low))
                return F.struct(F.when(low.isNull(), ids).otherwise(new).alias("ids"), low.isNotNull().alias("live"))

            return let(ranks(ids), lambda found: let(F.array_min(found), lambda low: chosen(found, low)))

        def long_turn(old: Column) -> Column:
            known, low, pair = old["rank"] >= 0, old["rank"], old["pair"]
            new = F.get(signs, low.cast("int"))
            everywhere = F.when(known, F.replace(old["tokens"], pair, new)).otherwise(old["tokens"])
            before = F.call_function("substring_index", old["tokens"], pair, F.lit(1))
            alone = F.concat(before, new, F.substr(old["tokens"], F.length(before) + 3))

            def chosen(tokens: Column, one: Column, found: Column) -> Column:
                best = F.coalesce(F.array_min(found), F.lit(NONE).cast("long"))
                at = F.array_position(found, best).cast("int")
                # The new token and the old pair's first would have been neighbours meanwhile.
                between = F.coalesce(F.get(ranks(F.array(low, _token(F.ascii(pair)).cast("long"))), F.lit(0)), F.lit(NONE))
                again = F.struct(alone.alias("tokens"), F.lit(-1).cast("long").alias("rank"), F.lit("").alias("pair"))
                on = F.struct(tokens.alias("tokens"), best.alias("rank"), F.concat(F.get(one, at - 1), F.get(one, at)).alias("pair"))
                return F.when(known & ((best < low) | (between < low)), again).otherwise(on)

            def split(tokens: Column) -> Column:
                return let(F.split(tokens, ""), lambda one: let(ranks(F.transform(one, lambda x: _token(F.ascii(x)).cast("long"))), lambda found: chosen(tokens, one, found)))

            return let(everywhere, split)

        raw = F.split(F.decode(F.encode(word, "utf-8"), "iso-8859-1"), "")
        ids = F.transform(raw, lambda x: F.get(singles, F.ascii(x)))
        turns = F.sequence(F.lit(1), F.octet_length(word))
        short = F.aggregate(turns, F.struct(ids.alias("ids"), F.lit(True).alias("live")), lambda s, _: F.when(s["live"], turn(s)).otherwise(s), lambda s: s["ids"])
        short = F.array_join(F.transform(short, lambda x: F.get(signs, x.cast("int"))), "")
        tokens = F.array_join(F.transform(ids, lambda x: F.get(signs, x.cast("int"))), "")
        start = F.struct(tokens.alias("tokens"), F.lit(-1).cast("long").alias("rank"), F.lit("").alias("pair"))
        turns = F.sequence(F.lit(0), F.lit(2) * F.octet_length(word))
        long = F.aggregate(turns, start, lambda s, _: F.when(s["rank"] < NONE, long_turn(s)).otherwise(s), lambda s: s["tokens"])
        return F.when(F.octet_length(word) == 0, "").when(F.octet_length(word) <= LONG, short).otherwise(long)


def _token(code: Column) -> Column:
    """The token id of a character's code point."""
    return F.when(code < _GAP, code - _FIRST).otherwise(code - _FIRST - _GAP_SIZE)


# The characters that the pattern's classes of white space mean.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def exact_pattern(pattern: str) -> regex.Pattern:
    """The splitting pattern with its classes of white space written out."""
    for short, long in ((r"[^\s", f"[^{WHITE}"), (r"\S", f"[^{WHITE}]"), (r"\s", f"[{WHITE}]")):
        pattern = pattern.replace(short, long)
    return regex.compile(pattern)


class _Chunks(dict):
    """The number of each chunk; new ones are numbered by the portion."""

    def __init__(self, number: Callable[[bytes], int]):
        super().__init__()
        self._number = number

    def __missing__(self, raw: bytes) -> int:
        found = self[raw] = self._number(raw)
        return found


class _Portion:
    """Texts as numbers of their chunks, chunks as numbers of their words.

    A chunk ends before a space that follows something else than white space; no match of the
    pattern crosses such a place.
    """

    _CHUNK = regex.compile(f"(?<=[^{WHITE}])(?= )")
    _ENDS = regex.compile(f"[{WHITE}]$")

    def __init__(self, pattern: regex.Pattern):
        self.pattern, self.bytes = pattern, 0
        self.words: dict[str, int] = {}
        self.chunks = _Chunks(self._chunk)
        self.lists: list[tuple[int, ...]] = []
        self.open: set[int] = set()  # chunks that may go on after the next space
        self.texts: list[tuple] = []

    def _chunk(self, raw: bytes) -> int:
        number, text = len(self.lists), raw.decode("utf-8", "replace")
        if not text or self._ENDS.search(text) is not None:
            self.open.add(number)
        self.lists.append(tuple([self.words.setdefault(w, len(self.words)) for w in self.pattern.findall(text)]))
        return number

    def add(self, key, raw: bytes) -> None:
        self.bytes += len(raw)
        if not raw:
            self.texts.append((key, b""))
            return
        first, *rest = raw.split(b" ")
        numbers = [self.chunks[first]] if first else []
        numbers += map(self.chunks.__getitem__, [b" " + r for r in rest])
        if raw.startswith(b" ") or not self.open.isdisjoint(numbers[:-1]):
            numbers = [self.chunks[c.encode()] for c in self._CHUNK.split(raw.decode("utf-8", "replace"))]
        self.texts.append((key, np.array(numbers, np.int32).tobytes()))

    def _slices(self, flat: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """Some texts at a time: their keys, how many words each has, and the words' numbers."""
        starts = np.cumsum(sizes) - sizes
        keys, parts, n = [], [], 0
        for at, (key, data) in enumerate(self.texts, 1):
            keys.append(key)
            parts.append(np.frombuffer(data, np.int32))
            n += len(parts[-1])
            if n >= MOST_NUMBERS or len(keys) >= MOST_TEXTS or at == len(self.texts):
                chunks = np.concatenate(parts)
                many = np.concatenate([[0], np.cumsum(sizes[chunks])])
                counts = np.diff(many[np.cumsum([0, *map(len, parts)])])
                yield keys, counts, flat[_ranges(starts[chunks], sizes[chunks])]
                keys, parts, n = [], [], 0

    def rows(self, schema: pa.Schema, portion: int, buckets: int) -> Iterator[pa.RecordBatch]:
        """The words by bucket, then the bucket of each word, then the texts; empties the portion."""
        self.chunks.clear()
        sizes = np.fromiter(map(len, self.lists), np.int64, len(self.lists))
        flat = np.fromiter((w for x in self.lists for w in x), np.int32, int(sizes.sum()))
        self.lists, words = [], [w.encode() for w in self.words]
        self.words = {}
        uses = np.zeros(len(words), np.int64)
        for _, _, numbers in self._slices(flat, sizes):
            uses += np.bincount(numbers, minlength=len(uses))
        order = np.argsort(-uses, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        words = [words[i] for i in order.tolist()]
        bucket = np.array([zlib.crc32(w) % buckets for w in words], np.int32)
        row = {"portion": pa.array([portion], pa.int64())}
        by = np.argsort(bucket, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1) if len(by) else []:
            own = [words[i] for i in part.tolist()]
            sent = row | {"kind": pa.array([0], pa.int32()), "bucket": pa.array([bucket[part[0]]], pa.int32())}
            yield _columns(schema, 1, **sent, lens=_binary(np.array([len(w) for w in own])), data=pa.array([_squeezed(b"".join(own))], pa.binary()))
        yield _columns(schema, 1, **row, kind=pa.array([1], pa.int32()), data=_binary(bucket))
        for keys, counts, numbers in self._slices(flat, sizes):
            listed = pa.array([keys], schema.field("ids").type)
            yield _columns(schema, 1, **row, kind=pa.array([2], pa.int32()), ids=listed, lens=_binary(counts), data=_binary(rank[numbers]))
        self.__init__(self.pattern)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _squeezed(raw: bytes) -> bytes:
    """The bytes compressed, after their number."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _whole(squeezed: bytes) -> bytes:
    return pa.decompress(squeezed[8:], int.from_bytes(squeezed[:8], "little"), codec="zstd", asbytes=True)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, their lowest bytes first, compressed."""
    return _squeezed(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(squeezed: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(_whole(squeezed), np.uint8).reshape(4, -1).T.tobytes(), "<u4").astype(np.int64)


def _binary(numbers: np.ndarray) -> pa.Array:
    return pa.array([_packed(numbers)], pa.binary())


def _columns(schema: pa.Schema, n: int, **given: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([given.get(f.name, None) if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema)


def _portions(pattern: str, buckets: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        portion, number = _Portion(exact_pattern(pattern)), TaskContext.get().partitionId() << 32
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                portion.add(key, text.as_py())
                if portion.bytes >= PORTION:
                    yield from portion.rows(schema, number, buckets)
                    number += 1
        if portion.texts:
            yield from portion.rows(schema, number, buckets)

    return run


BUCKET = "bucket int, lens binary, data binary, portions array<long>, asked array<binary>"


def _merged(table: pa.Table) -> pa.Table:
    """A row for one bucket: the words that differ, and for each portion which of them it has."""
    words: dict[bytes, int] = {}
    asked: list[bytes] = []
    for lens, data in zip(table.column("lens"), table.column("data")):
        raw, ends = _whole(data.as_py()), np.cumsum(_unpacked(lens.as_py())).tolist()
        asked.append(_packed(np.array([words.setdefault(raw[a:b], len(words)) for a, b in zip([0, *ends], ends)])))
    made = {"bucket": table.column("bucket")[:1], "lens": _binary(np.array([len(w) for w in words])), "data": pa.array([_squeezed(b"".join(words))], pa.binary())}
    return pa.table(made | {"portions": pa.array([table.column("portion").to_pylist()], pa.list_(pa.int64())), "asked": pa.array([asked], pa.list_(pa.binary()))})


def _distinct(schema: pa.Schema):
    """Of each bucket the words, then what each portion asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, lens, data, portions, asked in zip(*batch.columns):
                raw, ends = _whole(data.as_py()), [0, *np.cumsum(_unpacked(lens.as_py())).tolist()]
                for i in range(0, len(ends) - 1, 20_000):
                    cuts = ends[i : i + 20_001]
                    part = pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()).cast(pa.string())
                    yield _columns(schema, len(part), kind=pa.array(np.zeros(len(part), np.int32)), word=part)
                n = len(portions)
                yield _columns(
                    schema, n, kind=pa.array([1] * n, pa.int32()), portion=portions.values.cast(pa.int64()),
                    bucket=pa.array([bucket.as_py()] * n, pa.int32()), data=asked.values.cast(pa.binary()),
                )

    return run


ANSWERS = T.StructType([T.StructField("portion", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("lens", T.BinaryType()), T.StructField("data", T.BinaryType())])


def _answered(schema: pa.Schema):
    """For each portion and bucket, how many tokens its words have, and the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, codes, fresh = [], [], True
        for batch in batches:
            kinds = batch.column(0).to_numpy()
            for a, b in _runs(kinds):
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    if fresh:
                        sizes, codes, fresh = [], [], False
                    tokens = part.column(1).to_pylist()
                    sizes.append(np.fromiter(map(len, tokens), np.int64, len(tokens)))
                    signs = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32)
                    codes.append(signs - np.uint32(_FIRST) - np.where(signs >= _GAP, np.uint32(_GAP_SIZE), np.uint32(0)))
                    continue
                if not fresh:
                    many, ids, fresh = np.concatenate(sizes), np.concatenate(codes), True
                    starts = np.cumsum(many) - many
                for portion, bucket, data in zip(*(part.column(c) for c in (2, 3, 4))):
                    numbers = _unpacked(data.as_py())
                    lens = many[numbers]
                    yield _columns(
                        schema, 1, portion=pa.array([portion.as_py()], pa.int64()), bucket=pa.array([bucket.as_py()], pa.int32()),
                        lens=_binary(lens), data=_binary(ids[_ranges(starts[numbers], lens)]),
                    )

    return run


def _runs(kinds: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(kinds[1:] != kinds[:-1]) + 1).tolist(), len(kinds)] if len(kinds) else []
    return zip(cuts, cuts[1:])


def _put_together(pieces: list[bytes], schema: pa.Schema):
    """The texts of one portion, from the answers to it."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        found = answers.take(pa.array(order))
        lens, codes = ([_unpacked(x.as_py()) for x in found.column(c)] for c in ("lens", "data"))
        kinds = texts.column("kind").to_numpy()
        words = texts.column("data")[int(np.flatnonzero(kinds == 1)[0])].as_py()
        ids, raws = _words(np.argsort(_unpacked(words), kind="stable"), lens, codes, pieces)
        made = []
        for i in np.flatnonzero(kinds == 2).tolist():
            listed, counts, data = (texts.column(c)[i] for c in ("ids", "lens", "data"))
            made.append(_digests(listed.values, _unpacked(counts.as_py()), _unpacked(data.as_py()).tolist(), ids, raws, schema))
        return pa.Table.from_batches(made, schema)

    return run


def _words(order: np.ndarray, lens: list[np.ndarray], codes: list[np.ndarray], pieces: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """The ids and the decoded bytes of a portion's words, which the answers hold in the given order."""
    if not len(order):
        return [], []
    many, tokens = np.concatenate(lens), np.concatenate(codes)
    if len(many) != len(order):
        raise RuntimeError("the answers are not those of the portion's words")
    sizes = np.empty(len(order), np.int64)
    starts = np.empty(len(order), np.int64)
    sizes[order], starts[order] = many, np.cumsum(many) - many
    tokens = tokens[_ranges(starts, sizes)]
    flat, ends = tokens.astype("<u4").tobytes(), [0, *np.cumsum(sizes).tolist()]
    ids = [flat[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]
    raws: list[bytes] = []
    for i in range(0, len(ids), 20_000):
        cuts = ends[i : i + 20_001]
        shown = [pieces[t] for t in tokens[cuts[0] : cuts[-1]].tolist()]
        raws += [b"".join(shown[a - cuts[0] : b - cuts[0]]) for a, b in zip(cuts, cuts[1:])]
    return ids, raws


def _digests(keys: pa.Array, counts: np.ndarray, numbers: list[int], word_ids: list[bytes], word_raws: list[bytes], schema: pa.Schema) -> pa.RecordBatch:
    rows = []
    ends = np.cumsum(counts).tolist()
    for a, b in zip([0, *ends], ends):
        own = numbers[a:b]
        rows.append((b"".join([word_ids[n] for n in own]), b"".join([word_raws[n] for n in own])))
    columns = [
        keys.cast(schema.field(0).type),
        pa.array([len(i) // 4 for i, _ in rows], pa.int64()),
        pa.array([hashlib.sha256(i).hexdigest() for i, _ in rows]),
        pa.array([hashlib.sha256(d).hexdigest() for _, d in rows]),
    ]
    if len(schema) > 4:
        columns += [pa.array([i for i, _ in rows], pa.binary()), pa.array([d for _, d in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _written(portions: DataFrame, parts: int) -> DataFrame:
    """The portions in the shared folder, bucketed, so that their texts meet the answers without being shuffled.

    The table's name is only needed to read its files as buckets; the files stay when it goes.
    """
    spark, name = portions.sparkSession, f"bpe_portions_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    portions.write.format("parquet").bucketBy(parts, "portion").option("path", path).saveAsTable(name)
    made = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return made


def round_trip(
    docs: DataFrame, path: str, pattern: str, outputs: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: ``id, n_tokens, ids_sha256, decoded_sha256`` and, with ``outputs``, ``ids, decoded``.

    ``ids`` are little-endian unsigned 32-bit numbers one after the other; ``decoded`` is made from
    them.
    """
    vocabulary = Vocabulary(read_ranks(path))
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    key = rows.schema["id"].dataType
    shape = T.StructType().add("portion", T.LongType()).add("kind", T.IntegerType()).add("bucket", T.IntegerType())
    shape = shape.add("ids", T.ArrayType(key)).add("lens", T.BinaryType()).add("data", T.BinaryType())
    portions = _written(rows.mapInArrow(_portions(pattern, parts, to_arrow_schema(shape)), shape), parts)
    words = portions.where("kind = 0").select(*ANSWERS.names).groupBy("bucket").applyInArrow(_merged, BUCKET)
    middle = T.StructType().add("kind", T.IntegerType()).add("word", T.StringType()).add("portion", T.LongType()).add("bucket", T.IntegerType()).add("data", T.BinaryType())
    # The folds' tables are literals: in a query without a shuffle their plan is told once.
    differ = written(words, "bpe-words").mapInArrow(_distinct(to_arrow_schema(middle)), middle)
    folded = differ.select("kind", F.when(F.col("kind") == 0, vocabulary.encoded(F.col("word"))).alias("tokens"), "portion", "bucket", "data")
    answers = written(folded.mapInArrow(_answered(to_arrow_schema(ANSWERS)), ANSWERS), "bpe-answers")
    made = T.StructType().add("id", key).add("n_tokens", T.LongType()).add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())
    if outputs:
        made = made.add("ids", T.BinaryType()).add("decoded", T.BinaryType())
    both = portions.where("kind > 0").groupBy("portion").cogroup(answers.groupBy("portion"))
    return both.applyInArrow(_put_together(vocabulary.pieces, to_arrow_schema(made)), made).withColumnRenamed("id", id_col)
