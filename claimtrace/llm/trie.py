"""Conversation prefix trie: nodes in tables addressed by a minimal perfect hash, one table a shard.

A node is a distinct sequence of first turns; its 128-bit digest is made from its parent's digest and its
last turn's. Conversations are dealt by id and sorted, so a task makes the chains of digests as rows
stream by. Shards are runs of ``SHARD`` rows of a task. Each shard lists its distinct digests, gives
them slots by a minimal perfect hash of several levels, and keeps the digest in its slot, so a lookup is
verified and a stranger is told from a member. Counts are scattered into flat arrays by slot; sums
over subtrees go through the array of parents' slots, deepest nodes first.

1. Each shard counts its conversations per node; Spark adds up the shards' counts by digest.
2. A node is owned by its smallest member. An owner's rows and its path to the root come into one shard,
   so each node is weighed once, where its whole path is known. Shards sum over subtrees; the
   partial sums of a node that several shards know add up by digest.

No node's members or children meet in one task: a node that all conversations share is one row of each
shard. The ids that end at a node are sorted by range over all tasks and joined to pieces of ``PIECE``
characters; only the pieces of a node meet, streamed through one SHA-256, which is sequential by nature.
A conversation longer than a shard goes through several, deepest turns first, and hands its sums on.

Nulls: null roles and texts are empty; null turns come first; rows with a null conversation id belong to
none and are left out. Rows of a conversation with equal turns are ordered by the digest of role and text, so
repeated rows are turns of their own. Very long texts enter as their digest and length. An empty table
gives no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimtrace.llm.common import U64, mix, seed, whole_text, written

SHARD = 1 << 18
PIECE = 1 << 16
HOT = 1000
ROOT, ABOVE = (0, 0), (-1, -1)
_SPARSE = 1.3  # places a level has for each key left
TURNS = "conv long, place long, turn binary, chars long"
PATHS = "conv long, depth long, hi long, lo long, above_hi long, above_lo long, chars long, last boolean"
COUNTS = "hi long, lo long, above_hi long, above_lo long, depth long, chars long, least long, convs long, ends long"
SUMS = "hi long, lo long, children long, leaves long, saved long"
_KEY = ["hi", "lo"]


class Slots:
    """A minimal perfect hash of distinct 128-bit keys, with the keys in their slots.

    On each level a key that is alone in its place stays; the others go to the next, smaller level.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        order = np.lexsort((lo, hi))
        hi, lo = hi[order], lo[order]
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        hi, lo = hi[new], lo[new]
        self.size = len(hi)
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        self._levels: list[tuple[np.ndarray, np.ndarray]] = []  # taken places, and the slot of each
        base = 0
        while len(hi):
            places = self._places(hi, lo, len(self._levels), int(len(hi) * _SPARSE) + 1)
            taken = np.bincount(places, minlength=int(len(hi) * _SPARSE) + 1) == 1
            slot = base - 1 + np.cumsum(taken)
            stays = taken[places]
            self.hi[slot[places[stays]]], self.lo[slot[places[stays]]] = hi[stays], lo[stays]
            self._levels.append((taken, slot))
            base += int(stays.sum())
            hi, lo = hi[~stays], lo[~stays]

    @staticmethod
    def _places(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = mix(mix(hi.view(U64) + seed(2 * level)) ^ (lo.view(U64) + seed(2 * level + 1)))
        return (mixed % U64(size)).astype(np.int64)

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key that is not in the table."""
        found = np.full(len(hi), -1, np.int64)
        left = np.arange(len(hi))
        for level, (taken, slot) in enumerate(self._levels):
            places = self._places(hi[left], lo[left], level, len(taken))
            here = taken[places]
            found[left[here]] = slot[places[here]]
            left = left[~here]
        same = (found >= 0) & (self.hi[found] == hi) & (self.lo[found] == lo) if self.size else found >= 0
        return np.where(same, found, -1)


def _table(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The rows of a task in runs of ``SHARD``, as arrays; nulls are 0."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, SHARD - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == SHARD:
                yield _arrays(held)
                held, rows = [], 0
    if rows:
        yield _arrays(held)


def _arrays(parts: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    table = pa.Table.from_batches(parts).combine_chunks()
    return {name: table.column(name).fill_null(0).to_numpy() for name in table.column_names if not pa.types.is_boolean(table.schema.field(name).type)} | {
        name: table.column(name).to_numpy() for name in table.column_names if pa.types.is_boolean(table.schema.field(name).type)
    }


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole conversations in order, to the chain of their nodes; each starts with a row without a turn."""
    names = [f.split()[0] for f in PATHS.split(", ")]
    held, digest, depth = None, bytes(16), 0
    for batch in batches:
        rows = []
        for conv, turn, chars in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "chars")]):
            if held is not None:
                rows.append((*held, turn is None))
            if turn is None:
                digest, depth = bytes(16), 0
                held = (conv, 0, *ROOT, *ABOVE, 0)
            else:
                above, digest, depth = digest, hashlib.blake2b(digest + turn, digest_size=16).digest(), depth + 1
                held = (conv, depth, *struct.unpack("<qq", digest), *struct.unpack("<qq", above), chars)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*held, True)], names=names)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations and ends of each node of a shard."""
    for shard in _shards(batches):
        table = Slots(shard["hi"], shard["lo"])
        at = table.find(shard["hi"], shard["lo"])
        made = {"hi": table.hi, "lo": table.lo}
        for name in ("above_hi", "above_lo", "depth", "chars"):
            made[name] = np.zeros(table.size, np.int64)
            made[name][at] = shard[name]
        made["least"] = np.full(table.size, np.iinfo(np.int64).max)
        np.minimum.at(made["least"], at, shard["conv"])
        made["convs"] = np.bincount(at, minlength=table.size)
        made["ends"] = np.bincount(at[shard["last"]], minlength=table.size)
        yield _table(made)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Children, leaves and saved tokens of the subtrees of a shard's nodes, as far as it owns them.

    Rows come by conversation, deepest first. Nodes whose parent comes only in the next shard hand
    it their sums.
    """
    rest: dict[str, np.ndarray] | None = None
    for shard in _shards(batches):
        table = Slots(shard["hi"], shard["lo"])
        at = table.find(shard["hi"], shard["lo"])
        up = np.full(table.size, -1, np.int64)
        up[at] = table.find(shard["above_hi"], shard["above_lo"])
        depth, above = np.zeros(table.size, np.int64), np.zeros((2, table.size), np.int64)
        depth[at] = shard["depth"]
        above[0, at], above[1, at] = shard["above_hi"], shard["above_lo"]
        owned = np.flatnonzero(shard["convs"])  # one row for each node, as only owners have counts
        children, leaves, saved = (np.zeros(table.size, np.int64) for _ in range(3))
        leaves[at[owned]] = shard["convs"][owned] == shard["ends"][owned]
        saved[at[owned]] = (shard["convs"][owned] - 1) * shard["chars"][owned]
        into = up[at[owned]]
        np.add.at(children, into[into >= 0], 1)
        outside = np.zeros(table.size, np.int64)  # children of a parent that comes in the next shard
        outside[at[owned[into < 0]]] = 1
        if rest is not None:
            where = table.find(rest["hi"], rest["lo"])
            for sums, name in ((children, "children"), (leaves, "leaves"), (saved, "saved")):
                np.add.at(sums, where, rest[name])
        order = np.argsort(-depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            inner = level[up[level] >= 0]
            np.add.at(leaves, up[inner], leaves[inner])
            np.add.at(saved, up[inner], saved[inner])
        cut = np.flatnonzero((up < 0) & (depth > 0))
        rest = {"hi": above[0, cut], "lo": above[1, cut], "children": outside[cut], "leaves": leaves[cut], "saved": saved[cut]}
        some = (children != 0) | (leaves != 0) | (saved != 0)
        yield _table({"hi": table.hi[some], "lo": table.lo[some], "children": children[some], "leaves": leaves[some], "saved": saved[some]})


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of nodes, to texts of some of the ids of one node, joined by commas."""
    names = ["hi", "lo", "first", "piece"]
    key, first, ids, size = None, 0, [], 0
    for batch in batches:
        rows = []
        for hi, lo, conv in zip(*[batch.column(c).to_pylist() for c in ("hi", "lo", "conv")]):
            if ids and ((hi, lo) != key or size > PIECE):
                rows.append((*key, first, ",".join(ids)))
                ids, size = [], 0
            if not ids:
                key, first = (hi, lo), conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, first, ",".join(ids))], names=names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of nodes, to the SHA-256 of all ids of each node."""
    names = ["hi", "lo", "sha"]
    key, state = None, None
    for batch in batches:
        rows = []
        for hi, lo, piece in zip(*[batch.column(c).to_pylist() for c in ("hi", "lo", "piece")]):
            if key == (hi, lo):
                state.update(b"," + piece.encode())
                continue
            if key is not None:
                rows.append((*key, state.hexdigest()))
            key, state = (hi, lo), hashlib.sha256(piece.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=names)


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, place`` (from 1), ``turn`` (digest of role and text) and ``chars`` of each turn; texts are not shuffled."""
    who, said = whole_text(f"`{role}`"), whole_text(f"`{text}`")
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256), 1, 32))
    light = rows.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("at"), digest.alias("turn"), F.length(said).cast("long").alias("chars")
    )
    order = Window.partitionBy("conv").orderBy(F.col("at").asc_nulls_first(), "turn")
    return light.select("conv", F.row_number().over(order).cast("long").alias("place"), "turn", "chars")


def shared_openings(held: DataFrame, most: int = 6, block: int = 100) -> DataFrame:
    """Conversations that take their first turns from the first of their block, as ``turns`` gives them.

    Each takes the first h turns of the conversation whose id ends its block (all if fewer, none if there is
    none) and goes on with its own after its first h; h is a hash of its id below ``most``. A conversation
    whose turns all go stays, as its row at place 0 without a turn; all have such a row.
    """

    def taken(conv: Column) -> Column:
        return F.pmod(F.crc32(conv.cast("string")), F.lit(most))

    conv = F.col("conv")
    own = held.where(F.col("place") > taken(conv)).withColumn("place", F.col("place") + most)
    starts = held.where("place = 1").select("conv")
    first = held.where((F.pmod(conv, F.lit(block)) == 0) & (F.col("place") < most))
    first = first.select(conv.alias("block"), F.col("place"), "turn", "chars")
    wanted = starts.withColumn("block", conv - F.pmod(conv, F.lit(block)))
    led = wanted.join(first, "block").where(F.col("place") <= taken(conv)).select("conv", "place", "turn", "chars")
    heads = starts.select("conv", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("chars"))
    return own.unionByName(led).unionByName(heads)


def nodes(rows: DataFrame) -> DataFrame:
    """One row per node of conversations in the form that ``shared_openings`` returns.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of its
    subtree, ``ends_sha256`` of the ids that end there.
    """
    dealt = rows.select("conv", "place", "turn", "chars").repartition("conv").sortWithinPartitions("conv", "place")
    paths = written(dealt.mapInArrow(_chained, PATHS), "trie-paths")
    counts = paths.mapInArrow(_counted, COUNTS).groupBy(*_KEY)
    same = [F.max(c).alias(c) for c in ("above_hi", "above_lo", "depth", "chars")]
    known = written(counts.agg(*same, F.min("least").alias("least"), F.sum("convs").alias("convs"), F.sum("ends").alias("ends")), "trie-counts")

    # Path rows say where a node hangs; an owner's rows also weigh.
    shape = [c for c in paths.columns if c != "last"]
    weighed = known.select(F.col("least").alias("conv"), *[c for c in known.columns if c != "least"])
    placed = paths.select(*shape).unionByName(weighed, allowMissingColumns=True)
    placed = placed.repartition("conv").sortWithinPartitions("conv", F.desc("depth"))
    sums = placed.mapInArrow(_summed, SUMS)
    zero = F.lit(0).cast("long")
    both = known.select(*_KEY, "above_hi", "above_lo", "depth", "least", "convs", "ends").unionByName(sums, allowMissingColumns=True)
    total = both.groupBy(*_KEY).agg(
        *[F.max(c).alias(c) for c in ("above_hi", "above_lo", "depth", "least", "convs", "ends")],
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("children", "leaves", "saved")],
    )
    total = written(total, "trie-nodes")

    ends = paths.where("last").select(*_KEY, "conv").repartitionByRange(*_KEY, "conv").sortWithinPartitions(*_KEY, "conv")
    pieces = ends.mapInArrow(_pieces, "hi long, lo long, first long, piece string")
    shas = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_hashed, "hi long, lo long, sha string")

    # At most HOT nodes have more than 1/HOT of all children; their own children look them up without a shuffle.
    least = (total.agg(F.sum("children")).first()[0] or 0) // HOT
    parents = total.where("children > 0").select(F.col("hi").alias("above_hi"), F.col("lo").alias("above_lo"), F.col("least").alias("parent"), "children")
    hot = F.broadcast(parents.where(F.col("children") > least).select("above_hi", "above_lo", F.col("parent").alias("near")))
    cold = parents.where(F.col("children") <= least).select("above_hi", "above_lo", "parent")
    marked = total.join(hot, ["above_hi", "above_lo"], "left")
    done = marked.where("near IS NOT NULL OR depth = 0").withColumn("parent", F.col("near"))
    done = done.unionByName(marked.where("near IS NULL AND depth > 0").join(cold, ["above_hi", "above_lo"]))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return done.join(shas, _KEY, "left").select(
        F.col("least").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("convs").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", none).alias("ends_sha256"),
    )
