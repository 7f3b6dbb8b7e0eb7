"""MinHash near-dedup: fast similarity sketching, banding, exact verification, components.

Sketch. Round ``i < T`` throws every shingle into a hashed bin with the value ``i + [0, 1)``;
round ``T + j`` throws all of them into bin ``j``. A bin keeps its least value. After ``2 T`` rounds
every bin is filled, large sets fill all of them in the first few rounds, and each bin of two sets
agrees with the probability of their similarity, with concentration as if sampled without
replacement.

Candidates. ``T = BANDS * ROWS`` bins make ``BANDS`` keys. Sets as similar as the threshold 0.75
share none of them with probability (1 - 0.75 ** ROWS) ** BANDS, below 2e-7, while a passage that
many different texts share seldom fills a whole band. Three bits of each of the first ``CODED`` bins
are packed into numbers; a pair whose codes differ in more than ``APART`` bins, five standard
deviations beyond what similar sets have, is no candidate. Nor is one of too different sizes.

Links. Equal sets are one node (a 128-bit digest). In a bucket, the member that shares most buckets
stands for it, and all others are verified against it: as many pairs as members. Sets that link are
joined into components. Buckets whose members then still belong to several components can hide a
link that avoids the representative, so members outside a bucket's largest component are verified
against its members of other components. Sizes and codes are compared inside the join, so only
plausible pairs leave it, and a bucket's members meet ``INNER`` at a time, so a large family just below the threshold is
spread over tasks; a large component is compared with its neighbours in tiles instead. No cap applies anywhere. Verification counts common shingles on full sets.

Nulls: a null or blank text has an empty set, links with nothing and is its own component; a null
id is never a component's name unless all its members' are. Rows with equal ids are linked by their
texts like any others; rows equal in id and set get equal results. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimtrace.llm import shingles
from claimtrace.llm.common import U64, mix, seed, slices, whole_text, written

ROWS = 6
BANDS = 80
BINS = ROWS * BANDS
CODED = 448  # bins whose codes are compared, a multiple of 64
APART = 141  # mean 98 and deviation 8.7 at a similarity of 0.75
PLANES = [f"c{i}" for i in range(3 * CODED // 64)]
LARGE = 256  # nodes of a component that others are verified against in tiles
OUTER, INNER = 256, 1024  # nodes on the sides of a tile
_LOW = U64(0xFFFFFFFF)
SLICE = 1 << 21


def sketch(elements: np.ndarray, ends: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The sketches of non-empty sets: a row of bins each, round and value in one number."""
    sizes = np.diff(np.concatenate([[0], ends]))
    owner = np.repeat(np.arange(len(ends)), sizes)
    made = np.full((len(ends), bins), np.iinfo(U64).max, U64)
    flat = made.reshape(-1)
    for turn in range(2 * bins):
        value = mix(elements + seed(turn))
        if turn < bins:
            place = (value >> U64(32)) * U64(bins) >> U64(32)
        else:
            place = np.full(len(value), turn - bins, U64)
        np.minimum.at(flat, owner * bins + place.astype(np.int64), (U64(turn) << U64(32)) | (value & _LOW))
        full = (made != np.iinfo(U64).max).all(axis=1)
        if turn % 8 < 3 or turn >= bins:  # sets whose bins are all filled take no further part
            stay = ~full[owner]
            elements, owner = elements[stay], owner[stay]
            if not len(elements):
                break
    return made


def bands(made: np.ndarray) -> np.ndarray:
    """The key of each band, different for each."""
    parts = made.reshape(len(made), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=U64)), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key * U64(3) + mix(parts[:, :, i]))
    return key


def codes(made: np.ndarray) -> np.ndarray:
    """Three bits of each of the first bins: three planes of ``CODED`` bits as numbers."""
    part = mix(made[:, :CODED] + seed(500))
    planes = [((part >> U64(p)) & U64(1)).astype(np.uint8) for p in range(3)]
    return np.concatenate([np.packbits(p, axis=1, bitorder="little").view("<u8") for p in planes], axis=1)


def _apart(other: str) -> Column:
    """In how many coded bins the sketches of two columns' structs differ."""
    size = CODED // 64
    total = F.lit(0)
    for i in range(size):
        differ = [F.col(f"codes.{PLANES[p * size + i]}").bitwiseXOR(F.col(f"{other}.{PLANES[p * size + i]}")) for p in range(3)]
        total = total + F.bit_count(differ[0].bitwiseOR(differ[1]).bitwiseOR(differ[2]))
    return total


def _digests(elements: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """A 128-bit digest of each set; none for an empty one."""
    raw, at = memoryview(elements.view(np.uint8)), (8 * offsets.astype(np.int64)).tolist()
    return [hashlib.blake2b(raw[a:b], digest_size=16).digest() if b > a else None for a, b in zip(at, at[1:])]


def _sketched(width: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            elements, ends = shingles.sets(batch.column("text"), width)
            sizes = np.diff(np.concatenate([[0], ends])).astype(np.int64)
            digests = _digests(elements, np.concatenate([[0], ends]))
            filled = sizes > 0
            made = sketch(elements, ends[filled]) if filled.any() else np.zeros((0, BINS), U64)
            keys, packed = bands(made).view(np.int64), np.zeros((len(sizes), len(PLANES)), np.int64)
            packed[filled] = codes(made).view(np.int64)
            coded = pa.StructArray.from_arrays([pa.array(packed[:, i]) for i in range(len(PLANES))], PLANES)
            offsets = np.concatenate([[0], np.cumsum(np.where(filled, BANDS, 0))]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))
            kept = [batch.column(c).cast(schema.field(c).type) for c in batch.schema.names if c != "text"]
            made = [pa.array(sizes), pa.array(digests, pa.binary()), coded, listed]
            yield pa.RecordBatch.from_arrays([*kept, *made], schema=schema)

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            elements, ends = shingles.sets(batch.column(0), width)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(elements.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(_digests(elements, offsets), pa.binary()), listed], ["node", "members"])

    return run


def _verified(pairs: DataFrame, full: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are as similar as the threshold, in percent."""
    left = full.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = full.select(F.col("node").alias("b"), F.col("members").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(100 * common >= threshold * (F.size("x") + F.size("y") - common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node, root``: each linked node's least connected node, by repeated star contraction.

    A large star points a node's larger neighbours to its least one, a small star its smaller
    ones; both only ever move links closer to the least node, and end when nothing moves.
    """
    edges = written(links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(), "near-links")
    while True:
        both = edges.union(edges.select("root", "node"))
        least = both.groupBy("node").agg(F.min("root").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = large.where("node <> root").distinct()
        small = large.groupBy("node").agg(F.min("root").alias("least"))
        moved = large.join(small, "node").select(F.col("root").alias("node"), F.col("least").alias("root")).where("node <> root")
        after = written(moved.union(small.select("node", "least")).distinct(), "near-links")
        state = [d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first() for d in (edges, after)]
        edges = after
        if state[0] == state[1]:
            return edges


def _size_close(threshold: int) -> str:
    return f"100 * least(n, n2) >= {threshold} * greatest(n, n2)"


def _tile_links(threshold: int):
    """Of one tile, for each outer set the first member it is as similar to as the threshold."""

    def run(table: pa.Table) -> pa.Table:
        outer = table.column("outer").to_numpy(zero_copy_only=False)
        coded = np.column_stack([table.column(c).to_numpy() for c in PLANES]).view(U64).reshape(len(outer), 3, -1)
        sets = [np.asarray(m.values).view(U64) for m in table.column("members")]
        sizes, nodes = np.array([len(x) for x in sets]), table.column("node")
        inner, found = np.flatnonzero(~outer), []
        for i in np.flatnonzero(outer):
            differ = coded[inner] ^ coded[i]
            apart = np.bitwise_count(differ[:, 0] | differ[:, 1] | differ[:, 2]).sum(axis=1, dtype=np.int64)
            close = 100 * np.minimum(sizes[inner], sizes[i]) >= threshold * np.maximum(sizes[inner], sizes[i])
            for j in inner[(apart <= APART) & close][np.argsort(apart[(apart <= APART) & close], kind="stable")]:
                common = int((sets[i][np.minimum(np.searchsorted(sets[i], sets[j]), sizes[i] - 1)] == sets[j]).sum())
                if 100 * common >= threshold * (sizes[i] + sizes[j] - common):
                    found.append(sorted((nodes[int(i)].as_py(), nodes[int(j)].as_py())))
                    break
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})

    return run


def _against_large(open_: DataFrame, large: DataFrame, roots: DataFrame, small: DataFrame, full: DataFrame, threshold: int) -> DataFrame:
    """Links of nodes with a large component that they share a bucket with but are not in.

    Such a node is verified against the whole component, in tiles of bounded size, so what moves is
    each set once for each tile, not once for each pair or bucket.
    """
    own = large.select(F.col("root").alias("target"))
    holds = open_.join(large, "root", "left_semi").select("key", F.col("root").alias("target")).distinct()
    outer = open_.select("key", "node", "root").join(holds, "key").where("root <> target")
    both_large = own.withColumnRenamed("target", "root").withColumn("is_large", F.lit(True))
    outer = outer.join(both_large, "root", "left").where("is_large IS NULL OR root < target").select("node", "target").distinct()
    whole = roots.join(large, "root", "left_semi").select("node", F.col("root").alias("target"))
    whole = whole.unionByName(own.select(F.col("target").alias("node"), "target"))
    outer, whole = written(outer, "near-outer"), written(whole, "near-whole")
    rows = outer.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / OUTER).cast("long").alias("rows"))
    columns = whole.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / INNER).cast("long").alias("columns"))
    tiles = rows.join(columns, "target")
    h = F.xxhash64("node")
    a = outer.join(tiles, "target").select(
        "node", "target", F.pmod(h, "rows").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)).alias("j"), F.lit(True).alias("outer")
    )
    b = whole.join(tiles, "target").select(
        "node", "target", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("i"), F.pmod(h, "columns").alias("j"), F.lit(False).alias("outer")
    )
    coded = small.select("node", *[f"codes.{c}" for c in PLANES])
    dealt = a.unionByName(b).join(coded, "node").join(full, "node")
    return dealt.groupBy("target", "i", "j").applyInArrow(_tile_links(threshold), "a binary, b binary")


def label(
    docs: DataFrame, width: int = 5, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: ``id, n_shingles, component_id, kept``."""
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    rows, by_node = _by_component(texts, width, threshold)
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("name"))
    return rows.select("id", "n", "node").join(by_node, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def representatives(
    docs: DataFrame, width: int = 5, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows without near copies, whole: of each component one row, and all rows without words.

    It is the row with the least id, null ids last; of rows with that id, the one whose text has the least digest,
    and of repeated ones the one whose other columns sort last. Rows are known by id and text, so a row
    that shares its id with a near copy stays.
    """
    text = whole_text(f"`{text_col}`")
    keyed = docs.withColumns({"_id": F.col(f"`{id_col}`"), "_sha": F.unhex(F.sha2(text, 256))})
    blank = F.trim(text, F.lit(" \t\n\x0b\x0c\r")) == ""
    worded = keyed.where(~blank)
    texts = worded.select(F.col("_id").alias("id"), F.col("_sha").alias("sha"), text.cast("binary").alias("text"))
    rows, by_node = _by_component(texts, width, threshold)
    found = rows.select("id", "sha", "node").join(by_node.select("node", "root"), "node")
    least = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "sha")).alias("row"))
    winners = written(least.select(F.col("row.id").alias("id"), F.col("row.sha").alias("sha")), "near-winners")
    same = worded["_id"].eqNullSafe(winners["id"]) & (worded["_sha"] == winners["sha"])
    kept = worded.join(winners, same, "left_semi")
    again = rows.groupBy("id", "sha").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    if again.limit(1).count():  # repeated rows: one of them
        whole = F.struct(*[F.col(f"`{c}`") for c in keyed.columns])
        kept = kept.groupBy("_id", "_sha").agg(F.max(whole).alias("row")).select("row.*")
    return kept.unionByName(keyed.where(blank)).drop("_id", "_sha")


def _by_component(texts: DataFrame, width: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``texts`` with their ``node`` in place of the text; each node's ``root`` and ``name``."""
    carried = [f for f in texts.schema.fields if f.name != "text"]
    planes = T.StructType([T.StructField(c, T.LongType()) for c in PLANES])
    made = [("n", T.LongType()), ("node", T.BinaryType()), ("codes", planes), ("bands", T.ArrayType(T.LongType()))]
    schema = T.StructType([*carried, *(T.StructField(n, t) for n, t in made)])
    rows = written(texts.mapInArrow(_sketched(width, to_arrow_schema(schema)), schema), "near-sketches")
    nodes = rows.where("n > 0").groupBy("node").agg(
        F.min("id").alias("least"), F.first("n").alias("n"), F.first("codes").alias("codes"), F.first("bands").alias("bands")
    )
    nodes = written(nodes, "near-nodes")
    members = nodes.select(F.explode("bands").alias("key"), "node")
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = written(members.join(shared, "key"), "near-buckets")
    small = nodes.select("node", "n", "codes").join(buckets.groupBy("node").agg(F.sum("size").alias("degree")), "node")
    small = written(small, "near-shared")  # the nodes that share a bucket
    heads = buckets.join(small.select("node", "degree"), "node").groupBy("key")
    heads = heads.agg(F.max(F.struct("degree", "node")).alias("head")).select("key", F.col("head.node").alias("node2"))
    pair = (F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))
    pairs = buckets.join(heads, "key").where("node <> node2").select(*pair).distinct()
    other = small.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("codes").alias("codes2"))
    pairs = pairs.join(small.withColumnRenamed("node", "a"), "a").join(other, "b")
    pairs = written(pairs.where(_size_close(threshold)).where(_apart("codes2") <= APART).select("a", "b"), "near-pairs")
    # The full sets of all nodes that share a bucket, made again from their least document's text.
    wanted = nodes.join(small.select("node"), "node", "left_semi").select(F.col("least").alias("wanted")).distinct()
    chosen = texts.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    full = written(chosen.mapInArrow(_full_sets(width), "node binary, members array<long>"), "near-sets")
    links = written(_verified(pairs, full, threshold), "near-verified")
    roots = components(links)
    # Members of one bucket in several components: verified across them.
    named = buckets.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    named = written(named, "near-named")
    groups = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    mixed = groups.groupBy("key").agg(
        F.count(F.lit(1)).alias("roots"), F.max(F.struct("size", "root")).alias("main"), F.sum("size").alias("members")
    )
    tiles = F.ceil(F.col("members") / INNER).cast("int").alias("tiles")
    mixed = mixed.where("roots > 1").select("key", F.col("main.root").alias("main"), tiles)
    # Similar sets have sizes of the same or neighbouring classes.
    step = F.floor(F.log(F.col("n")) / math.log(100 / threshold)).cast("int")
    open_ = named.join(mixed, "key").join(small.select("node", "n", "codes", step.alias("step")), "node")
    open_ = written(open_, "near-open")
    large = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= LARGE).select("root")
    large = written(large, "near-large")
    far = open_.join(large, "root", "left_anti").select(
        "key", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)).alias("step"),
        F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile"),
        *[F.col(c).alias(f"{c}2") for c in ("node", "root", "n", "codes")],
    )
    once = (F.col("root") != F.col("root2")) & ((F.col("root2") == F.col("main")) | (F.col("root") < F.col("root2")))
    likely = once & F.expr(_size_close(threshold)) & (_apart("codes2") <= APART)
    apart = open_.where("root <> main").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    meet = (apart["key"] == far["key"]) & (apart["step"] == far["step"]) & (apart["tile"] == far["tile"])
    near_by = apart.join(far, meet & likely)
    rest = written(near_by.select(*pair).distinct(), "near-pairs")
    more = _verified(rest, full, threshold).unionByName(_against_large(open_, large, roots, small, full, threshold))
    more = written(more, "near-verified")
    if more.limit(1).count():
        roots = components(links.union(more))
    named = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("name"))
    return rows, named.select("node", "root").join(names, "root").select("node", "root", "name")
