"""Sharding by longest processing time: whole groups of equal texts, shards of near equal bytes.

A heap holds the load of each shard; the groups, largest first, go to the least loaded one. The
heap runs on the driver, so its list is bounded: a group of at least 1/``FINE`` of a shard is an
entry of its own (there are at most ``shards * FINE`` of these, as their sizes add up to the
total), and smaller groups are entries together, in bundles chosen by a hash of their digest.
Bundles come in ``LEVELS`` sizes, each level holding an eighth of what the one above holds; the
last, smallest bundles level the loads out. A table with few groups is thus dealt group by group.

Nulls: a null text has size 16 and is a group of its own, apart from empty texts; null ids come
first in the slots. Repeated rows take a slot each. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimtrace.llm.common import written

FINE = 128
LEVELS = 4
BUNDLES = 32  # of each level, for each shard
BLOCKS = 64  # of each shard, for numbering its rows


def lpt(entries: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Each entry's shard: largest first, to the least loaded shard, lowest number on a tie."""
    heap = [(0, shard) for shard in range(shards)]
    place = {}
    for size, entry in sorted(entries, key=lambda e: (-e[0], str(e[1]))):
        load, shard = heap[0]
        place[entry] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return place


def _bundle(digest: Column, shards: int) -> Column:
    """The bundle of a small group: a level by three bits of its hash a time, then a number."""
    h = F.xxhash64(digest)
    level = F.lit(LEVELS - 1)
    for i in reversed(range(LEVELS - 1)):
        level = F.when(F.shiftrightunsigned(h, 3 * i).bitwiseAND(7) != 0, F.lit(i)).otherwise(level)
    return level * (shards * BUNDLES) + F.pmod(F.xxhash64(digest, F.lit(1)), F.lit(shards * BUNDLES))


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id, size, text_crc32, shard, slot``; equal texts share a shard."""
    spark: SparkSession = docs.sparkSession
    raw = F.encode(F.col(text_col).cast("string"), "utf-8")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.length(raw), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(raw, F.lit(b""))).alias("crc"),
        F.coalesce(F.sha2(raw, 256), F.lit("null")).alias("digest"),
    )
    rows = written(rows, "shard-rows")
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    least = max(1, total // (shards * FINE))
    large = [(r.bytes, r.digest) for r in groups.where(F.col("bytes") > least).collect()]
    small = groups.where(F.col("bytes") <= least).groupBy(_bundle(F.col("digest"), shards).alias("bundle"))
    bundles = [(r.bytes, r.bundle) for r in small.agg(F.sum("bytes").alias("bytes")).collect()]
    place = lpt(large + bundles, shards)
    # Both tables are bounded: shards * FINE large groups, shards * BUNDLES * LEVELS bundles.
    own = spark.createDataFrame([(d, place[d]) for _, d in large], "digest string, own int")
    shared = spark.createDataFrame([(b, place[b]) for _, b in bundles], "bundle long, theirs int")
    placed = (
        rows.join(F.broadcast(own), "digest", "left")
        .withColumn("bundle", F.when(F.col("own").isNull(), _bundle(F.col("digest"), shards)).cast("long"))
        .join(F.broadcast(shared), "bundle", "left")
        .select("id", "size", "crc", F.coalesce("own", "theirs").alias("shard"))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(BLOCKS)).cast("int"))
    )
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))  # shards * BLOCKS rows
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy(F.asc_nulls_first("id"), "crc", "size")
    return placed.withColumn("at", F.row_number().over(inside)).join(F.broadcast(starts), ["shard", "block"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("start") + F.col("at") - 1).alias("slot")
    )
