"""Exact dedup by skew-safe combining.

A text shared by a third of all rows is one group, so groups are combined in three steps, and
each step groups on the whole text, not on its digest alone:

1. local: rows of one digest, salt and text are reduced where they are read (the partial step of
   the aggregate), so a task sends one row for a text and salt, however often it saw it;
2. salted: the rest of a (digest, salt, text) meets in one task;
3. global: the winners of the salts of a text meet.

The salt is a hash of the id, so a repeated task deals its rows alike. ``groups`` salts the digests
that hold more than one in ``HOT`` of the rows, ``HOT`` of them at most; the winners of the others
are already global. ``survivors`` salts all.

Nulls: a null text counts as empty; null ids lose against all others. Repeated rows (equal id
and text) are all counted in the group, and one of them is kept. An empty table gives an empty
result. Columns of any other name pass through ``survivors`` and are ignored by ``groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimtrace.llm.common import whole_text, written

SALTS = 64
HOT = 1000


def _salt(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id, keep_id, group_size, kept, text_sha256``; the largest id stays.

    Rows look their text's winner up by digest; only if one digest had several texts would they
    have to carry them, and then these rows do.
    """
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"))
    counts = written(counts, "exact-counts")
    least = (counts.agg(F.sum("rows")).first()[0] or 0) // HOT
    hot = F.broadcast(counts.where(F.col("rows") > least).where("rows > 1").select("digest", F.lit(True).alias("hot")).limit(HOT))
    rows = rows.join(hot, "digest", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    rows = rows.withColumn("salt", F.when(F.col("hot"), _salt("id")).otherwise(0))
    salted = rows.groupBy("digest", "salt", "text", "hot").agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n"))
    salted = salted.withColumn("text", F.when(F.col("hot"), F.col("text")))
    salted = written(salted, "exact-salted")
    across = salted.where("hot").groupBy("digest", "text").agg(F.max("best").alias("keep"), F.sum("n").alias("size"))
    across = across.select("digest", "keep", "size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    winners = salted.where("NOT hot").select("digest", F.col("best").alias("keep"), F.col("n").alias("size"), "salt").unionByName(across)
    winners = written(winners, "exact-winners")
    clashing = winners.groupBy("digest", "salt").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest").distinct()
    light = rows.select("id", "digest", "salt")
    if clashing.limit(1).count():
        odd = rows.join(clashing, "digest", "left_semi").select("id", "digest", "text")
        whole = odd.groupBy("digest", "text").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size"))
        found = odd.join(whole, ["digest", "text"]).select("id", "digest", "keep", "size")
        light = light.join(clashing, "digest", "left_anti")
    else:
        found = None
    plain = light.join(winners, ["digest", "salt"]).select("id", "digest", "keep", "size")
    found = plain if found is None else plain.unionByName(found)
    twin = Window.partitionBy("digest", "id").orderBy("keep")
    return found.withColumn("twin", F.row_number().over(twin)).select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep")) & (F.col("twin") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the largest id of each text, whole, by the same three steps.

    Rows equal in id and text leave the one whose other columns sort last.
    """
    names = docs.columns
    others = [c for c in names if c not in (id_col, text_col)]
    rest = F.struct(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").isNotNull().alias("given"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    text = whole_text(text_col)
    rows = docs.select(text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"), _salt(id_col).alias("salt"), rest.alias("rest"))
    salted = rows.groupBy("digest", "salt", "text").agg(F.max("rest").alias("rest"))
    winners = salted.groupBy("digest", "text").agg(F.max("rest").alias("rest"))
    made = {id_col: F.col("rest.id"), text_col: F.when(F.col("rest.given"), F.col("text"))}
    made |= {c: F.col(f"rest.c{i}") for i, c in enumerate(others)}
    return winners.select(*[made[c].alias(c) for c in names])
