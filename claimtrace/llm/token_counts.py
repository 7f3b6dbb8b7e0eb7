"""Exact token counts: a histogram of encoded lengths, and sums from its end.

Tasks count their documents by length before anything is shuffled; what is shuffled, and all
that follows, has one row per length. With ``docs_at_least`` and ``tokens_at_least``, the counts
and tokens of the documents of a length or more, every question about a context limit has an
exact answer: totals, quantiles, and the total if all documents were cut at the limit.

Nulls: a null text counts as empty, length 0. Repeated rows count each. An empty table gives an
empty histogram. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimtrace.llm import tokens
from claimtrace.llm.common import whole_text, written

SPAN = 1024  # lengths summed by one window


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.words(path)
        for batch in batches:
            if batch.num_rows:
                length, n = np.unique([len(known.ids(t.as_py())) // 4 for t in batch.column(0)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array(n, pa.int64())], ["length", "docs"])

    return run


def histogram(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``length, docs``: how many whole texts encode to each number of tokens; written, as sums read it twice."""
    rows = docs.select(whole_text(text_col).cast("binary").alias("text"))
    counted = rows.mapInArrow(_counts(path), "length long, docs long")
    return written(counted.groupBy("length").agg(F.sum("docs").alias("docs")), "token-histogram")


def suffix_sums(hist: DataFrame) -> DataFrame:
    """The histogram with sums from each length up, and what follows from them.

    ``truncated_tokens`` is the total if texts were cut at the length; ``share`` is the part of the
    documents of at most that length. Sums run inside spans of lengths and over the spans, so no
    task holds more than one span, or one row for each.
    """
    rows = hist.withColumns({"tokens": F.col("length") * F.col("docs"), "span": F.floor(F.col("length") / SPAN)})
    up = Window.partitionBy("span").orderBy(F.desc("length"))
    inside = rows.withColumns({"docs_up": F.sum("docs").over(up), "tokens_up": F.sum("tokens").over(up)})
    spans = rows.groupBy("span").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select(
        "span",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(every).alias("total_docs"),
        F.sum("t").over(every).alias("total_tokens"),
    )
    at_least, tokens_at_least = F.col("docs_up") + F.col("docs_above"), F.col("tokens_up") + F.col("tokens_above")
    return inside.join(spans, "span").select(
        "length",
        "docs",
        "tokens",
        at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
        (F.col("total_tokens") - tokens_at_least + F.col("length") * at_least).alias("truncated_tokens"),
        ((F.col("total_docs") - at_least + F.col("docs")) / F.col("total_docs")).alias("share"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``limit, docs_longer, truncated_tokens`` for context limits; beyond all lengths, the total."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(x,) for x in sorted(set(limits))], "limit long")
    after = sums.where(F.col("length") > F.lit(min(limits))).select("length", "docs_at_least", "tokens_at_least")
    next_up = after.join(F.broadcast(asked), F.col("length") > F.col("limit")).groupBy("limit")
    next_up = next_up.agg(F.min_by(F.struct("docs_at_least", "tokens_at_least"), "length").alias("up"))
    total = sums.agg(F.max("total_tokens").alias("total"))
    return asked.join(next_up, "limit", "left").join(F.broadcast(total)).select(
        "limit",
        F.coalesce("up.docs_at_least", F.lit(0)).alias("docs_longer"),
        (F.coalesce("total", F.lit(0)) - F.coalesce("up.tokens_at_least", F.lit(0)) + F.col("limit") * F.coalesce("up.docs_at_least", F.lit(0))).alias("truncated_tokens"),
    )


def quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least the share ``q`` of the documents does not exceed."""
    return sums.where(F.col("share") >= q).agg(F.min("length")).first()[0]
