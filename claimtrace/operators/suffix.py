"""Order numbers that end with a given number: one sorted pass for all lengths.

Reversed, "ends with" becomes "begins with", and in sorted order all texts that begin with a number follow it
directly. So a pass over orders and numbers together needs no more than a stack of the numbers still open, at
most one per length. Orders and numbers are dealt by their last ``TAIL`` characters; the few numbers that are
shorter go to every ending in use that they fit. Nothing is multiplied by lengths or by hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Characters by which orders and numbers are dealt.
TAIL = 4

_FOUND = T.StructType(
    [
        T.StructField("is_number", T.BooleanType()),
        T.StructField("text", T.StringType()),
        T.StructField("by_suffix", T.BooleanType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("is_order", T.BooleanType()),
    ]
)


def _values(array: pa.Array) -> list:
    """The values of a column as something Python can compare: structs become tuples, times whole numbers."""
    kind = array.type
    if pa.types.is_struct(kind):
        return list(zip(*[_values(part) for part in array.flatten()]))
    if pa.types.is_timestamp(kind):
        array = array.cast(pa.int64())
    if pa.types.is_integer(array.type):
        return array.to_pandas(integer_object_nulls=True).tolist()
    if pa.types.is_string(kind) or pa.types.is_boolean(kind):
        return array.to_numpy(zero_copy_only=False).tolist()
    return array.to_pylist()


class _Open:
    """A number that orders to come may end with, with the latest status of it and those below it."""

    def __init__(self, turned: str, text: str, best: tuple):
        self.turned, self.text, self.best, self.rows = turned, text, best, 0


def _merged(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted orders and numbers to one row for each."""
    columns = ("tail", "turned", "text", "by_suffix", "is_order", "status", "seq", "rows")
    stack: list[_Open] = []
    out: list[tuple] = []
    here, order, numbers = None, None, []

    def close(turned: str | None) -> None:
        while stack and (turned is None or not turned.startswith(stack[-1].turned)):
            done = stack.pop()
            out.append((True, done.text, True, None, done.rows, False))
            if stack:
                stack[-1].rows += done.rows

    def finish() -> None:
        """All rows of one text have come."""
        if here is None:
            return
        if order is not None:
            best = stack[-1].best if stack else None
            for _, _, status, seq, _ in numbers:
                best = max(best, (seq, status)) if best else (seq, status)
            out.append((False, order[0], None, best[1] if best else None, order[1], None))
            if stack:
                stack[-1].rows += order[1]
        for text, by_suffix, status, seq, is_order in numbers:
            if order is not None or is_order or not by_suffix:
                out.append((True, text, by_suffix, None, order[1] if order else 0, order is not None or bool(is_order)))
            else:
                own = (seq, status)
                stack.append(_Open(here[1], text, max(stack[-1].best, own) if stack else own))

    for batch in batches:
        for tail, turned, text, by_suffix, is_order, status, seq, rows in zip(
            *[_values(batch.column(c)) for c in columns]
        ):
            if here != (tail, turned):
                finish()
                close(turned if here is not None and here[0] == tail else None)
                here, order, numbers = (tail, turned), None, []
            if by_suffix is None:
                order = (text, rows)
            else:
                numbers.append((text, by_suffix, status, seq, is_order))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
    finish()
    close(None)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def match_numbers(orders: DataFrame, numbers: DataFrame) -> DataFrame:
    """What the ``numbers`` say about the ``orders``, and which of them they meet.

    ``orders``: distinct ``order_id`` with ``rows``. ``numbers``: distinct ``order_number`` and ``by_suffix``, with ``status``,
    ``seq`` and ``is_order``, whether the number is known to equal an order that may not be among these. A number that
    equals an order says something about that order only; another one with ``by_suffix`` about all orders that end
    with it. One row per order: ``is_number`` false, ``text``, ``rows``, and as ``status`` that of the latest ``seq``, or NULL.
    One row per number: ``is_number``, ``text``, ``by_suffix``, ``rows`` of the orders it is about, and ``is_order``.
    """
    turned = F.reverse("text")
    tail = F.substring(turned, 1, TAIL)
    seq_type = numbers.schema["seq"].dataType.simpleString()
    asked = orders.filter(F.length("order_id") > 0).select(
        F.col("order_id").alias("text"), F.col("rows").cast("bigint").alias("rows")
    )
    asked = asked.select(
        tail.alias("tail"), turned.alias("turned"), "text", F.lit(None).cast("boolean").alias("by_suffix"),
        F.lit(None).cast("boolean").alias("is_order"), F.lit(None).cast("string").alias("status"),
        F.lit(None).cast(seq_type).alias("seq"), "rows",
    )
    given = numbers.filter(F.length("order_number") > 0).select(
        F.col("order_number").alias("text"), "by_suffix", "is_order", "status", "seq"
    )
    given = given.select(
        tail.alias("tail"), turned.alias("turned"), "text", "by_suffix", "is_order", "status", "seq",
        F.lit(None).cast("bigint").alias("rows"),
    )
    long = given.filter(F.length("text") >= TAIL)
    short = given.filter(F.length("text") < TAIL)
    # Every ending in use, under itself and each beginning of its reversal; no more than the alphabet allows.
    endings = asked.select("tail").distinct()
    fits = endings.select(
        "tail",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("tail")), lambda n: F.substr(F.col("tail"), F.lit(1), n))
        ).alias("turned"),
    ).filter(F.length("turned") < TAIL)
    spread = short.drop("tail").join(fits, "turned", "left")
    alike = asked.filter(F.length("text") < TAIL).select("text", F.lit(True).alias("_alike"))
    spread = spread.join(alike, "text", "left").select(
        F.coalesce("tail", "turned").alias("tail"), "turned", "text", "by_suffix",
        (F.coalesce("is_order", F.lit(False)) | F.col("_alike").isNotNull()).alias("is_order"), "status", "seq", "rows",
    )
    arrow = to_arrow_schema(_FOUND)
    both = asked.unionByName(long).unionByName(spread)
    found = both.repartition("tail").sortWithinPartitions("tail", "turned").mapInArrow(
        lambda batches: _merged(batches, arrow), _FOUND
    )
    # A short number has a row for each ending.
    per_number = found.filter("is_number").groupBy("is_number", "text", "by_suffix").agg(
        F.sum("rows").alias("rows"), F.max("is_order").alias("is_order")
    )
    return found.filter(~F.col("is_number")).unionByName(per_number, allowMissingColumns=True)
