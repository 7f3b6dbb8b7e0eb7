"""Order statuses as keyed state: the latest row per number and kind, looked up for the orders at hand.

What status an order has follows from the state alone: the latest row that names the order, or whose number
ends it and equals no order. So it does not matter in which load a status or a shipment came, only when its file
was last changed. A number that turns out to equal an order gives up the longer orders it had by suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace.operators.lookup import is_small
from claimtrace.operators.suffix import TAIL, match_numbers

# What decides which of two rows is later: the time of the file, then the place in it.
PLACE = ("file_time", "file_name", "block", "row")
_KEY = ("order_number", "by_suffix")
# Last characters by which longer numbers are looked up.
END = 8


def latest(rows: DataFrame) -> DataFrame:
    """One row per number and kind: the latest, and whether any says that the number is an order."""
    last = rows.groupBy(*_KEY).agg(
        F.max_by(F.struct("order_status", *PLACE), F.struct(*PLACE)).alias("_last"), F.max("is_order").alias("is_order")
    )
    return last.select(*_KEY, "_last.*", "is_order")


def order_counts(shipments: DataFrame) -> DataFrame:
    """Shipment rows per order."""
    named = shipments.filter(F.length("order_id") > 0)
    return named.groupBy("order_id").agg(F.count(F.lit(1)).alias("rows"))


def ending_like(shipments: DataFrame, numbers: DataFrame) -> DataFrame:
    """The shipments whose order could end with one of the ``numbers``, by its last characters.

    Only few endings are broadcast; with more, all shipments stay.
    """
    endings = numbers.select(F.right("order_number", F.lit(TAIL)).alias("_ending")).distinct()
    if not is_small(endings):
        return shipments
    kept, found = shipments, F.lit(False)
    for n in range(1, TAIL + 1):
        side = F.broadcast(endings.filter(F.length("_ending") == n).select(F.col("_ending").alias(f"_ending_{n}")))
        kept = kept.join(side, F.right(F.col("order_id"), F.lit(n)) == F.col(f"_ending_{n}"), "left")
        found = found | F.col(f"_ending_{n}").isNotNull()
    return kept.filter(found).select(*shipments.columns)


def _numbers(state: DataFrame) -> DataFrame:
    return state.select(*_KEY, "is_order", F.col("order_status").alias("status"), F.struct(*PLACE).alias("seq"))


def meet(orders: DataFrame, state: DataFrame) -> DataFrame:
    """Orders against latest status rows; see ``match_numbers``."""
    return match_numbers(orders, _numbers(state))


def touched(met: DataFrame) -> DataFrame:
    """The orders that some number is about, with its latest status: ``order_id rows status``."""
    found = met.filter(~F.col("is_number") & F.col("status").isNotNull())
    return found.select(F.col("text").alias("order_id"), "rows", "status")


def numbers_met(met: DataFrame) -> DataFrame:
    """The shipment rows each number is about, and whether it is an order."""
    return met.filter("is_number").select(F.col("text").alias("order_number"), "by_suffix", "rows", "is_order")


def near(orders: DataFrame, rows: DataFrame) -> DataFrame:
    """The latest status rows that could be about the orders, by their last characters; short numbers all stay.

    Numbers of at least ``END`` characters are told apart by so many, so what is kept, and reduced to the latest, grows
    with the orders and not with the rows.
    """

    def end(text: Column, n: int) -> Column:
        return F.when(F.length(text) >= n, F.right(text, F.lit(n)))

    ends = F.explode(F.array(end(F.col("order_id"), END), F.right("order_id", F.lit(TAIL))))
    tails = orders.select(ends.alias("_tail")).filter("_tail IS NOT NULL").distinct()
    if is_small(orders):
        tails = F.broadcast(tails)
    number = F.col("order_number")
    cut = F.coalesce(end(number, END), F.right(number, F.lit(TAIL)))
    kept = rows.filter(F.length(number) >= TAIL).join(tails, cut == F.col("_tail"), "left_semi")
    return latest(kept.unionByName(rows.filter(F.length(number) < TAIL)))


def resolve(orders: DataFrame, state: DataFrame) -> DataFrame:
    """``order_id status`` of every order by all its latest status rows (``near``); NULL without one."""
    met = meet(orders.select("order_id", F.lit(1).alias("rows")), state)
    return met.filter(~F.col("is_number")).select(F.col("text").alias("order_id"), "status")
