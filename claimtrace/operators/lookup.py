"""Attach looked-up values to rows without overloading one task.

A plain join sends all rows of one key to one task, and all rows without a key
too. Here the keys in use are counted first, with a partial count before the
shuffle. Keys that hold at least ``hot_rows`` rows are broadcast: there are at
most (key uses / hot_rows) of them, so with the default a table of 10^11 rows
yields no more than about 10^5. The other keys go through an ordinary join, in
which rows with a hot key or no key are spread by a hash of ``spread_by``
columns. The spread does not depend on row order or on a random number, so a
task that is run again after a lost executor sends its rows the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
SMALL_ROWS = 200_000
SPREAD = 4096


def is_small(df: DataFrame) -> bool:
    """Whether a frame has at most ``SMALL_ROWS`` rows; counts no further than that."""
    return df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def attach(
    rows: DataFrame,
    wanted: Mapping[str, Column],
    lookup: DataFrame,
    key: str,
    value: str,
    spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS,
    small: bool = False,
) -> DataFrame:
    """``rows`` plus one column per entry of ``wanted``.

    The column holds ``lookup``'s ``value`` under the wanted text key, or NULL.
    ``key`` must be unique in ``lookup``. With ``small``, the caller has checked that
    ``lookup`` is small: it is broadcast and no row is shuffled.
    """
    if small:
        return _attach_small(rows, wanted, lookup, key, value)
    slots = {name: f"_key_{i}" for i, name in enumerate(wanted)}
    keyed = rows.withColumns({slots[name]: column for name, column in wanted.items()})

    used = (
        keyed.select(F.explode(F.array(*slots.values())).alias("_used"))
        .filter(F.col("_used").isNotNull())
        .groupBy("_used")
        .agg(F.count(F.lit(1)).alias("_uses"))
    )
    found = lookup.select(F.col(key).alias("_found"), F.col(value).alias("_value"))
    resolved = used.join(found, F.col("_used") == F.col("_found"), "left")
    hot = resolved.filter(F.col("_uses") >= hot_rows).select("_used", "_value")
    cold = resolved.filter((F.col("_uses") < hot_rows) & F.col("_found").isNotNull()).select(
        "_used", "_value"
    )

    spread = F.concat(
        F.lit("s"), F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("string")
    )
    for name, slot in slots.items():
        hot_side = F.broadcast(
            hot.select(F.col("_used").alias("_hot"), F.col("_value").alias("_hot_value"))
        )
        cold_side = cold.select(
            F.concat(F.lit("k"), F.col("_used")).alias("_cold"),
            F.col("_value").alias("_cold_value"),
        )
        keyed = (
            keyed.join(hot_side, F.col(slot) == F.col("_hot"), "left")
            .withColumn(
                "_route",
                F.when(F.col(slot).isNull() | F.col("_hot").isNotNull(), spread).otherwise(
                    F.concat(F.lit("k"), F.col(slot))
                ),
            )
            .join(cold_side, F.col("_route") == F.col("_cold"), "left")
            .withColumn(name, F.coalesce("_hot_value", "_cold_value"))
            .drop("_hot", "_hot_value", "_route", "_cold", "_cold_value")
        )
    return keyed.drop(*slots.values())


def _attach_small(
    rows: DataFrame, wanted: Mapping[str, Column], lookup: DataFrame, key: str, value: str
) -> DataFrame:
    for name, column in wanted.items():
        side = F.broadcast(lookup.select(F.col(key).alias("_found"), F.col(value).alias(name)))
        rows = (
            rows.withColumn("_wanted", column)
            .join(side, F.col("_wanted") == F.col("_found"), "left")
            .drop("_wanted", "_found")
        )
    return rows
