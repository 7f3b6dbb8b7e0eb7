"""What a dashboard does to a returned report: last value, change, footer, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lower bounds of the bands.
DAYS_BANDS = ((90, "green"), (50, "light green"), (30, "orange"))
COVERAGE_BANDS = ((80, "green"), (60, "orange"))
LOWEST_BAND = "red"


def last_not_null(series: DataFrame, value: str, order: str = "time") -> DataFrame:
    """The latest value that is not NULL, as one row."""
    return series.filter(F.col(value).isNotNull()).agg(F.max_by(value, order).alias("value"))


def percent_change(series: DataFrame, value: str, order: str = "time") -> DataFrame:
    """The series with ``change_pct`` against the point before; NULL at the first point.

    The window has no partition; a series has one row per bucket.
    """
    before = F.lag(F.col(value).cast("double")).over(Window.orderBy(order))
    return series.withColumn(
        "change_pct", F.try_divide(F.col(value).cast("double") - before, before) * 100
    )


def footer(table: DataFrame, value: str | None = None) -> DataFrame:
    """Row count of a shown table and, with ``value``, the sum of that column."""
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    if value is not None:
        aggregates.append(F.sum(value).alias("total"))
    return table.agg(*aggregates)


def band(value: Column, bands: tuple[tuple[int, str], ...]) -> Column:
    """Name of the band a number falls into; NULL counts as lowest."""
    chain = F.when(value >= bands[0][0], F.lit(bands[0][1]))
    for bound, name in bands[1:]:
        chain = chain.when(value >= bound, F.lit(name))
    return chain.otherwise(F.lit(LOWEST_BAND))


def no_value(value: Column, shown: str = "0") -> Column:
    """NULL shown as ``shown``, other values as text."""
    return F.coalesce(value.cast("string"), F.lit(shown))
