"""Parameter filters and list queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace.functions.report import contains_text, day
from claimtrace.params import Params


def time_range(df: DataFrame, column: str, params: Params) -> DataFrame:
    """Rows within the report range, both ends included."""
    return df.filter(F.col(column).between(F.lit(params.time_from), F.lit(params.time_to)))


def one_of(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows whose column is in ``values``; ``None`` keeps every row, NULLs too."""
    if values is None:
        return df
    return df.filter(F.col(column).isin(*values))


def carriers(df: DataFrame, params: Params) -> DataFrame:
    """Shipments of the chosen carriers."""
    return one_of(df, "scac", params.carriers)


def claim_types(df: DataFrame, params: Params) -> DataFrame:
    """Claims of the chosen types."""
    return one_of(df, "claim_type", params.claim_types)


def business_units(df: DataFrame, params: Params) -> DataFrame:
    """Claims of the chosen business units."""
    return one_of(df, "business_unit_code", params.business_units)


def containing(df: DataFrame, params: Params) -> DataFrame:
    """Rows whose order number and package code hold the searched text."""
    if params.order_contains:
        df = df.filter(contains_text(F.col("order_id"), params.order_contains))
    if params.sscc_contains:
        df = df.filter(contains_text(F.col("sscc18"), params.sscc_contains))
    return df


def report_shipments(shipments: DataFrame, params: Params) -> DataFrame:
    """Shipments of the report range and carriers."""
    return carriers(time_range(shipments, "appointment_date", params), params)


def report_claims(claims: DataFrame, params: Params, units: bool = True) -> DataFrame:
    """Claims of the report range, types and, if ``units``, business units."""
    chosen = claim_types(time_range(claims, "claim_date", params), params)
    return business_units(chosen, params) if units else chosen


def month_before(column: str, params: Params) -> Column:
    """Condition: within the calendar month before the month of ``as_of``."""
    return (F.col(column) >= F.lit(params.previous_month_start)) & (
        F.col(column) < F.lit(params.month_start)
    )


def at_least(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Rows whose magnitude reaches the threshold."""
    return df.filter(F.abs(F.col(column)) >= F.lit(threshold))


def before_cutover(df: DataFrame, column: str, params: Params) -> DataFrame:
    """Rows before the cutover day."""
    return df.filter(F.col(column) < F.lit(params.cutover))


def from_cutover(df: DataFrame, column: str, params: Params) -> DataFrame:
    """Rows from the cutover day on."""
    return df.filter(F.col(column) >= F.lit(params.cutover))


def distinct_carriers(shipments: DataFrame) -> DataFrame:
    """Carrier codes in order."""
    return shipments.filter(F.col("scac").isNotNull()).select("scac").distinct().orderBy("scac")


def distinct_claim_types(claims: DataFrame) -> DataFrame:
    """Claim types in order, without the missing-PRO kind."""
    # Fixed value: the pattern of the kind left out.
    left_out = F.col("claim_type").ilike("%missing%pro%")
    return (
        claims.filter(F.col("claim_type").isNotNull() & ~left_out)
        .select("claim_type")
        .distinct()
        .orderBy("claim_type")
    )


def with_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """The same report with display names for its columns."""
    return df.select(*[F.col(c).alias(labels.get(c, c)) for c in df.columns])


def latest(df: DataFrame, column: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The ``n`` newest rows; ``ties`` makes the order total."""
    return df.orderBy(F.col(column).desc(), *[F.col(c).asc_nulls_first() for c in ties]).limit(n)


def as_day(df: DataFrame, column: str) -> DataFrame:
    """The frame with ``day``, the calendar day of ``column``."""
    return df.withColumn("day", day(F.col(column)))
