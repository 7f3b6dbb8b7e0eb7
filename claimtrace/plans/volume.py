"""Shipment volume: scans per hour and day, totals, the list of shipments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtrace.functions.report import dash, minute_text_half
from claimtrace.operators import filters, series
from claimtrace.operators.match import PERFECT, SHORT
from claimtrace.params import Params

# Fixed value: rows of a detail list.
PAGE = 500


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value"))


def shipments_per_hour(shipments: DataFrame, params: Params) -> DataFrame:
    """Shipments of each hour that has any."""
    return series.per_bucket(
        filters.report_shipments(shipments, params),
        "hour",
        "appointment_date",
        F.count(F.lit(1)).alias("shipments"),
    )


def total_shipments(shipments: DataFrame, params: Params) -> DataFrame:
    """Scanned packages."""
    return _count(filters.report_shipments(shipments, params))


def unique_carriers(shipments: DataFrame, params: Params) -> DataFrame:
    """Distinct carriers."""
    return filters.report_shipments(shipments, params).agg(
        F.count_distinct("scac").alias("value")
    )


def unique_orders(shipments: DataFrame, params: Params) -> DataFrame:
    """Distinct orders."""
    return filters.report_shipments(shipments, params).agg(
        F.count_distinct("order_id").alias("value")
    )


def shipments_per_day(shipments: DataFrame, params: Params) -> DataFrame:
    """Shipments of each day that has any."""
    return series.per_bucket(
        filters.report_shipments(shipments, params),
        "day",
        "appointment_date",
        F.count(F.lit(1)).alias("shipments"),
    ).withColumnRenamed("time", "day")


def shipment_details(shipments: DataFrame, params: Params, page: int = PAGE) -> DataFrame:
    """The newest shipments."""
    ties = ["sscc18", "order_id", "pro_number", "scac", "shipment_id", "order_status", "source_file"]
    newest = filters.latest(
        filters.report_shipments(shipments, params).select("appointment_date", *ties),
        "appointment_date",
        page,
        ties,
    )
    return newest.select(
        minute_text_half(F.col("appointment_date")).alias("appointment_date"),
        dash(F.col("pro_number")).alias("pro_number"),
        "sscc18",
        F.col("scac").alias("carrier"),
        "order_id",
        "shipment_id",
        dash(F.col("order_status")).alias("order_status"),
        dash(F.col("source_file")).alias("source_file"),
    )


def perfect_orders(shipments: DataFrame, params: Params) -> DataFrame:
    """Scanned packages of flawless orders."""
    chosen = filters.report_shipments(shipments, params)
    return _count(chosen.filter(F.col("order_status") == PERFECT))


def short_orders(shipments: DataFrame, params: Params) -> DataFrame:
    """Scanned packages of incomplete orders."""
    chosen = filters.report_shipments(shipments, params)
    return _count(chosen.filter(F.col("order_status") == SHORT))
