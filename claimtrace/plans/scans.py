"""Barcode validation: claims against scans by day, before and after the cutover, logs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtrace.functions.report import (
    dash,
    day,
    day_text,
    grouped_number,
    minute_text,
    percent,
    plain_number,
    ratio,
    sum_abs,
)
from claimtrace.operators import filters, match, series
from claimtrace.params import Params
from claimtrace.plans.volume import PAGE

# Texts of the claim log.
VALID = "✓ Valid"
NOT_SCANNED = "✗ Not Scanned"


def total_claim_amount(claims: DataFrame, params: Params) -> DataFrame:
    """Claimed money; NULL over no claims."""
    return filters.report_claims(claims, params, units=False).agg(
        sum_abs(F.col("claim_amount")).alias("value")
    )


def total_claim_count(claims: DataFrame, params: Params) -> DataFrame:
    """Claims."""
    return filters.report_claims(claims, params, units=False).agg(
        F.count(F.lit(1)).alias("value")
    )


def claims_per_1000_scans(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Claims per thousand scans over the range; NULL without scans."""
    return series.ratio_of_counts(
        filters.report_claims(claims, params, units=False),
        filters.report_shipments(shipments, params),
        1000,
        1,
    )


def _days(params: Params, early: int = 0):
    return params.time_from.date() - timedelta(days=early), params.time_to.date()


def daily_scans_spine(shipments: DataFrame, params: Params) -> DataFrame:
    """Scans of every day of the range, 0 where there are none."""
    first, last = _days(params)
    spine = series.calendar(shipments.sparkSession, first, last)
    scans = series.daily_scans(shipments, params, first, last)
    return (
        series.on_calendar(spine, scans, ["scans"])
        .select(F.col("day").cast("timestamp_ntz").alias("time"), F.col("scans").alias("daily_scans"))
        .orderBy("time")
    )


def _averaged(daily: DataFrame, value: str, name: str, params: Params, warm_up: bool) -> DataFrame:
    """Adds the moving average.

    The reports cut the series to the range first, so the first six days average
    fewer rows. ``warm_up`` lets the six days before the range count.
    """
    inside = F.col("day") >= F.lit(params.time_from.date())
    if warm_up:
        return daily.withColumn(name, series.moving_average(value)).filter(inside)
    daily = daily.filter(inside)
    return daily.withColumn(name, series.moving_average(value))


def daily_claims_moving_avg(
    claims: DataFrame, params: Params, warm_up: bool = False
) -> DataFrame:
    """Money and count of claims of every day, with the moving average of the money."""
    first, last = _days(params, series.ROWS_BEFORE if warm_up else 0)
    spine = series.calendar(claims.sparkSession, first, last)
    facts = series.daily_claims(claims, params, first, last)
    daily = series.on_calendar(spine, facts, ["claims_amount", "claim_count"])
    return (
        _averaged(daily, "claims_amount", "moving_avg_7", params, warm_up)
        .select(
            F.col("day").cast("timestamp_ntz").alias("time"),
            "claims_amount",
            "moving_avg_7",
            "claim_count",
        )
        .orderBy("time")
    )


def daily_claims_per_1000(
    shipments: DataFrame, claims: DataFrame, params: Params, warm_up: bool = False
) -> DataFrame:
    """Claims per thousand scans of every day, with its moving average.

    Each side is counted per day before the join, so nothing is multiplied.
    """
    first, last = _days(params, series.ROWS_BEFORE if warm_up else 0)
    spine = series.calendar(claims.sparkSession, first, last)
    with_scans = series.on_calendar(
        spine, series.daily_scans(shipments, params, first, last), ["scans"]
    )
    both = series.on_calendar(
        with_scans,
        series.daily_claims(claims, params, first, last).select("day", "claim_count"),
        ["claim_count"],
    )
    daily = both.withColumn(
        "claims_per_1000",
        F.coalesce(ratio(F.col("claim_count"), F.col("scans"), 1000, 1), F.lit(0)),
    )
    return (
        _averaged(daily, "claims_per_1000", "avg_ratio_7", params, warm_up)
        .select(
            F.col("day").cast("timestamp_ntz").alias("time"), "claims_per_1000", "avg_ratio_7"
        )
        .orderBy("time")
    )


def days_since_large_claim(claims: DataFrame, params: Params) -> DataFrame:
    """Days from the last large claim to ``as_of``, whatever the range."""
    large = filters.at_least(
        filters.claim_types(claims, params), "claim_amount", params.threshold
    )
    return large.agg(
        F.datediff(F.lit(params.as_of), F.max(day(F.col("claim_date")))).alias("value")
    )


def _claims_days(claims: DataFrame) -> DataFrame:
    # One row per day first: no distinct over all claims, and few rows to shuffle.
    daily = claims.groupBy(day(F.col("claim_date")).alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = daily.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("day").alias("days")
    )
    return totals.select(
        F.concat(
            grouped_number(F.col("n")), F.lit(" / "), F.col("days").cast("string"), F.lit(" Days")
        ).alias("claims_days")
    )


def before_claims_days(claims: DataFrame, params: Params) -> DataFrame:
    """``claims / days`` before the cutover."""
    chosen = filters.claim_types(claims, params)
    return _claims_days(filters.before_cutover(chosen, "claim_date", params))


def after_claims_days(claims: DataFrame, params: Params) -> DataFrame:
    """``claims / days`` from the cutover on."""
    chosen = filters.claim_types(claims, params)
    return _claims_days(filters.from_cutover(chosen, "claim_date", params))


def _large_share(claims: DataFrame, params: Params) -> DataFrame:
    counted = claims.agg(
        F.count_if(F.abs("claim_amount") >= F.lit(params.threshold)).alias("large"),
        F.count(F.lit(1)).alias("n"),
    )
    return counted.select(
        F.concat(
            F.col("large").cast("string"),
            F.lit(" / "),
            plain_number(percent(F.col("large"), F.col("n"), 1), 1),
            F.lit("%"),
        ).alias("large_share")
    )


def before_large_share(claims: DataFrame, params: Params) -> DataFrame:
    """``large claims / share`` before the cutover; NULL without claims."""
    chosen = filters.claim_types(claims, params)
    return _large_share(filters.before_cutover(chosen, "claim_date", params), params)


def after_large_share(claims: DataFrame, params: Params) -> DataFrame:
    """``large claims / share`` from the cutover on; NULL without claims."""
    chosen = filters.claim_types(claims, params)
    return _large_share(filters.from_cutover(chosen, "claim_date", params), params)


def claim_log(
    shipments: DataFrame, claims: DataFrame, params: Params, page: int = PAGE
) -> DataFrame:
    """The newest claims and whether any scan matches, whatever carrier and status."""
    chosen = filters.containing(filters.report_claims(claims, params, units=False), params)
    newest = filters.latest(
        chosen.select("claim_date", "order_id", "sscc18"), "claim_date", page, ["order_id", "sscc18"]
    )
    flagged = match.with_match_few(newest, shipments)
    ordered = filters.latest(flagged, "claim_date", page, ["order_id", "sscc18"])
    return ordered.select(
        day_text(F.col("claim_date")).alias("claim_date"),
        "order_id",
        "sscc18",
        F.when(F.col("matched"), F.lit(VALID)).otherwise(F.lit(NOT_SCANNED)).alias(
            "validation_status"
        ),
    )


def scan_log(shipments: DataFrame, params: Params, page: int = PAGE) -> DataFrame:
    """The newest scans."""
    ties = ["order_id", "sscc18", "scac", "pro_number", "order_status"]
    chosen = filters.containing(filters.report_shipments(shipments, params), params)
    newest = filters.latest(chosen.select("appointment_date", *ties), "appointment_date", page, ties)
    return newest.select(
        minute_text(F.col("appointment_date")).alias("timestamp"),
        "order_id",
        "sscc18",
        F.col("scac").alias("carrier"),
        "pro_number",
        dash(F.col("order_status")).alias("order_status"),
    )
