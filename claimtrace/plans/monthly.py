"""Monthly claims performance: received, refutable, paid, coverage, summary texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtrace.functions.report import (
    bucket,
    grouped_number,
    money,
    month_text,
    percent,
    plain_number,
    sum_abs,
)
from claimtrace.operators import filters, match, series
from claimtrace.params import Params

# The parts of the bottom-line sentence.
BOTTOM_LINE = (
    "\U0001f4b0 Bottom Line: We paid $",
    " last month, but Kargo shows $",
    " of that was avoidable — a verified opportunity to reduce cost.",
)

_AMOUNT = "claim_amount"


def _per_month(df: DataFrame, *aggregates) -> DataFrame:
    return series.per_bucket(df, "month", "claim_date", *aggregates)


def _flagged(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    return match.with_match(filters.report_claims(claims, params), shipments, params)


def _refuted_amount():
    return F.sum(F.when(F.col("matched"), F.abs(_AMOUNT)))


def _legitimate_amount():
    return F.sum(F.when(~F.col("matched"), F.abs(_AMOUNT)))


def claims_received_monthly(claims: DataFrame, params: Params) -> DataFrame:
    """Claims per month."""
    return _per_month(
        filters.report_claims(claims, params), F.count(F.lit(1)).alias("claims_received")
    )


def would_have_paid_monthly(claims: DataFrame, params: Params) -> DataFrame:
    """Claims per month that would have been paid without validation: all of them, as a count."""
    return _per_month(
        filters.report_claims(claims, params), F.count(F.lit(1)).alias("would_have_paid")
    )


def refutable_monthly(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Refuted claims of each month that has any."""
    return _per_month(
        _flagged(shipments, claims, params).filter("matched"),
        F.count(F.lit(1)).alias("refutable_claims"),
    )


def avoidable_spend_monthly(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Money of the refuted claims of each month that has any."""
    return _per_month(
        _flagged(shipments, claims, params).filter("matched"),
        money(sum_abs(F.col(_AMOUNT))).alias("avoidable_spend"),
    )


def actually_paid_monthly(claims: DataFrame, params: Params) -> DataFrame:
    """All claimed money per month."""
    return _per_month(
        filters.report_claims(claims, params),
        money(sum_abs(F.col(_AMOUNT))).alias("actually_paid"),
    )


def paid_vs_should_have(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Legitimate and refutable money per month, whole dollars."""
    return _per_month(
        _flagged(shipments, claims, params),
        money(_legitimate_amount(), 0).alias("legitimate"),
        money(_refuted_amount(), 0).alias("refutable"),
    )


def coverage_claims_pct(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Share of claims refuted, in percent; NULL without claims."""
    counted = _flagged(shipments, claims, params).agg(
        F.count_if("matched").alias("hit"), F.count(F.lit(1)).alias("n")
    )
    return counted.select(percent(F.col("hit"), F.col("n")).alias("claims_coverage"))


def coverage_dollars_pct(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Share of money refuted, in percent; NULL without money."""
    summed = _flagged(shipments, claims, params).agg(
        F.coalesce(_refuted_amount(), F.lit(0)).alias("hit"),
        sum_abs(F.col(_AMOUNT)).alias("total"),
    )
    return summed.select(percent(F.col("hit"), F.col("total")).alias("dollars_coverage"))


def received_vs_refutable(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Claims and refuted claims per month."""
    return _per_month(
        _flagged(shipments, claims, params),
        F.count(F.lit(1)).alias("claims_received"),
        F.count_if("matched").alias("refutable"),
    )


def monthly_summary(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """One line of text per month, oldest first."""
    months = (
        _flagged(shipments, claims, params)
        .groupBy(bucket("month", F.col("claim_date")).alias("time"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            sum_abs(F.col(_AMOUNT)).alias("total"),
            F.count_if("matched").alias("hit"),
            F.coalesce(_refuted_amount(), F.lit(0)).alias("hit_total"),
            F.coalesce(_legitimate_amount(), F.lit(0)).alias("miss_total"),
        )
        .orderBy("time")
    )

    def share(part: str, total: str):
        return F.concat(
            F.lit(" ("), plain_number(percent(F.col(part), F.col(total))), F.lit("%)")
        )

    def dollars(name: str):
        return F.concat(F.lit("$"), grouped_number(F.round(F.col(name), 0)))

    return months.select(
        month_text(F.col("time")).alias("month"),
        F.col("n").alias("claims"),
        F.round("total", 0).alias("paid"),
        F.concat(F.col("hit").cast("string"), share("hit", "n")).alias("perfect_match"),
        F.concat(dollars("hit_total"), share("hit_total", "total")).alias("avoidable_spend"),
        F.concat(
            (F.col("n") - F.col("hit")).cast("string"), F.lit(" / "), dollars("miss_total")
        ).alias("unverifiable"),
    )


def _last_month(claims: DataFrame, params: Params) -> DataFrame:
    chosen = filters.business_units(filters.claim_types(claims, params), params)
    return chosen.filter(filters.month_before("claim_date", params))


def missed_claims_last_month(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Refuted claims of the previous calendar month, whatever the range."""
    refuted = match.matched_claims(_last_month(claims, params), shipments, params)
    return refuted.agg(F.count(F.lit(1)).alias("claims_to_deny"))


def missed_savings_last_month(
    shipments: DataFrame, claims: DataFrame, params: Params
) -> DataFrame:
    """Money of the refuted claims of the previous calendar month."""
    refuted = match.matched_claims(_last_month(claims, params), shipments, params)
    return refuted.agg(money(sum_abs(F.col(_AMOUNT)), 0).alias("missed_savings"))


def bottom_line_text(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """The closing sentence on the previous calendar month; NULL without claims."""
    flagged = match.with_match(_last_month(claims, params), shipments, params)
    summed = flagged.agg(
        sum_abs(F.col(_AMOUNT)).alias("paid"),
        F.coalesce(_refuted_amount(), F.lit(0)).alias("avoidable"),
    )
    start, middle, end = BOTTOM_LINE
    return summed.select(
        F.concat(
            F.lit(start),
            grouped_number(F.round("paid", 0)),
            F.lit(middle),
            grouped_number(F.round("avoidable", 0)),
            F.lit(end),
        ).alias("summary")
    )
