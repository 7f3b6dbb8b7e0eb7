"""Order and claims summary: month over month, weekly volumes, verified claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace.functions.report import customer_name, money, percent, sum_abs
from claimtrace.operators import filters, match, series
from claimtrace.params import Params


def _earlier(column: str, params: Params) -> Column:
    """From the start of the range to the start of the current month."""
    return (F.col(column) >= F.lit(params.time_from)) & (
        F.col(column) < F.lit(params.month_start)
    )


def _whole(column: str, params: Params) -> Column:
    return F.col(column).between(F.lit(params.time_from), F.lit(params.time_to))


def _two_points(one_row: DataFrame, name: str, params: Params) -> DataFrame:
    """Columns ``earlier`` and ``whole`` of a one-row frame as two dated rows."""
    points = F.array(
        F.struct(
            F.lit(params.previous_month_start).cast("timestamp_ntz").alias("time"),
            F.col("earlier").alias(name),
        ),
        F.struct(
            F.lit(params.month_start).cast("timestamp_ntz").alias("time"),
            F.col("whole").alias(name),
        ),
    )
    return one_row.select(F.inline(points)).orderBy("time")


def _marked(df: DataFrame, column: str, params: Params) -> DataFrame:
    """Rows of either point, with a flag for each."""
    earlier, whole = _earlier(column, params), _whole(column, params)
    return df.filter(earlier | whole).withColumns({"_earlier": earlier, "_whole": whole})


def orders_shipped_mom(shipments: DataFrame, params: Params) -> DataFrame:
    """Distinct orders up to this month and over the whole range."""
    marked = _marked(filters.carriers(shipments, params), "appointment_date", params)
    # One row per order first: a single shuffle serves both distinct counts.
    orders = (
        marked.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.max("_earlier").alias("_earlier"), F.max("_whole").alias("_whole"))
    )
    counted = orders.agg(
        F.count_if("_earlier").alias("earlier"), F.count_if("_whole").alias("whole")
    )
    return _two_points(counted, "orders_shipped", params)


def _marked_claims(claims: DataFrame, params: Params) -> DataFrame:
    chosen = filters.business_units(filters.claim_types(claims, params), params)
    return _marked(chosen, "claim_date", params)


def claims_submitted_mom(claims: DataFrame, params: Params) -> DataFrame:
    """Claims up to this month and over the whole range."""
    counted = _marked_claims(claims, params).agg(
        F.count_if("_earlier").alias("earlier"), F.count_if("_whole").alias("whole")
    )
    return _two_points(counted, "claims_submitted", params)


def verified_shortages_mom(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Claims refuted by a Perfect shipment, up to this month and over the whole range."""
    verified = match.matched_claims(_marked_claims(claims, params), shipments, params)
    counted = verified.agg(
        F.count_if("_earlier").alias("earlier"), F.count_if("_whole").alias("whole")
    )
    return _two_points(counted, "verified_shortages", params)


def saved_mom(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Money of the verified claims, up to this month and over the whole range."""
    verified = match.matched_claims(_marked_claims(claims, params), shipments, params)
    amount = F.abs("claim_amount")
    summed = verified.agg(
        money(F.sum(F.when(F.col("_earlier"), amount))).alias("earlier"),
        money(F.sum(F.when(F.col("_whole"), amount))).alias("whole"),
    )
    return _two_points(summed, "saved", params)


def weekly_orders_vs_claims(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Distinct orders and claims per week; a week of either kind appears."""
    orders = series.per_bucket(
        filters.report_shipments(shipments, params),
        "week",
        "appointment_date",
        F.count_distinct("order_id").alias("orders_shipped"),
    )
    submitted = series.per_bucket(
        filters.report_claims(claims, params),
        "week",
        "claim_date",
        F.count(F.lit(1)).alias("claims_submitted"),
    )
    return series.full_join_buckets(orders, submitted, ["orders_shipped", "claims_submitted"])


def verified_invalid_by_customer(
    shipments: DataFrame, claims: DataFrame, params: Params, top: int = 7
) -> DataFrame:
    """Scanned and unscanned claims of the customers with most claims, any order status."""
    flagged = match.with_match(
        filters.report_claims(claims, params), shipments, params, status=None
    )
    customer = customer_name(F.col("ship_to_name"), F.col("address_name"))
    return (
        flagged.groupBy(customer.alias("customer"))
        .agg(
            F.count(F.lit(1)).alias("_claims"),
            F.count_if("matched").alias("verified"),
            F.count_if(~F.col("matched")).alias("invalid"),
        )
        .orderBy(F.col("_claims").desc(), "customer")
        .limit(top)
        .drop("_claims")
    )


def verified_claims(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Claims of the report refuted by a Perfect shipment."""
    return match.matched_claims(filters.report_claims(claims, params), shipments, params)


def saved_total(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Money of the verified claims; 0 when there are none."""
    return verified_claims(shipments, claims, params).agg(
        money(sum_abs(F.col("claim_amount"))).alias("saved")
    )


def verified_shortage_details(
    shipments: DataFrame, claims: DataFrame, params: Params
) -> DataFrame:
    """The verified claims, largest first."""
    return (
        verified_claims(shipments, claims, params)
        .select(
            customer_name(F.col("ship_to_name"), F.col("address_name")).alias("customer"),
            F.col("order_id").alias("order_number"),
            F.round(F.abs("claim_amount"), 2).alias("shortage"),
        )
        .orderBy(F.col("shortage").desc(), "customer", "order_number")
    )


def claim_shortage_rate(shipments: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Claims and verified shortages per hundred orders, by week; NULL in a week without orders."""
    orders = series.per_bucket(
        filters.report_shipments(shipments, params),
        "week",
        "appointment_date",
        F.count_distinct("order_id").alias("orders"),
    )
    submitted = series.per_bucket(
        match.with_match(filters.report_claims(claims, params), shipments, params),
        "week",
        "claim_date",
        F.count(F.lit(1)).alias("claims"),
        F.count_if("matched").alias("verified"),
    )
    weeks = series.full_join_buckets(orders, submitted, ["orders", "claims", "verified"])
    return weeks.select(
        "time",
        percent(F.col("claims"), F.col("orders"), 1).alias("claim_rate_pct"),
        percent(F.col("verified"), F.col("orders"), 1).alias("shortage_rate_pct"),
    )
