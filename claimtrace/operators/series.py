"""Time series: buckets, calendars without gaps, moving averages, daily history."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimtrace import schemas
from claimtrace.functions.report import bucket, day, ratio, sum_abs
from claimtrace.operators import filters
from claimtrace.params import Params

# Fixed value: rows before the current one in the moving average.
ROWS_BEFORE = 6


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per ``day`` from ``first`` to ``last``, both included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day")
    )


def per_bucket(df: DataFrame, unit: str, column: str, *aggregates: Column) -> DataFrame:
    """Aggregates per hour, day, week or month, in order of ``time``."""
    return df.groupBy(bucket(unit, F.col(column)).alias("time")).agg(*aggregates).orderBy("time")


def moving_average(value: str, order: str = "day") -> Column:
    """Mean over the row and up to six rows before it.

    The window has no partition, so use it on one row per day only.
    """
    frame = Window.orderBy(order).rowsBetween(-ROWS_BEFORE, Window.currentRow)
    return F.avg(F.col(value).cast("double")).over(frame)


def within_days(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Rows from the start of ``first`` to the end of ``last``, as a plain range filter."""
    after = last + timedelta(days=1)
    return df.filter((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(after)))


def on_calendar(spine: DataFrame, facts: DataFrame, zeros: list[str]) -> DataFrame:
    """Every day of the spine with its facts; missing numbers become 0.

    ``facts`` has one row per day already, so the join cannot multiply rows.
    """
    joined = spine.join(facts, "day", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeros})


def daily_scans(shipments: DataFrame, params: Params, first: date, last: date) -> DataFrame:
    """Scans per day that has any."""
    chosen = within_days(filters.carriers(shipments, params), "appointment_date", first, last)
    return chosen.groupBy(day(F.col("appointment_date")).alias("day")).agg(
        F.count(F.lit(1)).alias("scans")
    )


def daily_claims(claims: DataFrame, params: Params, first: date, last: date) -> DataFrame:
    """Claim count and money per day that has any."""
    chosen = within_days(filters.claim_types(claims, params), "claim_date", first, last)
    return chosen.groupBy(day(F.col("claim_date")).alias("day")).agg(
        sum_abs(F.col("claim_amount")).alias("claims_amount"),
        F.count(F.lit(1)).alias("claim_count"),
    )


def full_join_buckets(left: DataFrame, right: DataFrame, zeros: list[str]) -> DataFrame:
    """Buckets of either side by ``time``; numbers of the missing side become 0."""
    joined = left.join(right, "time", "full")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeros}).orderBy("time")


def ratio_of_counts(left: DataFrame, right: DataFrame, factor: int, places: int) -> DataFrame:
    """``factor * rows of left / rows of right`` as one ``value``; NULL when right is empty."""
    counts = left.agg(F.count(F.lit(1)).alias("_part")).unionByName(
        right.agg(F.count(F.lit(1)).alias("_total")), allowMissingColumns=True
    )
    pair = counts.agg(F.max("_part").alias("_part"), F.max("_total").alias("_total"))
    return pair.select(ratio(F.col("_part"), F.col("_total"), factor, places).alias("value"))


def daily_history(claims: DataFrame) -> DataFrame:
    """The daily history table: money, count and moving average per day with claims.

    The average runs over rows, so days without claims are not filled in.
    """
    daily = claims.groupBy(day(F.col("claim_date")).alias("day")).agg(
        sum_abs(F.col("claim_amount")).alias("total_amount"),
        F.count(F.lit(1)).alias("claim_count"),
    )
    frame = Window.orderBy("day").rowsBetween(-ROWS_BEFORE, Window.currentRow)
    averaged = daily.withColumn(
        "moving_avg_7d",
        F.sum("total_amount").over(frame) / F.count(F.lit(1)).over(frame),
    )
    return schemas.conform(
        averaged.withColumnRenamed("day", "claim_date"), schemas.CLAIM_DAILY_HISTORY
    )


def refresh_history(history: DataFrame, claims: DataFrame, days: DataFrame) -> DataFrame:
    """The months of the daily history that change when claims of some ``day`` rows came in, whole.

    ``claims`` holds all claims of these days. Only their totals are taken anew; the average changes on them and on
    the six rows that follow each. The history has one row per day, so the window over it is small.
    """
    chosen = F.broadcast(days.select("day").distinct())  # bounded by the calendar
    totals = claims.withColumn("day", day(F.col("claim_date"))).join(chosen, "day", "left_semi")
    totals = totals.groupBy("day").agg(
        sum_abs(F.col("claim_amount")).alias("total_amount"), F.count(F.lit(1)).alias("claim_count")
    )
    kept = history.withColumnRenamed("claim_date", "day").join(chosen, "day", "left_anti")
    kept = kept.select("day", "total_amount", "claim_count", F.lit(False).alias("_new"))
    rows = kept.unionByName(totals.withColumn("_new", F.lit(True)))
    frame = Window.orderBy("day").rowsBetween(-ROWS_BEFORE, Window.currentRow)
    month = F.date_trunc("month", F.col("day"))
    averaged = rows.withColumns(
        {
            "moving_avg_7d": F.sum("total_amount").over(frame) / F.count(F.lit(1)).over(frame),
            "_moved": F.max("_new").over(frame),
        }
    )
    changed = averaged.withColumn("_touched", F.max("_moved").over(Window.partitionBy(month))).filter("_touched")
    return schemas.conform(changed.withColumnRenamed("day", "claim_date"), schemas.CLAIM_DAILY_HISTORY)


def moving_average_rounded(daily: DataFrame, value: str, order: str) -> DataFrame:
    """The frame with ``moving_avg_7d``, the moving average rounded to cents."""
    return daily.withColumn(
        "moving_avg_7d", F.round(moving_average(value, order), 2)
    )


def before_after(daily: DataFrame, value: str, order: str, cutover: date) -> DataFrame:
    """Daily mean before and from the cutover day, and the reduction in percent."""
    early = F.col(order) < F.lit(cutover)
    means = daily.agg(
        F.avg(F.when(early, F.col(value).cast("double"))).alias("before_avg"),
        F.avg(F.when(~early, F.col(value).cast("double"))).alias("after_avg"),
    )
    return means.withColumn(
        "reduction_pct",
        F.try_divide(F.col("before_avg") - F.col("after_avg"), F.col("before_avg")) * 100,
    )
