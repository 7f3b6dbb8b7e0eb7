"""Edges of the reports: nothing to report, ranges that end early, reducers."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

from claimtrace.operators import filters, reducers, series
from claimtrace.params import Params
from claimtrace.plans import monthly, scans, summary, volume
from pyspark.sql import functions as F

PARAMS = Params(datetime(2025, 1, 1), datetime(2025, 1, 10), date(2025, 2, 15))
SHIPMENT = (
    "appointment_date timestamp, pro_number string, sscc18 string, scac string, order_id string,"
    " shipment_id string, source_file string, order_status string"
)
CLAIM = (
    "claim_date timestamp, order_id string, sscc18 string, claim_amount decimal(10,2), claim_type string,"
    " business_unit_code string, ship_to_name string, address_name string"
)


def shipments(spark, *rows):
    return spark.createDataFrame(list(rows), SHIPMENT)


def claims(spark, *rows):
    return spark.createDataFrame(
        [(d, o, s, Decimal(str(a)), "SHORTAGE", "1MF", n, None) for d, o, s, a, n in rows], CLAIM
    )


def values(df):
    return [tuple(r) for r in df.collect()]


def test_reports_over_nothing(spark):
    sh, cl = shipments(spark), claims(spark)
    assert values(summary.saved_total(sh, cl, PARAMS)) == [(Decimal("0.00"),)]
    assert values(scans.total_claim_amount(cl, PARAMS)) == [(None,)]
    assert values(scans.total_claim_count(cl, PARAMS)) == [(0,)]
    assert values(scans.claims_per_1000_scans(sh, cl, PARAMS)) == [(None,)]
    assert values(monthly.coverage_claims_pct(sh, cl, PARAMS)) == [(None,)]
    assert values(monthly.coverage_dollars_pct(sh, cl, PARAMS)) == [(None,)]
    assert values(monthly.bottom_line_text(sh, cl, PARAMS)) == [(None,)]
    assert values(scans.before_claims_days(cl, PARAMS)) == [("0 / 0 Days",)]
    assert values(scans.before_large_share(cl, PARAMS)) == [(None,)]
    assert values(scans.days_since_large_claim(cl, PARAMS)) == [(None,)]
    assert values(summary.orders_shipped_mom(sh, PARAMS)) == [
        (datetime(2025, 1, 1), 0), (datetime(2025, 2, 1), 0),
    ]
    assert {r.daily_scans for r in scans.daily_scans_spine(sh, PARAMS).collect()} == {0}
    assert scans.daily_scans_spine(sh, PARAMS).count() == 10
    daily = scans.daily_claims_per_1000(sh, cl, PARAMS).collect()
    assert {(float(r.claims_per_1000), r.avg_ratio_7) for r in daily} == {(0.0, 0.0)}


def test_earlier_point_has_no_upper_end_but_the_month(spark):
    sh = shipments(
        spark,
        (datetime(2025, 1, 5), None, "a", "FXFE", "1", None, None, None),
        (datetime(2025, 1, 20), None, "b", "FXFE", "2", None, None, None),
        (datetime(2025, 1, 21), None, "c", None, "3", None, None, None),
    )
    assert [v for _, v in values(summary.orders_shipped_mom(sh, PARAMS))] == [2, 1]
    every = replace(PARAMS, carriers=None)
    assert [v for _, v in values(summary.orders_shipped_mom(sh, every))] == [3, 1]


def test_warm_up_uses_the_days_before(spark):
    cl = claims(spark, (datetime(2024, 12, 31), None, None, 70, None), (datetime(2025, 1, 1), None, None, 14, None))
    cut = scans.daily_claims_moving_avg(cl, PARAMS).first()
    warm = scans.daily_claims_moving_avg(cl, PARAMS, warm_up=True).first()
    assert (cut.moving_avg_7, warm.moving_avg_7) == (14.0, 12.0)


def test_range_includes_both_ends(spark):
    sh = shipments(
        spark,
        (datetime(2025, 1, 1), None, "a", "FXFE", "1", None, None, "Perfect"),
        (datetime(2025, 1, 10), None, "b", "FXFE", "2", None, None, "Short"),
        (datetime(2025, 1, 10, 0, 0, 1), None, "c", "FXFE", "2", None, None, "Short"),
    )
    assert values(volume.total_shipments(sh, PARAMS)) == [(2,)]
    assert values(volume.perfect_orders(sh, PARAMS)) == [(1,)]
    assert values(volume.short_orders(sh, PARAMS)) == [(1,)]


def test_monthly_texts(spark):
    sh = shipments(spark, (datetime(2025, 1, 1), None, "p", "FXFE", "6112345678", None, None, "Perfect"))
    cl = claims(
        spark,
        (datetime(2025, 1, 2), "12345678", None, -1234.5, "X"),
        (datetime(2025, 1, 3), "1234567", "", -1, "X"),
        (datetime(2025, 1, 4), None, "q", -1, "X"),
    )
    assert values(monthly.monthly_summary(sh, cl, PARAMS)) == [
        ("January 2025", 3, Decimal(1237), "1 (33%)", "$1,235 (100%)", "2 / $2")
    ]
    assert monthly.bottom_line_text(sh, cl, PARAMS).first().summary.endswith(
        "$1,235 of that was avoidable — a verified opportunity to reduce cost."
    )


def test_reducers(spark):
    points = spark.createDataFrame(
        [(1, 10.0), (2, 15.0), (3, None), (4, 0.0), (5, 3.0)], "time int, v double"
    )
    assert values(reducers.last_not_null(points, "v")) == [(3.0,)]
    changes = [r.change_pct for r in reducers.percent_change(points, "v").orderBy("time").collect()]
    assert changes == [None, 50.0, None, None, None]
    assert values(reducers.footer(points, "v")) == [(5, 28.0)]
    bands = points.select(
        reducers.band(F.col("v") * 10, reducers.DAYS_BANDS).alias("b"), reducers.no_value(F.col("v"), "-").alias("n")
    )
    assert [r.b for r in bands.collect()] == ["green", "green", "red", "red", "orange"]
    assert [r.n for r in bands.collect()][2] == "-"


def test_before_and_after(spark):
    daily = spark.createDataFrame(
        [(date(2025, 1, 1), 10.0), (date(2025, 1, 2), 30.0), (date(2025, 1, 3), 5.0)], "day date, v double"
    )
    row = series.before_after(daily, "v", "day", date(2025, 1, 3)).first()
    assert tuple(row) == (20.0, 5.0, 75.0)


def test_labels_and_lists(spark):
    sh = shipments(spark, (datetime(2025, 1, 1), None, "a", "B", "1", None, None, None),
                   (datetime(2025, 1, 1), None, "a", "A", "1", None, None, None),
                   (datetime(2025, 1, 1), None, "a", None, "1", None, None, None))
    listed = filters.with_labels(filters.distinct_carriers(sh), {"scac": "Carrier"})
    assert listed.columns == ["Carrier"] and values(listed) == [("A",), ("B",)]


def test_scan_reads_only_needed_columns(spark, tmp_path, capsys):
    path = str(tmp_path / "sh")
    shipments(spark, (datetime(2025, 1, 1), None, "a", "B", "1", None, None, None)).write.parquet(path)
    volume.total_shipments(spark.read.parquet(path), PARAMS).explain("formatted")
    plan = capsys.readouterr().out
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "appointment_date" in schema and "scac" in schema and "sscc18" not in schema
    assert "GreaterThanOrEqual(appointment_date" in pushed and "In(scac" in pushed
