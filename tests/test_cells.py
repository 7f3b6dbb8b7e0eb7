from __future__ import annotations

from datetime import datetime

import pytest
from claimtrace.functions import cells
from pyspark.sql import functions as F


def one(spark, make, text):
    frame = spark.createDataFrame([(text,)], "c string")
    return frame.select(make(F.col("c")).alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-04-01", datetime(2025, 4, 1)),
        (" 2025-04-01 08:30:05 ", datetime(2025, 4, 1, 8, 30, 5)),
        ("2025-04-01T08:30", datetime(2025, 4, 1, 8, 30)),
        ("2025-04-01T08", datetime(2025, 4, 1, 8)),
        ("2025-04-01 08:30:05.123456", datetime(2025, 4, 1, 8, 30, 5, 123456)),
        ("2025-4-1 8:30:05.5", datetime(2025, 4, 1, 8, 30, 5, 500000)),
        ("2025-04-01 08:30 pm", datetime(2025, 4, 1, 20, 30)),
        ("4/1/2025 08:30:00", datetime(2025, 4, 1, 8, 30)),
        ("04/01/2025 1:30 AM", datetime(2025, 4, 1, 1, 30)),
        ("12/31/2025 12:00 am", datetime(2025, 12, 31)),
        ("2025-4-1", datetime(2025, 4, 1)),
        ("20250401", datetime(2025, 4, 1)),
        ("20250401T0830", datetime(2025, 4, 1, 8, 30)),
        ("20250401 083005", datetime(2025, 4, 1, 8, 30, 5)),
        ("2025-04-01T08:30:00+02:00", datetime(2025, 4, 1, 6, 30)),
        ("2025", None),
        ("2025-04", None),
        ("12:30", None),
        ("2025-02-30", None),
        ("13/01/2025 08:30:00", None),
        ("not a date", None),
        ("  ", None),
        (None, None),
    ],
)
def test_parse_datetime(spark, text, expected):
    assert one(spark, cells.parse_datetime, text) == expected


@pytest.mark.parametrize("text", ["2025-02-28 23:59:59", "2025-02-30 10:00:00", "2025-13-01 10:00:00", "2025-01-01 24:00:00", "2025-01-01 10:60:00"])
def test_plain_times_read_as_iso(spark, text):
    """A plain time was stripped and tried by some ten patterns before it was read."""
    import re

    assert re.search(cells.PLAIN_TIME.replace(r"\z", r"\Z"), text)
    want = one(spark, cells.iso_timestamp, text)
    assert one(spark, cells.parse_datetime, text) == want == one(spark, cells.parse_datetime, f" {text}\n")


def test_claim_dates_are_iso_only(spark):
    assert one(spark, cells.iso_timestamp, "2025-04-01") == datetime(2025, 4, 1)
    assert one(spark, cells.iso_timestamp, "4/1/2025 08:30:00") is None
    assert one(spark, cells.iso_timestamp, "2025-4-1") is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("00100854129315998618", "100854129315998624"),
        ("345678901234567890", "345678901234567872"),
        ("10.7", "10"),
        ("-10.7", "-10"),
        ("0012", "12"),
        ("1e3", "1000"),
        ("123D", "123D"),
        ("1f", "1f"),
        ("inf", "inf"),
        ("1_000", "1000"),
        (" A7 ", "A7"),
        ("99999999999999999999", "99999999999999999999"),
        ("", None),
        (" \t", None),
        (None, None),
    ],
)
def test_int_text(spark, text, expected):
    assert one(spark, cells.int_text, text) == expected


def test_exact_identifiers(spark):
    assert one(spark, lambda c: cells.int_text(c, True), "00100854129315998618") == "00100854129315998618"
    assert one(spark, lambda c: cells.int_text(c, True), "10.7") == "10"


@pytest.mark.parametrize(
    ("text", "expected"),
    [("OBSOLETE - SHORTAGE - CC", "SHORTAGE"), ("short", "SHORTAGE"), ("DAMAGED, SHORT", "SHORTAGE"),
     ("DAMAGED IN TRANSIT", "DAMAGE"), ("Other", "Other"), (None, "SHORTAGE"), ("", "SHORTAGE")],
)
def test_claim_type(spark, text, expected):
    assert one(spark, cells.claim_type, text) == expected


def test_small_helpers(spark):
    assert one(spark, cells.strip, "\t a b \n") == "a b"
    assert one(spark, cells.clean_text, " \t\n") is None
    assert one(spark, cells.normalize_header, " Carrier/BP Name\t") == "carrier_bp_name"
    assert one(spark, cells.normalize_header, None) == ""
    assert one(spark, cells.order_status, "completed") == "Perfect"
    assert one(spark, cells.order_status, "Pending") == "PENDING"
    assert one(spark, cells.whole_number, "-2.9") == -2
    assert one(spark, cells.whole_number, "2x") is None
    assert one(spark, cells.digits, "\t12-3a") == "123"
    assert one(spark, cells.content_hash, "abc").startswith("ba7816bf")
