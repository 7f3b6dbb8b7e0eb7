"""The registered queries against their SQL; ``check.py`` runs all of them."""

from __future__ import annotations

from pathlib import Path

import pytest
from oracle import database, spark_rows, sql_rows

import __spark_entry__ as entry
from registry import catalog, loads

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "k1_orders_shipped_mom", "k4_saved_mom", "k6_verified_invalid_by_customer", "k14_shipment_details",
    "k22_daily_claims_per_1000_warm_up", "k28_claim_log_containing", "k39_monthly_summary",
    "k42_bottom_line_text", "j1_match_perfect_semi", "j9_double_left_join_distinct", "m3_insert_ignore_shipments",
    "m6_upsert_claims_coalesce", "m10_update_status_suffix_stats", "r6_match_reason", "src7_scan_csv",
    "p5_parse_order_level_csv",
]

needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="tables not present")


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) and set(catalog.QUERIES) <= set(entry.queries())


@needs_tables
def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["time", "legitimate", "refutable"] and rows.count() == 12


@needs_tables
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, connection, name):
    assert spark_rows(entry.queries()[name](spark, SF_DIR)) == sql_rows(connection, entry.oracle_sql()[name])


@needs_tables
def test_bad_files_are_told_apart_where_the_first_task_has_no_rows(spark, connection):
    # The first split of a file of one row group holds no rows; its task writes a header alone.
    name, key = "t3_per_file_isolation", "spark.sql.files.maxPartitionBytes"
    held = spark.conf.get(key)
    spark.conf.set(key, "32k")
    try:
        assert spark_rows(entry.queries()[name](spark, SF_DIR)) == sql_rows(connection, entry.oracle_sql()[name])
    finally:
        spark.conf.set(key, held)


@needs_tables
def test_copies_of_a_file_are_equal(spark, tmp_path):
    loads._shipment_files(spark, SF_DIR, str(tmp_path / "in"), 2)
    first, second = (sorted(tmp_path.glob(f"in/copy={i}/*.csv")) for i in range(2))
    assert first and [f.read_bytes() for f in first] == [f.read_bytes() for f in second]
    assert not {f.name for f in first} & {f.name for f in second}
