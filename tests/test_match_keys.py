"""The match keys that loads keep, against keys made from the stored shipments."""

from __future__ import annotations

import re
from datetime import date, datetime

from claimtrace.operators import match
from claimtrace.params import Params
from claimtrace.sources import files
from claimtrace.sources.tables import Tables
from claimtrace.streaming import ingest
from pyspark.sql import functions as F
from test_tables import csv, put, status_files

PARAMS = Params(datetime(2025, 1, 1), datetime(2025, 12, 31), as_of=date(2026, 1, 15), carriers=("FXFE",))


def held(keys: match.MatchKeys):
    counts = keys.counts.groupBy("match_key", "scac", "order_status").agg(F.sum("n").alias("n")).filter("n <> 0")
    return sorted(map(repr, counts.collect()))


def claims(spark):
    orders = ["12345678", "2345678", "9345678", "00000001", "345678", None, ""]
    rows = [(datetime(2025, 4, 1), i, o, p) for i, o in enumerate(orders) for p in (None, "p01", "p10")]
    return spark.createDataFrame(rows, "claim_date timestamp, claim_amount int, order_id string, sscc18 string")


def test_keys_follow_loads(spark, tmp_path):
    given = status_files(4)
    put(tmp_path / "in", {**given, "Result_last.csv": csv("order_number,sscc18,scac,kargo_shipment_id,appointment_date", "6112345678,p01,OTHER,S,2025-04-01")})
    tables = Tables(spark, str(tmp_path / "db"))
    for i, name in enumerate([*given, "Result_last.csv"]):
        ingest.load_files(files.scan_folder(spark, str(tmp_path / "in" / name)), tables, f"b{i}")
    stored = tables.read("shipments")
    assert stored.count() and held(tables.match_keys()) == held(match.MatchKeys(match.key_counts(stored)))
    cl = claims(spark)
    for status in (match.PERFECT, "HELD", None):
        for params in (None, PARAMS):
            kept = match.with_match(cl, tables.match_keys(), params, status).collect()
            assert sorted(map(repr, kept)) == sorted(map(repr, match.with_match(cl, stored, params, status).collect()))
    kept = match.with_reason(cl, tables.match_keys()).collect()
    assert sorted(map(repr, kept)) == sorted(map(repr, match.with_reason(cl, stored).collect()))
    assert ingest.tidy(tables, 2) > 0
    assert held(tables.match_keys()) == held(match.MatchKeys(match.key_counts(tables.read("shipments"))))


def test_shipments_written_otherwise_are_seen(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    rows = spark.createDataFrame([(datetime(2025, 4, 1), "a", "61234567")], "appointment_date timestamp, sscc18 string, order_id string")
    tables.append("shipments", rows)
    assert held(tables.match_keys()) == held(match.MatchKeys(match.key_counts(rows.withColumns({"scac": F.lit(None).cast("string"), "order_status": F.lit(None).cast("string")}))))
    put(tmp_path / "in", {"Result_1.csv": csv("order_number,sscc18,scac,kargo_shipment_id,appointment_date", "61234567,b,FXFE,S,2025-04-01")})
    ingest.load_files(files.scan_folder(spark, str(tmp_path / "in")), tables, "b")  # makes them from all shipments
    assert tables.parts("match_keys") and len({k for k in held(tables.match_keys()) if "'P" in k}) == 2
    tables.reset()
    assert held(tables.match_keys()) == []


def test_stored_keys_are_not_shuffled(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    put(tmp_path / "in", {"Result_1.csv": csv("order_number,sscc18,scac,kargo_shipment_id,appointment_date", "61234567,b,FXFE,S,2025-04-01")})
    ingest.load_files(files.scan_folder(spark, str(tmp_path / "in")), tables, "b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = match.with_match(claims(spark), tables.match_keys(), PARAMS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    scans = [i for i, line in enumerate(lines) if "claimtrace_keys_" in line]
    assert scans
    for i in scans:  # up from the scan to the join there is no exchange
        depth, above = lines[i].index("FileScan"), []
        for line in reversed(lines[:i]):
            at = re.search(r"[A-Za-z*]", line).start()
            if at < depth:
                depth = at
                above.append(line)
                if "SortMergeJoin" in line:
                    break
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above)


def test_stored_keys_are_added_up_behind_one_shuffle(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    ids = spark.range(0, 400, 1, 4)
    rows = ids.select(
        F.concat(F.lit("6123456"), (F.col("id") % 4).cast("string")).alias("order_id"), F.lit("p").alias("sscc18"),
        F.lit("FXFE").alias("scac"), F.lit("Perfect").alias("order_status"),
    )
    tables.append("match_keys", match.key_rows(rows))
    stored = tables.read("match_keys")
    assert sorted(r.n for r in stored.collect()) == [100] * 8 + [400]
    assert held(tables.match_keys()) == held(match.MatchKeys(match.key_counts(rows)))
