from __future__ import annotations

import os
from datetime import datetime
from decimal import Decimal

import pytest
from claimtrace.sources import files, text_grid
from claimtrace.sources.tables import Tables
from claimtrace.streaming import ingest
from pyspark.sql import functions as F

from registry.workbooks import write_workbook

HEAD = ["Effective Date", "Original Order Number", "Shipment Number", "Credit Issued",
        "Concatenation Carrier Number", "Returned Reason", "Ship To"]


def csv(*lines):
    return ("\n".join(lines)).encode()


def result_file(*rows):
    return csv("order_number,sscc18,scac,kargo_shipment_id,appointment_date", *rows)


def rma_book(claims, credits=(("FXFE", 10.5, 2),)):
    return write_workbook(
        {
            "Summary": [["Credits"], ["Carrier/BP", "Credit", "Count"], *credits],
            "Data": [["t"], HEAD, *claims],
        }
    )


def day(d):
    return datetime(2025, 4, d)


FILES = {
    "Result_1.csv": result_file(
        "6112345678,p1,FXFE,S1,2025-04-01 08:00:00", "6187654321,p2,HSNR,S2,2025-04-02",
        "6112345678,p1,FXFE,S9,2025-04-01 08:00:00", ",p3,HSNR,S2,2025-05-02", "6100000000,,x,S,2025-04-01",
    ),
    "MS_Kargo_1.xlsx": write_workbook(
        {"Sheet1": [["APPOINTMENT_DATE", "PRO_NUMBER", "SSCC18", "SCAC", "ORDER_ID", "SHIPMENT_ID"],
                    [day(3), "PRO", "p2", "FXFE", "6187654321", "fromsheet"],
                    [day(3), "PRO", "p4", "FXFE", "6155555555", "S4"]]}
    ),
    "AllOrders.csv": csv("Order_Number,Order_Status", "6187654321,Short", "6100,Perfect"),
    "order_level_1.csv": csv(
        "orderNumber,orderStatus,missedLpns", '"\t1111111112345678","COMPLETED",""',
        '"\t1111111155555555","INCOMPLETE","a|b"',
    ),
    "CS_RMA_1.xlsx": rma_book(
        [[day(1), 12345678, None, 100, "FXFE", "SHORTAGE", "Clinic"],
         [day(2), 11111111, None, 50, "FXFE", "DAMAGE", None],
         [day(2), 11111111, None, 50, "FXFE", "SHORT", "Ward"]]
    ),
    "notes.txt": b"not read",
    "broken_rma.xlsx": b"PK" + b"x" * 300,
}


def write(folder, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / name).write_bytes(FILES[name])


def run(spark, folder, tables, progress, **options):
    query = ingest.start(spark, str(folder), tables, str(progress), every=None, **options)
    query.awaitTermination()
    assert query.exception() is None


def state(tables):
    skip = {"ingested_at", "processed_at", "logged_at", "batch"}
    found = {}
    for name in ("shipments", "rma_credits", "claim_details", "claim_daily_history", "processed_attachments"):
        df = tables.read(name)
        found[name] = sorted(repr(r) for r in df.drop(*skip).collect())
    return found


def audit(tables):
    return {
        (r.file_name, r.outcome): (r.parsed_rows, r.inserted_rows, r.updated_rows)
        for r in tables.read("load_audit").collect()
    }


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("one")
    write(root / "in", FILES)
    tables = Tables(spark, str(root / "db"))
    run(spark, root / "in", tables, root / "progress")
    return root, tables


def test_one_run_fills_all_tables(loaded):
    _, tables = loaded
    rows = {
        (r.sscc18, r.order_id): (r.shipment_id, r.source_file, r.order_status)
        for r in tables.read("shipments").collect()
    }
    assert rows == {
        ("p1", "6112345678"): ("S1", "Result_1.csv", "Perfect"),
        ("p2", "6187654321"): ("fromsheet", "MS_Kargo_1.xlsx", "Short"),
        ("p3", None): ("S2", "Result_1.csv", None),
        ("p4", "6155555555"): ("S4", "MS_Kargo_1.xlsx", "Short"),
    }
    claims = tables.read("claim_details").orderBy("claim_date").collect()
    assert [(c.order_id, c.claim_type, c.ship_to_name) for c in claims] == [
        ("12345678", "SHORTAGE", "Clinic"), ("11111111", "SHORTAGE", "Ward"),
    ]
    history = tables.read("claim_daily_history").orderBy("claim_date").collect()
    assert [(h.total_amount, h.claim_count, h.moving_avg_7d) for h in history] == [
        (Decimal("100.00"), 1, Decimal("100.00")), (Decimal("50.00"), 1, Decimal("75.00")),
    ]
    assert tables.read("rma_credits").count() == 1


def test_audit_and_marks(loaded):
    _, tables = loaded
    assert audit(tables) == {
        ("Result_1.csv", "loaded"): (4, 2, 0),
        ("MS_Kargo_1.xlsx", "loaded"): (2, 2, 0),
        ("AllOrders.csv", "loaded"): (2, 0, 0),
        ("order_level_1.csv", "loaded"): (2, 0, 0),
        ("CS_RMA_1.xlsx", "loaded"): (4, 3, 0),
        ("broken_rma.xlsx", "failed"): (None, None, None),
    }
    marked = {r.filename for r in tables.read("processed_attachments").collect()}
    assert marked == set(FILES) - {"notes.txt", "broken_rma.xlsx"}


def test_copies_are_recognised_by_content(spark, loaded, tmp_path):
    root, tables = loaded
    before = state(tables)
    (root / "in" / "Result_copy.csv").write_bytes(FILES["Result_1.csv"])
    run(spark, root / "in", tables, root / "progress")
    assert state(tables) == before
    assert ("Result_copy.csv", "duplicate") in audit(tables)


def test_two_batches_equal_one(spark, loaded, tmp_path):
    _, tables = loaded
    before = {k: v for k, v in state(tables).items()}
    write(tmp_path / "in", ["Result_1.csv", "MS_Kargo_1.xlsx", "CS_RMA_1.xlsx"])
    split = Tables(spark, str(tmp_path / "db"))
    run(spark, tmp_path / "in", split, tmp_path / "progress")
    write(tmp_path / "in", ["AllOrders.csv", "order_level_1.csv"])
    run(spark, tmp_path / "in", split, tmp_path / "progress", files_per_batch=1)
    assert state(split) == before


def test_statuses_that_come_before_their_shipments(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    given = {
        "AllOrders_1.csv": csv("Order_Number,Order_Status", "6187654321,Short", "6100,Perfect", "6155555555,Short"),
        "AllOrders_2.csv": csv("Order_Number,Order_Status", "6187654321,Perfect"),
        "order_level_1.csv": FILES["order_level_1.csv"],
        "Result_1.csv": FILES["Result_1.csv"],
        "Result_2.csv": result_file("6187654321,p9,HSNR,S2,2025-06-02", "6155555555,p4,x,S,2025-04-03", "6999999999,p8,x,S,2025-04-03"),
    }
    for i, (name, content) in enumerate(given.items()):
        (folder / name).write_bytes(content)
        os.utime(folder / name, (1_700_000_000 + 100 * i,) * 2)
    found = []
    for batch in (1, 64):
        tables = Tables(spark, str(tmp_path / f"db{batch}"))
        run(spark, folder, tables, tmp_path / f"progress{batch}", files_per_batch=batch)
        found.append({r.sscc18: r.order_status for r in tables.read("shipments").collect()})
    assert found[0] == found[1]
    assert found[0] == {"p1": "Perfect", "p2": "Perfect", "p3": None, "p4": "Short", "p8": None, "p9": "Perfect"}
    tables.reset()
    assert tables.read("status_rows").count() == 0


def test_manual_upload_twice_and_claim_update(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, ["CS_RMA_1.xlsx"])
    tables = Tables(spark, str(tmp_path / "db"))
    ingest.load_folder(spark, str(folder), tables)
    again = ingest.load_folder(spark, str(folder), tables).first()
    assert (again.parsed_rows, again.inserted_rows, again.updated_rows) == (4, 0, 2)
    (folder / "CS_RMA_1.xlsx").write_bytes(
        rma_book([[day(1), 12345678, None, 100, "OTHER", "DAMAGE", "Hospital"],
                  [datetime(2025, 6, 1), 1, None, 7, "FXFE", None, None]])
    )
    ingest.load_folder(spark, str(folder), tables)
    rows = {
        (r.claim_date, r.claim_amount): (r.claim_type, r.carrier_bp, r.ship_to_name, r.reason_text)
        for r in tables.read("claim_details").collect()
    }
    assert rows == {
        (day(1), Decimal("100.00")): ("SHORTAGE", "FXFE", "Hospital", "DAMAGE"),
        (day(2), Decimal("50.00")): ("SHORTAGE", "FXFE", "Ward", "SHORT"),
        (datetime(2025, 6, 1), Decimal("7.00")): ("SHORTAGE", "FXFE", None, None),
    }
    assert tables.read("processed_attachments").count() == 0


def test_bad_files_do_not_stop_others(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "cs_rma_bad.xlsx").write_bytes(rma_book([[day(1), 1, None, 5]], credits=[("A", "x", 1)]))
    (folder / "Result_long.csv").write_bytes(result_file("1," + "9" * 31 + ",A,S,2025-04-01", "2,p,A,S,2025-04-01"))
    (folder / "Result_ok.csv").write_bytes(result_file("3,q,A,S,2025-04-01"))
    (folder / "Result_empty.csv").write_bytes(result_file())
    (folder / "Result_none.csv").write_bytes(b"")  # never listed by the reader
    tables = Tables(spark, str(tmp_path / "db"))
    run(spark, folder, tables, tmp_path / "progress")
    assert {k[0]: k[1] for k in audit(tables)} == {
        "cs_rma_bad.xlsx": "failed", "Result_long.csv": "failed", "Result_ok.csv": "loaded",
        "Result_empty.csv": "no data",
    }
    assert [r.sscc18 for r in tables.read("shipments").collect()] == ["q"]
    assert tables.read("claim_details").count() == 0
    assert [r.filename for r in tables.read("processed_attachments").collect()] == ["Result_ok.csv"]


def test_keywords_and_reset(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, ["Result_1.csv", "AllOrders.csv"])
    tables = Tables(spark, str(tmp_path / "db"))
    run(spark, folder, tables, tmp_path / "progress", keywords=("Result_",))
    assert {k[0] for k in audit(tables)} == {"Result_1.csv"}
    tables.reset()
    assert tables.read("shipments").count() == 0
    assert tables.read("shipments").columns[0] == "appointment_date"


def test_only_touched_months_are_rewritten(spark, loaded):
    _, tables = loaded
    stamp = {r.path: r.modificationTime for r in spark.read.format("binaryFile").load(
        tables.path("shipments") + "/month=2025-05").select("path", "modificationTime").collect()}
    rows = spark.createDataFrame(
        [("6155555555", "Perfect", ("f", 0, 0))],
        "order_number string, order_status string, seq struct<file_name:string,block:long,row:long>",
    ).withColumn("file_name", F.lit("f"))
    ingest._update_statuses(tables, rows, by_suffix=False)
    after = {r.path: r.modificationTime for r in spark.read.format("binaryFile").load(
        tables.path("shipments") + "/month=2025-05").select("path", "modificationTime").collect()}
    assert stamp and stamp == after
    assert tables.read("shipments").filter("sscc18 = 'p4'").first().order_status == "Perfect"


def test_large_csv_files_are_known_by_their_lines(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    write(folder, ["Result_1.csv", "MS_Kargo_1.xlsx"])
    (folder / "Result_copy.csv").write_bytes(FILES["Result_1.csv"])
    tables = Tables(spark, str(tmp_path / "db"))
    monkeypatch.setattr(files, "LARGEST_VALUE", 1_000_000)
    (folder / "MS_Kargo_huge.xlsx").write_bytes(b"x" * 1_000_001)
    ingest.load_files(files.scan_folder(spark, str(folder)), tables, "b", whole_file=10)
    assert {k: v[1] for k, v in audit(tables).items()} == {
        ("Result_1.csv", "loaded"): 2, ("Result_copy.csv", "duplicate"): None, ("MS_Kargo_1.xlsx", "loaded"): 2,
        ("MS_Kargo_huge.xlsx", "failed"): None,
    }


@pytest.mark.parametrize("small", [True, False])
def test_suffix_rule_looks_at_all_months(spark, tmp_path, monkeypatch, small):
    """A number that equals an order of an unchanged month is not matched by suffix elsewhere."""
    monkeypatch.setattr(ingest, "is_small", lambda df: small)
    tables = Tables(spark, str(tmp_path / "db"))
    rows = [(day(1), "a", "12345678", "Perfect"), (datetime(2025, 5, 1), "b", "9912345678", "Short"),
            (datetime(2025, 6, 1), "c", "77", None)]
    tables.append("shipments", spark.createDataFrame(
        rows, "appointment_date timestamp, sscc18 string, order_id string, order_status string"))
    statuses = spark.createDataFrame(
        [("f", "12345678", "Perfect", ("f", 0, 0)), ("f", "7", "New", ("f", 0, 1))],
        "file_name string, order_number string, order_status string,"
        " seq struct<file_name:string,block:long,row:long>")
    ingest._update_statuses(tables, statuses, by_suffix=True)
    got = {r.sscc18: r.order_status for r in tables.read("shipments").collect()}
    assert got == {"a": "Perfect", "b": "Short", "c": "New"}


def test_manifest_filters(spark):
    mails = spark.createDataFrame(
        [("A@x.org", False, True, "Result_1.CSV"), ("b@x.org", False, True, "a.pdf"),
         ("a@x.org", True, True, "r.xlsx"), ("c@x.org", False, False, "order_level.csv"),
         (None, False, True, "k.xlsx")],
        "sender string, is_read boolean, has_attachments boolean, file_name string",
    )
    assert files.supported(mails).count() == 4
    assert files.unread_with_attachments(mails).count() == 3
    assert files.sender_allowed(mails, ["A@X.org ", ""]).count() == 2
    assert files.sender_allowed(mails, []).count() == 5
    assert files.keyword_allowed(mails, ["RESULT_", " order_level"]).count() == 2
    assert files.keyword_allowed(mails, [" "]).count() == 5


def test_large_files_with_the_same_lines_in_another_order_both_load(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [f"61000000{i:02d},p{i},FXFE,S{i},2025-04-01" for i in range(40)]
    (folder / "Result_1.csv").write_bytes(result_file(*lines))
    (folder / "Result_2.csv").write_bytes(result_file(*reversed(lines)))
    (folder / "Result_3.csv").write_bytes(result_file(*lines))
    hashes = {}
    for size in ("128m", "100b"):  # where blocks end changes nothing
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = files.line_hash(text_grid.scan_lines(spark, str(folder))).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        hashes[size] = {r.file_name: r.attachment_hash for r in found}
    assert hashes["128m"] == hashes["100b"]
    one = hashes["100b"]
    assert one["Result_1.csv"] == one["Result_3.csv"] != one["Result_2.csv"]
    tables = Tables(spark, str(tmp_path / "db"))
    ingest.load_files(files.scan_folder(spark, str(folder)), tables, "b", whole_file=10)
    assert {r.filename for r in tables.read("processed_attachments").collect()} == {"Result_1.csv", "Result_2.csv"}
