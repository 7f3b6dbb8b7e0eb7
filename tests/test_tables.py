"""Publishing: readers see a load as a whole or not at all, and a batch counts once."""

from __future__ import annotations

import os
import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pyarrow as pa
import pytest
from claimtrace import schemas
from claimtrace.operators import series, statuses, suffix
from claimtrace.operators.suffix import match_numbers
from claimtrace.sources import files
from claimtrace.sources.tables import KEEP, Tables, durable, scratch
from claimtrace.streaming import ingest
from pyspark.sql import functions as F

SHIPMENT = "appointment_date timestamp, sscc18 string, order_id string, order_status string"


def day(d, month=4):
    return datetime(2025, month, d)


def shipments(spark, *rows):
    return spark.createDataFrame(list(rows), SHIPMENT)


def csv(*lines):
    return ("\n".join(lines)).encode()


def put(folder, content: dict[str, bytes]):
    """Files changed one after the other, a minute apart, in the order given."""
    folder.mkdir(exist_ok=True)
    for i, (name, data) in enumerate(content.items()):
        (folder / name).write_bytes(data)
        os.utime(folder / name, (1_700_000_000 + 60 * i,) * 2)


def test_a_reader_sees_the_old_state_until_all_is_published(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    tables.append("shipments", shipments(spark, (day(1), "a", "1", None), (day(1, 5), "b", "2", None)))
    other = Tables(spark, str(tmp_path / "db"))
    before = other.read("shipments")
    load = tables.begin()
    assert load.rewrite_months("shipments", load.read_months("shipments", ["2025-05"]).withColumn("order_status", F.lit("X"))) == 1
    assert load.append("rma_credits", spark.createDataFrame([("A", 1)], "carrier_bp string, count int")) == 1
    assert load.append("shipments", shipments(spark)) == 0
    assert {r.order_status for r in load.read("shipments").collect()} == {None, "X"}
    assert {r.order_status for r in other.read("shipments").collect()} == {None}
    assert other.read("rma_credits").count() == 0
    load.publish(("stream", 4))
    assert {r.order_status for r in other.read("shipments").collect()} == {None, "X"}
    assert other.read("rma_credits").count() == 1 and other.last_batch("stream") == 4
    assert {r.order_status for r in before.collect()} == {None}  # the old parts are still there


def test_a_load_that_fails_leaves_nothing(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    with pytest.raises(ZeroDivisionError), tables.begin() as load:
        load.append("shipments", shipments(spark, (day(1), "a", "1", None)))
        raise ZeroDivisionError
    assert tables.read("shipments").count() == 0 and tables.version == 0
    tables.append("shipments", shipments(spark, (day(1), "b", "1", None)))
    assert len(list((tmp_path / "db" / "shipments" / "month=2025-04").iterdir())) == 2
    assert tables.vacuum() == 1 and tables.vacuum() == 0
    assert [r.sscc18 for r in tables.read("shipments").collect()] == ["b"]


def test_of_two_loads_at_once_one_is_refused(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    first, second = tables.begin(), tables.begin()
    for load in (first, second):
        load.append("shipments", shipments(spark, (day(1), "a", None, None)))
    first.publish()
    with pytest.raises(RuntimeError, match="another load"):
        second.publish()
    assert tables.read("shipments").count() == 1


def test_old_parts_and_lists_go(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    tables.append("shipments", shipments(spark, (day(1), "a", "1", None)))
    for i in range(KEEP + 2):
        tables.rewrite_months("shipments", tables.read("shipments").withColumn("order_status", F.lit(str(i))))
    assert len(list((tmp_path / "db" / "_versions").glob("*.json"))) == KEEP
    assert len(list((tmp_path / "db" / "shipments" / "month=2025-04").iterdir())) == KEEP
    assert [r.order_status for r in tables.read("shipments").collect()] == [str(KEEP + 1)]


def test_scratch_rows_go(spark, tmp_path):
    with scratch(spark, str(tmp_path / "s")):
        assert durable(spark.range(5)).count() == 5 and (tmp_path / "s").exists()
    assert not (tmp_path / "s").exists()


EXPORT = "order_number,sscc18,scac,kargo_shipment_id,appointment_date"
RESULT = csv(EXPORT, ",p1,FXFE,S1,2025-04-01", ",p2,FXFE,S1,2025-04-02", "6112345678,p3,FXFE,S1,2025-04-02")


def rows_of(tables):
    return sorted((r.sscc18, r.order_id or "", r.order_status) for r in tables.read("shipments").collect())


def test_a_batch_run_twice_counts_once(spark, tmp_path):
    """Also rows without an order, which equal no stored row."""
    put(tmp_path / "in", {"Result_1.csv": RESULT})
    tables = Tables(spark, str(tmp_path / "db"))
    for _ in range(2):
        audit = ingest.load_files(files.scan_folder(spark, str(tmp_path / "in")), tables, "stream-0", skip_known=False, stream=("s", 0))
        assert [(r.file_name, r.inserted_rows) for r in audit.collect()] == [("Result_1.csv", 3)]
    assert len(rows_of(tables)) == 3


def test_a_batch_that_dies_before_it_is_published_starts_anew(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", {"Result_1.csv": RESULT})
    tables = Tables(spark, str(tmp_path / "db"))

    def load():
        ingest.load_files(files.scan_folder(spark, str(tmp_path / "in")), tables, "stream-0", stream=("s", 0))

    with monkeypatch.context() as patch:
        patch.setattr("claimtrace.sources.tables.Load.publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load()
    assert rows_of(tables) == []
    load()
    assert len(rows_of(tables)) == 3
    assert not (tmp_path / "db" / "_scratch").exists() or not list((tmp_path / "db" / "_scratch").iterdir())


def status_files(seed: int) -> dict[str, bytes]:
    """Shipments and statuses of both kinds in any order; some numbers end others, some become orders late."""
    r = random.Random(seed)
    orders = ["6112345678", "12345678", "345678", "6199345678", "99345678", "6100000001"]
    kinds = ["Result", "AllOrders", "order_level"]
    made = {}
    for i in range(7):
        kind = kinds[i % 3] if i < 3 else r.choice(kinds)
        lines = []
        for j in range(4):
            order, status = r.choice(orders), r.choice(["COMPLETED", "INCOMPLETE", "HELD", "LATE"])
            if kind == "Result":
                lines.append(f"{order},p{i}{j},FXFE,S,2025-0{r.choice('456')}-01")
            elif kind == "AllOrders":
                lines.append(f"{order},{status}")
            else:
                lines.append(f'"11111111{order}","{status}",""')
        head = {"Result": EXPORT, "AllOrders": "Order_Number,Order_Status", "order_level": "orderNumber,orderStatus,missedLpns"}
        made[f"{kind}_{i}.csv"] = csv(head[kind], *lines)
    return made


@pytest.mark.parametrize("seed", [1, 2])
def test_statuses_do_not_depend_on_batches(spark, tmp_path, seed):
    given = status_files(seed)
    put(tmp_path / "in", given)
    found = []
    for size in (1, 64):
        tables = Tables(spark, str(tmp_path / f"db{size}"))
        query = ingest.start(spark, str(tmp_path / "in"), tables, str(tmp_path / f"progress{size}"), every=None, files_per_batch=size)
        query.awaitTermination()
        found.append({(s, o): st for s, o, st in rows_of(tables)})
    assert found[0] == found[1]
    # The rule itself: the latest row that names the order, or ends it and is no order.
    words = {"COMPLETED": "Perfect", "INCOMPLETE": "Short"}
    orders = {o for _, o in found[0]}
    told = []
    for name, data in given.items():
        for line in data.decode().split("\n")[1:]:
            if name.startswith("AllOrders"):
                told.append((*line.split(","), False))
            elif name.startswith("order_level"):
                number, status = line.replace('"', "").split(",")[:2]
                told.append((number[8:], words.get(status, status), True))
    for (_, order), status in found[0].items():
        about = [s for n, s, suffix in told if n == order or (suffix and order.endswith(n) and n not in orders)]
        assert status == (about[-1] if about else None)


def test_status_audit(spark, tmp_path):
    put(
        tmp_path / "in",
        {
            "Result_1.csv": csv(EXPORT, *[f"6112345678,p{i},FXFE,S1,2025-04-02" for i in (1, 1, 2)], "6,,x,S,2025-04-01", "6,p,x,S,never"),
            "AllOrders_1.csv": csv("Order_Number,Order_Status", "6112345678,Perfect", "6112345678,Short", "6200,Perfect", ",x"),
            "AllOrders_2.csv": csv("Order_Number,Order_Status", "6112345678,12345678901234567890X"),
        },
    )
    tables = Tables(spark, str(tmp_path / "db"))
    audit = {r.file_name: r for r in ingest.load_folder(spark, str(tmp_path / "in"), tables, files_per_batch=2).collect()}
    told = audit["AllOrders_1.csv"]
    assert (told.parsed_rows, told.shipments_updated, told.not_found_rows, told.duplicate_rows) == (3, 4, 1, 0)
    assert (told.rejected_rows, told.reject_reasons) == (1, "missing order number or status: 1")
    sent = audit["Result_1.csv"]
    assert (sent.parsed_rows, sent.unique_rows, sent.inserted_rows, sent.duplicate_rows) == (3, 2, 2, 1)
    assert (sent.duplicate_rows_in_file, sent.duplicate_rows_existing, sent.rejected_rows) == (1, 0, 2)
    assert sent.reject_reasons == "missing or unreadable date: 1; missing sscc18: 1"
    assert (audit["AllOrders_2.csv"].outcome, audit["AllOrders_2.csv"].reason) == ("failed", "text too long")
    assert {s for _, _, s in rows_of(tables)} == {"Short"}


def test_session_in_another_zone_is_refused(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            ingest.load_rows(tables, {}, "b")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parts_are_merged_by_class(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    state = "order_number string, by_suffix boolean, order_status string, file_time timestamp, file_name string, block long, row long, is_order boolean"
    for i in range(4):
        with tables.begin() as load:
            load.append("shipments", shipments(spark, (day(1), f"a{i}", "1", None)))
            load.append("status_rows", spark.createDataFrame([("12345678", True, f"s{i}", day(1 + i), "f", 0, i, i == 1)], state))
    assert ingest.tidy(tables, 5) == 0
    assert ingest.tidy(tables, 4) == 2
    assert [len(p) for p in tables.parts("shipments").values()] == [1]
    assert sorted(r.sscc18 for r in tables.read("shipments").collect()) == ["a0", "a1", "a2", "a3"]
    assert [(r.order_status, r.is_order) for r in tables.read("status_rows").collect()] == [("s3", True)]
    assert ingest.tidy(tables, 2) == 0  # one part of the second class


@pytest.mark.parametrize("seed", range(2))
def test_history_after_each_load_equals_a_rebuild(spark, tmp_path, seed):
    r = random.Random(seed)
    tables = Tables(spark, str(tmp_path / "db"))
    for batch in range(4):
        rows = [
            (datetime(2025, 1, 1) + timedelta(days=r.randrange(90), hours=r.randrange(24)), f"{batch}{i}", Decimal(r.randrange(-900, 900)) / 100,
             "f", ("f", 0, i))
            for i in range(r.choice([1, 3, 12]))
        ]
        frame = spark.createDataFrame(
            rows, "claim_date timestamp, order_id string, claim_amount decimal(10,2), file_name string,"
            " seq struct<file_name:string,block:long,row:long>"
        ).withColumn("sscc18", F.lit(None).cast("string"))
        before = tables.parts("claim_daily_history")
        ingest.load_rows(tables, {"claims": frame}, f"b{batch}")
        whole = series.daily_history(tables.read("claim_details"))
        assert sorted(tables.read("claim_daily_history").collect()) == sorted(whole.collect())
        if batch:  # months before the first new day stay as they are
            first = min(x[0] for x in rows).strftime("%Y-%m")
            after = tables.parts("claim_daily_history")
            assert all(after[m] == before[m] for m in before if m < first)


def test_refreshing_touches_only_months_that_change(spark):
    history = spark.createDataFrame(
        [(date(2025, m, d), Decimal("1.00"), 1, Decimal("1.00")) for m in (1, 2, 3, 4) for d in range(1, 21)], schemas.CLAIM_DAILY_HISTORY
    )
    claims = spark.createDataFrame([(datetime(2025, 2, 18, 5), Decimal("8.00"))], "claim_date timestamp, claim_amount decimal(10,2)")
    days = spark.createDataFrame([(date(2025, 2, 18),)], "day date")
    got = series.refresh_history(history, claims, days)
    assert {r.claim_date.month for r in got.collect()} == {2, 3}
    assert {r.claim_date.day: r.moving_avg_7d for r in got.filter("month(claim_date) = 3 AND day(claim_date) < 6").collect()} == {
        1: Decimal("2.00"), 2: Decimal("2.00"), 3: Decimal("2.00"), 4: Decimal("2.00"), 5: Decimal("1.00")
    }


@pytest.mark.parametrize("seed", range(6))
def test_numbers_against_all_pairs(spark, seed):
    r = random.Random(seed)
    orders = {"".join(r.choice("12") for _ in range(r.randrange(1, 9))): r.randrange(1, 5) for _ in range(60)}
    numbers = {}
    for i in range(40):
        key = ("".join(r.choice("12") for _ in range(r.randrange(1, 8))), r.random() < 0.7)
        numbers[key] = (r.choice([None, None, False, True]), f"s{i}", i)
    told = spark.createDataFrame([(*k, *v) for k, v in numbers.items()], "order_number string, by_suffix boolean, is_order boolean, status string, seq long")
    found = match_numbers(spark.createDataFrame(list(orders.items()), "order_id string, rows long"), told).collect()
    want, touched = {}, {k: 0 for k in numbers}
    for order, rows in orders.items():
        about = []
        for (number, suffix), (known, status, seq) in numbers.items():
            if number == order or (suffix and order.endswith(number) and number not in orders and not known):
                about.append((seq, status))
                touched[number, suffix] += rows
        want[order] = (rows, max(about)[1] if about else None)
    assert {x.text: (x.rows, x.status) for x in found if not x.is_number} == want
    assert {(x.text, x.by_suffix): x.rows for x in found if x.is_number} == touched
    assert all(x.is_order == (x.text in orders or numbers[x.text, x.by_suffix][0] is True) for x in found if x.is_number)


def test_a_progress_folder_made_anew_is_another_stream(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "db"))
    for i, folder in enumerate(("one", "two")):
        put(tmp_path / folder, {f"Result_{i}.csv": csv(EXPORT, f"61{i},p{i},FXFE,S1,2025-04-01")})
        progress = tmp_path / "progress"
        ingest.start(spark, str(tmp_path / folder), tables, str(progress), every=None).awaitTermination()
        progress.rename(tmp_path / f"old{i}")
    assert [s for s, _, _ in rows_of(tables)] == ["p0", "p1"]


def test_places_of_status_rows_are_compared_without_objects_of_their_own():
    """Structs with times come as tuples of whole numbers and texts: one dict and one datetime a row took most of the pass."""
    place = pa.struct([("file_time", pa.timestamp("us", "UTC")), ("file_name", pa.string()), ("row", pa.int64())])
    times = [datetime(2025, 1, 2, tzinfo=timezone.utc), datetime(2025, 1, 1, tzinfo=timezone.utc)]
    rows = [{"file_time": t, "file_name": "a.csv", "row": 2**60 + n} for n, t in enumerate(times)]
    late, early, none = suffix._values(pa.array([*rows, None], place))
    assert late > early and late[1:] == ("a.csv", 2**60) and early[1:] == ("a.csv", 2**60 + 1)
    assert all(type(v) in (int, str) for v in late) and set(none) == {None}
    assert suffix._values(pa.array([True, None])) == [True, None]
    assert suffix._values(pa.array([2**60 + 1, None])) == [2**60 + 1, None]


def test_short_numbers_and_those_with_the_tail_of_an_order_are_looked_at(spark):
    columns = "order_number string, by_suffix boolean, order_status string, file_time timestamp, file_name string, block long, row long, is_order boolean"
    when = datetime(2025, 1, 1)
    told = [(n, True, n, when, "a", 0, i, None) for i, n in enumerate(("12", "1234", "91234", "5678", "91235"))]
    orders = spark.createDataFrame([("7891234",)], "order_id string")
    state = statuses.near(orders, spark.createDataFrame(told, columns))
    assert sorted(r["order_number"] for r in state.collect()) == ["12", "1234", "91234"]
    assert [tuple(r) for r in statuses.resolve(orders, state).collect()] == [("7891234", "91234")]


def test_longer_numbers_are_looked_up_by_more_than_the_tail(spark):
    """Rows that share four characters with an order but not eight were all reduced and met with it in each batch."""
    columns = "order_number string, by_suffix boolean, order_status string, file_time timestamp, file_name string, block long, row long, is_order boolean"
    numbers = ("34567890", "99567890", "1234567890", "9934567890", "67890", "7890", "90", "1234567891")
    told = [(n, True, f"{n}-{i}", datetime(2025, 1, 1 + i), "a", 0, i, None) for n in numbers for i in range(2)]
    orders = spark.createDataFrame([("1234567890",), ("90",)], "order_id string")
    state = statuses.near(orders, spark.createDataFrame(told, columns))
    near = {"34567890", "1234567890", "9934567890", "67890", "7890", "90"}
    assert {(r["order_number"], r["order_status"]) for r in state.collect()} == {(n, f"{n}-1") for n in near}
    assert state.count() == len(near)


def test_stored_shipments_are_looked_up_within_the_ranges_of_the_files(spark, tmp_path, monkeypatch):
    """Each batch met all stored shipments."""
    rows = spark.createDataFrame(
        [("a", "10", "1"), ("a", "19", "1"), ("b", "15", "1"), ("b", "25", "1"), ("c", "40", "1"), ("c", "99", None), ("d", "60", "1")],
        "file_name string, sscc18 string, order_id string",
    )
    assert ingest._ranges(rows) == [("10", "25"), ("40", "40"), ("60", "60")]
    stored = spark.createDataFrame([("10",), ("25",), ("30",), ("40",), ("5",), (None,)], "sscc18 string")
    found = stored.filter(ingest._within(ingest._ranges(rows), F.col("sscc18")))
    assert sorted(r[0] for r in found.collect()) == ["10", "25", "40"]
    assert ingest._ranges(rows.filter("order_id IS NULL")) == []
    assert stored.filter(ingest._within([], F.col("sscc18"))).count() == 0
    monkeypatch.setattr(ingest, "RANGES_AT_MOST", 2)
    assert ingest._ranges(rows) == [("10", "40"), ("60", "60")]
    tables = Tables(spark, str(tmp_path / "db"))
    for i, packages in enumerate((["10", "20", "30"], ["30", "35", "10"], ["05", "20", "99"])):
        lines = [f"61,{p},FXFE,S{i},2025-04-01" for p in packages]
        put(tmp_path / f"in{i}", {f"Result_{i}.csv": csv("order_number,sscc18,scac,kargo_shipment_id,appointment_date", *lines)})
        ingest.load_folder(spark, str(tmp_path / f"in{i}"), tables)
    held = tables.read("shipments").select("sscc18", "shipment_id").collect()
    assert sorted(map(tuple, held)) == [("05", "S2"), ("10", "S0"), ("20", "S0"), ("30", "S0"), ("35", "S1"), ("99", "S2")]
