"""Merge operators against a row-by-row model."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from claimtrace import schemas
from claimtrace.operators import merge
from claimtrace.streaming import ingest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQ = T.StructField("seq", schemas.SEQ)
DAY = datetime(2025, 1, 1)


def with_seq(schema):
    return T.StructType([*schema.fields, SEQ])


def shipment_rows(rng, n, file="a.csv"):
    return [
        (
            DAY + timedelta(days=rng.randrange(70)), None, f"s{rng.randrange(12)}", "FXFE",
            rng.choice([None, "", "61", "62", "63"]), f"id{i}", (file, 0, i),
        )
        for i in range(n)
    ]


def shipments(spark, rows):
    parsed = spark.createDataFrame(rows, with_seq(schemas.SHIPMENT_ROW))
    return parsed


@pytest.mark.parametrize("seed", [1, 2])
def test_insert_ignore(spark, seed):
    rng = random.Random(seed)
    old, new = shipment_rows(rng, 30), shipment_rows(rng, 40, "b.csv")
    seen, table = set(), []
    counts = []
    for rows in (old, new):
        inserted = 0
        for r in rows:
            key = (r[2], r[4])
            if r[4] is None or key not in seen:
                seen.add(key)
                table.append(r[:6])
                inserted += 1
        counts.append((len(rows), len({(r[2], r[4] or "") for r in rows}), inserted))
    empty = spark.createDataFrame([], schemas.SHIPMENTS)
    first = merge.insert_ignore_shipments(empty, shipments(spark, old))
    held = schemas.conform(first, schemas.SHIPMENTS)
    second = merge.insert_ignore_shipments(held, shipments(spark, new))
    columns = schemas.SHIPMENT_ROW.fieldNames()
    got = first.select(columns).unionByName(second.select(columns)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, table))
    stats = merge.shipment_stats(shipments(spark, new), second).first()
    parsed, unique, inserted = counts[1]
    assert stats.asDict() == {
        "parsed_rows": parsed, "unique_rows": unique, "inserted_rows": inserted,
        "duplicate_rows": parsed - inserted, "duplicate_rows_in_file": parsed - unique,
        "duplicate_rows_existing": max(unique - inserted, 0),
    }
    few = merge.insert_ignore_shipments(held, shipments(spark, new), small=True)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, second.collect()))
    # Again: only rows without an order come in.
    again = merge.insert_ignore_shipments(
        held.unionByName(schemas.conform(second, schemas.SHIPMENTS)), shipments(spark, new)
    )
    assert again.filter("order_id is not null").count() == 0
    assert again.count() == sum(1 for r in new if r[4] is None)


def test_insert_ignore_rma(spark):
    rows = [("A", Decimal("1.0000"), 1), ("A", Decimal("1.0000"), 1), ("A", None, 1), ("A", None, 1),
            ("B", Decimal("2.0000"), None)]
    batch = spark.createDataFrame(
        [(*r, ("f", 0, i)) for i, r in enumerate(rows)],
        T.StructType([*schemas.RMA_CREDITS.fields[:3], SEQ]),
    )
    empty = spark.createDataFrame([], schemas.RMA_CREDITS)
    fresh = merge.insert_ignore_rma(empty, batch)
    assert fresh.count() == 4
    assert {r.claim_type for r in fresh.collect()} == {"Short Shipment"}
    assert merge.rma_stats(batch, fresh).first().unique_rows == 3


def claim(rng, i, file):
    row = [None] * len(schemas.CLAIM_ROW.fields)
    row[0] = DAY + timedelta(days=rng.randrange(3))
    row[1] = rng.choice([None, "", "61"])
    row[2] = rng.choice([None, "", "s"])
    row[3] = Decimal(rng.choice(["1.00", "2.00"]))
    row[4], row[5] = f"type{i}{file}", rng.choice([None, f"bp{i}"])
    for place in (6, 8, 15, 26):
        name = schemas.CLAIM_ROW.fields[place]
        if rng.random() < 0.6:
            row[place] = i if isinstance(name.dataType, T.IntegerType) else f"{name.name}{i}{file}"
    return (*row, (file, 0, i))


def model_key(r):
    return (r[0], r[1] or "", r[2] or "", r[3])


@pytest.mark.parametrize("seed", [3, 4])
def test_upsert(spark, seed):
    rng = random.Random(seed)
    loads = [[claim(rng, i, "a") for i in range(25)], [claim(rng, i, "b") for i in range(25)],
             [claim(rng, i, "c") for i in range(25)]]
    table = {}
    stats = []
    for rows in loads:
        last = {model_key(r): r for r in rows}
        inserted = 0
        for key, r in last.items():
            if key not in table:
                table[key] = list(r[:-1])
                inserted += 1
                continue
            for place in range(6, len(r) - 1):
                if r[place] is not None:
                    table[key][place] = r[place]
        stats.append((len(rows), len(last), inserted))
    schema = with_seq(schemas.CLAIM_ROW)
    columns = schemas.CLAIM_ROW.fieldNames()
    empty = spark.createDataFrame([], schemas.CLAIM_DETAILS)
    first = merge.upsert_claims(empty, spark.createDataFrame(loads[0], schema))
    # The second and third file come in one load.
    both = spark.createDataFrame(loads[1] + loads[2], schema)
    for small in (False, True):
        result = merge.upsert_claims(first, both, small).select(columns).collect()
        assert sorted(map(repr, map(tuple, result))) == sorted(map(repr, map(tuple, table.values())))
    counted = merge.upsert_stats(first, spark.createDataFrame(loads[1], schema)).first()
    parsed, unique, inserted = stats[1]
    assert counted.asDict() == {
        "parsed_rows": parsed, "unique_rows": unique, "inserted_rows": inserted,
        "updated_rows": unique - inserted, "duplicate_rows_in_file": parsed - unique,
    }


def test_amounts_equal_after_rounding_are_one_claim(spark):
    rows = [(DAY, "1", "", 10.001, ("f", 0, 0)), (DAY, "1", None, 10.002, ("f", 0, 1))]
    frame = spark.createDataFrame(
        rows, "claim_date timestamp, order_id string, sscc18 string, claim_amount double,"
        " seq struct<file_name:string,block:long,row:long>"
    )
    kept = merge.keep_last(frame).collect()
    assert [(r.claim_amount, r.seq.row) for r in kept] == [(Decimal("10.00"), 1)]


STATUS = "order_number string, order_status string, seq struct<file_name:string,block:long,row:long>"


@pytest.mark.parametrize(("hot_rows", "small"), [(3, False), (1_000_000, False), (1, True)])
@pytest.mark.parametrize("by_suffix", [False, True])
def test_status_updates(spark, by_suffix, hot_rows, small):
    rng = random.Random(5)
    orders = [None, "", "12345678", "912345678", "812345678", "5678", "77", "0005678"]
    table = [
        (DAY, None, f"s{i}", "C", rng.choice(orders), f"{i}", None, None, rng.choice([None, "Old"]))
        for i in range(60)
    ]
    numbers = ["12345678", "5678", "77", "678", "nothing", "45678"]
    rows = [(rng.choice(numbers), f"st{i}", ("f", 0, i)) for i in range(25)]
    status = {r[2]: r[8] for r in table}
    updated = missing = 0
    for number, value, _ in rows:
        hit = [r[2] for r in table if r[4] == number]
        if not hit and by_suffix:
            hit = [r[2] for r in table if r[4] is not None and r[4][-len(number):] == number]
        for s in hit:
            status[s] = value
        updated += len(hit)
        missing += not hit
    target = spark.createDataFrame(table, schemas.SHIPMENTS)
    batch = spark.createDataFrame(rows, STATUS)
    if by_suffix:
        after = merge.update_status_suffix(target, batch, hot_rows, small)
        stats = merge.update_status_suffix_stats(target, batch, hot_rows)
    else:
        after = merge.update_status(target, batch, hot_rows, small)
        stats = merge.update_status_stats(target, batch)
    assert {r.sscc18: r.order_status for r in after.collect()} == status
    assert after.columns == target.columns
    assert tuple(stats.first()) == (len(rows), updated, missing)


def test_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], schemas.SHIPMENTS)
    batch = shipments(spark, [])
    fresh = merge.insert_ignore_shipments(empty, batch)
    assert tuple(merge.shipment_stats(batch, fresh).first()) == (0,) * 6
    none = spark.createDataFrame([], STATUS)
    assert tuple(merge.update_status_stats(empty, none).first()) == (0, 0, 0)
    assert tuple(merge.update_status_suffix_stats(empty, none).first()) == (0, 0, 0)


def test_length_limits(spark):
    rows = spark.createDataFrame([("x" * 31, "a"), ("x" * 30, None)], "sscc18 string, scac string")
    assert schemas.over_long(rows, "shipments").count() == 1


def test_missing_columns_become_null(spark):
    row = schemas.conform(spark.createDataFrame([("1",)], "sscc18 string"), schemas.SHIPMENTS).first()
    assert row.sscc18 == "1" and row.order_status is None


def test_table_count(spark):
    assert merge.table_count(spark.range(5)).first().rows == 5
    assert merge.table_count(spark.range(5).filter(F.lit(False))).first().rows == 0


def test_one_file_needs_no_fold(spark):
    rows = [(1, "o", "1", "S"), (2, "o", "1", None), (3, None, "2", "T"), (4, "", "2", "U")]
    batch = spark.createDataFrame(
        [(datetime(2025, 1, 1), o, None, Decimal(a), s, ("f", 0, i)) for i, o, a, s in rows],
        "claim_date timestamp, order_id string, sscc18 string, claim_amount decimal(10,2), rma_status string,"
        " seq struct<file_name:string,block:long,row:long>",
    )
    batch = batch.withColumns({c: F.lit("x") for c in ("claim_type", "carrier_bp")})
    held = batch.filter("seq.row = 1").drop("seq")
    folded = merge.upsert_claims(held, batch)
    assert sorted(map(repr, merge.upsert_claims(held, batch, one_file=True).collect())) == sorted(map(repr, folded.collect()))


def test_claims_of_one_file_are_shuffled_once(spark):
    rows = spark.createDataFrame(
        [(datetime(2025, 1, 1), "o", "p", Decimal("1.00"), "T", "C", ("f", 1))],
        "claim_date timestamp, order_id string, sscc18 string, claim_amount decimal(10,2), claim_type string, carrier_bp string,"
        " seq struct<file_name:string,row:long>",
    )
    merged = merge.upsert_claims(rows.drop("seq"), rows, one_file=True).hint("merge")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 2


def test_keys_of_one_file_are_counted_as_those_of_many(spark):
    keys = "claim_date timestamp, order_id string, sscc18 string, claim_amount decimal(10,2)"
    dates, amounts = [datetime(2025, 1, d) for d in (1, 2, 3)], [Decimal("1.00"), Decimal("2.00"), None]
    r = random.Random(3)
    drawn = [(r.choice(dates), r.choice(["o", "", None]), r.choice(["p", None]), r.choice(amounts)) for _ in range(40)]
    held = spark.createDataFrame(drawn[:12], keys)
    rows = spark.createDataFrame([(*row, ("f", i)) for i, row in enumerate(drawn)], keys + ", seq struct<file_name:string,row:long>")
    got = [
        ([d.day for d in days.orderBy("day").collect()], told.select("file_name", "uniques", "inserted").collect())
        for days, told in (ingest._keys_of_one_file(rows, held), ingest._keys_of_files(rows, held))
    ]
    assert got[0] == got[1] and got[0][1][0].inserted > 0


def broadcasts(spark, frame):
    """The keys that a frame's plan broadcasts by."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    return re.findall(r"HashedRelationBroadcastMode\(List\((.*?)\),", plan)


def test_small_batches_broadcast_numbers_of_their_keys(spark):
    ships = "sscc18 string, order_id string, scac string, seq struct<file_name:string,row:long>"
    batch = spark.createDataFrame([("p", "o", "S", ("f", 1)), ("q", "o", "S", ("f", 2)), (None, "o", "S", ("f", 3))], ships)
    held = batch.filter("seq.row <> 2").drop("seq")
    fresh = merge.insert_ignore(held, batch, merge.SHIPMENT_KEY, small=True)
    assert sorted(r["sscc18"] or "" for r in fresh.collect()) == ["", "q"]
    sent = broadcasts(spark, fresh)
    assert sent and all(s == "input[0, bigint, false]" for s in sent)

    days = [datetime(2025, 1, 1), None]
    claims = spark.createDataFrame(
        [(d, "o", p, Decimal("1.004"), f"T{p}", "C", ("f", i)) for i, (d, p) in enumerate([(d, p) for d in days for p in "abc"])],
        "claim_date timestamp, order_id string, sscc18 string, claim_amount decimal(14,3), claim_type string, carrier_bp string,"
        " seq struct<file_name:string,row:long>",
    )
    # Amounts of other types are equal keys too; those without a date equal none.
    stored = claims.filter("sscc18 <> 'b'").withColumn("claim_amount", F.col("claim_amount").cast("decimal(10,2)")).drop("seq")
    merged = merge.upsert_claims(stored, claims, small=True)
    large = merge.upsert_claims(stored, claims)
    assert merged.filter("claim_date IS NOT NULL").count() == 3
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, large.collect()))
    sent = broadcasts(spark, merged)
    assert sent and all(s == "input[0, bigint, false]" for s in sent)


def test_stored_keys_are_not_broadcast_by_estimate(spark, tmp_path):
    """Equal values take few bytes in files, so many stored keys look small."""
    spark.range(50_000).selectExpr("'C' AS carrier_bp", "CAST(1 AS DECIMAL(15,4)) AS credit", "1 AS count").write.parquet(str(tmp_path / "held"))
    held = spark.read.parquet(str(tmp_path / "held"))
    batch = held.limit(10).withColumn("seq", F.lit(1))
    plan = merge.insert_ignore(held, batch, merge.RMA_KEY)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
