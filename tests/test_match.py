from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import pytest
from claimtrace.operators import match
from claimtrace.operators.lookup import attach
from claimtrace.params import Params
from pyspark.sql import functions as F

PARAMS = Params(datetime(2025, 1, 1), datetime(2025, 12, 31), datetime(2025, 6, 1).date(), ("A", "B"))
CLAIM = "claim_date timestamp, claim_amount decimal(10,2), order_id string, sscc18 string, n int"
SHIPMENT = "sscc18 string, order_id string, scac string, order_status string"


def refers(claim, shipment):
    order, package = claim[2], claim[3]
    if package and package == shipment[0]:
        return "package"
    if order and shipment[1] and len(order) in (7, 8) and shipment[1][-len(order):] == order:
        return "order"
    return None


@pytest.fixture(scope="module")
def data():
    rng = random.Random(9)
    orders = [None, "", "1234567", "12345678", "012345678", "91234567", "123456", "7654321", "99"]
    shipments = [
        (rng.choice(["", "p1", "p2", "p3", None]), rng.choice(orders), rng.choice(["A", "B", "C", None]),
         rng.choice(["Perfect", "Short", None, "Other"]))
        for _ in range(25)
    ]
    claims = [
        (datetime(2025, 2, 1), Decimal(i), rng.choice([*orders, "2345678"]),
         rng.choice([None, "", "p1", "p3", "p9"]), i)
        for i in range(80)
    ]
    return shipments, claims


def frames(spark, data):
    shipments, claims = data
    return spark.createDataFrame(shipments, SHIPMENT), spark.createDataFrame(claims, CLAIM)


@pytest.mark.parametrize("hot_rows", [1, 4, 1_000_000])
@pytest.mark.parametrize(("params", "status"), [(PARAMS, "Perfect"), (PARAMS, None), (None, None)])
def test_match_equals_nested_loop(spark, data, params, status, hot_rows):
    shipments, claims = data
    usable = [
        s for s in shipments
        if (params is None or s[2] in params.carriers) and (status is None or s[3] == status)
    ]
    expected = {c[4]: any(refers(c, s) for s in usable) for c in claims}
    sh, cl = frames(spark, data)
    flagged = match.with_match(cl, sh, params, status, hot_rows)
    assert {r.n: r.matched for r in flagged.collect()} == expected
    assert flagged.count() == len(claims)
    few = match.with_match_few(cl, sh, params, status)
    assert {r.n: r.matched for r in few.collect()} == expected
    hit = {r.n for r in match.matched_claims(cl, sh, params, status, hot_rows).collect()}
    miss = {r.n for r in match.unmatched_claims(cl, sh, params, status, hot_rows).collect()}
    assert hit == {n for n, m in expected.items() if m}
    assert miss == {n for n, m in expected.items() if not m}


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_reasons(spark, data, hot_rows):
    shipments, claims = data
    rank = {"Perfect": 0, "Short": 1, "Other": 2, None: 3}
    expected = {}
    for c in claims:
        hits = [(s, refers(c, s)) for s in shipments]
        statuses = [s[3] for s, why in hits if why or (
            c[2] and s[1] and len(c[2]) in (7, 8) and s[1][-len(c[2]):] == c[2])]
        kinds = {why for _, why in hits}
        why = match.BY_PACKAGE if "package" in kinds else match.BY_ORDER if "order" in kinds else match.NO_MATCH
        best = min(statuses, key=rank.get) if statuses else None
        expected[c[4]] = (why, why != match.NO_MATCH, best or "-")
    sh, cl = frames(spark, data)
    got = match.with_reason(cl, sh, hot_rows=hot_rows).collect()
    assert {r.n: (r.match_reason, r.order_scanned, r.order_status) for r in got} == expected
    matrix = match.scanned_by_status(match.with_reason(cl, sh)).collect()
    assert sum(r.claims for r in matrix) == len(claims)


def test_attach_with_one_key_in_most_rows(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("key"),
        "id",
    )
    lookup = spark.createDataFrame([("hot", 1), ("k4", 2), ("other", 3)], "key string, v int")
    out = attach(rows, {"v": F.col("key")}, lookup, "key", "v", ["id"], hot_rows=500)
    assert out.count() == 3000
    assert {(r.v, r["count"]) for r in out.groupBy("v").count().collect()} == {(1, 1000), (2, 1), (None, 1999)}


def test_plan_has_no_nested_loop(spark, data):
    sh, cl = frames(spark, data)
    plan = match.with_match(cl, sh, PARAMS)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
