"""The claim match: was the claimed package or order scanned?

A claim matches a shipment when the package codes are equal, or when the claim's
order number has 7 or 8 characters and ends the shipment's order number. Written
as one condition with OR this becomes a nested loop over claims x shipments.
Here each side is turned into text keys instead - a package key and an order key
per claim, a package key and two suffix keys per shipment - so the match is an
equality lookup. The tag in front keeps package and order keys apart; the length
of an order key already tells 7 from 8.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace.operators import filters
from claimtrace.operators.lookup import HOT_ROWS, attach
from claimtrace.params import Params

# Order statuses, suffix lengths, texts of the claim notes.
PERFECT = "Perfect"
SHORT = "Short"
SUFFIX_LENGTHS = (7, 8)
BY_PACKAGE = "Matched by SSCC18"
BY_ORDER = "Matched by Order ID"
NO_MATCH = "No Matching Shipment"

_SPREAD_BY = ("claim_date", "claim_amount", "order_id", "sscc18")


def package_key(sscc18: Column) -> Column:
    """Package key of a row; NULL and blank codes give none."""
    return F.when(sscc18 != "", F.concat(F.lit("P"), sscc18))


def claim_order_key(order_id: Column) -> Column:
    """Order key of a claim; other lengths never match."""
    return F.when(F.length(order_id).isin(*SUFFIX_LENGTHS), F.concat(F.lit("O"), order_id))


@dataclass(frozen=True)
class MatchKeys:
    """The match keys of the stored shipments, kept by the loads; reports take them in place of the shipments.

    ``counts``: ``match_key scac order_status n``, bucketed by ``match_key``. The ``n`` of a key, carrier and status add
    up to the shipments that have them, so a shipment that changed its status counts where it is now.
    """

    counts: DataFrame

    def chosen(self, params: Params | None, status: str | None) -> DataFrame:
        counts = self.counts if params is None else filters.carriers(self.counts, params)
        return counts if status is None else counts.filter(F.col("order_status") == status)

    def known(self, params: Params | None, status: str | None) -> DataFrame:
        """The keys that some shipment has, each once; grouped where they lie."""
        held = self.chosen(params, status).groupBy("match_key").agg(F.sum("n").alias("n"))
        return held.filter("n > 0").select("match_key")

    def with_status(self, params: Params | None) -> DataFrame:
        """The keys with each status that some shipment has."""
        held = self.chosen(params, None).groupBy("match_key", "order_status").agg(F.sum("n").alias("n"))
        return held.filter("n > 0").drop("n")


def key_rows(shipments: DataFrame, n: Column | int = 1) -> DataFrame:
    """Each key of each shipment, which counts ``n`` times: rows of ``MatchKeys`` not yet added up."""
    each = n if isinstance(n, Column) else F.lit(n)
    counted = shipments.withColumn("n", each.cast("long")).select(
        F.explode(_keys()).alias("match_key"), "scac", "order_status", "n"
    )
    return counted.filter(F.col("match_key").isNotNull())


def added_up(rows: DataFrame) -> DataFrame:
    """One row per key, carrier and status that some shipment has."""
    return rows.groupBy("match_key", "scac", "order_status").agg(F.sum("n").alias("n")).filter("n <> 0")


def key_counts(shipments: DataFrame, n: Column | int = 1) -> DataFrame:
    """Rows of ``MatchKeys`` for shipments, each of which counts ``n`` times."""
    return added_up(key_rows(shipments, n))


def _keys() -> Column:
    """All match keys of a shipment; some can be NULL."""
    keys = [package_key(F.col("sscc18"))]
    for n in SUFFIX_LENGTHS:
        keys.append(
            F.when(
                F.length("order_id") >= n,
                F.concat(F.lit("O"), F.right(F.col("order_id"), F.lit(n))),
            )
        )
    return F.array(*keys)


def shipment_keys(
    shipments: DataFrame | MatchKeys, params: Params | None = None, status: str | None = None
) -> DataFrame:
    """All match keys of the shipments with the order status, one row per shipment and key or less.

    ``params`` restricts the carriers, ``status`` the order status.
    """
    if isinstance(shipments, MatchKeys):
        if status is None:
            return shipments.with_status(params)
        return shipments.known(params, status).withColumn("order_status", F.lit(status))
    if params is not None:
        shipments = filters.carriers(shipments, params)
    if status is not None:
        shipments = shipments.filter(F.col("order_status") == status)
    return shipments.select("order_status", F.explode(_keys()).alias("match_key")).filter(
        F.col("match_key").isNotNull()
    )


def _known(
    shipments: DataFrame | MatchKeys, params: Params | None, status: str | None
) -> DataFrame:
    if isinstance(shipments, MatchKeys):
        keys = shipments.known(params, status)
    else:
        keys = shipment_keys(shipments, params, status).select("match_key").distinct()
    return keys.withColumn("hit", F.lit(True))


def with_hits(
    claims: DataFrame,
    shipments: DataFrame | MatchKeys,
    params: Params | None = None,
    status: str | None = PERFECT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Claims plus ``package_hit`` and ``order_hit``, never NULL."""
    wanted = {
        "package_hit": package_key(F.col("sscc18")),
        "order_hit": claim_order_key(F.col("order_id")),
    }
    known = _known(shipments, params, status)
    hits = attach(claims, wanted, known, "match_key", "hit", _SPREAD_BY, hot_rows)
    return hits.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in wanted})


def with_match(
    claims: DataFrame,
    shipments: DataFrame | MatchKeys,
    params: Params | None = None,
    status: str | None = PERFECT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Claims plus ``matched``, never NULL; rows and their number stay as they are."""
    hits = with_hits(claims, shipments, params, status, hot_rows)
    return hits.withColumn("matched", F.col("package_hit") | F.col("order_hit")).drop(
        "package_hit", "order_hit"
    )


def matched_claims(
    claims: DataFrame,
    shipments: DataFrame | MatchKeys,
    params: Params | None = None,
    status: str | None = PERFECT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Claims that a shipment matches."""
    return (
        with_match(claims, shipments, params, status, hot_rows).filter("matched").drop("matched")
    )


def unmatched_claims(
    claims: DataFrame,
    shipments: DataFrame | MatchKeys,
    params: Params | None = None,
    status: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Claims that no shipment matches."""
    return (
        with_match(claims, shipments, params, status, hot_rows).filter(~F.col("matched"))
        .drop("matched")
    )


def with_match_few(
    claims: DataFrame,
    shipments: DataFrame | MatchKeys,
    params: Params | None = None,
    status: str | None = None,
) -> DataFrame:
    """``with_match`` for a page of claims, at most a few thousand rows.

    The caller bounds ``claims`` by a LIMIT. Their keys are broadcast and the
    shipments are scanned once without a shuffle of their rows.
    """
    keyed = claims.withColumns(
        {
            "_package": package_key(F.col("sscc18")),
            "_order": claim_order_key(F.col("order_id")),
        }
    )
    asked = keyed.select(F.explode(F.array("_package", "_order")).alias("match_key")).distinct()
    known = (
        shipment_keys(shipments, params, status)
        .select("match_key")
        .join(F.broadcast(asked), "match_key", "left_semi")
        .distinct()
    )
    # At most two keys per claim of the page are left.
    for slot, hit in (("_package", "_package_hit"), ("_order", "_order_hit")):
        side = F.broadcast(known.select(F.col("match_key").alias(hit)))
        keyed = keyed.join(side, F.col(slot) == F.col(hit), "left")
    return keyed.withColumn(
        "matched", F.col("_package_hit").isNotNull() | F.col("_order_hit").isNotNull()
    ).drop("_package", "_order", "_package_hit", "_order_hit")


def with_reason(
    claims: DataFrame,
    shipments: DataFrame | MatchKeys,
    params: Params | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Claims plus ``order_scanned``, ``match_reason`` and ``order_status``.

    The status is the best one among the shipments that match: Perfect, else
    Short, else any other, else a dash.
    """
    status = F.col("order_status")
    rank = (
        F.when(status == PERFECT, 0)
        .when(status == SHORT, 1)
        .when(status.isNotNull(), 2)
        .otherwise(3)
    )
    keys = shipment_keys(shipments, params)
    # The rank is a number, so this aggregate hashes; texts are only kept for rare statuses.
    ranked = keys.groupBy("match_key").agg(F.min(rank).alias("rank"))
    rare = keys.filter(rank == 2).groupBy("match_key").agg(F.min("order_status").alias("rare"))
    text = (
        F.when(F.col("rank") == 0, F.lit(PERFECT))
        .when(F.col("rank") == 1, F.lit(SHORT))
        .when(F.col("rank") == 2, F.col("rare"))
    )
    best = ranked.join(rare, "match_key", "left").select(
        "match_key", F.struct("rank", text.alias("status")).alias("best")
    )
    wanted = {
        "_by_package": package_key(F.col("sscc18")),
        "_by_order": claim_order_key(F.col("order_id")),
    }
    found = attach(claims, wanted, best, "match_key", "best", _SPREAD_BY, hot_rows)
    by_package, by_order = F.col("_by_package"), F.col("_by_order")
    return found.withColumns(
        {
            "order_scanned": F.coalesce(by_package, by_order).isNotNull(),
            "match_reason": F.when(by_package.isNotNull(), F.lit(BY_PACKAGE))
            .when(by_order.isNotNull(), F.lit(BY_ORDER))
            .otherwise(F.lit(NO_MATCH)),
            "order_status": F.coalesce(F.least(by_package, by_order)["status"], F.lit("-")),
        }
    ).drop("_by_package", "_by_order")


def scanned_by_status(reasoned: DataFrame) -> DataFrame:
    """Count and amount of claims by scanned flag and order status."""
    return reasoned.groupBy("order_scanned", "order_status").agg(
        F.count(F.lit(1)).alias("claims"), F.sum(F.abs("claim_amount")).alias("amount")
    )
