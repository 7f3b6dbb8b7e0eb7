"""The report queries."""

from __future__ import annotations

from dataclasses import replace

from claimtrace.plans import monthly, scans, summary, volume
from registry.views import (
    BU, CF, CT, CTF, FROM, LAST_MONTH, MONTH, PARAMS, STF, TO, WITH_BOTH, WITH_CL, WITH_SH,
    Query, claims, flagged, from_views, match_keys, plain, rounded, shipments,
)

_PERFECT = f"{CF} AND order_status = 'Perfect'"
_REPORT = f"{CTF} AND {CT} AND {BU}"
_FLAGGED = f"{WITH_BOTH}, f AS ({flagged(_REPORT, _PERFECT)})"
_LAST = f"claim_date >= {LAST_MONTH} AND claim_date < {MONTH} AND {CT} AND {BU}"
_FLAGGED_LAST = f"{WITH_BOTH}, f AS ({flagged(_LAST, _PERFECT)})"
_EARLIER = f"claim_date >= {FROM} AND claim_date < {MONTH}"
_AMOUNT = "CAST(coalesce(round(sum(abs(claim_amount)), 2), 0) AS DOUBLE)"
_DAYS = (
    "days AS (SELECT CAST(d AS DATE) AS day FROM generate_series("
    f"{FROM}, {TO}, INTERVAL 1 DAY) t(d))"
)
_WARM_DAYS = (
    "days AS (SELECT CAST(d AS DATE) AS day FROM generate_series("
    f"{FROM} - INTERVAL 6 DAY, {TO}, INTERVAL 1 DAY) t(d))"
)


def _mom(table: str, value: str, name: str, earlier: str, whole: str, head: str) -> str:
    return (
        f"{head} SELECT {LAST_MONTH} AS time, {value} AS {name} FROM {table} WHERE {earlier}"
        f" UNION ALL SELECT {MONTH}, {value} FROM {table} WHERE {whole}"
    )


def _half_up(part: str, total: str, factor: int) -> str:
    """factor * part / total rounded half up, in whole-number arithmetic."""
    return (
        f"((2 * {factor} * CAST({part} AS HUGEINT) + CAST({total} AS HUGEINT))"
        f" // (2 * nullif(CAST({total} AS HUGEINT), 0)))"
    )


def _commas(expression: str) -> str:
    return f"format('{{:,}}', CAST({expression} AS BIGINT))"


def _cents(condition: str | None = None) -> str:
    inner = "abs(claim_amount) * 100"
    if condition:
        inner = f"CASE WHEN {condition} THEN {inner} END"
    return f"coalesce(sum(CAST({inner} AS BIGINT)), 0)"


def _dollars(cents: str) -> str:
    return f"(({cents} + 50) // 100)"


def _avg_query(days: str, value: str, facts: str, cut_first: bool, outputs: str) -> str:
    window = f"avg(CAST({value} AS DOUBLE)) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    inside = f"day >= CAST({FROM} AS DATE)"
    if cut_first:
        return f"{facts} SELECT {outputs.format(avg=f'round({window}, 4)')} FROM daily WHERE {inside}"
    return (
        f"{facts}, w AS (SELECT *, {window} AS a FROM daily)"
        f" SELECT {outputs.format(avg='round(a, 4)')} FROM w WHERE {inside}"
    )


def _daily_claims(days: str) -> str:
    return (
        f"{WITH_CL}, {days}, daily AS (SELECT day, coalesce(sum(abs(claim_amount)), 0) AS total,"
        " count(claim_date) AS n FROM days LEFT JOIN cl ON CAST(claim_date AS DATE) = day"
        f" AND {CT} GROUP BY day)"
    )


def _daily_ratio(days: str) -> str:
    per_mille = _half_up("claims", "scans", 10000)
    return (
        f"{WITH_BOTH}, {days}, s AS (SELECT CAST(appointment_date AS DATE) AS day, count(*) AS scans"
        f" FROM sh WHERE {CF} GROUP BY 1),"
        f" c AS (SELECT CAST(claim_date AS DATE) AS day, count(*) AS claims FROM cl WHERE {CT}"
        " GROUP BY 1), daily AS (SELECT days.day,"
        f" coalesce(CAST({per_mille} AS DOUBLE) / 10, 0) AS r FROM days"
        " LEFT JOIN s ON s.day = days.day LEFT JOIN (SELECT days.day, coalesce(claims, 0) AS claims"
        " FROM days LEFT JOIN c ON c.day = days.day) c2 ON c2.day = days.day)"
    )


_CLAIM_AVG_COLUMNS = (
    "CAST(day AS TIMESTAMP) AS time, CAST(total AS DOUBLE) AS claims_amount,"
    " {avg} AS moving_avg_7, n AS claim_count"
)
_RATIO_AVG_COLUMNS = "CAST(day AS TIMESTAMP) AS time, r AS claims_per_1000, {avg} AS avg_ratio_7"


def _claims_days(condition: str) -> str:
    return (
        f"{WITH_CL} SELECT {_commas('count(*)')} || ' / ' ||"
        f" CAST(count(DISTINCT CAST(claim_date AS DATE)) AS VARCHAR) || ' Days' AS claims_days"
        f" FROM cl WHERE {condition} AND {CT}"
    )


def _large_share(condition: str) -> str:
    large = "count(*) FILTER (WHERE abs(claim_amount) >= 50000)"
    tenths = _half_up(large, "count(*)", 1000)
    return (
        f"{WITH_CL} SELECT CAST({large} AS VARCHAR) || ' / ' || CAST({tenths} // 10 AS VARCHAR)"
        f" || '.' || CAST({tenths} % 10 AS VARCHAR) || '%' AS large_share"
        f" FROM cl WHERE {condition} AND {CT}"
    )


_CUTOVER = "TIMESTAMP '1998-05-01'"
_WIDE = replace(PARAMS, order_contains="9", sscc_contains="")


def _rounded(build, *needed: str, round_columns: dict[str, int], **options) -> Query:
    sources = {"sh": shipments, "cl": claims, "keys": match_keys}

    def run(spark, sf_dir):
        frames = [sources[n](spark, sf_dir) for n in needed]
        return plain(rounded(build(*frames, **options), **round_columns))

    return run


def _k(build, *needed: str) -> Query:
    return from_views(build, *needed, params=PARAMS)


QUERIES: dict[str, Query] = {
    "k1_orders_shipped_mom": _k(summary.orders_shipped_mom, "sh"),
    "k2_claims_submitted_mom": _k(summary.claims_submitted_mom, "cl"),
    "k3_verified_shortages_mom": _k(summary.verified_shortages_mom, "keys", "cl"),
    "k4_saved_mom": _k(summary.saved_mom, "keys", "cl"),
    "k5_weekly_orders_vs_claims": _k(summary.weekly_orders_vs_claims, "sh", "cl"),
    "k6_verified_invalid_by_customer": _k(summary.verified_invalid_by_customer, "keys", "cl"),
    "k7_saved_total": _k(summary.saved_total, "keys", "cl"),
    "k8_verified_shortage_details": _k(summary.verified_shortage_details, "keys", "cl"),
    "k9_shipments_per_hour": _k(volume.shipments_per_hour, "sh"),
    "k10_total_shipments": _k(volume.total_shipments, "sh"),
    "k11_unique_carriers": _k(volume.unique_carriers, "sh"),
    "k12_unique_orders": _k(volume.unique_orders, "sh"),
    "k13_shipments_per_day": _k(volume.shipments_per_day, "sh"),
    "k14_shipment_details": _k(volume.shipment_details, "sh"),
    "k15_perfect_orders": _k(volume.perfect_orders, "sh"),
    "k16_short_orders": _k(volume.short_orders, "sh"),
    "k17_total_claim_amount": _k(scans.total_claim_amount, "cl"),
    "k18_total_claim_count": _k(scans.total_claim_count, "cl"),
    "k19_claims_per_1000_scans": _k(scans.claims_per_1000_scans, "sh", "cl"),
    "k20_daily_scans_spine": _k(scans.daily_scans_spine, "sh"),
    "k21_daily_claims_moving_avg": _rounded(
        scans.daily_claims_moving_avg, "cl", round_columns={"moving_avg_7": 4}, params=PARAMS
    ),
    "k21_daily_claims_moving_avg_warm_up": _rounded(
        scans.daily_claims_moving_avg,
        "cl",
        round_columns={"moving_avg_7": 4},
        params=PARAMS,
        warm_up=True,
    ),
    "k22_daily_claims_per_1000": _rounded(
        scans.daily_claims_per_1000, "sh", "cl", round_columns={"avg_ratio_7": 4}, params=PARAMS
    ),
    "k22_daily_claims_per_1000_warm_up": _rounded(
        scans.daily_claims_per_1000,
        "sh",
        "cl",
        round_columns={"avg_ratio_7": 4},
        params=PARAMS,
        warm_up=True,
    ),
    "k23_days_since_large_claim": _k(scans.days_since_large_claim, "cl"),
    "k24_before_claims_days": _k(scans.before_claims_days, "cl"),
    "k25_after_claims_days": _k(scans.after_claims_days, "cl"),
    "k26_before_large_share": _k(scans.before_large_share, "cl"),
    "k27_after_large_share": _k(scans.after_large_share, "cl"),
    "k28_claim_log": _k(scans.claim_log, "sh", "cl"),
    "k28_claim_log_containing": from_views(scans.claim_log, "sh", "cl", params=_WIDE),
    "k29_scan_log": _k(scans.scan_log, "sh"),
    "k30_claims_received_monthly": _k(monthly.claims_received_monthly, "cl"),
    "k31_would_have_paid_monthly": _k(monthly.would_have_paid_monthly, "cl"),
    "k32_refutable_monthly": _k(monthly.refutable_monthly, "keys", "cl"),
    "k33_avoidable_spend_monthly": _k(monthly.avoidable_spend_monthly, "keys", "cl"),
    "k34_actually_paid_monthly": _k(monthly.actually_paid_monthly, "cl"),
    "k35_paid_vs_should_have": _k(monthly.paid_vs_should_have, "keys", "cl"),
    "k36_coverage_claims_pct": _k(monthly.coverage_claims_pct, "keys", "cl"),
    "k37_coverage_dollars_pct": _k(monthly.coverage_dollars_pct, "keys", "cl"),
    "k38_received_vs_refutable": _k(monthly.received_vs_refutable, "keys", "cl"),
    "k39_monthly_summary": _k(monthly.monthly_summary, "keys", "cl"),
    "k40_missed_claims_last_month": _k(monthly.missed_claims_last_month, "keys", "cl"),
    "k41_missed_savings_last_month": _k(monthly.missed_savings_last_month, "keys", "cl"),
    "k42_bottom_line_text": _k(monthly.bottom_line_text, "keys", "cl"),
}

_CLAIMS = f"{CT} AND {BU}"
_VERIFIED = f"{WITH_BOTH}, f AS ({flagged(_CLAIMS, _PERFECT)})"
_CUSTOMER = "coalesce(ship_to_name, address_name, 'Unknown')"


def _value(select: str, table: str, where: str, head: str) -> str:
    return f"{head} SELECT {select} AS value FROM {table} WHERE {where}"


def _monthly(select: str, source: str) -> str:
    return f"SELECT date_trunc('month', claim_date)::TIMESTAMP AS time, {select} FROM {source} GROUP BY 1"


def _claim_log(extra: str) -> str:
    return (
        f"{WITH_BOTH}, f AS ({flagged(f'{CTF} AND {CT} AND {extra}', 'TRUE')})"
        " SELECT strftime(claim_date, '%b %d, %Y') AS claim_date, order_id, sscc18,"
        " CASE WHEN matched THEN '✓ Valid' ELSE '✗ Not Scanned' END AS validation_status"
        " FROM f ORDER BY f.claim_date DESC, order_id NULLS FIRST, sscc18 NULLS FIRST LIMIT 500"
    )


def _dollar_text(condition: str) -> str:
    return f"'$' || {_commas(_dollars(_cents(condition)))}"


_SCANS_REPORT = f"{STF} AND {CF}"

ORACLES: dict[str, str] = {
    "k1_orders_shipped_mom": _mom(
        "sh",
        "count(DISTINCT order_id)",
        "orders_shipped",
        f"appointment_date >= {FROM} AND appointment_date < {MONTH} AND {CF}",
        _SCANS_REPORT,
        WITH_SH,
    ),
    "k2_claims_submitted_mom": _mom(
        "cl", "count(*)", "claims_submitted", f"{_EARLIER} AND {_CLAIMS}", _REPORT, WITH_CL
    ),
    "k3_verified_shortages_mom": _mom(
        "f", "count(*)", "verified_shortages", f"matched AND {_EARLIER}", f"matched AND {CTF}", _VERIFIED
    ),
    "k4_saved_mom": _mom(
        "f", _AMOUNT, "saved", f"matched AND {_EARLIER}", f"matched AND {CTF}", _VERIFIED
    ),
    "k5_weekly_orders_vs_claims": (
        f"{WITH_BOTH}, cw AS (SELECT date_trunc('week', claim_date) AS d, count(*) AS c FROM cl"
        f" WHERE {_REPORT} GROUP BY 1), sw AS (SELECT date_trunc('week', appointment_date) AS d,"
        f" count(DISTINCT order_id) AS o FROM sh WHERE {_SCANS_REPORT} GROUP BY 1)"
        " SELECT coalesce(cw.d, sw.d)::TIMESTAMP AS time, coalesce(o, 0) AS orders_shipped,"
        " coalesce(c, 0) AS claims_submitted FROM cw FULL JOIN sw ON sw.d = cw.d"
    ),
    "k6_verified_invalid_by_customer": (
        f"{WITH_BOTH}, f AS ({flagged(_REPORT, CF)}) SELECT {_CUSTOMER} AS customer,"
        " count(*) FILTER (WHERE matched) AS verified, count(*) FILTER (WHERE NOT matched) AS invalid"
        " FROM f GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 7"
    ),
    "k7_saved_total": f"{_FLAGGED} SELECT {_AMOUNT} AS saved FROM f WHERE matched",
    "k8_verified_shortage_details": (
        f"{_FLAGGED} SELECT {_CUSTOMER} AS customer, order_id AS order_number,"
        " CAST(round(abs(claim_amount), 2) AS DOUBLE) AS shortage FROM f WHERE matched"
    ),
    "k9_shipments_per_hour": (
        f"{WITH_SH} SELECT date_trunc('hour', appointment_date)::TIMESTAMP AS time,"
        f" count(*) AS shipments FROM sh WHERE {_SCANS_REPORT} GROUP BY 1"
    ),
    "k10_total_shipments": _value("count(*)", "sh", _SCANS_REPORT, WITH_SH),
    "k11_unique_carriers": _value("count(DISTINCT scac)", "sh", _SCANS_REPORT, WITH_SH),
    "k12_unique_orders": _value("count(DISTINCT order_id)", "sh", _SCANS_REPORT, WITH_SH),
    "k13_shipments_per_day": (
        f"{WITH_SH} SELECT date_trunc('day', appointment_date)::TIMESTAMP AS day,"
        f" count(*) AS shipments FROM sh WHERE {_SCANS_REPORT} GROUP BY 1"
    ),
    "k14_shipment_details": (
        f"{WITH_SH} SELECT strftime(appointment_date, '%b %d, %Y %I:%M %p') AS appointment_date,"
        " coalesce(pro_number, '-') AS pro_number, sscc18, scac AS carrier, order_id, shipment_id,"
        " coalesce(order_status, '-') AS order_status, coalesce(source_file, '-') AS source_file"
        f" FROM sh WHERE {_SCANS_REPORT} ORDER BY sh.appointment_date DESC, sscc18 NULLS FIRST,"
        " sh.order_id NULLS FIRST, sh.pro_number NULLS FIRST, sh.scac NULLS FIRST,"
        " sh.shipment_id NULLS FIRST, sh.order_status NULLS FIRST, sh.source_file NULLS FIRST LIMIT 500"
    ),
    "k15_perfect_orders": _value(
        "count(*)", "sh", f"{_SCANS_REPORT} AND order_status = 'Perfect'", WITH_SH
    ),
    "k16_short_orders": _value(
        "count(*)", "sh", f"{_SCANS_REPORT} AND order_status = 'Short'", WITH_SH
    ),
    "k17_total_claim_amount": _value(
        "CAST(sum(abs(claim_amount)) AS DOUBLE)", "cl", f"{CTF} AND {CT}", WITH_CL
    ),
    "k18_total_claim_count": _value("count(*)", "cl", f"{CTF} AND {CT}", WITH_CL),
    "k19_claims_per_1000_scans": (
        f"{WITH_BOTH}, c AS (SELECT count(*) AS a FROM cl WHERE {CTF} AND {CT}),"
        f" s AS (SELECT count(*) AS b FROM sh WHERE {_SCANS_REPORT})"
        f" SELECT CAST({_half_up('a', 'b', 10000)} AS DOUBLE) / 10 AS value FROM c, s"
    ),
    "k20_daily_scans_spine": (
        f"{WITH_SH}, {_DAYS} SELECT CAST(day AS TIMESTAMP) AS time, count(sscc18) AS daily_scans"
        f" FROM days LEFT JOIN sh ON CAST(appointment_date AS DATE) = day AND {CF} GROUP BY 1"
    ),
    "k21_daily_claims_moving_avg": _avg_query(
        _WARM_DAYS, "total", _daily_claims(_WARM_DAYS), True, _CLAIM_AVG_COLUMNS
    ),
    "k21_daily_claims_moving_avg_warm_up": _avg_query(
        _WARM_DAYS, "total", _daily_claims(_WARM_DAYS), False, _CLAIM_AVG_COLUMNS
    ),
    "k22_daily_claims_per_1000": _avg_query(
        _WARM_DAYS, "r", _daily_ratio(_WARM_DAYS), True, _RATIO_AVG_COLUMNS
    ),
    "k22_daily_claims_per_1000_warm_up": _avg_query(
        _WARM_DAYS, "r", _daily_ratio(_WARM_DAYS), False, _RATIO_AVG_COLUMNS
    ),
    "k23_days_since_large_claim": (
        f"{WITH_CL} SELECT date_diff('day', max(CAST(claim_date AS DATE)), DATE '1997-01-15') AS value"
        f" FROM cl WHERE abs(claim_amount) >= 50000 AND {CT}"
    ),
    "k24_before_claims_days": _claims_days(f"claim_date < {_CUTOVER}"),
    "k25_after_claims_days": _claims_days(f"claim_date >= {_CUTOVER}"),
    "k26_before_large_share": _large_share(f"claim_date < {_CUTOVER}"),
    "k27_after_large_share": _large_share(f"claim_date >= {_CUTOVER}"),
    "k28_claim_log": _claim_log("TRUE"),
    "k28_claim_log_containing": _claim_log("order_id ILIKE '%9%'"),
    "k29_scan_log": (
        f"{WITH_SH} SELECT strftime(appointment_date, '%b %d, %Y %I:%M') AS timestamp, order_id,"
        " sscc18, scac AS carrier, pro_number, coalesce(order_status, '-') AS order_status FROM sh"
        f" WHERE {_SCANS_REPORT} ORDER BY appointment_date DESC, order_id NULLS FIRST,"
        " sscc18 NULLS FIRST, scac NULLS FIRST, pro_number NULLS FIRST,"
        " sh.order_status NULLS FIRST LIMIT 500"
    ),
    "k30_claims_received_monthly": f"{WITH_CL} "
    + _monthly("count(*) AS claims_received", f"cl WHERE {_REPORT}"),
    "k31_would_have_paid_monthly": f"{WITH_CL} "
    + _monthly("count(*) AS would_have_paid", f"cl WHERE {_REPORT}"),
    "k32_refutable_monthly": f"{_FLAGGED} "
    + _monthly("count(*) AS refutable_claims", "f WHERE matched"),
    "k33_avoidable_spend_monthly": f"{_FLAGGED} "
    + _monthly(f"{_AMOUNT} AS avoidable_spend", "f WHERE matched"),
    "k34_actually_paid_monthly": f"{WITH_CL} "
    + _monthly(f"{_AMOUNT} AS actually_paid", f"cl WHERE {_REPORT}"),
    "k35_paid_vs_should_have": f"{_FLAGGED} "
    + _monthly(
        f"CAST({_dollars(_cents('NOT matched'))} AS DOUBLE) AS legitimate,"
        f" CAST({_dollars(_cents('matched'))} AS DOUBLE) AS refutable",
        "f",
    ),
    "k36_coverage_claims_pct": (
        f"{_FLAGGED} SELECT CAST({_half_up('count(*) FILTER (WHERE matched)', 'count(*)', 100)}"
        " AS DOUBLE) AS claims_coverage FROM f"
    ),
    "k37_coverage_dollars_pct": (
        f"{_FLAGGED} SELECT CAST({_half_up(_cents('matched'), _cents(), 100)}"
        " AS DOUBLE) AS dollars_coverage FROM f"
    ),
    "k38_received_vs_refutable": f"{_FLAGGED} "
    + _monthly("count(*) AS claims_received, count(*) FILTER (WHERE matched) AS refutable", "f"),
    "k39_monthly_summary": (
        f"{_FLAGGED} SELECT strftime(date_trunc('month', claim_date), '%B %Y') AS month,"
        f" count(*) AS claims, CAST({_dollars(_cents())} AS DOUBLE) AS paid,"
        " CAST(count(*) FILTER (WHERE matched) AS VARCHAR) || ' (' ||"
        f" CAST({_half_up('count(*) FILTER (WHERE matched)', 'count(*)', 100)} AS VARCHAR) || '%)'"
        f" AS perfect_match, {_dollar_text('matched')} || ' (' ||"
        f" CAST({_half_up(_cents('matched'), _cents(), 100)} AS VARCHAR) || '%)' AS avoidable_spend,"
        " CAST(count(*) FILTER (WHERE NOT matched) AS VARCHAR) || ' / ' ||"
        f" {_dollar_text('NOT matched')} AS unverifiable FROM f GROUP BY date_trunc('month', claim_date)"
    ),
    "k40_missed_claims_last_month": (
        f"{_FLAGGED_LAST} SELECT count(*) AS claims_to_deny FROM f WHERE matched"
    ),
    "k41_missed_savings_last_month": (
        f"{_FLAGGED_LAST} SELECT CAST({_dollars(_cents())} AS DOUBLE) AS missed_savings"
        " FROM f WHERE matched"
    ),
    "k42_bottom_line_text": (
        f"{_FLAGGED_LAST} SELECT '💰 Bottom Line: We paid $' || {_commas(_dollars(_cents()))}"
        f" || ' last month, but Kargo shows $' || {_commas(_dollars(_cents('matched')))}"
        " || ' of that was avoidable — a verified opportunity to reduce cost.' AS summary FROM f"
    ),
}
