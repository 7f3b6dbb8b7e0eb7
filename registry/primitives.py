"""Functions, filters, matches, joins, sorts, aggregates, windows and reducers, one query each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtrace.functions import cells, report
from claimtrace.operators import filters, match, reducers, series
from claimtrace.operators.merge import one_row
from claimtrace.plans import monthly, scans, summary, volume
from registry import reports
from registry.views import (
    BU, CF, CT, CTF, FROM, LAST_MONTH, MONTH, PARAMS, STF, TO, WITH_BOTH, WITH_CL, WITH_SH,
    Query, claims, flagged, from_views, hit, plain, rounded, shipments, table,
)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, query: Query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def _grouped(df: DataFrame, *columns: Column) -> DataFrame:
    """Distinct results with their number of rows: every row of the table takes part."""
    return plain(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")))


def _over(name: str, source: str, sql: str, **columns: Callable[[], Column]) -> None:
    """A query that computes ``columns`` over a whole table and counts each result."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _grouped(table(spark, sf_dir, source), *[c().alias(n) for n, c in columns.items()])

    _add(name, run, sql)


def _count_sql(select: str, source: str) -> str:
    return f"SELECT {select}, count(*) AS n FROM {source} GROUP BY ALL"


# Functions ---------------------------------------------------------------------------------


def _header_text() -> Column:
    return F.concat(
        F.lit("\t "), F.col("o_orderstatus"), F.lit(" No/"), F.col("o_orderpriority"), F.lit(" \n")
    )


_over(
    "f1_normalize_header",
    "orders",
    _count_sql(
        "lower(o_orderstatus) || '_no_' || replace(replace(lower(o_orderpriority), ' ', '_'), '/', '_')"
        " AS header",
        "orders",
    ),
    header=lambda: cells.normalize_header(_header_text()),
)


def _minute() -> Column:
    return F.expr("l_shipdate + make_dt_interval(0, 0, CAST(l_partkey % 1440 AS INT), 0)")


def _kind() -> Column:
    return F.col("l_linenumber") % 7


def _date_text() -> Column:
    return (
        F.when(_kind() == 0, F.date_format(_minute(), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(_kind() == 1, F.date_format(_minute(), " yyyy-MM-dd HH:mm:ss"))
        .when(_kind() == 2, F.date_format(_minute(), "yyyy-MM-dd hh:mm a"))
        .when(_kind() == 3, F.date_format(_minute(), "M/d/yyyy HH:mm:ss"))
        .when(_kind() == 4, F.date_format(_minute(), "MM/dd/yyyy h:mm a"))
        .when(_kind() == 5, F.date_format(_minute(), "yyyy-M-d"))
        .otherwise(F.lit("not a date"))
    )


_MINUTE_SQL = "l_shipdate + INTERVAL 1 MINUTE * CAST(l_partkey % 1440 AS INTEGER)"
_over(
    "f2_parse_datetime_flexible",
    "lineitem",
    _count_sql(
        f"l_linenumber % 7 AS kind, CASE WHEN l_linenumber % 7 = 6 THEN NULL"
        f" WHEN l_linenumber % 7 = 5 THEN l_shipdate ELSE {_MINUTE_SQL} END AS parsed",
        "lineitem",
    ),
    kind=lambda: _kind(),
    parsed=lambda: cells.parse_datetime(_date_text()),
)
_over(
    "f3_parse_iso_or_drop",
    "lineitem",
    _count_sql(
        f"l_linenumber % 7 AS kind, CASE WHEN l_linenumber % 7 = 0 THEN {_MINUTE_SQL}"
        " WHEN l_linenumber % 7 = 5 AND month(l_shipdate) >= 10 AND day(l_shipdate) >= 10"
        " THEN l_shipdate END AS parsed",
        "lineitem",
    ),
    kind=lambda: _kind(),
    parsed=lambda: cells.iso_timestamp(_date_text()),
)


def _blankish() -> Column:
    return F.when(F.col("o_orderkey") % 3 == 0, F.lit(" \t")).otherwise(
        F.concat(F.lit("\n "), F.col("o_orderpriority"), F.lit("\t"))
    )


_over(
    "f4_safe_str",
    "orders",
    _count_sql("CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS text", "orders"),
    text=lambda: cells.clean_text(_blankish()),
)


def _key() -> Column:
    return F.col("l_orderkey")


def _number_text() -> Column:
    return (
        F.when(_kind() == 0, F.concat(F.lit("00"), _key().cast("string")))
        .when(_kind() == 1, F.concat(F.lit("-"), _key().cast("string"), F.lit(".75")))
        .when(_kind() == 2, F.concat(F.lit("0010085412931599"), F.lpad((_key() % 10000).cast("string"), 4, "0")))
        .when(_kind() == 3, F.concat(_key().cast("string"), F.lit("D")))
        .when(_kind() == 4, F.lit(" "))
        .when(_kind() == 5, F.concat((_key() % 1000).cast("string"), F.lit("e3")))
        .otherwise(F.concat(F.lit(" LOT"), _key().cast("string")))
    )


_NUMBER_SQL = (
    "CASE l_linenumber % 7 WHEN 0 THEN '00' || CAST(l_orderkey AS VARCHAR)"
    " WHEN 1 THEN '-' || CAST(l_orderkey AS VARCHAR) || '.75'"
    " WHEN 2 THEN '0010085412931599' || lpad(CAST(l_orderkey % 10000 AS VARCHAR), 4, '0')"
    " WHEN 3 THEN CAST(l_orderkey AS VARCHAR) || 'D' WHEN 4 THEN NULL"
    " WHEN 5 THEN CAST(l_orderkey % 1000 AS VARCHAR) || 'e3'"
    " ELSE 'LOT' || CAST(l_orderkey AS VARCHAR) END"
)
_WHOLE_SQL = f"CAST(trunc(TRY_CAST({_NUMBER_SQL} AS DOUBLE)) AS HUGEINT)"
_over(
    "f5_safe_int_str",
    "lineitem",
    _count_sql(f"coalesce(CAST({_WHOLE_SQL} AS VARCHAR), {_NUMBER_SQL}) AS text", "lineitem"),
    text=lambda: cells.int_text(_number_text()),
)
_over(
    "f6_int_via_float",
    "lineitem",
    _count_sql(f"CAST(TRY_CAST({_WHOLE_SQL} AS INTEGER) AS BIGINT) AS whole", "lineitem"),
    whole=lambda: cells.whole_number(_number_text()),
)
_over(
    "f7_float_or_drop",
    "lineitem",
    _count_sql(f"TRY_CAST({_NUMBER_SQL} AS DOUBLE) AS amount", "lineitem"),
    amount=lambda: cells.amount(_number_text()),
)


def _reason() -> Column:
    return (
        F.when(_kind() == 0, F.lit("OBSOLETE - SHORTAGE - CC"))
        .when(_kind() == 1, F.lit("Damaged in transit, short"))
        .when(_kind() == 2, F.concat(F.lit("damage "), F.col("l_returnflag")))
        .when(_kind() == 3, F.concat(F.lit("OTHER "), F.col("l_linestatus")))
    )


_over(
    "f8_claim_type_norm",
    "lineitem",
    _count_sql(
        "CASE l_linenumber % 7 WHEN 2 THEN 'DAMAGE' WHEN 3 THEN 'OTHER ' || l_linestatus"
        " ELSE 'SHORTAGE' END AS claim_type",
        "lineitem",
    ),
    claim_type=lambda: cells.claim_type(_reason()),
)
_over(
    "f9_status_map",
    "orders",
    _count_sql(
        "CASE o_orderstatus WHEN 'F' THEN 'Perfect' WHEN 'O' THEN 'Short' ELSE 'PENDING' END AS status",
        "orders",
    ),
    status=lambda: cells.order_status(
        F.when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "O", "INCOMPLETE")
        .otherwise("pending")
    ),
)


def _f10(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id", cells.content_hash(F.encode("text", "UTF-8")).alias("content_hash")
    )


_add("f10_sha256_content", _f10, "SELECT doc_id, sha256(text) AS content_hash FROM documents")


_add(
    "f11_abs_round_sum",
    from_views(
        lambda cl: cl.groupBy("business_unit_code").agg(
            F.round(report.sum_abs(F.col("claim_amount")), 2).alias("cents"),
            report.money(report.sum_abs(F.col("claim_amount")), 0).alias("dollars"),
        ),
        "cl",
    ),
    f"{WITH_CL} SELECT business_unit_code, CAST(round(sum(abs(claim_amount)), 2) AS DOUBLE) AS cents,"
    " CAST((CAST(sum(abs(claim_amount)) * 100 AS HUGEINT) + 50) // 100 AS DOUBLE) AS dollars"
    " FROM cl GROUP BY 1",
)
_CUSTOMER_SQL = "coalesce(ship_to_name, address_name, 'Unknown')"
_add(
    "f12_coalesce_chain",
    from_views(
        lambda cl: cl.groupBy(
            report.customer_name(F.col("ship_to_name"), F.col("address_name")).alias("customer"),
            report.dash(F.col("business_unit_code")).alias("unit"),
        ).agg(F.count(F.lit(1)).alias("n")),
        "cl",
    ),
    f"{WITH_CL} "
    + _count_sql(f"{_CUSTOMER_SQL} AS customer, coalesce(business_unit_code, '-') AS unit", "cl"),
)
_add(
    "f13_nullif_ratio",
    from_views(
        lambda sh: sh.groupBy("scac")
        .agg(
            F.count_if(F.col("order_status") == "Perfect").alias("a"),
            F.count_if(F.col("order_status") == "Nothing").alias("b"),
            F.count(F.lit(1)).alias("c"),
        )
        .select(
            "scac",
            report.ratio(F.col("a"), F.col("b"), 100, 1).alias("none"),
            report.ratio(F.col("a"), F.col("c"), 100, 1).alias("share"),
        ),
        "sh",
    ),
    f"{WITH_SH} SELECT scac, CAST(NULL AS DOUBLE) AS none, CAST((2000 *"
    " CAST(count(*) FILTER (WHERE order_status = 'Perfect') AS HUGEINT) + count(*))"
    " // (2 * count(*)) AS DOUBLE) / 10 AS share FROM sh GROUP BY 1",
)
for _unit in ("hour", "day", "week", "month"):

    def _bucketed(spark, sf_dir, unit=_unit):
        events = table(spark, sf_dir, "events")
        return series.per_bucket(events, unit, "ts", F.count(F.lit(1)).alias("n"))

    _add(
        f"f14_date_trunc_{_unit}",
        _bucketed,
        f"SELECT date_trunc('{_unit}', ts)::TIMESTAMP AS time, count(*) AS n FROM events GROUP BY 1",
    )


_over(
    "f15_to_date_cast",
    "events",
    _count_sql("CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day", "events"),
    day=lambda: report.day(F.col("ts")),
)
_over(
    "f16_to_char_date",
    "events",
    _count_sql(
        "strftime(ts, '%b %d, %Y') AS a, strftime(ts, '%b %d, %Y %I:%M') AS b,"
        " strftime(ts, '%b %d, %Y %I:%M %p') AS c, strftime(ts, '%B %Y') AS d",
        "events",
    ),
    a=lambda: report.day_text(F.col("ts")),
    b=lambda: report.minute_text(F.col("ts")),
    c=lambda: report.minute_text_half(F.col("ts")),
    d=lambda: report.month_text(F.col("ts")),
)
_over(
    "f17_to_char_number",
    "orders",
    _count_sql("format('{:,}', o_orderkey * 97) AS number", "orders"),
    number=lambda: report.grouped_number(F.col("o_orderkey") * 97),
)
_over(
    "f18_suffix_match",
    "orders",
    _count_sql(
        "right(CAST(100000 + o_orderkey AS VARCHAR), 2) = CAST(o_custkey AS VARCHAR)"
        " AND length(CAST(o_custkey AS VARCHAR)) = 2 AS ends",
        "orders",
    ),
    ends=lambda: report.suffix_equals(
        (F.lit(100000) + F.col("o_orderkey")).cast("string"), F.col("o_custkey").cast("string"), 2
    ),
)
_over(
    "f19_ilike_contains",
    "orders",
    _count_sql("o_orderpriority ILIKE '%NOT_spec%' AS hit", "orders"),
    hit=lambda: report.contains_text(F.col("o_orderpriority"), "NOT_spec"),
)
_add(
    "f20_concat_report_text",
    from_views(
        lambda cl: cl.groupBy(
            F.concat(F.col("claim_type"), F.lit(" / "), F.col("business_unit_code")).alias("text")
        ).agg(F.count(F.lit(1)).alias("n")),
        "cl",
    ),
    f"{WITH_CL} " + _count_sql("claim_type || ' / ' || business_unit_code AS text", "cl"),
)
_add(
    "f21_case_buckets",
    from_views(
        lambda cl: cl.groupBy(
            F.when(F.abs("claim_amount") >= 50_000, "large")
            .when(F.abs("claim_amount") >= 10_000, "middle")
            .otherwise("small")
            .alias("size")
        ).agg(F.count(F.lit(1)).alias("n")),
        "cl",
    ),
    f"{WITH_CL} "
    + _count_sql(
        "CASE WHEN abs(claim_amount) >= 50000 THEN 'large' WHEN abs(claim_amount) >= 10000"
        " THEN 'middle' ELSE 'small' END AS size",
        "cl",
    ),
)
_over(
    "f22_now_month_arithmetic",
    "orders",
    _count_sql(
        "date_trunc('month', o_orderdate)::TIMESTAMP - INTERVAL 1 MONTH AS previous_month,"
        " date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS days",
        "orders",
    ),
    previous_month=lambda: F.add_months(F.date_trunc("month", "o_orderdate"), -1),
    days=lambda: F.datediff(F.lit(date(2002, 1, 1)), F.to_date("o_orderdate")),
)

# Filters and list queries ------------------------------------------------------------------


def _totals(df: DataFrame, amount: str | None = None) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("n")]
    if amount:
        aggregates.append(F.sum(amount).alias("total"))
    return df.agg(*aggregates)


_CLAIM_TOTALS = "count(*) AS n, CAST(sum(claim_amount) AS DOUBLE) AS total"
_add(
    "q1_time_range_filter",
    from_views(lambda cl: _totals(filters.time_range(cl, "claim_date", PARAMS), "claim_amount"), "cl"),
    f"{WITH_CL} SELECT {_CLAIM_TOTALS} FROM cl WHERE {CTF}",
)


def _q2(sh):
    some = filters.one_of(sh, "scac", ("FXFE", "HSNR")).agg(F.count(F.lit(1)).alias("some"))
    every = filters.one_of(sh, "scac", None).agg(F.count(F.lit(1)).alias("every"))
    return one_row(some, every)


_add(
    "q2_multi_select_filter",
    from_views(_q2, "sh"),
    f"{WITH_SH} SELECT count(*) FILTER (WHERE scac IN ('FXFE', 'HSNR')) AS some, count(*) AS every FROM sh",
)
_SEARCH = replace(PARAMS, order_contains="99", sscc_contains="1")
_add(
    "q3_contains_filter",
    from_views(
        lambda sh: filters.containing(sh, _SEARCH).groupBy("scac").agg(F.count(F.lit(1)).alias("n")), "sh"
    ),
    f"{WITH_SH} SELECT scac, count(*) AS n FROM sh WHERE order_id ILIKE '%99%' AND sscc18 ILIKE '%1%' GROUP BY 1",
)
_add(
    "q4_business_unit_filter",
    from_views(
        lambda cl: filters.business_units(cl, PARAMS).groupBy("business_unit_code").agg(
            F.count(F.lit(1)).alias("n")
        ),
        "cl",
    ),
    f"{WITH_CL} SELECT business_unit_code, count(*) AS n FROM cl WHERE {BU} GROUP BY 1",
)
_add(
    "q5_distinct_carriers",
    from_views(filters.distinct_carriers, "sh"),
    f"{WITH_SH} SELECT DISTINCT scac FROM sh WHERE scac IS NOT NULL",
)
_add(
    "q6_distinct_claim_types",
    from_views(filters.distinct_claim_types, "cl"),
    f"{WITH_CL} SELECT DISTINCT claim_type FROM cl WHERE claim_type IS NOT NULL"
    " AND claim_type NOT ILIKE '%missing%pro%'",
)
_add(
    "q7_amount_threshold",
    from_views(
        lambda cl: _totals(filters.at_least(cl, "claim_amount", PARAMS.threshold), "claim_amount"), "cl"
    ),
    f"{WITH_CL} SELECT {_CLAIM_TOTALS} FROM cl WHERE abs(claim_amount) >= 50000",
)


def _q8(cl):
    before = _totals(filters.before_cutover(cl, "claim_date", PARAMS), "claim_amount")
    after = _totals(filters.from_cutover(cl, "claim_date", PARAMS), "claim_amount")
    return before.withColumn("side", F.lit("before")).unionByName(
        after.withColumn("side", F.lit("after"))
    )


_add(
    "q8_cutover_split",
    from_views(_q8, "cl"),
    f"{WITH_CL} SELECT CASE WHEN claim_date < TIMESTAMP '1998-05-01' THEN 'before' ELSE 'after' END AS side,"
    f" {_CLAIM_TOTALS} FROM cl GROUP BY 1",
)
_LABELS = {"customer": "Customer", "order_number": "Order Number", "shortage": "Shortage $"}
_add(
    "q9_project_alias",
    from_views(
        lambda sh, cl: filters.with_labels(
            summary.verified_shortage_details(sh, cl, PARAMS), _LABELS
        ),
        "sh",
        "cl",
    ),
    f"{WITH_BOTH}, f AS ({flagged(f'{CTF} AND {CT} AND {BU}', f'{CF} AND order_status = {chr(39)}Perfect{chr(39)}')})"
    f" SELECT {_CUSTOMER_SQL} AS \"Customer\", order_id AS \"Order Number\","
    " CAST(abs(claim_amount) AS DOUBLE) AS \"Shortage $\" FROM f WHERE matched",
)


def _predicate() -> Column:
    return (
        ((F.col("order_status") == "Perfect") | F.col("order_status").isNull())
        & (F.col("scac") != "FXFE")
        & F.col("scac").isin("HSNR", "HSND", "FXFE")
        & ~(F.col("pro_number").isNull())
        & (F.col("appointment_date") < F.lit(PARAMS.time_to))
        & (F.col("appointment_date") >= F.lit(PARAMS.time_from))
    )


_add(
    "q10_predicates",
    from_views(lambda sh: sh.filter(_predicate()).groupBy("scac", "order_status").agg(F.count(F.lit(1)).alias("n")), "sh"),
    f"{WITH_SH} SELECT scac, order_status, count(*) AS n FROM sh WHERE (order_status = 'Perfect' OR"
    " order_status IS NULL) AND scac <> 'FXFE' AND scac IN ('HSNR','HSND','FXFE') AND pro_number IS NOT NULL"
    f" AND appointment_date < {TO} AND appointment_date >= {FROM} GROUP BY 1, 2",
)
_over(
    "q11_casts",
    "lineitem",
    _count_sql(
        "CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS day, CAST(l_linenumber AS VARCHAR) AS text,"
        " CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS number",
        "lineitem",
    ),
    day=lambda: F.col("l_shipdate").cast("date"),
    text=lambda: F.col("l_linenumber").cast("string"),
    number=lambda: F.col("l_quantity").cast("decimal(12,2)"),
)


def _q12(sh, cl):
    weekly = sh.groupBy(report.bucket("week", F.col("appointment_date")).alias("time")).agg(
        F.count(F.lit(1)).alias("scans")
    )
    busiest = weekly.agg(F.max("scans").alias("most"))
    return weekly.join(busiest, F.col("scans") == F.col("most")).select("time", "scans")


_add(
    "q12_cte_and_derived_tables",
    from_views(lambda sh: _q12(sh, None), "sh"),
    f"{WITH_SH}, w AS (SELECT date_trunc('week', appointment_date)::TIMESTAMP AS time, count(*) AS scans"
    " FROM sh GROUP BY 1) SELECT time, scans FROM w WHERE scans = (SELECT max(scans) FROM w)",
)
_add(
    "q13_group_by_position",
    from_views(
        lambda sh: series.per_bucket(sh, "month", "appointment_date", F.count(F.lit(1)).alias("n")), "sh"
    ),
    f"{WITH_SH} SELECT date_trunc('month', appointment_date)::TIMESTAMP AS time, count(*) AS n FROM sh GROUP BY 1",
)

# The match and other joins -----------------------------------------------------------------

_PERFECT_SQL = f"{CF} AND order_status = 'Perfect'"
_CLAIM_COLUMNS = ["claim_date", "order_id", "sscc18", "claim_amount"]
_CLAIM_SELECT = "claim_date, order_id, sscc18, CAST(claim_amount AS DOUBLE) AS claim_amount"

_add(
    "j1_match_perfect_semi",
    from_views(lambda sh, cl: match.matched_claims(cl, sh, PARAMS).select(_CLAIM_COLUMNS), "keys", "cl"),
    f"{WITH_BOTH}, f AS ({flagged('TRUE', _PERFECT_SQL)}) SELECT {_CLAIM_SELECT} FROM f WHERE matched",
)
_add(
    "j2_match_any_flag",
    from_views(
        lambda sh, cl: match.with_match(cl, sh, PARAMS, None)
        .groupBy("claim_type", "matched")
        .agg(F.count(F.lit(1)).alias("n")),
        "sh",
        "cl",
    ),
    f"{WITH_BOTH}, f AS ({flagged('TRUE', CF)}) SELECT claim_type, matched, count(*) AS n FROM f GROUP BY 1, 2",
)
_add(
    "j3_match_any_unfiltered",
    from_views(
        lambda sh, cl: match.with_match(cl, sh, None, None)
        .groupBy("claim_type", "matched")
        .agg(F.count(F.lit(1)).alias("n")),
        "sh",
        "cl",
    ),
    f"{WITH_BOTH}, f AS ({flagged('TRUE', 'TRUE')}) SELECT claim_type, matched, count(*) AS n FROM f GROUP BY 1, 2",
)
_add(
    "j4_match_flag_column",
    from_views(
        lambda sh, cl: match.with_match(cl, sh, PARAMS).select(*_CLAIM_COLUMNS, "matched"), "keys", "cl"
    ),
    f"{WITH_BOTH}, f AS ({flagged('TRUE', _PERFECT_SQL)}) SELECT {_CLAIM_SELECT}, matched FROM f",
)
_add(
    "j5_unmatched_anti",
    from_views(
        lambda sh, cl: match.unmatched_claims(cl, sh, PARAMS).select(_CLAIM_COLUMNS), "sh", "cl"
    ),
    f"{WITH_BOTH}, f AS ({flagged('TRUE', CF)}) SELECT {_CLAIM_SELECT} FROM f WHERE NOT matched",
)
_add(
    "j6_exists_in_aggregate_filter",
    from_views(
        lambda sh, cl: match.with_match(cl, sh, PARAMS)
        .groupBy("business_unit_code")
        .agg(
            F.count_if("matched").alias("hits"),
            F.sum(F.when(F.col("matched"), F.abs("claim_amount"))).alias("hit_amount"),
        ),
        "sh",
        "cl",
    ),
    f"{WITH_BOTH}, f AS ({flagged('TRUE', _PERFECT_SQL)}) SELECT business_unit_code,"
    " count(*) FILTER (WHERE matched) AS hits,"
    " CAST(sum(abs(claim_amount)) FILTER (WHERE matched) AS DOUBLE) AS hit_amount FROM f GROUP BY 1",
)


def _j7(sh, cl):
    by_day = series.per_bucket(sh, "day", "appointment_date", F.count(F.lit(1)).alias("scans"))
    by_claim = series.per_bucket(cl, "day", "claim_date", F.count(F.lit(1)).alias("claims"))
    return series.full_join_buckets(by_day, by_claim, ["scans", "claims"])


_add(
    "j7_full_outer_buckets",
    from_views(_j7, "sh", "cl"),
    f"{WITH_BOTH}, a AS (SELECT date_trunc('day', appointment_date)::TIMESTAMP AS d, count(*) AS n FROM sh"
    " GROUP BY 1), b AS (SELECT date_trunc('day', claim_date)::TIMESTAMP AS d, count(*) AS n FROM cl GROUP BY 1)"
    " SELECT coalesce(a.d, b.d) AS time, coalesce(a.n, 0) AS scans, coalesce(b.n, 0) AS claims"
    " FROM a FULL JOIN b ON a.d = b.d",
)
_add(
    "j8_calendar_left_join",
    from_views(scans.daily_scans_spine, "sh", params=replace(PARAMS, carriers=("FXFE",))),
    f"{WITH_SH}, days AS (SELECT CAST(d AS DATE) AS day FROM generate_series({FROM}, {TO}, INTERVAL 1 DAY) t(d))"
    " SELECT CAST(day AS TIMESTAMP) AS time, count(sscc18) AS daily_scans FROM days LEFT JOIN sh"
    " ON CAST(appointment_date AS DATE) = day AND scac IN ('FXFE') GROUP BY 1",
)


def _j9(sh, cl):
    first, last = PARAMS.time_from.date(), PARAMS.time_to.date()
    spine = series.calendar(sh.sparkSession, first, last)
    both = series.on_calendar(spine, series.daily_scans(sh, PARAMS, first, last), ["scans"])
    facts = series.daily_claims(cl, PARAMS, first, last).select("day", "claim_count")
    return series.on_calendar(both, facts, ["claim_count"])


_add(
    "j9_double_left_join_distinct",
    from_views(_j9, "sh", "cl"),
    "WITH sh AS (SELECT *, row_number() OVER () AS id FROM (" + WITH_SH.split("(", 1)[1][:-1] + ") x),"
    " cl AS (SELECT *, row_number() OVER () AS id FROM (" + WITH_CL.split("(", 1)[1][:-1] + ") y),"
    f" days AS (SELECT CAST(d AS DATE) AS day FROM generate_series({FROM}, {TO}, INTERVAL 1 DAY) t(d))"
    " SELECT CAST(day AS TIMESTAMP) AS day, count(DISTINCT sh.id) AS scans, count(DISTINCT cl.id) AS claim_count"
    f" FROM days LEFT JOIN sh ON CAST(appointment_date AS DATE) = day AND {CF}"
    f" LEFT JOIN cl ON CAST(claim_date AS DATE) = day AND {CT} GROUP BY 1",
)
_add(
    "j10_cross_scalar",
    from_views(lambda sh, cl: series.ratio_of_counts(cl, sh, 1000, 1), "sh", "cl"),
    f"{WITH_BOTH}, a AS (SELECT count(*) AS x FROM cl), b AS (SELECT count(*) AS y FROM sh)"
    " SELECT CAST((20000 * CAST(x AS HUGEINT) + y) // (2 * y) AS DOUBLE) / 10 AS value FROM a, b",
)

# Sorts, limits, unions ---------------------------------------------------------------------

_add(
    "s1_two_point_union",
    reports.QUERIES["k2_claims_submitted_mom"],
    reports.ORACLES["k2_claims_submitted_mom"],
)
_add(
    "s2_top_n_groups",
    from_views(
        lambda cl: cl.groupBy(
            report.customer_name(F.col("ship_to_name"), F.col("address_name")).alias("customer")
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "customer")
        .limit(7),
        "cl",
    ),
    f"{WITH_CL} SELECT {_CUSTOMER_SQL} AS customer, count(*) AS n FROM cl GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7",
)
_add(
    "s3_latest_n_rows",
    from_views(
        lambda sh: filters.latest(
            sh.select("appointment_date", "sscc18", "order_id"), "appointment_date", 500, ["sscc18", "order_id"]
        ),
        "sh",
    ),
    f"{WITH_SH} SELECT appointment_date, sscc18, order_id FROM sh ORDER BY appointment_date DESC,"
    " sscc18 NULLS FIRST, order_id NULLS FIRST LIMIT 500",
)


def _s4(cl):
    ordered = cl.select(F.abs("claim_amount").alias("amount"), "claim_type").orderBy(
        F.col("amount").desc(), "claim_type"
    )
    return ordered


_add(
    "s4_order_by_amount",
    from_views(_s4, "cl"),
    f"{WITH_CL} SELECT CAST(abs(claim_amount) AS DOUBLE) AS amount, claim_type FROM cl ORDER BY 1 DESC, 2",
)

# Aggregates and windows --------------------------------------------------------------------

_add("a1_count_rows", from_views(_totals, "sh"), f"{WITH_SH} SELECT count(*) AS n FROM sh")
_add(
    "a2_count_distinct",
    from_views(
        lambda sh: sh.agg(
            F.count_distinct("scac").alias("carriers"),
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct(report.day(F.col("appointment_date"))).alias("days"),
            F.count_distinct("pro_number").alias("pros"),
        ),
        "sh",
    ),
    f"{WITH_SH} SELECT count(DISTINCT scac) AS carriers, count(DISTINCT order_id) AS orders,"
    " count(DISTINCT CAST(appointment_date AS DATE)) AS days, count(DISTINCT pro_number) AS pros FROM sh",
)
_add(
    "a3_sum_abs",
    from_views(
        lambda cl: cl.agg(
            report.sum_abs(F.col("claim_amount")).alias("total"),
            report.sum_abs(F.when(F.col("claim_type") == "none", F.col("claim_amount"))).alias("nothing"),
            report.money(
                report.sum_abs(F.when(F.col("claim_type") == "none", F.col("claim_amount")))
            ).alias("zero"),
        ),
        "cl",
    ),
    f"{WITH_CL} SELECT CAST(sum(abs(claim_amount)) AS DOUBLE) AS total, CAST(NULL AS DOUBLE) AS nothing,"
    " CAST(0 AS DOUBLE) AS zero FROM cl",
)
_add(
    "a4_count_nonnull",
    from_views(lambda sh: sh.groupBy("scac").agg(F.count("order_status").alias("known")), "sh"),
    f"{WITH_SH} SELECT scac, count(order_status) AS known FROM sh GROUP BY 1",
)
_add(
    "a5_conditional_count",
    from_views(
        lambda cl: cl.groupBy("claim_type").agg(
            F.count_if(F.abs("claim_amount") >= 50_000).alias("large"),
            F.sum(F.when(F.col("sscc18").isNull(), 1).otherwise(0)).alias("no_package"),
        ),
        "cl",
    ),
    f"{WITH_CL} SELECT claim_type, count(CASE WHEN abs(claim_amount) >= 50000 THEN 1 END) AS large,"
    " CAST(sum(CASE WHEN sscc18 IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_package FROM cl GROUP BY 1",
)
_add(
    "a6_filtered_sum",
    from_views(
        lambda cl: cl.groupBy("claim_type").agg(
            F.sum(F.when(F.col("order_id").isNull(), F.abs("claim_amount"))).alias("without"),
            F.sum(F.when(F.col("order_id").isNotNull(), F.abs("claim_amount"))).alias("with_order"),
        ),
        "cl",
    ),
    f"{WITH_CL} SELECT claim_type, CAST(sum(abs(claim_amount)) FILTER (WHERE order_id IS NULL) AS DOUBLE)"
    " AS without, CAST(sum(abs(claim_amount)) FILTER (WHERE order_id IS NOT NULL) AS DOUBLE) AS with_order"
    " FROM cl GROUP BY 1",
)
_add(
    "a7_max_date",
    from_views(
        lambda cl: cl.groupBy("claim_type").agg(F.max(report.day(F.col("claim_date"))).alias("last_day")), "cl"
    ),
    f"{WITH_CL} SELECT claim_type, CAST(max(CAST(claim_date AS DATE)) AS TIMESTAMP) AS last_day FROM cl GROUP BY 1",
)
_add(
    "a8_bucket_group",
    from_views(
        lambda sh: series.per_bucket(
            sh, "week", "appointment_date", F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("orders")
        ),
        "sh",
    ),
    f"{WITH_SH} SELECT date_trunc('week', appointment_date)::TIMESTAMP AS time, count(*) AS n,"
    " count(DISTINCT order_id) AS orders FROM sh GROUP BY 1",
)
_add(
    "a9_percent_of_total",
    from_views(
        lambda sh: sh.groupBy("scac")
        .agg(F.count_if(F.col("order_status") == "Short").alias("short"), F.count(F.lit(1)).alias("n"))
        .select(
            "scac",
            report.percent(F.col("short"), F.col("n")).alias("whole"),
            report.percent(F.col("short"), F.col("n"), 1).alias("tenths"),
        ),
        "sh",
    ),
    f"{WITH_SH}, g AS (SELECT scac, CAST(count(*) FILTER (WHERE order_status = 'Short') AS HUGEINT) AS a,"
    " count(*) AS b FROM sh GROUP BY 1) SELECT scac, CAST((200 * a + b) // (2 * b) AS DOUBLE) AS whole,"
    " CAST((2000 * a + b) // (2 * b) AS DOUBLE) / 10 AS tenths FROM g",
)
_add(
    "a10_ratio_per_1000",
    reports.QUERIES["k19_claims_per_1000_scans"],
    reports.ORACLES["k19_claims_per_1000_scans"],
)


def _daily_totals(cl: DataFrame) -> DataFrame:
    return cl.groupBy(report.day(F.col("claim_date")).alias("day")).agg(
        report.sum_abs(F.col("claim_amount")).alias("total")
    )


_DAILY_SQL = (
    f"{WITH_CL}, d AS (SELECT CAST(claim_date AS DATE) AS day, CAST(sum(abs(claim_amount)) AS DOUBLE) AS total"
    " FROM cl GROUP BY 1)"
)
_WINDOW_SQL = "avg(total) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_add(
    "w1_moving_avg_7",
    from_views(
        lambda cl: rounded(
            _daily_totals(cl).withColumn("average", series.moving_average("total")), average=4
        ),
        "cl",
    ),
    f"{_DAILY_SQL} SELECT CAST(day AS TIMESTAMP) AS day, total, round({_WINDOW_SQL}, 4) AS average FROM d",
)
_add(
    "w2_moving_avg_rounded",
    from_views(lambda cl: series.moving_average_rounded(_daily_totals(cl), "total", "day"), "cl"),
    f"{_DAILY_SQL} SELECT CAST(day AS TIMESTAMP) AS day, total, round({_WINDOW_SQL}, 2) AS moving_avg_7d FROM d",
)
_add(
    "m13_moving_avg_7_rounded",
    QUERIES["w2_moving_avg_rounded"],
    ORACLES["w2_moving_avg_rounded"],
)
_add(
    "m14_before_after_reduction",
    from_views(
        lambda cl: rounded(
            series.before_after(_daily_totals(cl), "total", "day", PARAMS.cutover),
            before_avg=4,
            after_avg=4,
            reduction_pct=4,
        ),
        "cl",
    ),
    f"{_DAILY_SQL}, m AS (SELECT avg(total) FILTER (WHERE day < DATE '1998-05-01') AS a,"
    " avg(total) FILTER (WHERE day >= DATE '1998-05-01') AS b FROM d)"
    " SELECT round(a, 4) AS before_avg, round(b, 4) AS after_avg, round((a - b) / a * 100, 4) AS reduction_pct FROM m",
)

# Reducers ----------------------------------------------------------------------------------

_MONTHLY_PAID = (
    f"p AS (SELECT date_trunc('month', claim_date)::TIMESTAMP AS time, CAST(sum(abs(claim_amount)) AS DOUBLE) AS v"
    f" FROM cl WHERE {CTF} AND {CT} AND {BU} GROUP BY 1)"
)
_add(
    "r1_last_not_null",
    from_views(
        lambda cl: reducers.last_not_null(monthly.actually_paid_monthly(cl, PARAMS), "actually_paid"), "cl"
    ),
    f"{WITH_CL}, {_MONTHLY_PAID} SELECT max_by(v, time) AS value FROM p WHERE v IS NOT NULL",
)
_add(
    "r2_percent_change",
    from_views(
        lambda cl: rounded(
            reducers.percent_change(monthly.actually_paid_monthly(cl, PARAMS), "actually_paid"), change_pct=4
        ),
        "cl",
    ),
    f"{WITH_CL}, {_MONTHLY_PAID}, l AS (SELECT time, v, lag(v) OVER (ORDER BY time) AS b FROM p)"
    " SELECT time, v AS actually_paid, round((v - b) / b * 100, 4) AS change_pct FROM l",
)
_VERIFIED_SQL = f"{WITH_BOTH}, f AS ({flagged(f'{CTF} AND {CT} AND {BU}', _PERFECT_SQL)})"
_add(
    "r3_footer_sum_count",
    from_views(
        lambda sh, cl: reducers.footer(summary.verified_shortage_details(sh, cl, PARAMS), "shortage"), "keys", "cl"
    ),
    f"{_VERIFIED_SQL} SELECT count(*) AS row_count, CAST(sum(abs(claim_amount)) AS DOUBLE) AS total"
    " FROM f WHERE matched",
)


def _r4(cl):
    age = F.datediff(F.lit(PARAMS.as_of), report.day(F.col("claim_date")))
    share = F.abs(F.col("claim_amount")) / 1000
    return cl.groupBy(
        reducers.band(age, reducers.DAYS_BANDS).alias("days"),
        reducers.band(share, reducers.COVERAGE_BANDS).alias("coverage"),
    ).agg(F.count(F.lit(1)).alias("n"))


_add(
    "r4_threshold_band",
    from_views(_r4, "cl"),
    f"{WITH_CL}, b AS (SELECT date_diff('day', CAST(claim_date AS DATE), DATE '1997-01-15') AS a,"
    " abs(claim_amount) AS c FROM cl) "
    + _count_sql(
        "CASE WHEN a >= 90 THEN 'green' WHEN a >= 50 THEN 'light green' WHEN a >= 30 THEN 'orange'"
        " ELSE 'red' END AS days, CASE WHEN c >= 80000 THEN 'green' WHEN c >= 60000 THEN 'orange'"
        " ELSE 'red' END AS coverage",
        "b",
    ),
)
_add(
    "r5_no_value_default",
    from_views(
        lambda cl: cl.groupBy(
            reducers.no_value(F.col("ship_to_name"), "—").alias("shown"),
            reducers.no_value(F.length("order_id")).alias("size"),
        ).agg(F.count(F.lit(1)).alias("n")),
        "cl",
    ),
    f"{WITH_CL} "
    + _count_sql(
        "coalesce(ship_to_name, '—') AS shown, coalesce(CAST(length(order_id) AS VARCHAR), '0') AS size", "cl"
    ),
)
_RANK = "CASE order_status WHEN 'Perfect' THEN 0 WHEN 'Short' THEN 1 ELSE 3 END"
_REASON_SQL = (
    f"{WITH_BOTH}, pk AS (SELECT sscc18 AS k, min({_RANK}) AS r FROM sh GROUP BY 1),"
    f" ok AS (SELECT right(order_id, 7) AS k, min({_RANK}) AS r FROM sh GROUP BY 1"
    f" UNION ALL SELECT right(order_id, 8), min({_RANK}) FROM sh GROUP BY 1),"
    " m AS (SELECT cl.*, pk.r AS pr, ok.r AS orr FROM cl"
    " LEFT JOIN pk ON coalesce(cl.sscc18, '') <> '' AND pk.k = cl.sscc18"
    " LEFT JOIN ok ON length(cl.order_id) IN (7, 8) AND length(ok.k) = length(cl.order_id) AND ok.k = cl.order_id),"
    " z AS (SELECT *, coalesce(pr, orr) IS NOT NULL AS order_scanned, CASE WHEN pr IS NOT NULL"
    " THEN 'Matched by SSCC18' WHEN orr IS NOT NULL THEN 'Matched by Order ID' ELSE 'No Matching Shipment' END"
    " AS match_reason, CASE least(coalesce(pr, 9), coalesce(orr, 9)) WHEN 0 THEN 'Perfect' WHEN 1 THEN 'Short'"
    " ELSE '-' END AS order_status FROM m)"
)
_add(
    "r6_match_reason",
    from_views(
        lambda sh, cl: match.with_reason(cl, sh).select(
            *_CLAIM_COLUMNS, "order_scanned", "match_reason", "order_status"
        ),
        "keys",
        "cl",
    ),
    f"{_REASON_SQL} SELECT {_CLAIM_SELECT}, order_scanned, match_reason, order_status FROM z",
)
_add(
    "r7_valid_by_status_matrix",
    from_views(lambda sh, cl: match.scanned_by_status(match.with_reason(cl, sh)), "keys", "cl"),
    f"{_REASON_SQL} SELECT order_scanned, order_status, count(*) AS claims,"
    " CAST(sum(abs(claim_amount)) AS DOUBLE) AS amount FROM z GROUP BY 1, 2",
)
_add(
    "r8_claim_shortage_rate",
    from_views(summary.claim_shortage_rate, "sh", "cl", params=PARAMS),
    f"{WITH_BOTH}, f AS ({flagged(f'{CTF} AND {CT} AND {BU}', _PERFECT_SQL)}),"
    " c AS (SELECT date_trunc('week', claim_date)::TIMESTAMP AS t, count(*) AS n,"
    " count(*) FILTER (WHERE matched) AS m FROM f GROUP BY 1),"
    " s AS (SELECT date_trunc('week', appointment_date)::TIMESTAMP AS t, count(DISTINCT order_id) AS o FROM sh"
    f" WHERE {STF} AND {CF} GROUP BY 1), j AS (SELECT coalesce(c.t, s.t) AS time, CAST(coalesce(n, 0) AS HUGEINT) AS n,"
    " CAST(coalesce(m, 0) AS HUGEINT) AS m, coalesce(o, 0) AS o FROM c FULL JOIN s ON c.t = s.t)"
    " SELECT time, CAST((2000 * n + o) // nullif(2 * o, 0) AS DOUBLE) / 10 AS claim_rate_pct,"
    " CAST((2000 * m + o) // nullif(2 * o, 0) AS DOUBLE) / 10 AS shortage_rate_pct FROM j",
)
