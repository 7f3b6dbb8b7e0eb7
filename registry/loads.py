"""Sources, parsers, merges, stored tables and streaming loads, on inputs made from the given tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtrace import schemas
from claimtrace.operators import merge, series
from claimtrace.sources import files, header, parsers, text_grid, workbook
from claimtrace.sources.tables import Tables, shared_folder
from claimtrace.streaming import ingest
from registry.views import (
    CL_SQL, SH_SQL, WITH_CL, WITH_SH, Query, claims, from_views, plain, shipments, table,
)
from registry.workbooks import as_lines, as_workbooks

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def _text(name: str) -> Column:
    return F.col(name).cast("string")


# Files and mails ---------------------------------------------------------------------------

# One mail with one attachment per order.
_MAIL_SQL = (
    "SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'AllOrders_' WHEN 1 THEN 'order_level_'"
    " WHEN 2 THEN 'MS_Kargo_' WHEN 3 THEN 'kargo_' WHEN 4 THEN 'Result_' WHEN 5 THEN 'CS_RMA_'"
    " WHEN 6 THEN 'performance_' WHEN 7 THEN 'shipment_' ELSE 'other_' END"
    " || CAST(o_orderkey AS VARCHAR(20)) ||"
    " CASE o_orderkey % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.XLSX' WHEN 2 THEN '.xlsx' ELSE '.pdf' END"
    " AS file_name, o_orderpriority AS sender, o_orderstatus = 'F' AS is_read,"
    " o_custkey % 3 <> 0 AS has_attachments FROM orders"
)
_WITH_MAILS = f"WITH mails AS ({_MAIL_SQL})"


def _mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    word = F.element_at(
        F.array(
            *[
                F.lit(w)
                for w in (
                    "AllOrders_", "order_level_", "MS_Kargo_", "kargo_", "Result_", "CS_RMA_",
                    "performance_", "shipment_", "other_",
                )
            ]
        ),
        (key % 9 + 1).cast("int"),
    )
    end = F.element_at(
        F.array(*[F.lit(w) for w in (".csv", ".XLSX", ".xlsx", ".pdf")]), (key % 4 + 1).cast("int")
    )
    return orders.select(
        "o_orderkey",
        F.concat(word, key.cast("string"), end).alias("file_name"),
        F.col("o_orderpriority").alias("sender"),
        (F.col("o_orderstatus") == "F").alias("is_read"),
        (F.col("o_custkey") % 3 != 0).alias("has_attachments"),
    )


def _mail_query(choose) -> Query:
    return lambda spark, sf_dir: plain(choose(_mails(spark, sf_dir)).select("o_orderkey", "file_name"))


_MAIL_ROWS = f"{_WITH_MAILS} SELECT o_orderkey, file_name FROM mails WHERE "
_SUPPORTED = "(lower(file_name) LIKE '%.xlsx' OR lower(file_name) LIKE '%.csv')"
_add("src2_filter_attachment_type", _mail_query(files.supported), _MAIL_ROWS + _SUPPORTED)
# The keyword list in use.
_KEYWORDS = ("MS_Kargo", "CS_RMA", "Result_", "order_level")
_add(
    "src3_filter_keyword_allowlist",
    _mail_query(lambda m: files.keyword_allowed(m, _KEYWORDS)),
    _MAIL_ROWS + " OR ".join(f"contains(lower(file_name), '{k.lower()}')" for k in _KEYWORDS),
)
_add(
    "src4_filter_sender_allowlist",
    _mail_query(lambda m: files.sender_allowed(m, ["1-urgent ", "5-LOW"])),
    _MAIL_ROWS + "sender IN ('1-URGENT', '5-LOW')",
)
_add(
    "src5_filter_unread_with_attachments",
    _mail_query(files.unread_with_attachments),
    _MAIL_ROWS + "NOT is_read AND has_attachments",
)


def _route(strict: bool) -> Query:
    return lambda spark, sf_dir: plain(
        files.route(_mails(spark, sf_dir), strict)
        .groupBy("parser", "file_kind")
        .agg(F.count(F.lit(1)).alias("n"), F.min("file_name").alias("first_name"))
    )


def _route_sql(strict: bool) -> str:
    rma = "l LIKE '%rma%'" if strict else "regexp_matches(l, '(^|[^a-z])rma([^a-z]|$)')"
    vendor = "l LIKE '%kargo%'" + ("" if strict else " AND NOT ends_with(l, '.csv')")
    return (
        f"{_WITH_MAILS}, p AS (SELECT file_name, CASE WHEN contains(l, 'allorders') OR contains(l, 'all_orders')"
        f" THEN 'order_status_csv' WHEN contains(l, 'order_level') THEN 'order_level_csv' WHEN {vendor}"
        " THEN 'shipments_sheet' WHEN ends_with(l, '.csv') AND (l LIKE '%result%' OR l LIKE '%shipment%')"
        f" THEN 'shipments_csv' WHEN {rma} THEN 'rma_workbook' WHEN ends_with(l, '.csv') THEN 'shipments_csv'"
        " ELSE 'shipments_sheet' END AS parser FROM (SELECT file_name, lower(file_name) AS l FROM mails) x)"
        " SELECT parser, CASE WHEN parser LIKE 'shipments%' THEN 'shipments' WHEN parser = 'rma_workbook'"
        " THEN 'rma' ELSE replace(parser, '_csv', '') END AS file_kind, count(*) AS n,"
        " min(file_name) AS first_name FROM p GROUP BY 1, 2"
    )


_add("src6_route_file_kind", _route(False), _route_sql(False))
_add("src6_route_file_kind_strict", _route(True), _route_sql(True))


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/claimtrace-{uuid4().hex}"


def _name_files(spark: SparkSession, folder: str, name: str, header: str | None = None) -> None:
    """Gives the files that Spark wrote last into a folder names that tell their kind.

    With ``header``, a file that holds no more than this line, as a first task without rows writes it, is named ``Result_blank``.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, file in enumerate(store.globStatus(path(f"{folder}/part-*.csv")) or []):  # one per task of the write
        blank = header is not None and file.getLen() <= len(header) + 1
        store.rename(file.getPath(), path(f"{folder}/{f'Result_blank_{name}' if blank else name}_{i}.csv"))


def _export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rows of shipment exports, some without an order number."""
    lines = table(spark, sf_dir, "lineitem")
    order = F.concat(F.lit("6"), (F.col("l_orderkey") + 10_000_000).cast("string"))
    return lines.select(
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_partkey") % 9 != 0, order).alias("order_number"),
        F.lpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 18, "0").alias("sscc18"),
        F.lit("FXFE").alias("scac"),
        _text("l_partkey").alias("kargo_shipment_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("appointment_date"),
    )


def _shipment_files(spark: SparkSession, sf_dir: str, folder: str, copies: int = 1) -> None:
    """Shipment exports of all line items, written by Spark; each file in ``copies`` of equal content and unequal names.

    One task writes all copies of a file from its own sorted rows: two writes of a joined table can deal and order them
    differently.
    """
    rows = shipments(spark, sf_dir).select(
        F.col("order_id").alias("order_number"),
        "sscc18",
        "scac",
        F.lit("S").alias("kargo_shipment_id"),
        F.date_format("appointment_date", "yyyy-MM-dd HH:mm:ss").alias("appointment_date"),
    )
    every = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    every = every.sortWithinPartitions("copy", *rows.columns)
    every.write.partitionBy("copy").option("header", True).csv(folder)
    for i in range(copies):
        _name_files(spark, f"{folder}/copy={i}", f"shipment_copy{i}")


def _scan_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    table(spark, sf_dir, "orders").select(_text("o_orderkey")).write.csv(folder)
    found = files.scan_folder(spark, folder)
    missing = files.scan_folder(spark, folder + "-missing")
    return plain(
        found.unionByName(missing)
        .groupBy(F.element_at(F.split("file_name", r"\."), -1).alias("type"), F.left("email_id", F.lit(6)).alias("mark"))
        .agg(F.sum("length").alias("bytes"), F.sum(F.length("content")).alias("content_bytes"))
    )


_add(
    "src1_scan_drop_folder",
    _scan_folder,
    "SELECT 'csv' AS type, 'demo::' AS mark,"
    " CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS bytes,"
    " CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS content_bytes FROM orders",
)

# CSV grids and parsers ---------------------------------------------------------------------


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the documents, line breaks and quotes included, as quoted CSV cells.

    A text with line breaks covers several lines of the file.
    """
    documents = table(spark, sf_dir, "documents")
    record = F.concat(_text("doc_id"), F.lit(","), _quoted(F.col("text")), F.lit(","), F.col("lang"))
    pieces = documents.select(
        "doc_id", F.posexplode(F.split(record, "\n")).alias("piece", "line")
    )
    return as_lines(
        pieces,
        F.col("doc_id") % 5,
        F.col("doc_id") * 1_000_000 + F.col("piece"),
        F.col("line"),
        "Doc ID,Text,Lang/Code",
    )


def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "text", "lang_code")
    grid = text_grid.grid_from_lines(_document_lines(spark, sf_dir), names)
    return grid.select(
        text_grid.cell("doc_id").cast("bigint").alias("doc_id"),
        F.md5(text_grid.cell("text")).alias("text_hash"),
        text_grid.cell("lang_code").alias("lang"),
        "broken",
    )


_add(
    "src7_scan_csv",
    _scan_csv,
    "SELECT doc_id, md5(text) AS text_hash, lang, FALSE AS broken FROM documents",
)


def _require(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    line = F.concat(_text("o_orderkey"), F.lit(","), F.col("o_orderstatus"))
    key = F.col("o_orderkey")
    complete = as_lines(orders.filter("o_orderstatus = 'F'"), key % 3, key, line, "ORDER NUMBER, Order/Status ")
    lacking = as_lines(orders.filter("o_orderstatus <> 'F'"), key % 3 + 3, key, line, "order_number,state")
    grid = text_grid.grid_from_lines(complete.unionByName(lacking))
    kept = text_grid.require_columns(grid, parsers.ORDER_STATUS_CSV)
    return plain(
        kept.select(
            text_grid.cell("order_number").cast("bigint").alias("o_orderkey"),
            text_grid.cell("order_status").alias("status"),
        )
    )


_add(
    "src8_require_columns",
    _require,
    "SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F'",
)

_MINUTE_SQL = "l_shipdate + INTERVAL 1 MINUTE * CAST(l_partkey % 1440 AS INTEGER)"


def _shipment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as lines of shipment exports: seven date layouts, some cells blank."""
    minute = F.expr("l_shipdate + make_dt_interval(0, 0, CAST(l_partkey % 1440 AS INT), 0)")
    layouts = (
        "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd hh:mm a",
        "M/d/yyyy HH:mm:ss", "MM/dd/yyyy h:mm a", "yyyy-MM-dd",
    )
    kind = F.col("l_linenumber") % 7
    date = F.lit("not a date")
    for i, layout in enumerate(layouts):
        date = F.when(kind == i, F.date_format(minute, layout)).otherwise(date)
    package = F.when(F.col("l_orderkey") % 11 == 0, F.lit("  ")).otherwise(
        F.lpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 18, "0")
    )
    line = F.concat_ws(
        ",",
        _quoted(F.concat(F.lit("\t6"), _text("l_orderkey"))),
        package,
        F.when(F.col("l_suppkey") % 5 == 0, F.lit("")).otherwise(_quoted(F.lit("FXFE"))),
        _text("l_partkey"),
        date,
    )
    return as_lines(
        table(spark, sf_dir, "lineitem"),
        F.col("l_orderkey") % 6,
        F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        line,
        "﻿Order Number,SSCC18,SCAC,Kargo_Shipment_ID,Appointment_Date",
    )


def _p2(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsers.parse_shipments_csv(text_grid.grid_from_lines(_shipment_lines(spark, sf_dir)))
    return plain(parsers.accepted(parsed).drop("seq", "file_name"))


_P2_GOOD = "l_orderkey % 11 <> 0 AND l_linenumber % 7 <> 6"
_add(
    "p2_parse_shipments_csv",
    _p2,
    f"SELECT CASE l_linenumber % 7 WHEN 5 THEN l_shipdate ELSE {_MINUTE_SQL} END AS appointment_date,"
    " CAST(NULL AS VARCHAR) AS pro_number, lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 18, '0') AS sscc18,"
    " CASE WHEN l_suppkey % 5 <> 0 THEN 'FXFE' END AS scac, '6' || CAST(l_orderkey AS VARCHAR) AS order_id,"
    f" CAST(l_partkey AS VARCHAR) AS shipment_id FROM lineitem WHERE {_P2_GOOD}",
)


def _p7(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsers.parse_shipments_csv(text_grid.grid_from_lines(_shipment_lines(spark, sf_dir)))
    return plain(parsers.reject_counts(parsed))


_add(
    "p7_reject_counts",
    _p7,
    "SELECT 'lines_' || CAST(l_orderkey % 6 AS VARCHAR) || '.csv' AS file_name,"
    " CASE WHEN l_orderkey % 11 = 0 THEN 'missing sscc18' ELSE 'missing or unreadable date' END AS reject_reason,"
    f" count(*) AS rejected_rows FROM lineitem WHERE NOT ({_P2_GOOD}) GROUP BY 1, 2",
)


def _status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    line = F.concat_ws(
        ",",
        F.when(F.col("o_custkey") % 13 == 0, F.lit(" ")).otherwise(_text("o_orderkey")),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
            F.concat(F.lit(" "), F.col("o_orderpriority"))
        ),
        F.lit("a|b "),
    )
    return as_lines(
        orders, F.col("o_orderkey") % 4, F.col("o_orderkey"), line, "Order_Number,Order_Status,Missed_LPNs"
    )


def _p4(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsers.parse_order_status_csv(text_grid.grid_from_lines(_status_lines(spark, sf_dir)))
    return plain(parsers.accepted(parsed).drop("seq", "file_name"))


_add(
    "p4_parse_order_status_csv",
    _p4,
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_number, o_orderpriority AS order_status, 'a|b' AS missed_lpns"
    " FROM orders WHERE o_custkey % 13 <> 0 AND o_orderstatus <> 'P'",
)


def _level_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as parsed order-level rows: prefixed, bare and too short numbers."""
    orders = table(spark, sf_dir, "orders")
    plain_number = (F.col("o_orderkey") + 10_000_000).cast("string")
    number = (
        F.when(F.col("o_custkey") % 17 == 0, F.right(plain_number, F.lit(7)))
        .when(F.col("o_custkey") % 5 == 0, plain_number)
        .otherwise(F.concat((F.col("o_custkey") + 10_000_000).cast("string"), F.lit("-"), plain_number))
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "Incomplete")
        .otherwise("pending")
    )
    missed = F.when(
        F.col("o_orderstatus") == "O", F.concat(_text("o_orderkey"), F.lit("1| |"), _text("o_orderkey"), F.lit("2 "))
    ).otherwise("")
    line = F.concat_ws(",", _quoted(F.concat(F.lit("\t"), number)), _quoted(status), _quoted(missed))
    lines = as_lines(
        orders, F.col("o_orderkey") % 4, F.col("o_orderkey"), line, "orderNumber,orderStatus,missedLpns"
    )
    return parsers.accepted(parsers.parse_order_level_csv(text_grid.grid_from_lines(lines)))


_LEVEL_SQL = (
    "SELECT CAST(10000000 + o_orderkey AS VARCHAR) AS order_number, CASE o_orderstatus WHEN 'F' THEN 'Perfect'"
    " WHEN 'O' THEN 'Short' ELSE 'PENDING' END AS order_status, CASE WHEN o_custkey % 5 = 0 THEN ''"
    " ELSE CAST(10000000 + o_custkey AS VARCHAR) END AS shipment_id, CASE WHEN o_orderstatus = 'O' THEN"
    " CAST(o_orderkey AS VARCHAR) || '1|' || CAST(o_orderkey AS VARCHAR) || '2' ELSE '' END AS missed_lpns"
    " FROM orders WHERE o_custkey % 17 <> 0"
)
_add(
    "p5_parse_order_level_csv",
    lambda spark, sf_dir: plain(
        _level_rows(spark, sf_dir).select("order_number", "order_status", "shipment_id", "missed_lpns")
    ),
    _LEVEL_SQL,
)
_add(
    "p8_explode_missed_lpns",
    lambda spark, sf_dir: plain(parsers.explode_missed_lpns(_level_rows(spark, sf_dir))),
    f"WITH l AS ({_LEVEL_SQL}) SELECT order_number, order_status, unnest(string_split(missed_lpns, '|')) AS sscc18"
    " FROM l WHERE missed_lpns <> ''",
)

# Workbooks ---------------------------------------------------------------------------------

_SHEET_HEADER = ("APPOINTMENT_DATE", "Pro Number", "SSCC18", "SCAC", "Order/ID", "shipment_id", "note")


def _as_sheets(
    rows: DataFrame, place: Column, header: tuple[str, ...], above: list[list] | None = None
) -> DataFrame:
    """Rows as the cells of sixteen sheets, each with the lines above its header, the header, and its rows."""
    above = above or []
    number, name = F.pmod(place, F.lit(16)), F.concat(F.lit("book_"), F.col("_n").cast("string"), F.lit(".xlsx"))
    cells = F.array(*[F.col(c).cast("string") for c in rows.columns if c != "_place"])
    data = rows.select(number.alias("_n"), (place + len(above) + 2).cast("bigint").alias("row"), cells.alias("cells"))
    tops = [F.array(*[F.lit(c).cast("string") for c in line]) for line in [*above, header]]
    top = data.select("_n").distinct().select("_n", F.posexplode(F.array(*tops)).alias("row", "cells"))
    top = top.withColumn("row", (F.col("row") + 1).cast("bigint"))
    return top.unionByName(data).select(
        F.concat(F.lit("/"), name).alias("path"), name.alias("file_name"), "row", "cells"
    )


def _shipment_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_place"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.concat(F.lit(" PRO"), _text("l_suppkey"))).alias("pro"),
        F.when(F.col("l_linenumber") != 7, F.lpad(_text("l_orderkey"), 18, "0")).alias("sscc18"),
        F.lit("FXFE").alias("scac"),
        F.col("l_orderkey"),
        F.col("l_quantity"),
        F.lit("x").alias("note"),
    )
    return _as_sheets(rows, F.col("_place"), _SHEET_HEADER)


def _p1(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = _shipment_books(spark, sf_dir)
    return plain(parsers.accepted(parsers.parse_shipments_sheet(grid)).drop("seq", "file_name"))


_add(
    "p1_parse_shipments_sheet",
    _p1,
    "SELECT l_shipdate AS appointment_date, CASE WHEN l_linenumber <> 1 THEN 'PRO' || CAST(l_suppkey AS VARCHAR) END"
    " AS pro_number, lpad(CAST(l_orderkey AS VARCHAR), 18, '0') AS sscc18, 'FXFE' AS scac,"
    " CAST(l_orderkey AS VARCHAR) AS order_id, CAST(CAST(l_quantity AS DECIMAL(10,1)) AS VARCHAR) AS shipment_id"
    " FROM lineitem WHERE l_linenumber <> 7",
)


def _credit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        F.when(F.col("c_nationkey") % 6 != 0, F.concat(F.col("c_name"), F.lit(" "))).alias("carrier"),
        "c_acctbal",
        "c_custkey",
        "c_mktsegment",
    )


def _credit_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _credit_rows(spark, sf_dir)
    return as_workbooks(
        rows, "Summary", ("Carrier/BP", "Credit", "Count", "x"), [["Credits"], [None, "by carrier"]]
    )


def _p3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _credit_rows(spark, sf_dir).withColumn("_place", F.col("c_custkey"))
    heading = ("Carrier/BP", "Credit", "Count", "x")
    parsed = parsers.parse_rma_summary(_as_sheets(rows, F.col("_place"), heading, [["Credits"], [None, "by carrier"]]))
    return plain(parsers.accepted(parsed).drop("seq", "file_name"))


_add(
    "p3_parse_rma_summary",
    _p3,
    "SELECT CASE WHEN c_nationkey % 6 = 0 THEN 'Unknown' ELSE c_name END AS carrier_bp,"
    " CAST(CAST(c_acctbal AS DECIMAL(15,4)) AS DOUBLE) AS credit, c_custkey AS count,"
    " 'Short Shipment' AS claim_type FROM customer",
)

_CLAIM_HEADER = (
    "Effective Date", "RMA Status", "Do Ty", "PO #", "Original Order Number", "Shipment Number",
    "Original Line Number", "Line Number", "Do Ty", "Address Number", "Address Number", "Ship To Number",
    "Ship To", "2nd Item Number", "UM", "Quantity", "Credit Issued", "Returned Reason", "Returned Reason",
    "Business Unit", "Business Unit", "Concatenation Carrier Number",
)


def _claim_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber")
    rows = lines.select(
        (F.col("l_orderkey") * 10 + number).alias("_place"),
        F.when(number != 7, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("date"),
        F.col("l_linestatus").alias("status"),
        F.lit("D1").alias("type"),
        F.concat(F.lit("PO"), _text("l_partkey")).alias("po"),
        F.col("l_orderkey"),
        F.when(number == 3, F.concat(F.lit("00"), _text("l_orderkey"))).alias("package"),
        (number + 0.5).alias("original_line"),
        F.concat(F.lit(" "), _text("l_linenumber")).alias("line"),
        F.lit("D2").alias("return_type"),
        _text("l_suppkey").alias("address"),
        F.concat(F.lit("addr "), _text("l_suppkey")).alias("address_name"),
        F.col("l_suppkey").alias("ship_to"),
        F.concat(F.lit("Ship "), _text("l_suppkey"), F.lit(" ")).alias("ship_to_name"),
        F.concat(F.lit("I"), _text("l_partkey")).alias("item"),
        F.lit("EA").alias("um"),
        F.col("l_quantity"),
        F.when(number != 6, -F.col("l_extendedprice")).alias("credit"),
        F.lit("K12").alias("code"),
        F.when(number == 1, F.lit("X - SHORTAGE - CC")).when(number == 2, F.lit("DAMAGED")).when(
            number == 4, F.lit("OTHER")
        ).alias("reason"),
        F.lit("1MF").alias("unit"),
        F.lit("Unit F").alias("unit_name"),
        F.when(number == 5, F.lit(" ")).otherwise(F.lit("HSNR")).alias("carrier"),
    )
    return _as_sheets(rows, F.col("_place"), _CLAIM_HEADER, [["Report"], [None, "Claims"]])


def _claim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsers.parse_claim_sheet(_claim_books(spark, sf_dir))


_CLAIM_OUT = (
    "claim_date", "order_id", "sscc18", "claim_amount", "claim_type", "carrier_bp", "rma_status", "rma_date",
    "doc_type", "return_doc_type", "po_number", "original_line_number", "line_number", "address_number",
    "address_name", "ship_to_number", "ship_to_name", "item_number", "unit_of_measure", "quantity", "reason_code",
    "reason_text", "business_unit_code", "business_unit", "bol_number",
)
_add(
    "p6_parse_claim_sheet",
    lambda spark, sf_dir: plain(parsers.accepted(_claim_rows(spark, sf_dir)).select(*_CLAIM_OUT)),
    "SELECT l_shipdate AS claim_date, CAST(l_orderkey AS VARCHAR) AS order_id,"
    " CASE WHEN l_linenumber = 3 THEN CAST(l_orderkey AS VARCHAR) END AS sscc18,"
    " -CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS claim_amount,"
    " CASE l_linenumber WHEN 2 THEN 'DAMAGE' WHEN 4 THEN 'OTHER' ELSE 'SHORTAGE' END AS claim_type,"
    " CASE WHEN l_linenumber = 5 THEN 'Unknown' ELSE 'HSNR' END AS carrier_bp, l_linestatus AS rma_status,"
    " l_shipdate AS rma_date, 'D1' AS doc_type, 'D2' AS return_doc_type, 'PO' || CAST(l_partkey AS VARCHAR)"
    " AS po_number, CAST(l_linenumber AS BIGINT) AS original_line_number, CAST(l_linenumber AS BIGINT) AS line_number,"
    " CAST(l_suppkey AS VARCHAR) AS address_number, 'addr ' || CAST(l_suppkey AS VARCHAR) AS address_name,"
    " CAST(l_suppkey AS VARCHAR) AS ship_to_number, 'Ship ' || CAST(l_suppkey AS VARCHAR) AS ship_to_name,"
    " 'I' || CAST(l_partkey AS VARCHAR) AS item_number, 'EA' AS unit_of_measure, CAST(l_quantity AS BIGINT) AS quantity,"
    " 'K12' AS reason_code, CASE l_linenumber WHEN 1 THEN 'X - SHORTAGE - CC' WHEN 2 THEN 'DAMAGED'"
    " WHEN 4 THEN 'OTHER' END AS reason_text, '1MF' AS business_unit_code, 'Unit F' AS business_unit,"
    " CAST(NULL AS VARCHAR) AS bol_number FROM lineitem WHERE l_linenumber NOT IN (6, 7)",
)


def _scan_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = workbook.scan_workbook(_credit_books(spark, sf_dir), workbook.RMA_SHEETS)
    return plain(
        grid.filter(F.size("cells") == 4).select("role", F.array_join("cells", "|", "-").alias("cells"))
        .filter(~F.col("cells").startswith("Carrier/BP"))
    )


_add(
    "src9_scan_workbook",
    _scan_books,
    "SELECT 'credits' AS role, CASE WHEN c_nationkey % 6 = 0 THEN '-' ELSE c_name || ' ' END || '|' ||"
    " CAST(c_acctbal AS VARCHAR) || '|' || CAST(c_custkey AS VARCHAR) || '|' || c_mktsegment AS cells FROM customer",
)


def _sheet_grid(spark: SparkSession, sf_dir: str, heading: list[str]) -> DataFrame:
    """One sheet per supplier as a grid: lines before the header, the header, the supplier's lines.

    The number of a supplier's lines decides how many rows go before the header, how many empty
    cells begin it, and whether the last column is there.
    """
    path = F.concat(F.lit("supplier-"), _text("l_suppkey")).alias("path")
    lines = table(spark, sf_dir, "lineitem")
    sheets = lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    kept = F.slice(F.array(*map(F.lit, heading)), F.lit(1), (len(heading) - F.col("n") % 2).cast("int"))
    headings = F.concat(F.array_repeat(F.lit(""), (F.col("n") % 5).cast("int")), kept)
    before = F.array_repeat(F.array(F.lit("Report"), _text("l_suppkey")), (F.col("n") % 8).cast("int"))
    top = sheets.select(path, F.posexplode(F.concat(before, F.array(headings))).alias("row", "cells"))
    data = lines.select(path, (F.lit(10) + F.col("l_linenumber")).cast("int").alias("row"), F.array(_text("l_extendedprice")).alias("cells"))
    return top.withColumn("row", F.col("row") + 1).unionByName(data)


_SHEETS_SQL = "(SELECT 'supplier-' || CAST(l_suppkey AS VARCHAR) AS path, count(*) AS n FROM lineitem GROUP BY 1) s"


def _locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "carrier": (header.carrier_row, ["Carrier/BP", "Credit", "Count"]),
        "date": (header.date_row, _CLAIM_HEADER),
        "first": (header.first_row, ["APPOINTMENT_DATE", "SSCC18"]),
    }
    found = [
        find(_sheet_grid(spark, sf_dir, names)).select(
            F.lit(rule).alias("rule"), "path", "header_row", F.array_join("header", "|").alias("headings")
        )
        for rule, (find, names) in rules.items()
    ]
    return plain(found[0].unionByName(found[1]).unionByName(found[2]))


def _headings_sql(names: list[str]) -> str:
    """The header row as text: the empty cells, then all headings or all but the last."""
    return f"repeat('|', n % 5) || CASE WHEN n % 2 = 1 THEN '{'|'.join(names[:-1])}' ELSE '{'|'.join(names)}' END"


_add(
    "src10_locate_header_row",
    _locate,
    f"SELECT 'carrier' AS rule, path, n % 8 + 1 AS header_row, {_headings_sql(['Carrier/BP', 'Credit', 'Count'])}"
    f" AS headings FROM {_SHEETS_SQL}"
    f" UNION ALL SELECT 'date', path, n % 8 + 1, {_headings_sql(_CLAIM_HEADER)} FROM {_SHEETS_SQL}"
    " UNION ALL SELECT 'first', path, 1, CASE WHEN n % 8 = 0 THEN"
    f" {_headings_sql(['APPOINTMENT_DATE', 'SSCC18'])} ELSE 'Report|' || substr(path, 10) END FROM {_SHEETS_SQL}",
)


def _map_columns(strict: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        grid = _sheet_grid(spark, sf_dir, _CLAIM_HEADER)
        names = header.claim_columns(strict)
        headers = header.with_columns_found(header.date_row(grid), names).select("path", "at.*")
        pairs = F.array(*[F.struct(F.lit(c).alias("slot"), F.col(c).alias("place")) for c in names])
        return plain(headers.select("path", F.inline(pairs)))

    return run


# Where each slot is in ``_CLAIM_HEADER``; its last heading is that of carrier_bp.
_PLACES = {
    "effective_date": 0, "credit_issued": 16, "order_id": 4, "sscc18": 5, "carrier_bp": 21, "rma_status": 1,
    "rma_order_number": None, "order_type": None, "reference_number_qualifier": None, "bol_number": None,
    "original_line_number": 6, "returned_material_status": None, "contact_name": None, "description": None,
    "ship_to_number": 11, "quantity": 15, "serial_number_lot": None, "lot_serial_number": None,
    "branch_code": None, "business_unit_code": 19, "doc_type": 2, "address_number": 9, "claim_type": 18,
    "branch": None, "business_unit": 20, "reason_code": 17, "return_doc_type": 8, "address_name": 10,
    "po_number": 3, "unit_of_measure": 14, "item_number": 13, "line_number": 7, "ship_to_name": 12,
}


def _places_sql(places: dict) -> str:
    values = ", ".join(
        f"('{slot}', CAST({'NULL' if place is None else place} AS BIGINT))" for slot, place in places.items()
    )
    return (
        "SELECT path, slot, CASE WHEN slot = 'carrier_bp' AND n % 2 = 1 THEN NULL ELSE place + n % 5 END AS place"
        f" FROM {_SHEETS_SQL}, (VALUES {values}) v(slot, place)"
    )


_add("src11_map_columns_fuzzy", _map_columns(False), _places_sql(_PLACES))
# Anywhere in a heading, "um" is first found in "Original Order Number".
_add(
    "src11_map_columns_fuzzy_strict", _map_columns(True), _places_sql({**_PLACES, "unit_of_measure": 4})
)


def _isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good files and files whose quotes do not close, in one load, with a file of no rows where Spark writes one."""
    folder = _folder(spark)
    rows = _export_rows(spark, sf_dir).withColumn("flag", F.col("flag") == "A")
    header = ",".join(c for c in rows.columns if c != "flag")
    rows.filter("flag").drop("flag").write.option("header", True).csv(f"{folder}/in")
    _name_files(spark, f"{folder}/in", "Result_good", header)
    bad = rows.filter("NOT flag").drop("flag").withColumn("scac", F.concat(F.lit('"'), F.col("scac")))
    bad.write.option("header", True).option("quote", "").mode("append").csv(f"{folder}/in")
    _name_files(spark, f"{folder}/in", "Result_bad", header)
    tables = Tables(spark, f"{folder}/db")
    audit = ingest.load_folder(spark, f"{folder}/in", tables)
    good, blank = (F.col("file_name").startswith(f"Result_{w}") for w in ("good", "blank"))
    # A file of no rows has nothing to load and no quote: neither loaded nor failed.
    failed = audit.agg(
        F.bool_and(good | blank | (F.col("outcome") == "failed")).alias("bad_reported"),
        F.count_if(
            (good & (F.col("outcome") != "loaded")) | (blank & (F.col("outcome") != "no data"))
        ).alias("good_failed"),
    )
    return plain(merge.one_row(merge.table_count(tables.read("shipments")), failed))


_add(
    "t3_per_file_isolation",
    _isolation,
    "WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey % 9 <> 0 AS has_order FROM lineitem WHERE l_returnflag = 'A')"
    " SELECT (SELECT count(*) FROM x WHERE NOT has_order) + (SELECT count(*) FROM (SELECT DISTINCT * FROM x WHERE has_order))"
    " AS rows, TRUE AS bad_reported, CAST(0 AS BIGINT) AS good_failed",
)

# Merges ------------------------------------------------------------------------------------

_SHIPMENT_OUT = ("appointment_date", "pro_number", "sscc18", "scac", "order_id", "shipment_id")
# Order of rows in a load; ties are rows equal in every column used here.
_PLACE = "l_shipdate, l_partkey, l_suppkey, l_orderkey, l_linenumber"
_LOOSE_SQL = SH_SQL.replace(
    "'6' || CAST(10000000 + o_orderkey AS STRING) AS order_id",
    "CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE '6' || CAST(10000000 + o_orderkey AS STRING) END AS order_id",
).replace("SELECT ", f"SELECT {_PLACE}, ", 1)
_KEY_SQL = "sscc18, order_id"
_FIRST_SQL = (
    f"SELECT *, row_number() OVER (PARTITION BY {_KEY_SQL} ORDER BY {_PLACE}) AS rn FROM"
)
_M3_WITH = (
    f"WITH sh AS ({_LOOSE_SQL}), old AS (SELECT * FROM ({_FIRST_SQL} sh WHERE l_linenumber <= 4 AND order_id IS NOT NULL)"
    " WHERE rn = 1), batch AS (SELECT * FROM sh WHERE l_linenumber >= 3),"
    f" fresh AS (SELECT * EXCLUDE (rn) FROM ({_FIRST_SQL} batch WHERE order_id IS NOT NULL) WHERE rn = 1"
    " AND (sscc18, order_id) NOT IN (SELECT (sscc18, order_id) FROM old)"
    " UNION ALL SELECT * FROM batch WHERE order_id IS NULL)"
)


def _m3_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    parts = _LOOSE_SQL.split(" FROM lineitem")[0].removeprefix("SELECT ")
    joined.createOrReplaceTempView("_claimtrace_m3")
    rows = spark.sql(f"SELECT {parts} FROM _claimtrace_m3").withColumn(
        "seq", F.struct(*_PLACE.split(", "))
    )
    old = merge.insert_ignore_shipments(
        rows.limit(0), rows.filter("l_linenumber <= 4 AND order_id IS NOT NULL").select(*_SHIPMENT_OUT, "seq")
    )
    return old, rows.filter("l_linenumber >= 3").select(*_SHIPMENT_OUT, "seq")


def _m3(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, batch = _m3_inputs(spark, sf_dir)
    return plain(merge.insert_ignore_shipments(old, batch).select(*_SHIPMENT_OUT))


_add("m3_insert_ignore_shipments", _m3, f"{_M3_WITH} SELECT {', '.join(_SHIPMENT_OUT)} FROM fresh")


def _m7(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, batch = _m3_inputs(spark, sf_dir)
    return plain(merge.shipment_stats(batch, merge.insert_ignore_shipments(old, batch)))


_add(
    "m7_load_stats_insert",
    _m7,
    f"{_M3_WITH}, c AS (SELECT (SELECT count(*) FROM batch) AS p, (SELECT count(*) FROM (SELECT DISTINCT sscc18,"
    " coalesce(order_id, '') FROM batch)) AS u, (SELECT count(*) FROM fresh) AS i) SELECT p AS parsed_rows,"
    " u AS unique_rows, i AS inserted_rows, p - i AS duplicate_rows, p - u AS duplicate_rows_in_file,"
    " greatest(u - i, 0) AS duplicate_rows_existing FROM c",
)

_CREDIT_SQL = (
    "SELECT l_orderkey, l_linenumber, 'C' || CAST(l_suppkey AS VARCHAR) AS carrier_bp,"
    " CASE WHEN l_partkey % 10 <> 0 THEN CAST(l_quantity AS DECIMAL(15,4)) END AS credit,"
    " CAST(l_linenumber AS BIGINT) AS count FROM lineitem"
)


def _m4(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select(
        F.concat(F.lit("C"), _text("l_suppkey")).alias("carrier_bp"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_quantity").cast(schemas.CREDIT)).alias("credit"),
        F.col("l_linenumber").alias("count"),
        F.struct("l_orderkey", "l_linenumber").alias("seq"),
        "l_returnflag",
    )
    empty = rows.limit(0)
    held = merge.insert_ignore_rma(empty, rows.filter("l_returnflag = 'A'").drop("l_returnflag"))
    fresh = merge.insert_ignore_rma(held, rows.filter("l_returnflag <> 'A'").drop("l_returnflag"))
    return plain(fresh.select("carrier_bp", "credit", "count", "claim_type"))


_add(
    "m4_insert_ignore_rma",
    _m4,
    f"WITH r AS ({_CREDIT_SQL.replace('SELECT ', 'SELECT l_returnflag, ', 1)}),"
    " fresh AS (SELECT DISTINCT carrier_bp, credit, count FROM r WHERE l_returnflag <> 'A' AND credit IS NOT NULL"
    " EXCEPT SELECT carrier_bp, credit, count FROM r WHERE l_returnflag = 'A')"
    " SELECT carrier_bp, CAST(credit AS DOUBLE) AS credit, count, 'Short Shipment' AS claim_type FROM fresh"
    " UNION ALL SELECT carrier_bp, NULL, count, 'Short Shipment' FROM r WHERE l_returnflag <> 'A' AND credit IS NULL",
)

# Claims for the upsert: few keys, many repeats, half of the extension columns NULL.
_UPSERT_COLUMNS = {
    "claim_date": "date_trunc('month', l_shipdate)",
    "order_id": "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE CAST(l_suppkey AS STRING) END",
    "sscc18": "CASE WHEN l_linenumber <= 3 THEN NULL ELSE CAST(l_linenumber AS STRING) END",
    "claim_amount": "CAST(l_quantity AS DECIMAL(10,2))",
    "claim_type": "'T' || CAST(l_partkey AS STRING)",
    "carrier_bp": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'B' || CAST(l_partkey AS STRING) END",
    "rma_status": "CASE WHEN l_partkey % 2 = 0 THEN 'S' || CAST(l_partkey AS STRING) END",
    "description": "CASE WHEN l_orderkey % 2 = 0 THEN 'D' || CAST(l_orderkey AS STRING) END",
    "quantity": "CASE WHEN l_suppkey % 3 = 0 THEN l_linenumber END",
}
_UPSERT_OUT = tuple(_UPSERT_COLUMNS)
_UPSERT_SQL = "SELECT l_returnflag, l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, " + ", ".join(
    f"{sql} AS {name}" for name, sql in _UPSERT_COLUMNS.items()
).replace("date_trunc('month', l_shipdate)", "date_trunc('month', l_shipdate)::TIMESTAMP") + " FROM lineitem"
_UPSERT_KEY = "claim_date, coalesce(order_id, ''), coalesce(sscc18, ''), claim_amount"
_UPSERT_PLACE = "l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice"


_HELD, _NEW = "l_returnflag = 'A'", "l_returnflag <> 'A'"  # rows stored before, rows of the load


def _last_sql(rows: str) -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_UPSERT_KEY} ORDER BY"
        f" {', '.join(c + ' DESC' for c in _UPSERT_PLACE.split(', '))}) AS rn FROM c"
        f" WHERE {rows}) WHERE rn = 1"
    )


_UPSERT_WITH = f"WITH c AS ({_UPSERT_SQL}), o AS ({_last_sql(_HELD)}), n AS ({_last_sql(_NEW)})"


def _claim_load(spark: SparkSession, sf_dir: str, rows: str = "TRUE") -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter(rows)
    typed = lines.withColumn(
        "seq",
        F.struct(
            F.lit("claims").alias("file_name"), *[F.col(c) for c in _UPSERT_PLACE.split(", ")]
        ),
    )
    return typed.selectExpr(
        *[f"CAST({sql} AS TIMESTAMP_NTZ) AS {name}" if name == "claim_date" else f"{sql} AS {name}"
          for name, sql in _UPSERT_COLUMNS.items()],
        "seq",
    )


def _m5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(merge.keep_last(_claim_load(spark, sf_dir)).select(*_UPSERT_OUT))


def _out(alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    special = {"claim_amount": "CAST({} AS DOUBLE)", "quantity": "CAST({} AS BIGINT)"}
    return ", ".join(special.get(c, "{}").format(dot + c) + f" AS {c}" for c in _UPSERT_OUT)


_add("m5_keep_last_in_file", _m5, f"WITH c AS ({_UPSERT_SQL}) SELECT {_out()} FROM ({_last_sql('TRUE')}) n")


def _m6(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = merge.keep_last(_claim_load(spark, sf_dir, _HELD)).drop("seq")
    return plain(merge.upsert_claims(held, _claim_load(spark, sf_dir, _NEW)).select(*_UPSERT_OUT))


_SAME = (
    "o.claim_date = n.claim_date AND coalesce(o.order_id, '') = coalesce(n.order_id, '')"
    " AND coalesce(o.sscc18, '') = coalesce(n.sscc18, '') AND o.claim_amount = n.claim_amount"
)
_add(
    "m6_upsert_claims_coalesce",
    _m6,
    f"{_UPSERT_WITH}, j AS (SELECT "
    + ", ".join(
        f"coalesce(n.{c}, o.{c}) AS {c}"
        if c in merge.CLAIM_EXTENSION
        else f"CASE WHEN o.rn IS NOT NULL THEN o.{c} ELSE n.{c} END AS {c}"
        for c in _UPSERT_OUT
    )
    + f" FROM o FULL JOIN n ON {_SAME}) SELECT {_out()} FROM j",
)


def _m8(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = merge.keep_last(_claim_load(spark, sf_dir, _HELD)).drop("seq")
    return plain(merge.upsert_stats(held, _claim_load(spark, sf_dir, _NEW)))


_add(
    "m8_load_stats_upsert",
    _m8,
    f"{_UPSERT_WITH}, k AS (SELECT (SELECT count(*) FROM c WHERE {_NEW}) AS p, count(*) AS u,"
    f" count(*) FILTER (WHERE EXISTS (SELECT 1 FROM o WHERE {_SAME})) AS h FROM n)"
    " SELECT p AS parsed_rows, u AS unique_rows, u - h AS inserted_rows, h AS updated_rows,"
    " p - u AS duplicate_rows_in_file FROM k",
)

# Status rows: every third order twice, numbers with and without the leading digit, and misses.
_STATUS_SQL = (
    "SELECT o_orderkey * 2 + t AS seq, CASE WHEN o_custkey % 7 = 0 THEN 'none' || CAST(o_orderkey AS VARCHAR)"
    " WHEN o_custkey % 3 = 0 THEN CAST(10000000 + o_orderkey AS VARCHAR)"
    " WHEN o_custkey % 3 = 1 THEN CAST(o_orderkey % 100 AS VARCHAR)"
    " ELSE '6' || CAST(10000000 + o_orderkey AS VARCHAR) END AS order_number,"
    " o_orderpriority || CAST(t AS VARCHAR) AS order_status FROM orders, (VALUES (0), (1)) v(t)"
    " WHERE t = 0 OR o_orderkey % 3 = 0"
)


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    full = (key + 10_000_000).cast("string")
    customer = F.col("o_custkey")
    number = (
        F.when(customer % 7 == 0, F.concat(F.lit("none"), key.cast("string")))
        .when(customer % 3 == 0, full)
        .when(customer % 3 == 1, (key % 100).cast("string"))
        .otherwise(F.concat(F.lit("6"), full))
    )
    times = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return orders.withColumn("t", F.explode(times)).select(
        (key * 2 + F.col("t")).alias("seq"),
        number.alias("order_number"),
        F.concat(F.col("o_orderpriority"), F.col("t").cast("string")).alias("order_status"),
    )


_STATUS_OUT = ("sscc18", "order_id", "order_status")
_ROWS_SQL = f"u AS ({_STATUS_SQL}), ids AS (SELECT order_id, count(*) AS n FROM sh GROUP BY 1)"
_EXACT_WITH = f"{WITH_SH}, {_ROWS_SQL}, hits AS (SELECT order_id, n, u.* FROM u JOIN ids ON order_number = order_id)"
_SUFFIX_WITH = (
    f"{_EXACT_WITH}, more AS (SELECT order_id, n, u.* FROM (SELECT * FROM u WHERE order_number NOT IN"
    " (SELECT order_id FROM ids)) u JOIN ids ON right(order_id, 2) = order_number OR right(order_id, 1) = order_number"
    " OR right(order_id, 8) = order_number), every AS (SELECT * FROM hits UNION ALL SELECT * FROM more)"
)
_APPLIED = (
    ", last AS (SELECT order_id, max_by(order_status, seq) AS s FROM {hits} GROUP BY 1)"
    " SELECT sscc18, sh.order_id, coalesce(s, order_status) AS order_status FROM sh LEFT JOIN last"
    " ON sh.order_id = last.order_id"
)
_TOLD = (
    " SELECT (SELECT count(*) FROM u) AS total, CAST((SELECT sum(n) FROM {hits}) AS BIGINT) AS updated,"
    " (SELECT count(*) FROM u WHERE seq NOT IN (SELECT seq FROM {hits})) AS not_found"
)


def _status_query(build, columns: tuple[str, ...] | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = build(shipments(spark, sf_dir), _statuses(spark, sf_dir))
        return plain(result.select(*columns) if columns else result)

    return run


_add(
    "m9_update_order_status",
    _status_query(merge.update_status, _STATUS_OUT),
    _EXACT_WITH + _APPLIED.format(hits="hits"),
)
_add(
    "m9_update_order_status_stats",
    _status_query(merge.update_status_stats, None),
    _EXACT_WITH + _TOLD.format(hits="hits"),
)
_add(
    "m10_update_status_suffix",
    _status_query(merge.update_status_suffix, _STATUS_OUT),
    _SUFFIX_WITH + _APPLIED.format(hits="every"),
)
_add(
    "m10_update_status_suffix_stats",
    _status_query(merge.update_status_suffix_stats, None),
    _SUFFIX_WITH + _TOLD.format(hits="every"),
)

# Average over up to seven days in cents, rounded half up in whole-number arithmetic.
_HISTORY_SQL = (
    "{head}, d AS (SELECT CAST(claim_date AS DATE) AS day, CAST(sum(abs(claim_amount)) * 100 AS HUGEINT) AS t,"
    " count(*) AS n FROM {source} GROUP BY 1), w AS (SELECT *, CAST(sum(t) OVER f AS HUGEINT) AS s, count(*) OVER f AS k"
    " FROM d WINDOW f AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"
    " SELECT CAST(day AS TIMESTAMP) AS claim_date, CAST(t AS DOUBLE) / 100 AS total_amount, n AS claim_count,"
    " CAST((2 * s + k) // (2 * k) AS DOUBLE) / 100 AS moving_avg_7d FROM w"
)
_add(
    "m11_rebuild_daily_history",
    from_views(series.daily_history, "cl"),
    _HISTORY_SQL.format(head=WITH_CL, source="cl"),
)
_add(
    "m12_table_counts",
    from_views(merge.table_count, "sh"),
    f"{WITH_SH} SELECT count(*) AS rows FROM sh",
)


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: some have equal content under other names."""
    documents = table(spark, sf_dir, "documents")
    named = documents.select(
        F.concat(F.lpad(_text("doc_id"), 12, "0"), F.when(F.col("doc_id") % 2 == 0, ".csv").otherwise(".xlsx")).alias(
            "file_name"
        ),
        F.lit("mail").alias("email_id"),
        F.encode("text", "UTF-8").alias("content"),
        "lang",
    )
    return files.with_hash(named).drop("content")


_HASHED_SQL = (
    "WITH h AS (SELECT lpad(CAST(doc_id AS VARCHAR), 12, '0') || CASE WHEN doc_id % 2 = 0 THEN '.csv' ELSE '.xlsx' END"
    " AS file_name, sha256(text) AS hash, lang FROM documents),"
    " known AS (SELECT DISTINCT hash FROM h WHERE lang = 'en')"
)
_FIRST_FILE = "min_by(file_name, CASE WHEN file_name LIKE '%.csv' THEN '1' ELSE '0' END || file_name)"


def _known(listed: DataFrame) -> DataFrame:
    return listed.filter("lang = 'en'").select("attachment_hash").distinct()


def _m1(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _hashed(spark, sf_dir)
    return files.skip_processed(listed, _known(listed)).select("attachment_hash", "file_name")


_add(
    "m1_skip_processed_files",
    _m1,
    f"{_HASHED_SQL} SELECT hash AS attachment_hash, {_FIRST_FILE} AS file_name FROM h"
    " WHERE hash NOT IN (SELECT hash FROM known) GROUP BY 1",
)


def _m2(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _hashed(spark, sf_dir)
    return files.mark_processed(listed, _known(listed)).drop("processed_at")


_add(
    "m2_mark_processed",
    _m2,
    f"{_HASHED_SQL} SELECT hash AS attachment_hash, {_FIRST_FILE} AS filename, 'mail' AS email_id FROM h"
    " WHERE hash NOT IN (SELECT hash FROM known) GROUP BY 1",
)

# Stored tables and streams -----------------------------------------------------------------


def _stored_shipments(spark: SparkSession, sf_dir: str) -> Tables:
    tables = Tables(spark, _folder(spark))
    tables.append("shipments", shipments(spark, sf_dir))
    return tables


def _src12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_stored_shipments(spark, sf_dir).read("shipments").drop("ingested_at"))


_add("src12_read_table", _src12, SH_SQL)


def _snk1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of claims: the first fills the table, the second rewrites the months it touches."""
    tables = Tables(spark, _folder(spark))
    for batch, rows in enumerate((_HELD, _NEW)):
        claims_in = _claim_load(spark, sf_dir, rows).withColumns(
            {"claim_date": F.col("claim_date").cast("timestamp"), "file_name": F.lit("claims")}
        )
        ingest.load_rows(tables, {"claims": claims_in}, f"claims-{batch}", stream=("claims", batch))
    stored = tables.read("claim_details").withColumn("claim_date", F.col("claim_date").cast("timestamp_ntz"))
    return plain(stored.select(*_UPSERT_OUT))


_add("snk1_append_upsert_tables", _snk1, ORACLES["m6_upsert_claims_coalesce"])


def _snk3(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored_shipments(spark, sf_dir)
    tables.reset()
    counts = [
        merge.table_count(tables.read(name)).withColumn("name", F.lit(name)) for name in schemas.TABLES
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


_add(
    "snk3_reset_tables",
    _snk3,
    "SELECT name, CAST(0 AS BIGINT) AS rows FROM (VALUES "
    + ", ".join(f"('{name}')" for name in schemas.TABLES)
    + ") v(name)",
)


def _streamed(spark: SparkSession, sf_dir: str, copies: int = 1) -> Tables:
    root = _folder(spark)
    _shipment_files(spark, sf_dir, f"{root}/in", copies)
    tables = Tables(spark, f"{root}/db")
    query = ingest.start(spark, f"{root}/in/*", tables, f"{root}/progress", every=None, files_per_batch=64)
    query.awaitTermination()
    return tables


def _all_kinds(spark: SparkSession, sf_dir: str, root: str) -> Tables:
    """Statuses of every third order, by suffix those of every fifth, then exports of all line items, as a stream.

    The status files come first. An order in both has its status from the later files, those by suffix.
    """
    orders = table(spark, sf_dir, "orders")
    key = (F.col("o_orderkey") + 10_000_000).cast("string")
    exact = orders.filter("o_orderkey % 3 = 0").select(
        F.concat(F.lit("6"), key).alias("Order_Number"), F.col("o_orderpriority").alias("Order_Status")
    )
    level = orders.filter("o_orderkey % 5 = 0").select(
        F.concat(F.lit("11111111"), key).alias("orderNumber"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("INCOMPLETE").alias("orderStatus"),
        F.lit("").alias("missedLpns"),
    )
    exports = _export_rows(spark, sf_dir).drop("flag")
    for name, rows in (("AllOrders", exact), ("order_level", level), ("Result", exports)):
        rows.write.option("header", True).mode("append").csv(f"{root}/in")
        _name_files(spark, f"{root}/in", name)
    tables = Tables(spark, f"{root}/db")
    query = ingest.start(spark, f"{root}/in", tables, f"{root}/progress", every=None, files_per_batch=4)
    query.awaitTermination()
    return tables


_STREAM_WITH = (
    "WITH x AS (SELECT l_orderkey, CASE WHEN l_partkey % 9 <> 0 THEN '6' || CAST(10000000 + l_orderkey AS VARCHAR) END"
    " AS order_id, lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 18, '0') AS sscc18 FROM lineitem),"
    " s AS (SELECT DISTINCT * FROM x WHERE order_id IS NOT NULL"
    " UNION ALL SELECT * FROM x WHERE order_id IS NULL)"
)


def _t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of all kinds of CSV files in small batches, and its first batch once more."""
    root = _folder(spark)
    tables = _all_kinds(spark, sf_dir, root)
    again = files.scan_folder(spark, f"{root}/in/Result_0.csv")
    ingest.load_files(again, tables, "stream-0", stream=(ingest.stream_id(spark, f"{root}/progress"), 0))
    return plain(tables.read("shipments").select("sscc18", "order_id", "order_status"))


_KEYS_SQL = "SELECT DISTINCT sscc18, order_id FROM sh"
_add(
    "t1_micro_batch_ingest",
    _t1,
    f"{_STREAM_WITH} SELECT sscc18, order_id, CASE WHEN order_id IS NULL THEN NULL WHEN o_orderkey % 5 = 0 THEN"
    " CASE o_orderstatus WHEN 'F' THEN 'Perfect' ELSE 'Short' END WHEN o_orderkey % 3 = 0 THEN o_orderpriority END"
    " AS order_status FROM s JOIN orders ON l_orderkey = o_orderkey",
)


def _t2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file twice under another name: the copies are not loaded."""
    tables = _streamed(spark, sf_dir, copies=2)
    read = tables.read("load_audit").agg(F.sum("parsed_rows").alias("parsed_rows"))
    held = merge.table_count(tables.read("shipments"))
    return plain(merge.one_row(read, held))


_add(
    "t2_file_dedup_state",
    _t2,
    f"{WITH_SH} SELECT (SELECT count(*) FROM sh) AS parsed_rows, (SELECT count(*) FROM ({_KEYS_SQL})) AS rows",
)


_AUDITED = (
    "parsed_rows", "unique_rows", "inserted_rows", "updated_rows", "duplicate_rows", "duplicate_rows_in_file",
    "duplicate_rows_existing", "shipments_updated", "not_found_rows", "rejected_rows",
)


def _two_loads(spark: SparkSession, sf_dir: str) -> Tables:
    """Rows of all kinds, loaded in two batches; in the second, some shipments, credits and claims come again."""
    tables = Tables(spark, _folder(spark))
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")

    def place(name: str, row: Column) -> Column:
        return F.struct(F.lit(name).alias("file_name"), F.lit(0).cast("long").alias("block"), row.cast("long").alias("row"))

    exports = _export_rows(spark, sf_dir).select(
        "flag",
        F.lit("ship.csv").alias("file_name"),
        F.to_timestamp("appointment_date").alias("appointment_date"),
        F.lit(None).cast("string").alias("pro_number"),
        "sscc18",
        "scac",
        F.col("order_number").alias("order_id"),
        F.col("kargo_shipment_id").alias("shipment_id"),
        place("ship.csv", F.col("sscc18")).alias("seq"),
    )
    told = orders.select(
        "o_orderkey",
        F.lit("all.csv").alias("file_name"),
        F.concat(F.lit("6"), (F.col("o_orderkey") + 10_000_000).cast("string")).alias("order_number"),
        F.col("o_orderpriority").alias("order_status"),
        place("all.csv", F.col("o_orderkey")).alias("seq"),
    )
    level = told.filter("o_orderkey % 2 = 0").withColumns(
        {"file_name": F.lit("level.csv"), "order_number": F.right("order_number", F.lit(8))}
    )
    credits = lines.select(
        "l_returnflag",
        F.lit("rma.xlsx").alias("file_name"),
        F.concat(F.lit("C"), _text("l_suppkey")).alias("carrier_bp"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_quantity").cast(schemas.CREDIT)).alias("credit"),
        F.col("l_linenumber").cast("int").alias("count"),
        F.struct("l_orderkey", "l_linenumber").alias("seq"),
    )
    loads = (("flag = 'A'", "l_returnflag = 'A'", _HELD), ("flag <> 'N'", "l_returnflag <> 'A'", _NEW))
    for batch, (shipped, credited, claimed) in enumerate(loads):
        claims_in = _claim_load(spark, sf_dir, claimed).withColumns(
            {"claim_date": F.col("claim_date").cast("timestamp"), "file_name": F.lit("claims")}
        )
        rows = {
            "shipments_csv": exports.filter(shipped).drop("flag"),
            "order_status_csv": told.drop("o_orderkey"),
            "order_level_csv": level.drop("o_orderkey"),
            "rma_credits": credits.filter(credited).drop("l_returnflag"),
            "claims": claims_in,
        }
        ingest.load_rows(tables, rows, f"load-{batch}")
    return tables


def _snk2(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = _two_loads(spark, sf_dir).read("load_audit")
    return plain(audit.groupBy("batch", "file_name", "file_kind", "outcome").agg(*[F.sum(c).alias(c) for c in _AUDITED]))


# Shipment rows of an order when its statuses come, in either load.
_HELD_SQL = (
    "(SELECT count(DISTINCT sscc18) FROM loads WHERE l_orderkey = o_orderkey AND has_order AND load <= {load})"
)
_TOLD_SQL = " UNION ALL ".join(
    f"SELECT '{batch}' AS batch, '{name}' AS file_name, '{kind}' AS kind, {_HELD_SQL.format(load=batch[-1])} AS n FROM orders WHERE {which}"
    for batch in ("load-0", "load-1")
    for name, kind, which in (("all.csv", "order_status", "TRUE"), ("level.csv", "order_level", "o_orderkey % 2 = 0"))
)
_AUDIT_SQL = f"""
WITH xs AS (
  SELECT l_orderkey, l_returnflag AS flag, l_partkey % 9 <> 0 AS has_order,
    lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 18, '0') AS sscc18 FROM lineitem),
-- Equal rows without an order are all added, in either load; one with an order is added once.
loads AS (SELECT 0 AS load, * FROM xs WHERE flag = 'A' UNION ALL SELECT 1, * FROM xs WHERE flag <> 'N'),
firsts AS (SELECT sscc18, min(load) AS load FROM loads WHERE has_order GROUP BY 1),
ships AS (
  SELECT 'load-' || load AS batch, count(*) AS p, count(DISTINCT (sscc18, has_order)) AS u,
    count(*) FILTER (NOT has_order) + (SELECT count(*) FROM firsts WHERE firsts.load = loads.load) AS i
  FROM loads GROUP BY load),
told AS ({_TOLD_SQL}),
r AS ({_CREDIT_SQL.replace('SELECT ', 'SELECT l_returnflag, ', 1)}),
credit_keys AS (SELECT DISTINCT l_returnflag = 'A' AS first, carrier_bp, credit, count FROM r),
credit_rows AS (SELECT l_returnflag = 'A' AS first, count(*) AS p, count(*) FILTER (credit IS NULL) AS loose FROM r GROUP BY 1),
c AS ({_UPSERT_SQL}),
claim_keys AS (
  SELECT DISTINCT l_returnflag = 'A' AS first, claim_date, coalesce(order_id, '') AS o, coalesce(sscc18, '') AS s, claim_amount FROM c),
claim_rows AS (SELECT l_returnflag = 'A' AS first, count(*) AS p FROM c GROUP BY 1),
counts AS (
  SELECT batch, 'ship.csv' AS file_name, 'shipments' AS kind, p, u, i, 0 AS up, NULL::BIGINT AS told, NULL::BIGINT AS missed FROM ships
  UNION ALL
  SELECT batch, file_name, kind, count(*), NULL, 0, 0, sum(n), count(*) FILTER (n = 0) FROM told GROUP BY batch, file_name, kind
  UNION ALL
  SELECT CASE WHEN first THEN 'load-0' ELSE 'load-1' END, 'rma.xlsx', 'rma', p, k.u, loose + k.i, 0, NULL, NULL
  FROM credit_rows JOIN (
    SELECT first, count(*) AS u, count(*) FILTER (credit IS NOT NULL AND (first OR NOT EXISTS (
      SELECT 1 FROM credit_keys o WHERE o.first AND o.carrier_bp = n.carrier_bp AND o.credit = n.credit AND o.count = n.count))) AS i
    FROM credit_keys n GROUP BY first) k USING (first)
  UNION ALL
  SELECT CASE WHEN first THEN 'load-0' ELSE 'load-1' END, 'claims', 'rma', p, k.u, k.i, k.u - k.i, NULL, NULL
  FROM claim_rows JOIN (
    SELECT first, count(*) AS u, count(*) FILTER (first OR NOT EXISTS (
      SELECT 1 FROM claim_keys o WHERE o.first AND o.claim_date = n.claim_date AND o.o = n.o AND o.s = n.s AND o.claim_amount = n.claim_amount)) AS i
    FROM claim_keys n GROUP BY first) k USING (first))
SELECT batch, file_name, kind AS file_kind, 'loaded' AS outcome, p::BIGINT AS parsed_rows, u::BIGINT AS unique_rows,
  i::BIGINT AS inserted_rows, up::BIGINT AS updated_rows, CASE WHEN told IS NULL THEN p - i - up ELSE 0 END::BIGINT AS duplicate_rows,
  (p - u)::BIGINT AS duplicate_rows_in_file, greatest(u - i - up, CASE WHEN u IS NOT NULL THEN 0 END)::BIGINT AS duplicate_rows_existing,
  told::BIGINT AS shipments_updated, missed::BIGINT AS not_found_rows, NULL::BIGINT AS rejected_rows
FROM counts
"""
_add("snk2_load_audit", _snk2, _AUDIT_SQL)


def _t4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history after two loads of claims, the second with days before, between and after those of the first."""
    tables = Tables(spark, _folder(spark))
    rows = claims(spark, sf_dir)
    row = F.xxhash64(*rows.columns).alias("row")
    seq = F.struct(F.lit("claims").alias("file_name"), F.lit(0).cast("long").alias("block"), row)
    rows = rows.withColumns(
        {"file_name": F.lit("claims"), "seq": seq, "claim_date": F.col("claim_date").cast("timestamp")}
    )
    for batch, chosen in enumerate(
        ("month(claim_date) IN (2, 3, 9)", "month(claim_date) NOT IN (2, 3, 9) OR day(claim_date) = 5")
    ):
        ingest.load_rows(tables, {"claims": rows.filter(chosen)}, f"claims-{batch}")
    return plain(tables.read("claim_daily_history"))


_add(
    "t4_refresh_history",
    _t4,
    _HISTORY_SQL.format(
        head=f"WITH cl AS ({CL_SQL}), kept AS (SELECT DISTINCT claim_date, coalesce(order_id, '') AS o,"
        " coalesce(sscc18, '') AS p, claim_amount FROM cl)",
        source="kept",
    ),
)
