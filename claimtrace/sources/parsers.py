"""Parsers: rows of cells to typed rows.

Every parser keeps all data rows and says in ``reject_reason`` why one is not
usable; ``accepted`` drops those and ``reject_counts`` counts them. ``seq`` is the
place of a row in the load: file name, then block and row in the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace import schemas
from claimtrace.functions import cells
from claimtrace.sources import header, text_grid

# Required and known column names per file kind.
SHIPMENT_CSV = ("order_number", "sscc18", "kargo_shipment_id", "appointment_date")
ORDER_STATUS_CSV = ("order_number", "order_status")
ORDER_LEVEL_CSV = ("ordernumber", "orderstatus")
SHIPMENT_SHEET = ("appointment_date", "pro_number", "sscc18", "scac", "order_id", "shipment_id")
# Digits of the shipment prefix, carrier of a row that names none.
PREFIX_DIGITS = 8
UNKNOWN = "Unknown"

NO_PACKAGE = "missing sscc18"
NO_DATE = "missing or unreadable date"
NO_ORDER = "missing order number or status"
SHORT_ORDER = "order number too short"
NO_AMOUNT = "missing or unreadable credit"
BAD_NUMBER = "number unreadable"
BROKEN = "record too long"


def _seq(block: Column, row: Column) -> Column:
    return F.struct(
        F.col("file_name").alias("file_name"),
        block.cast("bigint").alias("block"),
        row.cast("bigint").alias("row"),
    )


def _csv_rows(grid: DataFrame, required: tuple[str, ...]) -> DataFrame:
    known = text_grid.require_columns(grid, required)
    return known.withColumn("seq", _seq(F.col("block"), F.col("row")))


def _sheet_rows(grid: DataFrame, headers: DataFrame) -> DataFrame:
    rows = header.below_header(grid, headers)
    return rows.withColumn("seq", _seq(F.lit(0), F.col("row")))


def accepted(parsed: DataFrame) -> DataFrame:
    """The usable rows."""
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Rejected rows by file and reason."""
    return (
        parsed.filter(F.col("reject_reason").isNotNull())
        .groupBy("file_name", "reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )


def parse_shipments_csv(grid: DataFrame) -> DataFrame:
    """Shipments of a CSV export."""
    rows = _csv_rows(grid, SHIPMENT_CSV)
    made = F.struct(
        cells.parse_datetime(text_grid.cell("appointment_date")).alias("appointment_date"),
        F.lit(None).cast("string").alias("pro_number"),
        cells.clean_text(text_grid.cell("sscc18")).alias("sscc18"),
        cells.clean_text(text_grid.cell("scac")).alias("scac"),
        cells.clean_text(text_grid.cell("order_number")).alias("order_id"),
        cells.clean_text(text_grid.cell("kargo_shipment_id")).alias("shipment_id"),
    )
    # As a generator's output, the cells are parsed once, not again in each filter on them.
    typed = rows.select("file_name", "seq", F.inline(F.array(made)), "broken")
    return typed.withColumn(
        "reject_reason",
        F.when(F.col("broken"), F.lit(BROKEN))
        .when(F.col("sscc18").isNull(), F.lit(NO_PACKAGE))
        .when(F.col("appointment_date").isNull(), F.lit(NO_DATE)),
    ).drop("broken")


def parse_shipments_sheet(grid: DataFrame) -> DataFrame:
    """Shipments of a workbook whose first row names the columns."""
    names = F.transform("header", cells.normalize_header)
    headers = header.with_columns_found(
        header.first_row(grid), header.named_columns(list(SHIPMENT_SHEET), names)
    )
    rows = _sheet_rows(grid, headers)
    made = F.struct(
        cells.parse_datetime(header.value("appointment_date")).alias("appointment_date"),
        *[cells.strip(header.value(n)).alias(n) for n in SHIPMENT_SHEET[1:]],
    )
    # As a generator's output, the cells are parsed once; see parse_shipments_csv.
    typed = rows.select("file_name", "seq", F.inline(F.array(made)))
    return typed.withColumn(
        "reject_reason",
        F.when(F.coalesce("sscc18", F.lit("")) == "", F.lit(NO_PACKAGE)).when(
            F.col("appointment_date").isNull(), F.lit(NO_DATE)
        ),
    )


def parse_rma_summary(grid: DataFrame) -> DataFrame:
    """Credits per carrier of a summary sheet: the first three cells below the heading."""
    rows = _sheet_rows(grid, header.carrier_row(grid))

    def at(index: int) -> Column:
        return F.get(F.col("cells"), F.lit(index))

    credit = cells.amount(at(1)).try_cast(schemas.CREDIT)
    count = cells.whole_number(at(2))
    unreadable = (at(1).isNotNull() & credit.isNull()) | (at(2).isNotNull() & count.isNull())
    return rows.select(
        "file_name",
        "seq",
        cells.strip(F.coalesce(at(0), F.lit(UNKNOWN))).alias("carrier_bp"),
        credit.alias("credit"),
        count.alias("count"),
        F.lit(schemas.DEFAULT_CLAIM_TYPE).alias("claim_type"),
        F.when(unreadable, F.lit(BAD_NUMBER)).alias("reject_reason"),
    )


def parse_order_status_csv(grid: DataFrame) -> DataFrame:
    """Order numbers with their status, as exported."""
    rows = _csv_rows(grid, ORDER_STATUS_CSV)
    typed = rows.select(
        "file_name",
        "seq",
        cells.clean_text(text_grid.cell("order_number")).alias("order_number"),
        cells.clean_text(text_grid.cell("order_status")).alias("order_status"),
        F.coalesce(cells.strip(text_grid.cell("missed_lpns")), F.lit("")).alias("missed_lpns"),
        "broken",
    )
    missing = F.col("order_number").isNull() | F.col("order_status").isNull()
    return typed.withColumn(
        "reject_reason",
        F.when(F.col("broken"), F.lit(BROKEN)).when(missing, F.lit(NO_ORDER)),
    ).drop("broken")


def parse_order_level_csv(grid: DataFrame) -> DataFrame:
    """Order numbers cut out of prefixed numbers, with status and missed packages."""
    rows = _csv_rows(grid, ORDER_LEVEL_CSV)
    number = cells.clean_text(text_grid.cell("ordernumber"))
    status = cells.clean_text(text_grid.cell("orderstatus"))
    parts = F.split(F.coalesce(text_grid.cell("missedlpns"), F.lit("")), r"\|")
    missed = F.filter(F.transform(parts, cells.strip), lambda code: code != "")
    typed = rows.select(
        "file_name",
        "seq",
        number.alias("_number"),
        cells.digits(number).alias("full_number"),
        cells.order_status(status).alias("order_status"),
        missed.alias("missed_lpns"),
        "broken",
    )
    size = F.length("full_number")
    long = size > PREFIX_DIGITS
    full = F.col("full_number")
    return typed.select(
        "file_name",
        "seq",
        F.when(long, F.substr(full, F.lit(PREFIX_DIGITS + 1))).otherwise(full).alias("order_number"),
        "order_status",
        "full_number",
        F.when(long, F.left(full, F.lit(PREFIX_DIGITS))).otherwise(F.lit("")).alias("shipment_id"),
        "missed_lpns",
        F.when(F.col("broken"), F.lit(BROKEN))
        .when(F.col("_number").isNull() | F.col("order_status").isNull(), F.lit(NO_ORDER))
        .when(size < PREFIX_DIGITS, F.lit(SHORT_ORDER))
        .alias("reject_reason"),
    )


def explode_missed_lpns(orders: DataFrame) -> DataFrame:
    """One row per missed package of the parsed order-level rows."""
    return orders.select(
        "order_number", "order_status", F.explode("missed_lpns").alias("sscc18")
    )


_WHOLE_TEXT = ("rma_order_number", "address_number", "ship_to_number")
_WHOLE = ("original_line_number", "line_number", "quantity")


def parse_claim_sheet(
    grid: DataFrame, strict_parity: bool = False, exact_ids: bool = False
) -> DataFrame:
    """Claims of a data sheet in either layout.

    ``exact_ids`` keeps all digits of order and package numbers; by default they
    pass through a double as in the stored data.
    """
    headers = header.with_columns_found(
        header.date_row(grid), header.claim_columns(strict_parity)
    ).filter(F.col("at.effective_date").isNotNull() & F.col("at.credit_issued").isNotNull())
    rows = _sheet_rows(grid, headers)
    # The date column is ISO text only; the wider list of layouts is for shipments.
    date = cells.iso_timestamp(header.value("effective_date"))
    reason = cells.clean_text(header.value("claim_type"))
    made = {
        "claim_date": date,
        "rma_date": date,
        "order_id": cells.int_text(header.value("order_id"), exact_ids),
        "sscc18": cells.int_text(header.value("sscc18"), exact_ids),
        "claim_amount": cells.amount(header.value("credit_issued")).try_cast(schemas.MONEY),
        "claim_type": cells.claim_type(reason),
        "carrier_bp": F.coalesce(cells.clean_text(header.value("carrier_bp")), F.lit(UNKNOWN)),
        "reason_text": reason,
    }
    made.update({n: cells.int_text(header.value(n)) for n in _WHOLE_TEXT})
    made.update({n: cells.whole_number(header.value(n)) for n in _WHOLE})
    typed = rows.select(
        "file_name",
        "seq",
        *[
            (made[f.name] if f.name in made else cells.clean_text(header.value(f.name))).alias(f.name)
            for f in schemas.CLAIM_ROW.fields
        ],
    )
    return typed.withColumn(
        "reject_reason",
        F.when(F.col("claim_date").isNull(), F.lit(NO_DATE)).when(
            F.col("claim_amount").isNull(), F.lit(NO_AMOUNT)
        ),
    )
