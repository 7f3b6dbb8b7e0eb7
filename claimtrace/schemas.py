"""Declared schemas of the stored tables and of the parsed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
CREDIT = T.DecimalType(15, 4)
# Daily totals add up many claims, so they get more digits than one claim.
DAY_MONEY = T.DecimalType(20, 2)

DEFAULT_CLAIM_TYPE = "Short Shipment"

_TEXT = T.StringType()
_TIME = T.TimestampType()
_INT = T.IntegerType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Where a parsed row came from: file name order, then place in the file.
SEQ = T.StructType(
    [
        T.StructField("file_name", _TEXT),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)

PROCESSED_ATTACHMENTS = _schema(
    ("attachment_hash", _TEXT),
    ("filename", _TEXT),
    ("email_id", _TEXT),
    ("processed_at", _TIME),
)

SHIPMENT_ROW = _schema(
    ("appointment_date", _TIME),
    ("pro_number", _TEXT),
    ("sscc18", _TEXT),
    ("scac", _TEXT),
    ("order_id", _TEXT),
    ("shipment_id", _TEXT),
)

SHIPMENTS = T.StructType(
    SHIPMENT_ROW.fields
    + _schema(("source_file", _TEXT), ("ingested_at", _TIME), ("order_status", _TEXT)).fields
)

RMA_CREDITS = _schema(
    ("carrier_bp", _TEXT),
    ("credit", CREDIT),
    ("count", _INT),
    ("claim_type", _TEXT),
    ("source_file", _TEXT),
    ("ingested_at", _TIME),
)

CLAIM_CORE = _schema(
    ("claim_date", _TIME),
    ("order_id", _TEXT),
    ("sscc18", _TEXT),
    ("claim_amount", MONEY),
    ("claim_type", _TEXT),
    ("carrier_bp", _TEXT),
)

CLAIM_EXTENSION = _schema(
    ("rma_status", _TEXT),
    ("rma_date", _TIME),
    ("doc_type", _TEXT),
    ("return_doc_type", _TEXT),
    ("rma_order_number", _TEXT),
    ("po_number", _TEXT),
    ("order_type", _TEXT),
    ("reference_number_qualifier", _TEXT),
    ("bol_number", _TEXT),
    ("original_line_number", _INT),
    ("line_number", _INT),
    ("returned_material_status", _TEXT),
    ("contact_name", _TEXT),
    ("description", _TEXT),
    ("address_number", _TEXT),
    ("address_name", _TEXT),
    ("ship_to_number", _TEXT),
    ("ship_to_name", _TEXT),
    ("item_number", _TEXT),
    ("unit_of_measure", _TEXT),
    ("quantity", _INT),
    ("reason_code", _TEXT),
    ("reason_text", _TEXT),
    ("branch_code", _TEXT),
    ("branch", _TEXT),
    ("business_unit_code", _TEXT),
    ("business_unit", _TEXT),
    ("serial_number_lot", _TEXT),
    ("lot_serial_number", _TEXT),
)

CLAIM_ROW = T.StructType(CLAIM_CORE.fields + CLAIM_EXTENSION.fields)
CLAIM_DETAILS = T.StructType(CLAIM_ROW.fields + _schema(("ingested_at", _TIME)).fields)

CLAIM_DAILY_HISTORY = _schema(
    ("claim_date", T.DateType()),
    ("total_amount", DAY_MONEY),
    ("claim_count", T.LongType()),
    ("moving_avg_7d", DAY_MONEY),
)

LOAD_AUDIT = _schema(
    ("batch", _TEXT),
    ("file_name", _TEXT),
    ("file_kind", _TEXT),
    ("outcome", _TEXT),
    ("reason", _TEXT),
    ("parsed_rows", T.LongType()),
    ("inserted_rows", T.LongType()),
    ("updated_rows", T.LongType()),
    ("duplicate_rows", T.LongType()),
    ("logged_at", _TIME),
    ("unique_rows", T.LongType()),
    ("duplicate_rows_in_file", T.LongType()),
    ("duplicate_rows_existing", T.LongType()),
    # Of status files: shipment rows they are about, and their own rows about none.
    ("shipments_updated", T.LongType()),
    ("not_found_rows", T.LongType()),
    ("rejected_rows", T.LongType()),
    ("reject_reasons", _TEXT),
)

TABLES = {
    "processed_attachments": PROCESSED_ATTACHMENTS,
    "shipments": SHIPMENTS,
    "rma_credits": RMA_CREDITS,
    "claim_details": CLAIM_DETAILS,
    "claim_daily_history": CLAIM_DAILY_HISTORY,
    "load_audit": LOAD_AUDIT,
}

# The latest status row of each number and kind, and whether the number is an order; kept beside the tables above.
STATUS_ROWS = T.StructType(
    _schema(("order_number", _TEXT), ("order_status", _TEXT), ("by_suffix", T.BooleanType())).fields
    + SEQ.fields
    + _schema(("applied_at", _TIME), ("file_time", _TIME), ("is_order", T.BooleanType())).fields
)
# How many shipments have a match key, carrier and status; loads add what changes, so the numbers of a key add up.
MATCH_KEYS = _schema(("match_key", _TEXT), ("scac", _TEXT), ("order_status", _TEXT), ("n", T.LongType()))
STORED = {**TABLES, "status_rows": STATUS_ROWS, "match_keys": MATCH_KEYS}

# Length limits of the stored text columns; see ``over_long``.
TEXT_LIMITS = {
    "shipments": {
        "pro_number": 50,
        "sscc18": 30,
        "scac": 10,
        "order_id": 50,
        "shipment_id": 50,
        "source_file": 255,
        "order_status": 20,
    },
    "rma_credits": {"claim_type": 100, "source_file": 255},
    "claim_details": {
        "order_id": 50,
        "sscc18": 30,
        "claim_type": 50,
        "rma_status": 20,
        "doc_type": 10,
        "return_doc_type": 10,
        "rma_order_number": 50,
        "po_number": 50,
        "order_type": 10,
        "reference_number_qualifier": 50,
        "bol_number": 50,
        "address_number": 50,
        "ship_to_number": 50,
        "item_number": 50,
        "unit_of_measure": 20,
        "reason_code": 10,
        "branch_code": 50,
        "business_unit_code": 50,
    },
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema``; a column it lacks becomes a typed NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def over_long(df: DataFrame, table: str) -> DataFrame:
    """Rows with a text value beyond the length limit of ``table``.

    A load with such rows is refused, so check before merging.
    """
    limits = {c: n for c, n in TEXT_LIMITS.get(table, {}).items() if c in df.columns}
    broken = F.lit(False)
    for column, limit in limits.items():
        broken = broken | F.coalesce(F.length(column) > limit, F.lit(False))
    return df.filter(broken)
