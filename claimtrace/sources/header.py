"""Finding the header row of a sheet and the columns it names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace.functions.cells import strip

# Texts that tell a header row.
CARRIER_HEADERS = ("carrier/bp", "carrier_bp")
DATE_HEADER = "effective date"
DATE_HEADER_ROWS = 10

# Header texts of the claim columns found by their first occurrence.
FIRST_WITH = {
    "effective_date": "effective date",
    "credit_issued": "credit issued",
    "order_id": "original order number",
    "sscc18": "shipment number",
    "carrier_bp": "concatenation carrier number",
    "rma_status": "rma status",
    "rma_order_number": "rma order",
    "order_type": "or ty",
    "reference_number_qualifier": "reference number qualifier",
    "bol_number": "bol number",
    "original_line_number": "original line number",
    "returned_material_status": "returned material status",
    "contact_name": "contact name",
    "description": "description",
    "ship_to_number": "ship to number",
    "quantity": "quantity",
    "serial_number_lot": "serial number lot",
    "lot_serial_number": "lot serial number",
    "branch_code": "branch",
    "business_unit_code": "business unit",
    "doc_type": "do ty",
    "address_number": "address number",
}
# Columns found by their last occurrence.
LAST_WITH = {
    "claim_type": "returned reason",
    "branch": "branch",
    "business_unit": "business unit",
}
# Columns that exist only where the header text occurs twice.
FIRST_OF_TWO = {"reason_code": "returned reason"}
LAST_OF_TWO = {"return_doc_type": "do ty", "address_name": "address number"}


def first_row(grid: DataFrame) -> DataFrame:
    """Header rows of sheets whose header is row 1."""
    return _headers(grid.filter(F.col("row") == 1))


def carrier_row(grid: DataFrame) -> DataFrame:
    """Header rows of summary sheets: the first row with a carrier heading."""
    return _headers(
        grid.filter(F.exists("cells", lambda c: F.lower(strip(c)).isin(*CARRIER_HEADERS)))
    )


def date_row(grid: DataFrame) -> DataFrame:
    """Header rows of claim sheets: the first of ten rows that mentions the date heading."""
    early = grid.filter(F.col("row") <= DATE_HEADER_ROWS)
    return _headers(
        early.filter(F.exists("cells", lambda c: F.lower(strip(c)).contains(DATE_HEADER)))
    )


def _headers(rows: DataFrame) -> DataFrame:
    return rows.groupBy("path").agg(
        F.min("row").alias("header_row"), F.min_by("cells", "row").alias("header")
    )


def below_header(grid: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows below their sheet's header, with ``header`` and its columns; others are dropped."""
    return grid.join(headers, "path").filter(F.col("row") > F.col("header_row"))


def _places(test) -> Column:
    names = F.transform("header", lambda h: F.lower(strip(h)))
    return F.transform(names, lambda name, i: F.when(test(name), i))


def _first(test) -> Column:
    return F.array_min(_places(test))


def _last(test) -> Column:
    return F.array_max(_places(test))


def _word(text: str):
    return lambda name: name.rlike(rf"(^|[^a-z]){text}([^a-z]|$)")


def _part(text: str):
    return lambda name: name.contains(text)


def _twice(text: str, place: Column) -> Column:
    found = F.size(F.filter(_places(_part(text)), lambda p: p.isNotNull()))
    return F.when(found > 1, place)


def claim_columns(strict_parity: bool = False) -> dict[str, Column]:
    """Column index of every claim field within ``header``; NULL where the sheet lacks it.

    ``strict_parity`` looks for ``po`` and ``um`` anywhere in a heading, which also
    finds them inside other words, and passes over an item column at index 0.
    """
    at = {name: _first(_part(text)) for name, text in FIRST_WITH.items()}
    at.update({name: _last(_part(text)) for name, text in LAST_WITH.items()})
    for name, text in FIRST_OF_TWO.items():
        at[name] = _twice(text, _first(_part(text)))
    for name, text in LAST_OF_TWO.items():
        at[name] = _twice(text, _last(_part(text)))

    whole = _part if strict_parity else _word
    at["po_number"] = F.coalesce(_first(_part("po #")), _first(whole("po")))
    at["unit_of_measure"] = _first(whole("um"))
    second_item = _first(_part("2nd item"))
    if strict_parity:
        second_item = F.nullif(second_item, F.lit(0))
    at["item_number"] = F.coalesce(second_item, _first(_part("item number")))
    at["line_number"] = _first(lambda n: n.contains("line number") & ~n.contains("original"))
    at["ship_to_name"] = F.coalesce(
        _first(lambda n: n.contains("ship to") & ~n.contains("number")),
        _last(_part("ship to")),
    )
    return at


def named_columns(names: list[str], normalized: Column) -> dict[str, Column]:
    """Column index of each exact name, the last one if repeated; NULL where absent."""

    def place(name: str) -> Column:
        return F.array_max(F.transform(normalized, lambda h, i: F.when(h == name, i)))

    return {name: place(name) for name in names}


def with_columns_found(headers: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Header rows with ``at``, a struct of column indexes. Computed once per file."""
    return headers.withColumn(
        "at", F.struct(*[c.cast("int").alias(name) for name, c in columns.items()])
    )


def value(name: str) -> Column:
    """The row's text in the column found for ``name``; NULL if there is none."""
    return F.get(F.col("cells"), F.col(f"at.{name}"))
