from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import pytest
from claimtrace.sources import files, header, parsers, text_grid, workbook
from claimtrace.sources.tables import durable
from pyspark.sql import functions as F

from registry.workbooks import write_workbook


def folder_with(tmp_path, **contents):
    for name, content in contents.items():
        (tmp_path / name.replace("__", ".")).write_bytes(content)
    return str(tmp_path)


def grid_of(spark, tmp_path, name: str, text: bytes):
    (tmp_path / name).write_bytes(text)
    return text_grid.scan_csv(spark, str(tmp_path / name))


def books(spark, *contents: bytes):
    rows = [(f"/b{i}.xlsx", f"b{i}.xlsx", bytearray(c)) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "path string, file_name string, content binary")


def test_order_level_rows(spark, tmp_path):
    text = (
        b"orderNumber,orderStatus,missedLpns\n"
        b'"\t1111111122222222","INCOMPLETE","00100000000000000017|00100000000000000024"\n'
        b'"\t1111111233333333","COMPLETED",""\n'
        b'"12345678","pending"," a | |b"\n'
        b'"123456789","COMPLETED",""\n'
        b'"1234567","COMPLETED",""\n'
        b'"  ","COMPLETED",""'
    )
    parsed = parsers.parse_order_level_csv(grid_of(spark, tmp_path, "order_level_1,2.csv", text))
    rows = [
        (r.order_number, r.order_status, r.shipment_id, r.missed_lpns)
        for r in parsers.accepted(parsed).orderBy("seq").collect()
    ]
    assert rows == [
        ("22222222", "Short", "11111111", ["00100000000000000017", "00100000000000000024"]),
        ("33333333", "Perfect", "11111112", []),
        ("12345678", "PENDING", "", ["a", "b"]),
        ("9", "Perfect", "12345678", []),
    ]
    rejected = {r.reject_reason: r.rejected_rows for r in parsers.reject_counts(parsed).collect()}
    assert rejected == {parsers.SHORT_ORDER: 1, parsers.NO_ORDER: 1}
    missed = parsers.explode_missed_lpns(parsers.accepted(parsed))
    assert sorted(r.sscc18 for r in missed.collect()) == [
        "00100000000000000017", "00100000000000000024", "a", "b",
    ]


def test_csv_with_mark_quotes_and_line_breaks(spark, tmp_path):
    text = (
        "﻿Order Number,Order_Status,Note\r\n"
        'A1,Perfect,"says ""x, y"""\r\n'
        '\r\n'
        'A2,"Sh\nort","b\n\nc"\r\n'
        "A3,,late\r\n"
        'A4,"x"y\r\n'
    ).encode()
    grid = grid_of(spark, tmp_path, "allorders.csv", text)
    cells = [r.cells for r in grid.orderBy("block", "row").collect()]
    assert cells == [
        ["A1", "Perfect", 'says "x, y"'], ["A2", "Sh\nort", "b\n\nc"], ["A3", "", "late"], ["A4", "xy"],
    ]
    parsed = parsers.accepted(parsers.parse_order_status_csv(grid))
    assert [(r.order_number, r.order_status) for r in parsed.orderBy("seq").collect()] == [
        ("A1", "Perfect"), ("A2", "Sh\nort"), ("A4", "xy"),
    ]


def test_latin1_file_is_decoded_as_a_whole(spark, tmp_path):
    text = "order_number,order_status\nB\xe9,Perfect\nB\xc3\xa9,Short\n".encode("latin-1")
    parsed = parsers.parse_order_status_csv(grid_of(spark, tmp_path, "all_orders.csv", text))
    assert sorted(r.order_number for r in parsed.collect()) == ["B\xc3\xa9", "B\xe9"]


def test_header_may_span_lines_and_a_row_like_it_is_data(spark, tmp_path):
    (tmp_path / "all_orders_1.csv").write_text('"note\non two lines",order_number,order_status\nx,A,Perfect\n')
    (tmp_path / "all_orders_2.csv").write_text("order_status,order_number\nShort,B\norder_status,order_number\nShort,C")
    parsed = parsers.parse_order_status_csv(text_grid.scan_csv(spark, str(tmp_path)))
    assert sorted((r.order_number, r.order_status) for r in parsed.collect()) == [
        ("A", "Perfect"), ("B", "Short"), ("C", "Short"), ("order_number", "order_status"),
    ]


def test_quotes_inside_unquoted_cells_are_text(spark, tmp_path):
    text = 'ordernumber,note,orderstatus\n1111111122222222,5" pipe,COMPLETED\n1111111133333333,,INCOMPLETE\n1111111144444444,"a ""b""",COMPLETED\n'
    grid = grid_of(spark, tmp_path, "order_level_1.csv", text.encode())
    assert sorted(r.cells for r in grid.collect()) == [
        ["1111111122222222", '5" pipe', "COMPLETED"], ["1111111133333333", "", "INCOMPLETE"], ["1111111144444444", 'a "b"', "COMPLETED"],
    ]


def test_long_cells_are_read(spark, tmp_path):
    text = "order_number,order_status\n" + "x" * 200_000 + ',Perfect\n"' + "y" * 200_000 + '",Short\n'
    grid = grid_of(spark, tmp_path, "all_orders.csv", text.encode())
    assert sorted((len(r.cells[0]), r.broken) for r in grid.collect()) == [(200_000, False), (200_000, False)]


def test_missing_columns_give_no_rows(spark, tmp_path):
    grid = grid_of(spark, tmp_path, "a.csv", b"order_number,sscc18\n1,2\n")
    assert parsers.parse_shipments_csv(grid).count() == 0
    assert parsers.parse_order_level_csv(grid).count() == 0


def test_shipments_csv(spark, tmp_path):
    text = (
        b"appointment_date,SSCC18,order_number,Kargo_Shipment_ID,scac\n"
        b"2025-04-01 08:30 PM,001,O1,S1,FXFE\n"
        b"not a date,002,O2,S2,\n"
        b"not a date,  ,O2,S2,\n"
        b"4/1/2025 1:05 pm,003, , ,\n"
    )
    parsed = parsers.parse_shipments_csv(grid_of(spark, tmp_path, "Result_1.csv", text))
    rows = [
        (r.appointment_date, r.sscc18, r.order_id, r.shipment_id, r.scac, r.pro_number)
        for r in parsers.accepted(parsed).orderBy("seq").collect()
    ]
    assert rows == [
        (datetime(2025, 4, 1, 20, 30), "001", "O1", "S1", "FXFE", None),
        (datetime(2025, 4, 1, 13, 5), "003", None, None, None, None),
    ]
    counts = {r.reject_reason: r.rejected_rows for r in parsers.reject_counts(parsed).collect()}
    assert counts == {parsers.NO_DATE: 1, parsers.NO_PACKAGE: 1}


def test_blocks_of_a_split_file_stay_in_order(spark, tmp_path):
    lines = ["order_number,order_status"] + [f'N{i:05d},"a\n{i}"' for i in range(3000)]
    (tmp_path / "all_orders.csv").write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        grid = text_grid.scan_csv(spark, str(tmp_path / "all_orders.csv"))
        assert text_grid.scan_lines(spark, str(tmp_path / "all_orders.csv")).select(
            "block"
        ).distinct().count() > 5
        rows = grid.orderBy("block", "row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [tuple(r.cells) for r in rows] == [(f"N{i:05d}", f"a\n{i}") for i in range(3000)]


def test_unclosed_quote_marks_the_file_broken(spark, tmp_path):
    text = "order_number,order_status\nA,\"open\n" + "".join(f"B{i:0999},Perfect\n" for i in range(9000))
    grid = grid_of(spark, tmp_path, "all_orders.csv", text.encode())
    assert {r.broken for r in grid.select("broken").distinct().collect()} == {True}
    parsed = parsers.parse_order_status_csv(grid)
    assert parsers.accepted(parsed).count() == 0


def test_no_cell_is_too_long(spark, tmp_path):
    part = "x" * 100_000
    text = f'order_number,order_status,a,b\nA,Perfect,"{part}\n","{part}"\nB,Short,{part}{part},\n'
    grid = grid_of(spark, tmp_path, "all_orders.csv", text.encode())
    rows = {r.cells[0]: (r.broken, len(r.cells[2])) for r in grid.collect()}
    assert rows == {"A": (False, 100_001), "B": (False, 200_000)}


def test_a_stray_quote_beside_a_record_of_two_lines(spark, tmp_path):
    text = 'order_number,note,order_status\n1,"two\nlines",COMPLETED\n2,5" pipe,COMPLETED\n3,,INCOMPLETE\n4,,COMPLETED\n'
    grid = grid_of(spark, tmp_path, "all_orders.csv", text.encode())
    assert [(r.cells, r.broken) for r in grid.orderBy("block", "row").collect()] == [
        (["1", "two\nlines", "COMPLETED"], False), (["2", '5" pipe', "COMPLETED"], False),
        (["3", "", "INCOMPLETE"], False), (["4", "", "COMPLETED"], False),
    ]


@pytest.mark.parametrize("block", [1 << 20, 256])
def test_records_equal_a_reader_of_signs(spark, tmp_path, block):
    r = random.Random(block)
    signs = ["a", "b", ",", ",", '"', '"', '""', "\n", "\n", ',"', '",']
    wanted = {}
    for i in range(40):
        text = "h,i\n" + "".join(r.choice(signs) for _ in range(r.choice([12, 60, 900]))) + "\n"
        records, record, inside, start, j = [], "", False, True, 0
        while j < len(text):
            c = text[j]
            if inside and text[j : j + 2] == '""':
                record, j = record + '""', j + 2
                continue
            if c == "\n" and not inside:
                records, record, start = [*records, record], "", True
            else:
                record += c
                if c == '"':
                    inside = not inside if inside or start else inside
                start = c == "," and not inside
            j += 1
        broken = inside
        (tmp_path / f"f{i:02d}.csv").write_text(text)
        wanted[f"f{i:02d}.csv"] = (broken, [] if broken else [x for x in records[1:] if x])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        lines = durable(text_grid.scan_lines(spark, str(tmp_path)))
        joined = text_grid.join_spanning(lines).orderBy("file_name", "block", "row").collect()
        flat = text_grid.grid_from_lines(lines).select("file_name", "broken").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert any(b for b, _ in wanted.values()) and not all(b for b, _ in wanted.values())
    for name, (broken, records) in wanted.items():
        mine = [x for x in joined if x.file_name == name]
        assert {x.broken for x in mine} == {broken}
        if not broken:
            assert [x.line for x in mine if x.line][1:] == records
            assert sum(x.file_name == name for x in flat) == len(records)


def test_a_record_of_many_lines_may_be_large(spark, tmp_path):
    cell = "x" * 99_999 + "\n"
    text = "order_number,order_status,note\nA,Perfect,\"" + cell * 90 + '"\nB,Short,\n'
    (tmp_path / "all_orders_1.csv").write_text(text)
    (tmp_path / "all_orders_2.csv").write_text('order_number,order_status\nC,Short\n"D,Short\n')
    grid = text_grid.scan_csv(spark, str(tmp_path))
    rows = sorted((r.file_name, r.cells[0], r.broken, len(r.cells[-1])) for r in grid.collect())
    assert rows[:2] == [("all_orders_1.csv", "A", False, 9_000_000), ("all_orders_1.csv", "B", False, 0)]
    assert {x[2] for x in rows[2:]} == {True} and len(rows) > 2


def test_big_and_small_files_meet_their_facts(spark, tmp_path):
    for i in range(3):
        head = "order_number,order_status" if i else "order_status,order_number"
        (tmp_path / f"all_orders_{i}.csv").write_text(head + "\n" + "a,b\n" * (i + 1))
    lines = text_grid.scan_lines(spark, str(tmp_path))
    expected = sorted(map(str, text_grid.grid_from_lines(lines).collect()))
    for big in (1, 34):
        other = text_grid.grid_from_lines(lines, big_file=big, broadcast_bytes=0)
        assert sorted(map(str, other.collect())) == expected


def test_shipments_sheet(spark):
    rows = [
        ["APPOINTMENT_DATE", "PRO NUMBER", "SSCC18", "SCAC", "ORDER/ID", "extra"],
        [datetime(2025, 4, 1, 8, 30), "P1", " 0012 ", "FXFE", "61", "x"],
        [],
        ["2025-04-02", 17, 345678901234567890, None, "", None],
        ["never", "P", "5", "FXFE", "1"],
        [datetime(2025, 4, 3), "P", None, "FXFE", "1"],
    ]
    content = write_workbook({"Other": [["a"]], "Sheet1": rows})
    grid = workbook.scan_workbook(books(spark, content), workbook.SHIPMENT_SHEETS)
    parsed = parsers.parse_shipments_sheet(grid)
    got = [
        (r.appointment_date, r.pro_number, r.sscc18, r.scac, r.order_id)
        for r in parsers.accepted(parsed).orderBy("seq").collect()
    ]
    assert got == [
        (datetime(2025, 4, 1, 8, 30), "P1", "0012", "FXFE", "61"),
        (datetime(2025, 4, 2), "17", "345678901234567890", None, ""),
    ]


def test_active_sheet_and_bad_files(spark):
    good = write_workbook(
        {"One": [["x"]], "Two": [["sscc18", "appointment_date"], ["9", "2025-01-01"]]}, active=1
    )
    grid = workbook.scan_workbook(
        books(spark, good, b"PK" + b"x" * 200, b"tiny"), workbook.SHIPMENT_SHEETS
    )
    assert parsers.accepted(parsers.parse_shipments_sheet(grid)).count() == 1
    errors = grid.filter("error is not null").select("file_name", "error").collect()
    assert sorted(r.file_name for r in errors) == ["b1.xlsx", "b2.xlsx"]


def test_rma_summary(spark):
    rows = [["Report"], [], ["Carrier/BP ", "Credit", "Count"], ["FXFE ", 12.345678, 3], [None, "7", None],
            ["BAD", "x", 1]]
    grid = workbook.scan_workbook(
        books(spark, write_workbook({"Summary": rows})), workbook.RMA_SHEETS
    )
    parsed = parsers.parse_rma_summary(grid.filter("role = 'credits'"))
    got = [(r.carrier_bp, r.credit, r["count"]) for r in parsers.accepted(parsed).orderBy("seq").collect()]
    assert got == [("FXFE", Decimal("12.3457"), 3), ("Unknown", Decimal("7.0000"), None)]
    assert parsed.filter("reject_reason is not null").count() == 1


LONG_HEADER = (
    "Effective Date,RMA Status,Do Ty,RMA Order,PO #,Or Ty,Original Order Number,"
    "Reference Number Qualifier,BOL Number,Shipment Number,Original Line Number,Line Number,Do Ty,"
    "Returned Material Status,Contact Name,Description,Address Number,Address Number,Ship To Number,"
    "Ship To,2nd Item Number,UM,Quantity,Credit Issued,Returned Reason,Returned Reason,Branch,Branch,"
    "Business Unit,Business Unit,Concatenation Carrier Number,Serial Number Lot,Lot Serial Number"
).split(",")


def long_row(**values):
    row = [f"v{i}" for i in range(len(LONG_HEADER))]
    for name, value in values.items():
        row[int(name[1:])] = value
    return row


def claim_rows(spark, rows, **options):
    grid = workbook.scan_workbook(
        books(spark, write_workbook({"Data": rows})), workbook.RMA_SHEETS
    ).filter("role = 'claims'")
    return parsers.parse_claim_sheet(grid, **options)


def test_claim_sheet_long_layout(spark):
    when = datetime(2025, 5, 1, 13, 5)
    rows = [
        ["Title"], [], LONG_HEADER,
        long_row(_0=when, _6="0012345.0", _9="00100854129315998618", _10="3.9", _11="x", _22="-2.5",
                 _23=-12.345, _24="K12", _25=" OBSOLETE - SHORTAGE - CC ", _16=77, _18="12D"),
        long_row(_0="2025-05-02", _23="1e2", _25="DAMAGED IN TRANSIT", _30=None),
        long_row(_0="05/03/2025", _23=1),
        long_row(_0="2025-05-04", _23="n/a"),
        long_row(_0=None, _23=1),
    ]
    parsed = claim_rows(spark, rows)
    one, two = parsers.accepted(parsed).orderBy("seq").collect()
    assert one.claim_date == when and one.rma_date == when
    assert one.claim_amount == Decimal("-12.35")  # half up on the shown decimals
    assert (one.order_id, one.sscc18) == ("12345", "100854129315998624")
    assert (one.claim_type, one.reason_text, one.reason_code) == (
        "SHORTAGE", "OBSOLETE - SHORTAGE - CC", "K12")
    assert (one.original_line_number, one.line_number, one.quantity) == (3, None, -2)
    assert (one.doc_type, one.return_doc_type) == ("v2", "v12")
    assert (one.address_number, one.address_name) == ("77", "v17")
    assert (one.ship_to_number, one.ship_to_name) == ("12D", "v19")
    assert (one.branch_code, one.branch) == ("v26", "v27")
    assert (one.business_unit_code, one.business_unit) == ("v28", "v29")
    assert (one.item_number, one.unit_of_measure, one.po_number) == ("v20", "v21", "v4")
    assert (one.serial_number_lot, one.lot_serial_number) == ("v31", "v32")
    assert (one.rma_status, one.rma_order_number, one.order_type) == ("v1", "v3", "v5")
    assert (one.reference_number_qualifier, one.bol_number) == ("v7", "v8")
    assert (one.returned_material_status, one.contact_name, one.description) == ("v13", "v14", "v15")
    assert (two.claim_type, two.carrier_bp, two.claim_amount) == ("DAMAGE", "Unknown", Decimal("100.00"))
    counts = {r.reject_reason: r.rejected_rows for r in parsers.reject_counts(parsed).collect()}
    assert counts == {parsers.NO_DATE: 2, parsers.NO_AMOUNT: 1}
    strict = parsers.accepted(claim_rows(spark, rows, strict_parity=True)).orderBy("seq").first()
    assert strict.unit_of_measure == "0012345.0"  # found inside "Original Order Number"
    exact = parsers.accepted(claim_rows(spark, rows, exact_ids=True)).orderBy("seq").first()
    assert exact.sscc18 == "00100854129315998618"


def test_claim_sheet_compact_layout(spark):
    head = ["Effective Date", "Original Order Number", "Shipment Number", "Credit Issued",
            "Concatenation Carrier Number", "Returned Reason", "Ship To"]
    rows = [head, [datetime(2025, 1, 2), 61, None, 5, "HSNR", None, "Clinic"],
            [datetime(2025, 1, 3), None, "abc", 5, "HSNR", "OTHER", None]]
    one, two = parsers.accepted(claim_rows(spark, rows)).orderBy("seq").collect()
    assert (one.order_id, one.sscc18, one.claim_type, one.reason_text) == ("61", None, "SHORTAGE", None)
    assert (one.reason_code, one.ship_to_name, one.quantity) == (None, "Clinic", None)
    assert (two.claim_type, two.sscc18, two.ship_to_name) == ("OTHER", "abc", None)


def test_claim_sheet_without_credit_column(spark):
    assert claim_rows(spark, [["Effective Date", "Qty"], [datetime(2025, 1, 1), 1]]).count() == 0


@pytest.mark.parametrize(
    ("name", "parser", "strict"),
    [
        ("AllOrders.csv", "order_status_csv", "order_status_csv"),
        ("ORDER_LEVEL_1,2.csv", "order_level_csv", "order_level_csv"),
        ("MS_Kargo.xlsx", "shipments_sheet", "shipments_sheet"),
        ("kargo_result.csv", "shipments_csv", "shipments_sheet"),
        ("Result_27.CSV", "shipments_csv", "shipments_csv"),
        ("CS_RMA_DETAIL.xlsx", "rma_workbook", "rma_workbook"),
        ("performance.xlsx", "shipments_sheet", "rma_workbook"),
        ("all_orders_order_level.csv", "order_status_csv", "order_status_csv"),
        ("other.csv", "shipments_csv", "shipments_csv"),
        ("other.xlsx", "shipments_sheet", "shipments_sheet"),
    ],
)
def test_routing(spark, name, parser, strict):
    row = spark.range(1).select(
        files.parser_of(F.lit(name)).alias("a"), files.parser_of(F.lit(name), True).alias("b")
    ).first()
    assert (row.a, row.b) == (parser, strict)


def test_folder_scan(spark, tmp_path):
    odd = "order_level [1],2 %41+b.csv"
    (tmp_path / odd).write_bytes(b"orderNumber,orderStatus\n1234567812345678,COMPLETED\n")
    (tmp_path / "x.xlsx").write_bytes(b"1")
    (tmp_path / "x.txt").write_bytes(b"1")
    found = files.scan_folder(spark, str(tmp_path))
    assert sorted(r.file_name for r in found.collect()) == [odd, "x.xlsx"]
    path = found.filter(F.col("file_name") == odd).first().path
    assert {r.file_name for r in text_grid.scan_csv(spark, files.literal_path(path)).collect()} == {odd}
    assert files.scan_folder(spark, str(tmp_path / "missing")).count() == 0


def test_header_rows(spark):
    data = [("p", 1, ["x", None]), ("p", 2, [" Carrier/BP", "a"]), ("p", 3, ["carrier_bp", "b"]),
            ("q", 11, ["Effective Date"]), ("r", 10, ["the EFFECTIVE DATE is"])]
    grid = spark.createDataFrame(data, "path string, row long, cells array<string>")
    assert [tuple(r) for r in header.carrier_row(grid).collect()] == [("p", 2, [" Carrier/BP", "a"])]
    assert [r.path for r in header.date_row(grid).collect()] == ["r"]


def test_plain_quoted_lines_split_as_others_do(spark):
    lines = ['"a",b,"c d"', '"",x,""', ',"a",', '"a"b,"c"', '"a,b",c', '"a""b",c', 'a"b"c,d']
    lines.append(",".join(['"x"', "y"] * 20_000))
    given = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    split = {r.i: r.cells for r in given.select("i", text_grid.split_fields(F.col("line")).alias("cells")).collect()}
    assert [split[i] for i in range(7)] == [
        ["a", "b", "c d"], ["", "x", ""], ["", "a", ""], ["ab", "c"], ["a,b", "c"], ['a"b', "c"], ['a"b"c', "d"]
    ]
    assert split[7] == ["x", "y"] * 20_000


def test_dates_of_a_sheet_are_parsed_once(spark):
    rows = [("/s", "s.xlsx", 1, ["APPOINTMENT_DATE", "SSCC18"]), ("/s", "s.xlsx", 2, ["2025-04-01 10:00:00", "p1"]), ("/s", "s.xlsx", 3, ["x", "p2"])]
    grid = spark.createDataFrame(rows, "path string, file_name string, row long, cells array<string>")
    good = parsers.accepted(parsers.parse_shipments_sheet(grid))
    assert [(r.sscc18, r.appointment_date) for r in good.collect()] == [("p1", datetime(2025, 4, 1, 10))]
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    # Filters on the date stand on the parsed column, above the generator.
    above, below = plan.split("Generate", 1)
    assert "Filter" in above and "gettimestamp" not in above.lower()
