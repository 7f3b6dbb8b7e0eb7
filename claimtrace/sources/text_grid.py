"""CSV files as rows of cells.

Files are read as text lines, so a large file is split over many tasks. What a
line needs to know about its file - encoding, place of each column, whether
records run over several lines - comes from one aggregation per file, which runs
when a grid is made, as schema inference does. Its result has one row per file.
A later line equal to the header line is data like any other.
When it is small, by its measured bytes, it is broadcast and no line is shuffled.
Otherwise only the facts of large files are broadcast (at most total bytes /
``BIG_FILE`` rows), and the lines of other files meet theirs in an ordinary join,
where one file is never more than ``BIG_FILE`` bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimtrace.functions.cells import normalize_header
from claimtrace.sources.tables import durable

BIG_FILE = 1 << 30
BROADCAST_BYTES = 64 << 20
SPREAD = 4096

# Fixed value: byte order mark.
BYTE_ORDER_MARK = "\ufeff"
# Normalised names of the columns that are read.
COLUMNS = (
    "order_number",
    "sscc18",
    "scac",
    "kargo_shipment_id",
    "appointment_date",
    "order_status",
    "missed_lpns",
    "ordernumber",
    "orderstatus",
    "missedlpns",
)

_FIELD = r',("[^"]*(?:""[^"]*)*"[^,]*|[^,]*)'
# Whole cells, then a quoted one without its end; possessive, so that long cells need no stack.
_BEGUN = r'(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+),)*+"[^"]*+(?:""[^"]*+)*+'
_OPEN = "^" + _BEGUN + "$"
# The same for a line that starts inside a quoted cell, which goes on to the end or closes first.
_STAYS_OPEN = r'^[^"]*+(?:""[^"]*+)*+(?:"[^,]*+,' + _BEGUN + ")?$"
# Every cell is without quotes, or quoted as a whole with neither quote nor comma inside.
_PLAIN = r'^(?:"[^",]*+"|[^",]*+)(?:,(?:"[^",]*+"|[^",]*+))*+\z'
_QUOTED = r'(?s)^"((?:[^"]|"")*+)"(.*)$'


def scan_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of text files with their place: ``path file_name file_size block row line``.

    Row numbers rise within a block and blocks within a file, so (block, row) is
    the order of lines in the file.
    """
    text = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    # The metadata escapes the name as in a URL, but leaves a plus sign as it is.
    escaped = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.url_decode(escaped).alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )


def _unquoted(cell: Column) -> Column:
    """The cell without its quotes, doubled quotes made single."""
    one, two = F.lit('"'), F.lit('""')
    inner = F.substr(cell, F.lit(2), F.greatest(F.length(cell) - 2, F.lit(0)))
    closed = cell.endswith('"') & ~F.replace(inner, two, F.lit("")).contains('"')
    # Text after the closing quote belongs to the cell.
    body = F.replace(F.regexp_extract(cell, _QUOTED, 1), two, one)
    whole = F.concat(body, F.regexp_extract(cell, _QUOTED, 2))
    return (
        F.when(~cell.startswith('"'), cell)
        .when(closed & (F.length(cell) > 1), F.replace(inner, two, one))
        .otherwise(whole)
    )


def split_fields(line: Column) -> Column:
    """Cells of a CSV record."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    unquoted = F.replace(line, F.lit('"'), F.lit(""))
    return (
        F.when(~line.contains('"'), F.split(line, ",", -1))
        .when(line.rlike(_PLAIN), F.split(unquoted, ",", -1))
        .otherwise(F.transform(quoted, _unquoted))
    )


def _decoded(utf8: Column, line: Column) -> Column:
    """The line as text: UTF-8 if the whole file is valid UTF-8, else Latin-1."""
    return F.when(utf8, line).otherwise(F.decode(line.cast("binary"), "ISO-8859-1"))


def _left_open(line: Column) -> Column:
    """Whether a record that starts with the line goes on after it: its last cell is quoted and open.

    A quote opens a cell only as its first character; anywhere else in an unquoted cell it is text.
    """
    return F.coalesce(line.contains('"') & line.rlike(_OPEN), F.lit(False))


def _stays_open(line: Column) -> Column:
    """Whether a record that is inside a quoted cell where the line starts goes on after the line."""
    return F.coalesce(~line.contains('"') | line.rlike(_STAYS_OPEN), F.lit(True))


def file_facts(lines: DataFrame, names: Sequence[str] = COLUMNS) -> DataFrame:
    """One row per file: encoding, column places, first line, and whether records span lines."""
    facts = lines.groupBy("path").agg(
        F.first("file_size").alias("file_size"),
        F.bool_and(F.is_valid_utf8("line")).alias("utf8"),
        F.min(F.struct("block", "row", "line")).alias("_first"),
        F.bool_or(_left_open(F.col("line"))).alias("spanning"),
    )
    first = F.regexp_replace(
        _decoded(F.col("utf8"), F.col("_first.line")), "^" + BYTE_ORDER_MARK, ""
    )
    headed = facts.withColumn("_header", F.transform(split_fields(first), normalize_header))
    # Of equal names the last one counts.
    turned = F.reverse("_header")
    place = {
        name: F.when(
            F.array_position(turned, name) > 0,
            (F.size("_header") - F.array_position(turned, name)).cast("int"),
        )
        for name in names
    }
    return headed.select(
        "path",
        "file_size",
        "utf8",
        "spanning",
        F.col("_first.line").alias("first_line"),
        F.struct("_first.block", "_first.row").alias("first_place"),
        F.struct(*[c.alias(name) for name, c in place.items()]).alias("at"),
    )


def _with_facts(lines: DataFrame, facts: DataFrame, small: bool, big_file: int) -> DataFrame:
    """Lines joined with the facts of their file; ``small`` facts are broadcast whole."""
    names = [c for c in facts.columns if c not in ("path", "file_size")]
    packed = facts.select("path", "file_size", F.struct(*names).alias("_facts"))
    if small:
        joined = lines.join(F.broadcast(packed.drop("file_size")), "path")
        return joined.select(*lines.columns, "_facts.*")
    big = F.broadcast(
        packed.filter(F.col("file_size") >= big_file).select(
            F.col("path").alias("_big"), F.col("_facts").alias("_big_facts")
        )
    )
    rest = packed.filter(F.col("file_size") < big_file).select(
        F.concat(F.lit("f"), F.col("path")).alias("_rest"), F.col("_facts").alias("_rest_facts")
    )
    spread = F.concat(
        F.lit("s"), F.pmod(F.xxhash64("block", "row"), F.lit(SPREAD)).cast("string")
    )
    route = F.when(F.col("file_size") >= big_file, spread).otherwise(
        F.concat(F.lit("f"), F.col("path"))
    )
    return (
        lines.join(big, F.col("path") == F.col("_big"), "left")
        .withColumn("_route", route)
        .join(rest, F.col("_route") == F.col("_rest"), "left")
        .withColumn("_facts", F.coalesce("_big_facts", "_rest_facts"))
        .select(*lines.columns, "_facts.*")
    )


def join_spanning(lines: DataFrame) -> DataFrame:
    """Records of several lines put together; ``lines`` come from files that have such records.

    Whether a cell is open after a line depends on the line and on whether one was open
    before it: a line settles that, keeps it, or turns it around. So the state is that of
    the last line that settles it, turned around by each later line that does; both are
    running values within a block, carried from block to block, and no task sees a whole
    file. A file that ends inside a quoted cell has a quote that was never closed: its lines
    stay in pieces, marked in ``broken``, and it cannot be read. Else a record may have any
    length that one text can have.
    """
    in_block = Window.partitionBy("path", "block").orderBy("row")
    up_to_here = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over_blocks = Window.partitionBy("path").orderBy("block")
    up_to_block = over_blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_blocks = over_blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier_blocks = over_blocks.rowsBetween(Window.unboundedPreceding, -1)

    def state(settled: str, turns: str) -> Column:
        """Whether a cell is open; none is at the start of a file."""
        last = F.col(settled)
        since = F.col(turns) - F.coalesce(last["turns"], F.lit(0))
        return (F.coalesce(last["open"].cast("int"), F.lit(0)) + since) % 2 == 1

    counted = (
        lines.select(
            "path",
            "block",
            "row",
            _left_open(F.col("line")).alias("_if_closed"),
            _stays_open(F.col("line")).alias("_if_open"),
        )
        .withColumn("_turn", (F.col("_if_closed") & ~F.col("_if_open")).cast("int"))
        .withColumn("_turns", F.sum("_turn").over(up_to_here))
    )
    settles = F.when(
        F.col("_if_closed") == F.col("_if_open"),
        F.struct(F.col("_turns").alias("turns"), F.col("_if_closed").alias("open")),
    )
    counted = counted.withColumn("_settled", F.last(settles, True).over(up_to_here))
    # Turns of a block are counted on from those of the blocks before.
    blocks = (
        counted.groupBy("path", "block")
        .agg(F.max("_turns").alias("_sum"), F.max_by("_settled", "row").alias("_settled"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier_blocks), F.lit(0)))
    )
    shifted = F.when(
        F.col("_settled").isNotNull(),
        F.struct((F.col("_settled.turns") + F.col("_offset")).alias("turns"), F.col("_settled.open").alias("open")),
    )
    blocks = (
        blocks.withColumn("_own", shifted)
        .withColumn("_before", F.last("_own", True).over(earlier_blocks))
        .withColumn("_after", F.last("_own", True).over(up_to_block))
        .withColumn("_all", F.col("_offset") + F.col("_sum"))
        .withColumn("_was_open", state("_before", "_offset"))
        .withColumn("_ends_open", state("_after", "_all"))
    )
    blocks = blocks.withColumn("broken", F.last("_ends_open").over(all_blocks))
    offsets = blocks.select("path", "block", "_was_open", "broken")
    # Open after the line; without a settling line before it in the block, that of the block's start counts.
    here = F.when(F.col("_settled").isNotNull(), state("_settled", "_turns")).otherwise(
        F.col("_was_open") != (F.col("_turns") % 2 == 1)
    )
    placed = (
        counted.join(offsets, ["path", "block"])
        .withColumn("_open", here)
        .withColumn(
            "_starts",
            F.col("broken") | ~F.coalesce(F.lag("_open").over(in_block), F.col("_was_open")),
        )
    )
    placed = placed.withColumn(
        "_start_row", F.max(F.when(F.col("_starts"), F.col("row"))).over(up_to_here)
    )
    carried = (
        placed.groupBy("path", "block")
        .agg(F.max(F.when(F.col("_starts"), F.struct("block", "row"))).alias("_last"))
        .withColumn("_carried", F.max("_last").over(earlier_blocks))
        .select("path", "block", "_carried")
    )
    record = F.when(
        F.col("_start_row").isNotNull(),
        F.struct(F.col("block"), F.col("_start_row").alias("row")),
    ).otherwise(F.col("_carried"))
    named = placed.join(carried, ["path", "block"]).select(
        "path", "block", "row", record.alias("_record"), "broken"
    )
    rest = [c for c in lines.columns if c not in ("path", "block", "row", "line")]
    # The texts are shuffled only here: to their record, and with it.
    joined = (
        lines.join(named, ["path", "block", "row"])
        .groupBy("path", "_record")
        .agg(
            *[F.first(c).alias(c) for c in rest],
            F.array_sort(F.collect_list(F.struct("block", "row", "line"))).alias("_lines"),
            F.first("broken").alias("broken"),
        )
    )
    return joined.select(
        "path",
        F.col("_record.block").alias("block"),
        F.col("_record.row").alias("row"),
        *rest,
        F.array_join(F.col("_lines.line"), "\n").alias("line"),
        "broken",
    )


def grid_from_lines(
    lines: DataFrame,
    names: Sequence[str] = COLUMNS,
    big_file: int = BIG_FILE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Data rows of CSV files: ``path file_name block row at cells broken``.

    ``cells`` holds the texts of the row, ``at`` the index of each of the ``names``
    that the file's first line has. ``broken`` marks a piece of a record whose quote was
    never closed; a file with such a row cannot be read.
    """
    facts = durable(file_facts(lines, names))
    per_file = F.length("path") + F.length("first_line") + F.lit(8 * len(names) + 64)
    size, spanning = facts.agg(F.sum(per_file), F.bool_or("spanning")).first()
    small = (size or 0) <= broadcast_bytes
    known = _with_facts(lines, facts, small, big_file)
    # Row numbers can differ between two scans, so the header is known by its text; of the lines
    # with that text, all but the first are data.
    is_header = F.col("line") == F.col("first_line")
    flat = known.filter(~F.col("spanning") & ~is_header)
    alike = known.filter(~F.col("spanning") & is_header)
    nth = F.row_number().over(Window.partitionBy("path").orderBy("block", "row"))
    flat = flat.unionByName(alike.withColumn("_nth", nth).filter("_nth > 1").drop("_nth"))
    records = flat.withColumn("line", _decoded(F.col("utf8"), F.col("line"))).select(
        *lines.columns, "at", F.lit(False).alias("broken")
    )
    if spanning:
        records = records.unionByName(
            _spanning_records(known.filter("spanning"), lines.columns, names, small, big_file)
        )
    split = records.filter(F.col("line") != "").withColumn("cells", split_fields(F.col("line")))
    return split.select(
        "path",
        "file_name",
        "block",
        "row",
        "at",
        "cells",
        "broken",
    )


def _spanning_records(
    known: DataFrame, columns: Sequence[str], names: Sequence[str], small: bool, big_file: int
) -> DataFrame:
    """Records of files in which some span lines; there the header may span lines too.

    The lines are written once, because they are needed several times and their
    numbers must stay the same.
    """
    decoded = known.withColumn("line", _decoded(F.col("utf8"), F.col("line")))
    joined = durable(join_spanning(durable(decoded.select(*columns))))
    facts = durable(file_facts(joined, names))
    rows = _with_facts(joined, facts, small, big_file)
    place = F.struct("block", "row")
    return rows.filter(place != F.col("first_place")).select(*columns, "at", "broken")


def scan_csv(
    spark: SparkSession, paths: str | Sequence[str], names: Sequence[str] = COLUMNS
) -> DataFrame:
    """Data rows of CSV files; see ``grid_from_lines``."""
    return grid_from_lines(scan_lines(spark, paths), names)


def require_columns(grid: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows of the files whose header has all the required names."""
    condition = F.lit(True)
    for name in required:
        condition = condition & F.col(f"at.{name}").isNotNull()
    return grid.filter(condition)


def cell(name: str) -> Column:
    """The row's text under a header name; NULL if the file or the row lacks it."""
    return F.get(F.col("cells"), F.col(f"at.{name}"))
