"""Drop folder and mail manifest: which files to read, and as what."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtrace.functions.cells import content_hash

# File types read, identifier prefix of drop-folder files.
FILE_GLOB = "*.{xlsx,csv}"
FILE_PATTERN = r"\.(xlsx|csv)$"
FOLDER_PREFIX = "demo::"
# CSV files beyond this size are told apart by their lines, not read in one piece.
WHOLE_FILE = 256 << 20
# Largest file that fits in one value.
LARGEST_VALUE = (1 << 31) - 1024

BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

# Names of the parsers a file is routed to, with the kind of table they feed.
KINDS = {
    "order_status_csv": "order_status",
    "order_level_csv": "order_level",
    "shipments_sheet": "shipments",
    "shipments_csv": "shipments",
    "rma_workbook": "rma",
}


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def literal_path(path: str) -> str:
    """The path for a reader that takes patterns, with pattern characters escaped."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def read_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files with their content, named; content is only read where it is used."""
    return with_names(spark.read.schema(BINARY_FILE).format("binaryFile").load(paths))


def scan_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The workbooks and CSV files of a folder with their content; none if it is missing."""
    try:
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", FILE_GLOB).load(folder)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], BINARY_FILE)
    return with_names(files)


def with_names(files: DataFrame) -> DataFrame:
    """Files plus ``file_name`` and ``email_id``."""
    named = files.withColumn("file_name", file_name(F.col("path")))
    return named.withColumn("email_id", F.concat(F.lit(FOLDER_PREFIX), F.col("file_name")))


def supported(files: DataFrame) -> DataFrame:
    """Workbooks and CSV files by name, in any letter case."""
    return files.filter(F.lower("file_name").rlike(FILE_PATTERN))


def keyword_allowed(files: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Files whose name holds one of the keywords; no keywords allow all."""
    words = [k.strip().lower() for k in keywords if k.strip()]
    if not words:
        return files
    name = F.lower("file_name")
    allowed = F.lit(False)
    for word in words:
        allowed = allowed | name.contains(word)
    return files.filter(allowed)


def sender_allowed(mails: DataFrame, senders: Sequence[str]) -> DataFrame:
    """Mails from one of the senders; no senders allow all."""
    known = [s.strip().lower() for s in senders if s.strip()]
    if not known:
        return mails
    return mails.filter(F.lower("sender").isin(*known))


def unread_with_attachments(mails: DataFrame) -> DataFrame:
    """Unread mails that carry attachments."""
    return mails.filter(~F.col("is_read") & F.col("has_attachments"))


def parser_of(name: Column, strict_parity: bool = False) -> Column:
    """The parser for a file name; the first rule that fits decides.

    By default ``rma`` has to stand alone and the scanner vendor's name in a CSV
    name leads to the CSV parser. ``strict_parity`` takes both words anywhere and
    reads every file with the vendor's name as a workbook.
    """
    lower = F.lower(name)
    csv = lower.endswith(".csv")
    # Words in file names.
    status = lower.contains("allorders") | lower.contains("all_orders")
    level = lower.contains("order_level")
    vendor = lower.contains("kargo")
    export = lower.contains("result") | lower.contains("shipment")
    rma = lower.contains("rma") if strict_parity else lower.rlike("(^|[^a-z])rma([^a-z]|$)")
    if not strict_parity:
        vendor = vendor & ~csv
    return (
        F.when(status, F.lit("order_status_csv"))
        .when(level, F.lit("order_level_csv"))
        .when(vendor, F.lit("shipments_sheet"))
        .when(csv & export, F.lit("shipments_csv"))
        .when(rma, F.lit("rma_workbook"))
        .when(csv, F.lit("shipments_csv"))
        .otherwise(F.lit("shipments_sheet"))
    )


def kind_of(parser: Column) -> Column:
    """The kind of data a parser yields."""
    kind = F.lit(None).cast("string")
    for name, value in KINDS.items():
        kind = F.when(parser == name, F.lit(value)).otherwise(kind)
    return kind


def route(files: DataFrame, strict_parity: bool = False) -> DataFrame:
    """Files plus ``parser`` and ``file_kind``."""
    routed = files.withColumn("parser", parser_of(F.col("file_name"), strict_parity))
    return routed.withColumn("file_kind", kind_of(F.col("parser")))


def load_order(name: Column) -> Column:
    """Sort key of files within one load: workbooks first, then by name."""
    return F.struct(F.lower(name).endswith(".csv").alias("csv"), name.alias("name"))


def with_hash(files: DataFrame) -> DataFrame:
    """Files plus ``attachment_hash`` of their content."""
    return files.withColumn("attachment_hash", content_hash(F.col("content")))


def line_hash(lines: DataFrame) -> DataFrame:
    """One hash per file from its lines and their order: ``file_name attachment_hash``.

    A line's hash counts as often as its number in the file says. These sums are taken per block,
    where the lines are read, and moved by the lines of the blocks before, so a file of any size is
    spread over many tasks and the hash does not depend on where blocks end.
    """
    place = F.col("row").bitwiseAND((1 << 33) - 1)  # rows of one scan are numbered without gaps
    first, second = (
        F.pmod(F.xxhash64(F.lit(i), "line"), F.lit(1 << 40)).cast("decimal(13,0)") for i in (0, 1)
    )
    blocks = lines.groupBy("file_name", "block").agg(
        F.first("file_size").alias("_size"),
        F.count(F.lit(1)).alias("_n"),
        F.min(place).alias("_from"),
        *[F.sum(h).alias(f"_s{i}") for i, h in enumerate((first, second))],
        *[F.sum((h * place.cast("decimal(10,0)")).cast("decimal(28,0)")).alias(f"_p{i}") for i, h in enumerate((first, second))],
    )
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    moved = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")
    placed = blocks.withColumn("_moved", moved.cast("decimal(14,0)"))
    sums = placed.groupBy("file_name").agg(
        F.first("_size").alias("_size"),
        F.sum("_n").alias("_n"),
        *[F.sum(f"_s{i}").cast("decimal(38,0)").alias(f"_s{i}") for i in (0, 1)],
        *[
            F.sum(F.col(f"_p{i}").cast("decimal(38,0)") + (F.col(f"_s{i}").cast("decimal(23,0)") * F.col("_moved")).cast("decimal(38,0)"))
            .cast("decimal(38,0)").alias(f"_p{i}")
            for i in (0, 1)
        ],
    )
    parts = ("_size", "_n", "_s0", "_s1", "_p0", "_p1")
    return sums.select("file_name", F.sha2(F.concat_ws("|", *parts), 256).alias("attachment_hash"))


def skip_processed(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files with a content hash not seen before; of equal files the first one.

    ``files`` needs ``attachment_hash`` and ``file_name``. Leave ``content`` out, so
    that only names and hashes are shuffled.
    """
    rest = [c for c in files.columns if c != "attachment_hash"]
    first = (
        files.groupBy("attachment_hash")
        .agg(F.min_by(F.struct(*rest), load_order(F.col("file_name"))).alias("_first"))
        .select("attachment_hash", "_first.*")
    )
    known = processed.select("attachment_hash").filter(F.col("attachment_hash").isNotNull())
    return first.join(known, "attachment_hash", "left_anti")


def mark_processed(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows to append to the table of processed files: hashes it does not hold yet."""
    marked = files.groupBy("attachment_hash").agg(
        F.min_by(F.struct("file_name", "email_id"), load_order(F.col("file_name"))).alias("_f")
    )
    return marked.join(
        processed.select("attachment_hash"), "attachment_hash", "left_anti"
    ).select(
        "attachment_hash",
        F.col("_f.file_name").alias("filename"),
        F.col("_f.email_id").alias("email_id"),
        F.current_timestamp().alias("processed_at"),
    )
