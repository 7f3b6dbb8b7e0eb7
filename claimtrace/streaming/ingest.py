"""Loading files: one batch function for the stream, a single run and manual upload.

A batch writes new parts of the tables and publishes them together at its end, with its number; see ``sources.tables``.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from claimtrace import schemas
from claimtrace.functions.report import day
from claimtrace.operators import match, merge, statuses
from claimtrace.operators.lookup import attach, is_small
from claimtrace.operators.series import refresh_history
from claimtrace.sources import files as file_source
from claimtrace.sources import parsers, text_grid, workbook
from claimtrace.sources.tables import Load, Store, Tables, durable, months_of, scratch, slot_of

log = logging.getLogger(__name__)

# Files per micro-batch; bounds every list of files held by the driver.
FILES_PER_BATCH = 1_000
# Parts of one size class that a partition may have before they are merged.
PARTS_AT_MOST = 16
# Ranges of packages by which stored shipments are looked up.
RANGES_AT_MOST = 64

_CSV_PARSERS = {
    "shipments_csv": parsers.parse_shipments_csv,
    "order_status_csv": parsers.parse_order_status_csv,
    "order_level_csv": parsers.parse_order_level_csv,
}
LOADED, FAILED, DUPLICATE, EMPTY = "loaded", "failed", "duplicate", "no data"


class _Parsed:
    """Parsed rows of one batch, by target, with what is known per file."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.rows: dict[str, DataFrame] = {}
        self.failures: list[DataFrame] = []

    def add(self, target: str, parsed: DataFrame) -> None:
        held = self.rows.get(target)
        self.rows[target] = parsed if held is None else held.unionByName(parsed)

    def fail(self, files: DataFrame) -> None:
        """``files``: file_name and reason."""
        self.failures.append(files.select("file_name", "reason").distinct())


def _parse(spark: SparkSession, names: list, strict_parity: bool) -> _Parsed:
    """Parses the files of a batch; ``names`` are its file rows."""
    load = _Parsed(spark)
    chosen: dict[str, list] = {}
    for row in names:
        chosen.setdefault(row["parser"], []).append(row["path"])

    for parser, parse in _CSV_PARSERS.items():
        if paths := chosen.get(parser):
            parsed = durable(parse(text_grid.scan_csv(spark, [file_source.literal_path(p) for p in paths])))
            broken = parsed.filter(F.col("reject_reason") == parsers.BROKEN)
            load.fail(broken.select("file_name", F.col("reject_reason").alias("reason")))
            load.add(parser, parsed)

    for parser, sheets in (
        ("shipments_sheet", workbook.SHIPMENT_SHEETS),
        ("rma_workbook", workbook.RMA_SHEETS),
    ):
        if paths := chosen.get(parser):
            grid = durable(workbook.scan_workbook(_read(spark, paths), sheets))
            errors = grid.filter(F.col("error").isNotNull())
            load.fail(errors.select("file_name", F.col("error").alias("reason")))
            if parser == "shipments_sheet":
                sheet = grid.filter(F.col("role") == "shipments")
                load.add("shipments_csv", durable(parsers.parse_shipments_sheet(sheet)))
                continue
            credits = durable(parsers.parse_rma_summary(grid.filter(F.col("role") == "credits")))
            unreadable = credits.filter(F.col("reject_reason").isNotNull())
            load.fail(unreadable.select("file_name", F.col("reject_reason").alias("reason")))
            load.add("rma_credits", credits)
            claims = grid.filter(F.col("role") == "claims")
            load.add("claims", durable(parsers.parse_claim_sheet(claims, strict_parity)))
    return load


_TEXT_OF = {
    "shipments_csv": "shipments",
    "order_status_csv": "shipments",
    "order_level_csv": "shipments",
    "rma_credits": "rma_credits",
    "claims": "claim_details",
}


def _refuse_over_long(load: _Parsed) -> None:
    """Files with a text longer than its column are not loaded."""
    for target, table in _TEXT_OF.items():
        if target in load.rows:
            rows = parsers.accepted(load.rows[target])
            if target.startswith("order_"):
                rows = rows.select("file_name", "order_status")
            load.fail(schemas.over_long(rows, table).withColumn("reason", F.lit("text too long")))


def _union(spark: SparkSession, frames: list[DataFrame], schema: str) -> DataFrame:
    result = spark.createDataFrame([], schema)
    for frame in frames:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


_COUNTS = (
    "file_name string, parsed long, inserted long, updated long, uniques long, shipments_updated long, not_found long"
)
_SPREAD_BY = ("sscc18", "appointment_date")


def _zero(column: str):
    return F.coalesce(F.col(column), F.lit(0))


def _insert_counts(rows: DataFrame, fresh: DataFrame, key: tuple[str, ...], texts: tuple[str, ...]) -> DataFrame:
    """Rows, distinct keys and inserted rows per file; NULL and blank are one key here."""
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in key]
    per_key = rows.groupBy("file_name", *blank).agg(F.count(F.lit(1)).alias("n"))
    per_file = per_key.groupBy("file_name").agg(F.sum("n").alias("parsed"), F.count(F.lit(1)).alias("uniques"))
    new = fresh.groupBy(F.col("source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("inserted"))
    return per_file.join(new, "file_name", "left").withColumns(
        {"inserted": _zero("inserted"), "updated": F.lit(0).cast("long")}
    )


def _ranges(rows: DataFrame) -> list[tuple[str, str]]:
    """Ranges that the packages of the rows lie in: one for each file, or fewer where they overlap or are many."""
    keyed = rows.filter("sscc18 IS NOT NULL AND order_id IS NOT NULL").groupBy("file_name")
    found = keyed.agg(F.min("sscc18").alias("low"), F.max("sscc18").alias("high"))
    ranges: list[tuple[str, str]] = []
    for low, high in sorted((r["low"], r["high"]) for r in found.collect()):  # bounded by the batch
        if ranges and low <= ranges[-1][1]:
            low, last = ranges.pop()
            high = max(last, high)
        ranges.append((low, high))
    each = -(-len(ranges) // RANGES_AT_MOST) or 1
    return [(ranges[i][0], ranges[i : i + each][-1][1]) for i in range(0, len(ranges), each)]


def _within(ranges: list[tuple[str, str]], value: Column) -> Column:
    """Whether a value lies in one of the ranges; the scan skips stored rows by it."""
    found = F.lit(False)
    for low, high in ranges:
        found = found | value.between(low, high)
    return found


def _new_shipments(load: Load, rows: DataFrame) -> DataFrame:
    batch = rows.withColumns(
        {
            "source_file": F.col("file_name"),
            "ingested_at": F.current_timestamp(),
            "order_status": F.lit(None).cast("string"),
            "seq": F.struct(file_source.load_order(F.col("file_name")), F.col("seq")),
        }
    ).drop("file_name")
    held = load.read("shipments").filter(_within(_ranges(rows), F.col("sscc18")))
    return durable(merge.insert_ignore_shipments(held, batch, is_small(rows)))


def _load_credits(load: Load, rows: DataFrame) -> DataFrame:
    batch = rows.withColumns(
        {"source_file": F.col("file_name"), "ingested_at": F.current_timestamp()}
    ).drop("file_name")
    fresh = durable(merge.insert_ignore_rma(load.read("rma_credits"), batch, is_small(rows)))
    load.append("rma_credits", fresh)
    return _insert_counts(rows, fresh, merge.RMA_KEY, ("carrier_bp",))


def _events(rows: DataFrame, by_suffix: bool, times: DataFrame | None) -> DataFrame:
    """Parsed status rows in the form of the kept ones. ``times``: when each file was last changed; else now."""
    known = rows.select("file_name", "order_number", "order_status", "seq.block", "seq.row")
    if times is not None:
        known = known.join(F.broadcast(times), "file_name", "left")  # at most the files of the batch
    else:
        known = known.withColumn("file_time", F.lit(None).cast("timestamp"))
    return known.withColumns(
        {
            "by_suffix": F.lit(by_suffix),
            "file_time": F.coalesce("file_time", F.current_timestamp()),
            "is_order": F.lit(None).cast("boolean"),
            "applied_at": F.current_timestamp(),
        }
    )


def _kept_near(load: Load, orders: DataFrame) -> DataFrame:
    """The kept status rows that could be about the orders: only their slots are read."""
    slots = [r[0] for r in orders.select(slot_of(F.col("order_id"))).distinct().collect()]  # at most SLOTS + 1
    return load.read_months("status_rows", sorted({*slots, "short"}))


def _apply_statuses(load: Load, fresh: DataFrame | None, events: DataFrame | None) -> DataFrame | None:
    """Gives shipments the status that follows from all status rows, and appends the new ones.

    Looked at are the orders of ``fresh`` and those that the rows of ``events`` are about, and for them only the
    status rows that end like them. Only the months with a shipment that changes are written again. Returns the
    shipment rows that each number of ``events`` is about.
    """
    held = load.read("shipments")
    known, keyed = bool(load.parts("status_rows")), load.keyed
    if fresh is not None and not known and events is None:
        load.append("shipments", fresh)
        _follow(load, keyed, [(fresh, 1)])
        return None
    new_orders = durable(statuses.order_counts(fresh)) if fresh is not None else None
    found: list[DataFrame] = []  # held orders to look at again, and whether their status may go
    delta: list[DataFrame] = []
    numbers = None
    if events is not None:
        last = durable(statuses.latest(events))
        orders = statuses.order_counts(statuses.ending_like(held, last))
        if new_orders is not None:
            orders = orders.unionByName(new_orders).groupBy("order_id").agg(F.sum("rows").alias("rows"))
        # The pass over orders and numbers asks for the orders three times.
        met = durable(statuses.meet(durable(orders), last))
        numbers = statuses.numbers_met(met)
        met_order = numbers.select("order_number", "by_suffix", F.col("is_order").alias("_met"))
        delta.append(
            last.join(met_order, ["order_number", "by_suffix"], "left")
            .withColumn("is_order", F.coalesce("is_order", "_met", F.lit(False)))
            .drop("_met")
        )
        found.append(statuses.touched(met).select("order_id", F.lit(False).alias("may_go")))
    if new_orders is not None and known:
        ids = new_orders.select(F.col("order_id").alias("order_number"))
        # Only the rows of these numbers are reduced to the latest.
        kept = _kept_near(load, new_orders).filter("by_suffix").join(ids, "order_number", "left_semi")
        turned = durable(statuses.latest(kept).filter("NOT coalesce(is_order, false)"))
        if not turned.isEmpty():
            orders = durable(statuses.order_counts(statuses.ending_like(held, turned)))
            lost = statuses.touched(statuses.meet(orders, turned))
            found.append(lost.select("order_id", F.lit(True).alias("may_go")))
            delta.append(turned.withColumn("is_order", F.lit(True)))
    if delta:
        rows = delta[0]
        for more in delta[1:]:
            rows = rows.unionByName(more)
        load.append("status_rows", rows.withColumn("applied_at", F.current_timestamp()))

    asked = new_orders.select("order_id", F.lit(False).alias("may_go")) if new_orders is not None else None
    for more in found:
        asked = more if asked is None else asked.unionByName(more)
    asked = durable(asked.groupBy("order_id").agg(F.max("may_go").alias("may_go")))
    state = durable(statuses.near(asked, _kept_near(load, asked)))
    resolved = durable(statuses.resolve(asked, state).join(asked, "order_id"))
    moves = _rewrite_changed(load, held, resolved) if found else []
    if fresh is not None:
        small = is_small(resolved)
        status = attach(fresh, {"_status": F.col("order_id")}, resolved, "order_id", "status", _SPREAD_BY, small=small)
        fresh = status.withColumn("order_status", F.col("_status")).drop("_status")
        load.append("shipments", fresh)
        moves.append((fresh, 1))
    _follow(load, keyed, moves)
    return numbers


def _follow(load: Load, keyed: bool, moves: list[tuple[DataFrame, int]]) -> None:
    """Brings the match keys up to date: by the shipments that came (1) or went (-1), or from all of them."""
    if not keyed:
        load.replace("match_keys", match.key_rows(load.read("shipments")))
    elif moves:
        columns = ("sscc18", "order_id", "scac", "order_status")
        rows = [df.select(*columns, F.lit(n).alias("_each")) for df, n in moves]
        every = rows[0]
        for more in rows[1:]:
            every = every.unionByName(more)
        load.append("match_keys", match.key_rows(every, F.col("_each")))
    load.keyed = True


def _rewrite_changed(load: Load, held: DataFrame, resolved: DataFrame) -> list[tuple[DataFrame, int]]:
    """Writes the months anew in which ``resolved`` gives a stored shipment another status.

    Returns the shipments that changed, as they were (-1) and as they are (1).
    """
    small = is_small(resolved)
    value = resolved.select("order_id", F.struct("status", "may_go").alias("_set"))

    def after(shipments: DataFrame) -> DataFrame:
        found = attach(shipments, {"_new": F.col("order_id")}, value, "order_id", "_set", _SPREAD_BY, small=small)
        gone = F.col("_new.may_go") & F.col("_new.status").isNull()
        status = F.when(gone, F.lit(None)).otherwise(F.coalesce("_new.status", "order_status"))
        return found.withColumn("_after", status).drop("_new")

    changed = after(held.select("order_id", "order_status", "scac", *_SPREAD_BY))
    changed = durable(changed.filter(~F.col("_after").eqNullSafe(F.col("order_status"))))
    months = months_of(changed, "shipments")
    if not months:
        return []
    whole = after(load.read_months("shipments", months))
    load.rewrite_months("shipments", whole.withColumn("order_status", F.col("_after")).drop("_after"))
    return [(changed, -1), (changed.withColumn("order_status", F.col("_after")), 1)]


def _status_counts(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per file: status rows, shipment rows they are about (again for each repeat), rows about none."""
    per_number = events.groupBy("file_name", "order_number", "by_suffix").agg(F.count(F.lit(1)).alias("n"))
    joined = per_number.join(numbers.drop("is_order"), ["order_number", "by_suffix"], "left")
    return joined.groupBy("file_name").agg(
        F.sum("n").alias("parsed"),
        F.sum(F.col("n") * _zero("rows")).alias("shipments_updated"),
        F.sum(F.when(_zero("rows") == 0, F.col("n")).otherwise(0)).alias("not_found"),
    )


def _update_statuses(tables: Tables, rows: DataFrame, by_suffix: bool) -> DataFrame:
    """Applies parsed status rows alone, as if their file had just changed."""
    with tables.begin() as load, scratch(tables.spark, load.scratch):
        events = durable(_events(rows, by_suffix, None))
        counts = _status_counts(events, _apply_statuses(load, None, events)).toPandas()
    return tables.spark.createDataFrame(counts)


def _claim_keys(rows: DataFrame, *more: Column) -> DataFrame:
    """The keys of claims, after ``more``; NULL and blank are one."""
    return rows.select(
        *more,
        "claim_date",
        F.coalesce("order_id", F.lit("")).alias("order_id"),
        F.coalesce("sscc18", F.lit("")).alias("sscc18"),
        F.col("claim_amount").cast(schemas.MONEY).alias("claim_amount"),
    )


_CLAIM_KEYS = ("claim_date", "order_id", "sscc18", "claim_amount")


def _keys_of_one_file(rows: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Days with unknown keys, and the file's keys and how many are unknown, where all rows are of one file.

    Keys of both sides are added up together, with flags alone, and counted per day at once.
    """
    new, old = (_claim_keys(df, F.lit(n).alias("_held")) for df, n in ((rows, 0), (held, 1)))
    old = old.filter("claim_date IS NOT NULL AND claim_amount IS NOT NULL")  # NULL equals no stored key
    per_key = new.unionByName(old).groupBy(*_CLAIM_KEYS).agg(F.min("_held").alias("_new"), F.max("_held").alias("_held"))
    per_day = durable(
        per_key.filter("_new = 0")
        .groupBy(day(F.col("claim_date")).alias("day"))
        .agg(F.count(F.lit(1)).alias("uniques"), F.count_if(F.col("_held") == 0).alias("inserted"))
    )
    sums = per_day.agg(F.sum("uniques").alias("uniques"), F.sum("inserted").alias("inserted"))
    name = rows.select(F.col("seq.file_name").alias("file_name")).limit(1)
    return per_day.filter("inserted > 0").select("day"), name.crossJoin(sums)


def _keys_of_files(rows: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Days with unknown keys, and per file its keys and how many it inserts: the first file with an unknown key does."""
    # Each key once per file; all else about the keys is told by these narrow rows.
    per_file = durable(_claim_keys(rows, F.col("seq.file_name").alias("file_name")).distinct())
    # Places in a load begin with the file.
    named = per_file.groupBy(*_CLAIM_KEYS).agg(F.min("file_name").alias("file_name"))
    fresh = durable(named.join(_claim_keys(held), list(_CLAIM_KEYS), "left_anti"))
    inserted = fresh.groupBy("file_name").agg(F.count(F.lit(1)).alias("inserted"))
    unique = per_file.groupBy("file_name").agg(F.count(F.lit(1)).alias("uniques"))
    days = durable(fresh.select(day(F.col("claim_date")).alias("day")).distinct())
    return days, unique.join(inserted, "file_name", "left")


def _upsert_claims(load: Load, rows: DataFrame) -> DataFrame:
    """Upserts claims. The date is part of the key, so only the months of the batch change; so does the history."""
    months = months_of(rows, "claim_details")
    held = load.read_months("claim_details", months)
    batch = rows.drop("file_name")
    one_file = rows.select("seq.file_name").distinct().limit(2).count() < 2
    days, told = _keys_of_one_file(rows, held) if one_file else _keys_of_files(rows, held)
    if months:
        load.rewrite_months("claim_details", merge.upsert_claims(held, batch, is_small(rows), one_file))
        if not days.isEmpty():
            _refresh(load, days)
    parsed = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("parsed"))
    return (
        parsed.join(told, "file_name", "left").select(
            "file_name",
            "parsed",
            _zero("inserted").alias("inserted"),
            F.greatest(_zero("uniques") - _zero("inserted"), F.lit(0)).alias("updated"),
            "uniques",
        )
    )


def _refresh(load: Load, days: DataFrame) -> None:
    """Brings the daily history up to date after new claims of ``days``: reads the claims of their months only.

    A history that was never written is made from all claims.
    """
    if not load.parts("claim_daily_history"):
        days = load.read("claim_details").select(day(F.col("claim_date")).alias("day")).distinct()
        claims = load.read("claim_details")
    else:
        months = [r[0] for r in days.select(F.date_format("day", "yyyy-MM")).distinct().collect()]
        claims = load.read_months("claim_details", sorted(months))
    load.rewrite_months("claim_daily_history", refresh_history(load.read("claim_daily_history"), claims, days))


def _apply(load: Load, rows: Mapping[str, DataFrame], times: DataFrame | None) -> DataFrame:
    """Writes accepted rows of all kinds into the load's tables and counts them per file.

    Shipments and statuses come together, whatever their order; then credits and claims.
    """
    counts = []
    fresh = events = None
    if "shipments_csv" in rows:
        fresh = _new_shipments(load, rows["shipments_csv"])
        counts.append(durable(_insert_counts(rows["shipments_csv"], fresh, merge.SHIPMENT_KEY, merge.SHIPMENT_KEY)))
    told = [
        _events(rows[target], by_suffix, times)
        for target, by_suffix in (("order_status_csv", False), ("order_level_csv", True))
        if target in rows
    ]
    if told:
        events = durable(told[0] if len(told) == 1 else told[0].unionByName(told[1]))
    if fresh is not None or events is not None:
        numbers = _apply_statuses(load, fresh, events)
        if events is not None:
            counts.append(durable(_status_counts(events, numbers)))
    if "rma_credits" in rows:
        counts.append(durable(_load_credits(load, rows["rma_credits"])))
    if "claims" in rows:
        counts.append(durable(_upsert_claims(load, rows["claims"])))
    return _union(load.spark, counts, _COUNTS)


def _audit(
    names: DataFrame, counts: DataFrame, failures: DataFrame, rejects: DataFrame, skipped: DataFrame, batch: str
) -> DataFrame:
    """One row per file of the batch, in the audit schema."""
    why = failures.groupBy("file_name").agg(F.min("reason").alias("reason"))
    done = counts.groupBy("file_name").agg(
        F.sum("parsed").alias("parsed_rows"),
        F.sum("inserted").alias("inserted_rows"),
        F.sum("updated").alias("updated_rows"),
        F.sum("uniques").alias("unique_rows"),
        F.sum("shipments_updated").alias("shipments_updated"),
        F.sum("not_found").alias("not_found_rows"),
    )
    one = F.struct("reject_reason", "rejected_rows")
    left_out = rejects.groupBy("file_name").agg(
        F.sum("rejected_rows").alias("rejected_rows"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(one)),  # one row per file and reason
                lambda r: F.concat(r["reject_reason"], F.lit(": "), r["rejected_rows"].cast("string")),
            ),
            "; ",
        ).alias("reject_reasons"),
    )
    judged = (
        names.join(F.broadcast(why), "file_name", "left")
        .join(F.broadcast(done), "file_name", "left")
        .join(F.broadcast(left_out), "file_name", "left")
    )
    failed = F.col("reason").isNotNull()
    outcome = (
        F.when(failed, F.lit(FAILED))
        .when(_zero("parsed_rows") == 0, F.lit(EMPTY))
        .otherwise(F.lit(LOADED))
    )
    read = F.col("parsed_rows").isNotNull()
    judged = judged.withColumn("outcome", outcome).unionByName(
        skipped.withColumn("outcome", F.lit(DUPLICATE)), allowMissingColumns=True
    )
    told = F.col("shipments_updated").isNotNull()
    return schemas.conform(
        judged.withColumns(
            {
                "batch": F.lit(batch),
                "inserted_rows": F.when(read, _zero("inserted_rows")),
                "updated_rows": F.when(read, _zero("updated_rows")),
                # A status row is no duplicate: it is applied, again or not.
                "duplicate_rows": F.when(told, F.lit(0)).otherwise(
                    F.col("parsed_rows") - _zero("inserted_rows") - _zero("updated_rows")
                ),
                "duplicate_rows_in_file": F.col("parsed_rows") - F.col("unique_rows"),
                "duplicate_rows_existing": F.when(
                    F.col("unique_rows").isNotNull(),
                    F.greatest(F.col("unique_rows") - _zero("inserted_rows") - _zero("updated_rows"), F.lit(0)),
                ),
                "logged_at": F.current_timestamp(),
            }
        ),
        schemas.LOAD_AUDIT,
    )


_LISTED = ("path", "file_name", "email_id", "attachment_hash", "parser", "file_kind", "modificationTime")


def _listed(
    spark: SparkSession, files: DataFrame, strict_parity: bool, whole_file: int
) -> tuple[DataFrame, DataFrame]:
    """The files of a batch, routed and with their hash, and those too large to read.

    The filter on length reaches the reader and larger files are named one by one, so
    no content is read that is not needed.
    """
    routed = file_source.route(files, strict_parity)
    listed = file_source.with_hash(routed.filter(F.col("length") <= whole_file)).select(*_LISTED)

    facts = routed.select("path", "file_name", "email_id", "length", "parser", "file_kind", "modificationTime")
    large = facts.filter(F.col("length") > whole_file)
    rows = large.collect()  # bounded by the batch
    lines = [r["path"] for r in rows if r["parser"].endswith("_csv")]
    books = [
        r["path"]
        for r in rows
        if r["path"] not in lines and r["length"] <= file_source.LARGEST_VALUE
    ]
    if lines:
        text = text_grid.scan_lines(spark, [file_source.literal_path(p) for p in lines])
        hashed = large.join(F.broadcast(file_source.line_hash(text)), "file_name")
        listed = listed.unionByName(hashed.select(*_LISTED))
    if books:
        whole = _read(spark, books)
        hashed = file_source.with_hash(file_source.route(whole, strict_parity))
        listed = listed.unionByName(hashed.select(*_LISTED))
    beyond = large.filter(~F.col("path").isin(*lines, *books)).select(
        "path", "file_name", "email_id", "parser", "file_kind"
    )
    return durable(listed), beyond


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return file_source.read_files(spark, [file_source.literal_path(p) for p in paths])


def _check_utc(spark: SparkSession) -> None:
    """Stored days and months are those of UTC, as the files' times are."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if spark._jvm.java.time.ZoneId.of(zone).normalized().getId() != "Z":
        raise ValueError(f"set spark.sql.session.timeZone to UTC, not {zone}: days and months would shift")


def load_files(
    files: DataFrame,
    tables: Tables,
    batch: str,
    skip_known: bool = True,
    strict_parity: bool = False,
    keywords: tuple[str, ...] = (),
    whole_file: int = file_source.WHOLE_FILE,
    stream: tuple[str, int] | None = None,
) -> DataFrame:
    """Loads one batch of at most a few thousand files and returns its audit rows.

    ``files`` comes from ``scan_folder`` or ``read_files``; names must be unique in it. ``stream`` names a stream and the
    number of its batch: one that is published already is not loaded again.

    A file that cannot be read or holds an over-long text is left out as a whole, is not marked as processed, and
    does not stop the others. Nothing of the batch is visible before all of it is.
    """
    spark = files.sparkSession
    _check_utc(spark)
    if stream is not None and tables.last_batch(stream[0]) >= stream[1]:
        return tables.read("load_audit").filter(F.col("batch") == batch)
    load = tables.begin()
    with scratch(spark, load.scratch):
        _load_batch(load, files, batch, skip_known, strict_parity, keywords, whole_file)
        load.publish(stream)
    return load.written("load_audit")


def _load_batch(
    load: Load,
    files: DataFrame,
    batch: str,
    skip_known: bool,
    strict_parity: bool,
    keywords: tuple[str, ...],
    whole_file: int,
) -> None:
    spark = load.spark
    eligible = file_source.keyword_allowed(file_source.supported(files), keywords)
    listed, beyond = _listed(spark, eligible, strict_parity, whole_file)
    fresh = listed
    if skip_known:
        # The hashes of the batch filter the scan of the known ones.
        known = load.read("processed_attachments").join(
            F.broadcast(listed.select("attachment_hash").distinct()), "attachment_hash", "left_semi"
        )
        fresh = durable(file_source.skip_processed(listed, known))
    skipped = listed.join(F.broadcast(fresh.select("path")), "path", "left_anti")
    names = fresh.select("path", "file_name", "parser").collect()  # bounded by the batch
    parsed = _parse(spark, names, strict_parity)
    parsed.fail(beyond.select("file_name", F.lit("too large for a workbook").alias("reason")))
    _refuse_over_long(parsed)
    failures = durable(_union(spark, parsed.failures, "file_name string, reason string"))
    bad = F.broadcast(failures.select("file_name").distinct())  # at most the files of the batch

    good = {
        target: parsers.accepted(rows).join(bad, "file_name", "left_anti") for target, rows in parsed.rows.items()
    }
    times = fresh.select("file_name", F.col("modificationTime").alias("file_time"))
    counts = _apply(load, good, times)
    rejects = [parsers.reject_counts(rows) for rows in parsed.rows.values()]
    left_out = _union(spark, rejects, "file_name string, reject_reason string, rejected_rows long")

    seen = fresh.unionByName(beyond, allowMissingColumns=True)
    audit = durable(_audit(seen, counts, failures, left_out, skipped, batch))
    if skip_known:
        loaded = F.broadcast(audit.filter(F.col("outcome") == LOADED).select("file_name"))
        done = fresh.join(loaded, "file_name", "left_semi")
        load.append("processed_attachments", file_source.mark_processed(done, known))
    load.append("load_audit", audit)


_SCHEMA_OF = {"shipments_csv": schemas.SHIPMENT_ROW, "claims": schemas.CLAIM_ROW}


def _complete(rows: DataFrame, schema: StructType | None) -> DataFrame:
    """The rows with the columns of their kind that they lack, as NULL."""
    fields = [f for f in schema.fields if f.name not in rows.columns] if schema else []
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields})


_KIND_OF = {**file_source.KINDS, "rma_credits": "rma", "claims": "rma"}


def load_rows(
    tables: Tables, rows: Mapping[str, DataFrame], batch: str, stream: tuple[str, int] | None = None
) -> DataFrame:
    """Loads rows that are parsed already, as the parsers give them, and returns audit rows per ``file_name``.

    Keys: ``shipments_csv``, ``order_status_csv``, ``order_level_csv``, ``rma_credits``, ``claims``.
    """
    _check_utc(tables.spark)
    if stream is not None and tables.last_batch(stream[0]) >= stream[1]:
        return tables.read("load_audit").filter(F.col("batch") == batch)
    load = tables.begin()
    with scratch(tables.spark, load.scratch):
        none = tables.spark.createDataFrame([], "file_name string, reason string")
        rejects = tables.spark.createDataFrame([], "file_name string, reject_reason string, rejected_rows long")
        good = {k: parsers.accepted(r) if "reject_reason" in r.columns else r for k, r in rows.items()}
        good = {k: durable(_complete(r, _SCHEMA_OF.get(k))) for k, r in good.items()}
        counts = durable(_apply(load, good, None))
        named = [r.select("file_name", F.lit(_KIND_OF[k]).alias("file_kind")) for k, r in good.items()]
        names = _union(tables.spark, named, "file_name string, file_kind string").distinct()
        load.append("load_audit", _audit(names, counts, none, rejects, names.limit(0), batch))
        load.publish(stream)
    return load.written("load_audit")


def tidy(tables: Tables, most: int = PARTS_AT_MOST) -> int:
    """Merges parts where a partition has ``most`` of one size class; says how many partitions it wrote again.

    Merged parts are of the next class, so a row is written again only as often as the classes are many. Of kept
    status rows only the latest of each number stays.
    """
    crowded = [(name, value, parts) for name in schemas.STORED for value, parts in tables.crowded(name, most)]
    if not crowded:
        return 0
    with tables.begin() as load:
        for name, value, parts in crowded:
            rows = load.read_parts(name, value, parts)
            if name == "status_rows":
                rows = statuses.latest(rows).withColumn("applied_at", F.current_timestamp())
            load.merge(name, value, parts, rows)
    return len(crowded)


def _in_batches(spark: SparkSession, folder: str, files_per_batch: int) -> Iterator[list[str]]:
    """Paths of a folder or file, oldest first, in lists of bounded size."""
    listed = file_source.scan_folder(spark, folder).select("path", "modificationTime")
    some: list[str] = []
    for row in listed.orderBy("modificationTime", "path").toLocalIterator():
        some.append(row["path"])
        if len(some) == files_per_batch:
            yield some
            some = []
    if some:
        yield some


def load_folder(
    spark: SparkSession,
    folder: str,
    tables: Tables,
    strict_parity: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Manual upload of a folder or file: no check for known files, keys make it repeatable."""
    audit = spark.createDataFrame([], schemas.LOAD_AUDIT)
    for paths in _in_batches(spark, folder, files_per_batch):
        audit = audit.unionByName(load_files(_read(spark, paths), tables, "manual", False, strict_parity))
    return audit


def file_stream(
    spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Paths of new files of a folder as a stream; their content is not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema(file_source.BINARY_FILE)
        .option("pathGlobFilter", file_source.FILE_GLOB)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )


def stream_id(spark: SparkSession, progress: str) -> str:
    """The id that Spark gave the stream when it made its checkpoint folder; a folder made anew has another."""
    return json.loads(Store(spark).read(f"{progress.rstrip('/')}/metadata"))["id"]


def start(
    spark: SparkSession,
    folder: str,
    tables: Tables,
    progress: str,
    every: str | None = "30 minutes",
    files_per_batch: int = FILES_PER_BATCH,
    strict_parity: bool = False,
    keywords: tuple[str, ...] = (),
) -> StreamingQuery:
    """Loads new files of ``folder`` every so often; ``every=None`` loads what is there and ends.

    ``progress`` is the query's checkpoint folder. It remembers paths; content seen
    before under another name is recognised by its hash. A batch is published with the stream's id and its number, so
    one that Spark runs again after a crash is not loaded twice.
    """
    _check_utc(spark)

    def load(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # at most files_per_batch
        if paths:
            options = (True, strict_parity, keywords)
            stream = (stream_id(spark, progress), number)
            load_files(_read(spark, paths), tables, f"stream-{number}", *options, stream=stream)
            tidy(tables)

    writer = (
        file_stream(spark, folder, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", progress)
    )
    if every is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=every)
    return writer.start()
