"""Merging parsed rows into the stored tables.

The operators are functions of DataFrames: they return the rows to append or the
new state of the rows touched, and statistics as one-row frames. "First" and
"last" follow ``seq``, never the order in which Spark happens to read. Rows of one
key are reduced by ``min_by``/``max_by``, which combine before the shuffle, so a
key that fills a third of a load costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace import schemas
from claimtrace.operators.lookup import HOT_ROWS, attach
from claimtrace.operators.suffix import match_numbers

SHIPMENT_KEY = ("sscc18", "order_id")
RMA_KEY = ("carrier_bp", "credit", "count")
CLAIM_EXTENSION = tuple(f.name for f in schemas.CLAIM_EXTENSION.fields)
_CLAIM_KEPT = ("order_id", "sscc18", "claim_type", "carrier_bp")


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side."""
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    return union.agg(*[F.max(c).alias(c) for c in union.columns])


def _all_set(key: Sequence[str]) -> Column:
    condition = F.lit(True)
    for column in key:
        condition = condition & F.col(column).isNotNull()
    return condition


def _number(key: Sequence[str], like: DataFrame) -> Column:
    """A number that equal keys share, in the types of ``like``. Unequal ones rarely do, so it only narrows rows down."""
    return F.xxhash64(*[F.col(c).try_cast(like.schema[c].dataType) for c in key]).alias("_number")


def _numbers(rows: DataFrame, key: Sequence[str], like: DataFrame) -> DataFrame:
    """The numbers of the keys for a broadcast: a few bytes each on the driver, however long the keys are."""
    return F.broadcast(rows.select(_number(key, like)).distinct())


def insert_ignore(
    target: DataFrame, batch: DataFrame, key: Sequence[str], small: bool = False
) -> DataFrame:
    """The rows of ``batch`` to append to ``target``.

    Of rows with the same key the first stays, unless the target has the key. A key
    with a NULL equals no other key, so such rows are all kept. With ``small``, the
    caller has checked that the batch is small: the numbers of its keys are broadcast to
    the scan of the target, whose other rows are then not shuffled.
    """
    rest = [c for c in batch.columns if c not in (*key, "seq")]
    keyed = batch.filter(_all_set(key))
    first = (
        keyed.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), "seq").alias("_first"))
        .select(*key, "_first.*")
    )
    held = target.select(*key).filter(_all_set(key))
    if small:
        numbered = held.select("*", _number(key, held))
        held = numbered.join(_numbers(keyed, key, held), "_number", "left_semi").drop("_number")
    # Stored keys can be many in small files, so no estimate of their size sends them to the driver.
    fresh = first.join(held.hint("merge"), list(key), "left_anti")
    loose = batch.filter(~_all_set(key)).select(*fresh.columns)
    return fresh.unionByName(loose)


def insert_ignore_shipments(
    target: DataFrame, batch: DataFrame, small: bool = False
) -> DataFrame:
    """New shipments by package and order."""
    return insert_ignore(target, batch, SHIPMENT_KEY, small)


def insert_ignore_rma(target: DataFrame, batch: DataFrame, small: bool = False) -> DataFrame:
    """New credits by carrier, credit and count."""
    typed = batch.withColumn(
        "claim_type",
        F.coalesce(F.col("claim_type"), F.lit(schemas.DEFAULT_CLAIM_TYPE))
        if "claim_type" in batch.columns
        else F.lit(schemas.DEFAULT_CLAIM_TYPE),
    )
    return insert_ignore(target, typed, RMA_KEY, small)


def _blank_as_null(key: Sequence[str], texts: Sequence[str]) -> list[Column]:
    return [
        (F.coalesce(F.col(c), F.lit("")) if c in texts else F.col(c)).alias(f"_{c}") for c in key
    ]


def insert_stats(
    batch: DataFrame, fresh: DataFrame, key: Sequence[str], texts: Sequence[str]
) -> DataFrame:
    """Row counts of an insert.

    The ``texts`` of the key count NULL and blank as equal here, unlike the insert
    itself, so with keys that hold a NULL more rows can be inserted than are unique.
    """
    per_key = batch.groupBy(*_blank_as_null(key, texts)).agg(F.count(F.lit(1)).alias("n"))
    parsed = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("parsed_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
    )
    inserted = fresh.agg(F.count(F.lit(1)).alias("inserted_rows"))
    return one_row(parsed, inserted).select(
        "parsed_rows",
        "unique_rows",
        "inserted_rows",
        (F.col("parsed_rows") - F.col("inserted_rows")).alias("duplicate_rows"),
        (F.col("parsed_rows") - F.col("unique_rows")).alias("duplicate_rows_in_file"),
        F.greatest(F.col("unique_rows") - F.col("inserted_rows"), F.lit(0)).alias(
            "duplicate_rows_existing"
        ),
    )


def shipment_stats(batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """Row counts of a shipment insert."""
    return insert_stats(batch, fresh, SHIPMENT_KEY, SHIPMENT_KEY)


def rma_stats(batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """Row counts of a credit insert."""
    return insert_stats(batch, fresh, RMA_KEY, ("carrier_bp",))


def _claim_key() -> list[Column]:
    """Claims are the same with equal date, order, package and amount; NULL equals blank."""
    return [
        F.col("claim_date").alias("_date"),
        F.coalesce(F.col("order_id"), F.lit("")).alias("_order"),
        F.coalesce(F.col("sscc18"), F.lit("")).alias("_package"),
        F.col("claim_amount").alias("_amount"),
    ]


def _last_rows(batch: DataFrame, *more: Column) -> DataFrame:
    """Per claim key, and ``more``: the last row's columns that the key does not tell as ``_last``, and its ``seq``."""
    rest = [c for c in batch.columns if c not in ("claim_date", "claim_amount", "seq")]
    typed = batch.withColumn("claim_amount", F.col("claim_amount").cast(schemas.MONEY))
    return typed.groupBy(*more, *_claim_key()).agg(F.max_by(F.struct(*rest), "seq").alias("_last"), F.max("seq").alias("seq"))


def _whole(columns: Sequence[str]) -> list[Column]:
    """These columns of the rows of ``_last_rows``."""
    told = {"claim_date": F.col("_date"), "claim_amount": F.col("_amount"), "seq": F.col("seq")}
    return [told[c].alias(c) if c in told else F.col(f"_last.{c}").alias(c) for c in columns]


def keep_last(batch: DataFrame) -> DataFrame:
    """The last row of every claim key within each file, taken whole."""
    return _last_rows(batch, F.col("seq.file_name").alias("_file")).select(*_whole(batch.columns))


def fold_files(batch: DataFrame) -> DataFrame:
    """One row per claim key of a load of several files, as if the files came one by one.

    Within a file the last row counts. Across files an extension column takes the
    latest value that is not NULL, all other columns the values of the first file.
    """
    last = keep_last(batch)
    kept = ["claim_date", "claim_amount", *_CLAIM_KEPT, "seq"]
    extension = [c for c in last.columns if c in CLAIM_EXTENSION]
    folded = last.groupBy(*_claim_key()).agg(
        F.min_by(F.struct(*kept), "seq").alias("_first"),
        *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(F.col("seq"), F.col(c).alias("v")))).alias(c)
            for c in extension
        ],
    )
    return folded.select(
        "_first.*", *[F.col(c)["v"].alias(c) for c in extension]
    ).select(*last.columns)


_KEY_NAMES = ["_date", "_order", "_package", "_amount"]


def upsert_claims(
    target: DataFrame, batch: DataFrame, small: bool = False, one_file: bool = False
) -> DataFrame:
    """The target after the load.

    A new key is added. On a known key the extension columns take the new value
    unless it is NULL; every other column keeps the old value. ``batch`` may hold a
    key more than once; it is folded first. With ``small``, the caller has checked
    that the batch is small: the numbers of its keys are broadcast, and the target's rows
    stay in place but for those the batch could be about. With ``one_file``, that its rows
    come from one file, so nothing is folded across files.
    """
    columns = [c for c in batch.columns if c != "seq"]
    if one_file:
        # Reduced per key as it is joined, so its rows are shuffled once for both.
        added = _last_rows(batch).select(*_KEY_NAMES, F.struct(*_whole(columns)).alias("_new"))
    else:
        new = fold_files(batch).drop("seq")
        added = new.select(*_claim_key(), F.struct(*columns).alias("_new"))
    held = target.select(*_claim_key(), F.struct(*target.columns).alias("_old"))
    if small:
        asked = batch.withColumn("claim_amount", F.col("claim_amount").cast(schemas.MONEY)).select(*_claim_key())
        numbers = _numbers(asked, _KEY_NAMES, held).select("_number", F.lit(True).alias("_met"))
        marked = held.select("*", _number(_KEY_NAMES, held)).join(numbers, "_number", "left").drop("_number")
        kept = marked.filter("_met IS NULL").drop("_met")
        met = marked.filter("_met").drop("_met").join(added, _KEY_NAMES, "full")
        joined = met.unionByName(kept, allowMissingColumns=True)
    else:
        joined = held.join(added, _KEY_NAMES, "full")
    is_old = F.col("_old").isNotNull()
    merged = []
    for column in target.columns:
        old = F.col(f"_old.{column}")
        if column == "ingested_at":
            merged.append(F.when(is_old, old).otherwise(F.current_timestamp()).alias(column))
        elif column not in columns:
            merged.append(old.alias(column))
        elif column in CLAIM_EXTENSION:
            merged.append(F.coalesce(F.col(f"_new.{column}"), old).alias(column))
        else:
            merged.append(F.when(is_old, old).otherwise(F.col(f"_new.{column}")).alias(column))
    return joined.select(*merged)


def upsert_stats(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Row counts of a claim upsert."""
    columns = ["claim_date", "order_id", "sscc18", "claim_amount"]
    typed = batch.withColumn("claim_amount", F.col("claim_amount").cast(schemas.MONEY))
    per_key = typed.select(*columns).groupBy(*_claim_key()).agg(F.count(F.lit(1)).alias("_n"))
    held = target.select(*_claim_key()).withColumn("_held", F.lit(1))
    tagged = per_key.join(held, _KEY_NAMES, "left")
    return tagged.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("parsed_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
        F.count_if(F.col("_held").isNull()).alias("inserted_rows"),
        F.count("_held").alias("updated_rows"),
    ).withColumn("duplicate_rows_in_file", F.col("parsed_rows") - F.col("unique_rows"))


def _last_status(rows: DataFrame) -> DataFrame:
    """One row per order number: its last status, that row's place, and its count."""
    return rows.groupBy("order_number").agg(
        F.max_by("order_status", "seq").alias("status"),
        F.max("seq").alias("last_seq"),
        F.count(F.lit(1)).alias("n"),
    )


def _orders(shipments: DataFrame) -> DataFrame:
    """Shipment rows per order."""
    return (
        shipments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


_SPREAD_BY = ("sscc18", "appointment_date")


def _with_status(
    shipments: DataFrame, status: DataFrame, hot_rows: int, small: bool = False
) -> DataFrame:
    """Shipments with the status of their ``order_id`` where ``status`` has one."""
    wanted = {"_status": F.col("order_id")}
    found = attach(
        shipments, wanted, status, "order_id", "status", _SPREAD_BY, hot_rows, small
    )
    return found.withColumn("order_status", F.coalesce("_status", "order_status")).drop("_status")


def update_status(
    shipments: DataFrame, rows: DataFrame, hot_rows: int = HOT_ROWS, small: bool = False
) -> DataFrame:
    """Shipments after the status rows, applied in order: the last one of an order wins.

    With ``small``, the caller has checked that the status rows are few; they are
    broadcast.
    """
    status = _last_status(rows).withColumnRenamed("order_number", "order_id")
    return _with_status(shipments, status, hot_rows, small)


def update_status_stats(shipments: DataFrame, rows: DataFrame) -> DataFrame:
    """Status rows, shipment rows they touch (again for each repeat), rows without a shipment."""
    joined = _last_status(rows).join(
        _orders(shipments), F.col("order_number") == F.col("order_id"), "left"
    )
    return _status_counts(joined.select("n", "rows"))


def _status_counts(joined: DataFrame) -> DataFrame:
    zero = F.lit(0)
    return joined.agg(
        F.coalesce(F.sum("n"), zero).alias("total"),
        F.coalesce(F.sum(F.col("n") * F.coalesce("rows", zero)), zero).alias("updated"),
        F.coalesce(F.sum(F.when(F.col("rows").isNull(), F.col("n"))), zero).alias("not_found"),
    )


def _by_suffix(shipments: DataFrame, rows: DataFrame) -> DataFrame:
    """What the suffix update says about each order and meets with each number; see ``match_numbers``."""
    numbers = _last_status(rows).select(
        "order_number",
        F.lit(True).alias("by_suffix"),
        F.lit(None).cast("boolean").alias("is_order"),
        "status",
        F.col("last_seq").alias("seq"),
    )
    return match_numbers(_orders(shipments), numbers)


def update_status_suffix(
    shipments: DataFrame, rows: DataFrame, hot_rows: int = HOT_ROWS, small: bool = False
) -> DataFrame:
    """Shipments after the status rows, matched exactly or, failing that, by suffix.

    A number equal to an order touches only that order; a number equal to none touches all orders that
    end with it. Blank numbers touch nothing. ``small`` changes nothing: few numbers can still touch many orders.
    """
    found = _by_suffix(shipments, rows).filter(~F.col("is_number") & F.col("status").isNotNull())
    return _with_status(shipments, found.select(F.col("text").alias("order_id"), "status"), hot_rows)


def update_status_suffix_stats(
    shipments: DataFrame, rows: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Counts as for ``update_status_stats``."""
    touched = _by_suffix(shipments, rows).filter(F.col("is_number") & (F.col("rows") > 0))
    numbers = _last_status(rows).select("order_number", "n")
    met = touched.select(F.col("text").alias("order_number"), "rows")
    return _status_counts(numbers.join(met, "order_number", "left").select("n", "rows"))


def table_count(table: DataFrame) -> DataFrame:
    """Rows of a table."""
    return table.agg(F.count(F.lit(1)).alias("rows"))
