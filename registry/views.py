"""Shipments and claims derived from the given tables, for Spark and as SQL text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtrace import Params
from claimtrace.operators.match import MatchKeys, key_rows
from claimtrace.sources.tables import Tables, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

# The given dates run from 1995 to 2001 and amounts up to about 105,000.
PARAMS = Params(
    time_from=datetime(1996, 1, 1),
    time_to=datetime(1996, 12, 31),
    as_of=date(1997, 1, 15),
    cutover=date(1998, 5, 1),
    threshold=50_000,
)

_SHIPMENT_COLUMNS = {
    "appointment_date": "l_shipdate + INTERVAL 8 HOUR",
    "pro_number": "CASE WHEN l_linenumber = 1 THEN NULL ELSE 'PRO' || CAST(l_suppkey AS STRING) END",
    "sscc18": "lpad(CAST(l_orderkey * 10 + l_linenumber AS STRING), 18, '0')",
    "scac": "CASE l_suppkey % 6 WHEN 0 THEN 'FXFE' WHEN 1 THEN 'HSNR' WHEN 2 THEN 'HSND'"
    " WHEN 3 THEN 'HSNC' WHEN 4 THEN 'HSNN' ELSE 'HSNA' END",
    "order_id": "'6' || CAST(10000000 + o_orderkey AS STRING)",
    "shipment_id": "CAST(l_partkey AS STRING)",
    "order_status": "CASE o_orderstatus WHEN 'F' THEN 'Perfect' WHEN 'O' THEN 'Short' ELSE NULL END",
    "source_file": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE"
    " 'batch_' || CAST(l_partkey % 10 AS STRING) || '.csv' END",
}

_CLAIM_COLUMNS = {
    "claim_date": "l_shipdate + INTERVAL 30 DAY",
    "order_id": "CASE l_linenumber WHEN 1 THEN lpad(CAST(l_orderkey AS STRING), 7, '0')"
    " WHEN 2 THEN CAST(10000000 + l_orderkey AS STRING) WHEN 4 THEN ''"
    " WHEN 5 THEN CAST(99000000 + l_orderkey AS STRING)"
    " WHEN 6 THEN lpad(CAST(l_orderkey AS STRING), 6, '0')"
    " WHEN 7 THEN CAST(9000000 + l_orderkey AS STRING) ELSE NULL END",
    "sscc18": "CASE l_linenumber WHEN 3 THEN lpad(CAST(l_orderkey * 10 + 3 AS STRING), 18, '0')"
    " WHEN 4 THEN '' ELSE NULL END",
    "claim_amount": "-CAST(l_extendedprice AS DECIMAL(10,2))",
    "claim_type": "CASE WHEN l_linestatus = 'F' THEN 'SHORTAGE'"
    " WHEN l_suppkey % 7 = 0 THEN 'Missing PRO' ELSE 'DAMAGE' END",
    "business_unit_code": "CASE l_suppkey % 8 WHEN 0 THEN '1MF' WHEN 1 THEN '1MY' WHEN 2 THEN '1MQ'"
    " WHEN 3 THEN '1MS' WHEN 4 THEN '1MK' WHEN 5 THEN '2AA' WHEN 6 THEN '2BB' ELSE NULL END",
    "ship_to_name": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE n_name END",
    "address_name": "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE s_name END",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


SH_SQL = f"SELECT {_select(_SHIPMENT_COLUMNS)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
CL_SQL = (
    f"SELECT {_select(_CLAIM_COLUMNS)} FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
    " JOIN nation ON s_nationkey = n_nationkey WHERE l_returnflag = 'R'"
)
WITH_SH = f"WITH sh AS ({SH_SQL})"
WITH_CL = f"WITH cl AS ({CL_SQL})"
WITH_BOTH = f"WITH sh AS ({SH_SQL}), cl AS ({CL_SQL})"


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is looked up once per application."""
    place = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if place not in _TABLES:
        _TABLES[place] = spark.read.parquet(place[1])
    return _TABLES[place]


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned packages."""
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.selectExpr(*[f"{sql} AS {name}" for name, sql in _SHIPMENT_COLUMNS.items()])


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer claims."""
    joined = (
        table(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'R'")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.selectExpr(*[f"{sql} AS {name}" for name, sql in _CLAIM_COLUMNS.items()])


_KEYS: dict[tuple, MatchKeys] = {}


def match_keys(spark: SparkSession, sf_dir: str) -> MatchKeys:
    """The match keys of the shipments as a load keeps them: written for the first report, and when the tables change."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    place: tuple = (spark.sparkContext.applicationId,)
    for name in ("lineitem", "orders"):
        file = path(f"{sf_dir}/{name}.parquet")
        status = file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file)
        place += (str(file), status.getLen(), status.getModificationTime())
    if place not in _KEYS:
        tables = Tables(spark, f"{shared_folder(spark)}/claimtrace-keys-{uuid4().hex}")
        tables.append("match_keys", key_rows(shipments(spark, sf_dir)))
        _KEYS[place] = tables.match_keys()
    return _KEYS[place]


def plain(df: DataFrame) -> DataFrame:
    """Types that read the same from Spark and from SQL: whole numbers long, others double."""

    def cast(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType)):
            return c.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(c, "|").alias(field.name)
        return c

    return df.select(*[cast(f) for f in df.schema.fields])


def from_views(build: Callable[..., DataFrame], *needed: str, **options) -> Query:
    """A query that hands the named views to ``build``."""
    sources = {"sh": shipments, "cl": claims, "keys": match_keys}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = [sources[n](spark, sf_dir) for n in needed]
        return plain(build(*frames, **options))

    return run


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Named double columns rounded, for comparison."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c, n in places.items()})


# SQL fragments of the parameters above.
FROM, TO = "TIMESTAMP '1996-01-01'", "TIMESTAMP '1996-12-31'"
MONTH, LAST_MONTH = "TIMESTAMP '1997-01-01'", "TIMESTAMP '1996-12-01'"
CF = "scac IN ('FXFE','HSNR','HSND','HSNC','HSNN','HSNA')"
CT = "claim_type IN ('SHORTAGE')"
BU = "business_unit_code IN ('1MF','1MY','1MQ','1MS','1MK')"
STF = f"appointment_date BETWEEN {FROM} AND {TO}"
CTF = f"claim_date BETWEEN {FROM} AND {TO}"


def hit(shipment_filter: str = "TRUE") -> str:
    """SQL condition on a claim: some shipment matches."""
    return (
        f"((coalesce(sscc18,'') <> '' AND sscc18 IN (SELECT sscc18 FROM sh WHERE {shipment_filter}))"
        " OR (length(order_id) = 7 AND order_id IN"
        f" (SELECT right(order_id, 7) FROM sh WHERE {shipment_filter} AND order_id IS NOT NULL))"
        " OR (length(order_id) = 8 AND order_id IN"
        f" (SELECT right(order_id, 8) FROM sh WHERE {shipment_filter} AND order_id IS NOT NULL)))"
    )


def flagged(where: str, shipment_filter: str) -> str:
    """SQL of the chosen claims plus ``matched``."""
    return f"SELECT *, coalesce({hit(shipment_filter)}, FALSE) AS matched FROM cl WHERE {where}"
