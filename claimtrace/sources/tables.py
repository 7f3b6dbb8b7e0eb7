"""The stored tables: folders of parquet parts, and one list of the parts that count.

A load writes new parts only, below ``<table>/<partition>/part=<name>``, and replaces nothing. Publishing writes
one small file that lists the parts of all tables; readers resolve the newest list, so they see the state before
a load or after it, for all tables alike. A load that ends early leaves parts that no list names. A stream's
batch number is published with its rows: a batch that is run again finds itself published, or starts from
where it started before, so rows without a key are not added twice. Parts that the last ``KEEP`` lists do not
name are removed; a frame made from an older state can then no longer be read. ``Tables.vacuum`` removes what loads that
ended early left.

Two loads into the same tables at once: the second one to publish fails, and can be run again.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtrace import schemas
from claimtrace.operators.match import MatchKeys, added_up, key_counts
from claimtrace.sources.files import literal_path

# Column that decides the month of a row in the tables partitioned by month.
MONTH_OF = {"shipments": "appointment_date", "claim_details": "claim_date", "claim_daily_history": "claim_date"}
MONTH = "month"
SLOT = "slot"
PART = "part"
SLOTS = 64
# Numbers are told apart by their last characters: a number and all longer ones that end with it share them.
TAIL = 4
KEEP = 3
_VERSIONS = "_versions"
_LEVEL = "-of-class-"
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share.

    It is ``spark.checkpoint.dir`` or one set on the context. Only a local session
    without either, as in tests, gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The rows written to a shared folder, with their lineage cut.

    Within ``scratch`` they go to its folder, which is removed at its end; else to the checkpoint folder.
    """
    folder = _SCRATCH.get()
    if folder is None:
        shared_folder(df.sparkSession)
        return df.checkpoint()
    path = f"{folder}/{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, folder: str) -> Iterator[None]:
    """Within it, ``durable`` rows live in ``folder``; at the end they are gone."""
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        Store(spark).remove(folder)


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    properties: dict[str, str],
    split: tuple[str, str, str, int],
) -> DataFrame:
    """A table of an existing database, in the declared schema.

    ``split`` names a number or time column, its range, and in how many parts to read it, so that no task
    reads the whole table; rows beyond the range are in the first and the last part.
    """
    column, low, high, parts = split
    if parts < 1:
        raise ValueError("a table is read in one part at least")
    rows = spark.read.jdbc(
        url,
        name,
        column=column,
        lowerBound=low,
        upperBound=high,
        numPartitions=parts,
        properties=properties,
    )
    return schemas.conform(rows, schemas.TABLES[name])


def month_text(column: Column) -> Column:
    """Partition value of a time."""
    return F.date_format(column, "yyyy-MM")


def slot_of(number: Column) -> Column:
    """Partition value of a number: by its last characters; numbers with fewer share one slot."""
    hashed = F.pmod(F.xxhash64(F.right(number, F.lit(TAIL))), F.lit(SLOTS))
    return F.when(F.length(number) < TAIL, F.lit("short")).otherwise(hashed.cast("string"))


def _partition(name: str) -> tuple[str, Column] | None:
    """The column a table is partitioned by besides its parts."""
    if name in MONTH_OF:
        return MONTH, month_text(F.col(MONTH_OF[name]))
    if name == "status_rows":
        return SLOT, slot_of(F.col("order_number"))
    return None


class Store:
    """Files of any Hadoop file system, as far as publishing needs them."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    def names(self, pattern: str) -> list[str]:
        """Last parts of the paths that match; none if there is no such folder."""
        path = self._path(pattern)
        return [s.getPath().getName() for s in self._fs(path).globStatus(path) or []]

    def ends(self, pattern: str) -> list[tuple[str, str]]:
        """The last two parts of the paths that match."""
        path = self._path(pattern)
        found = [s.getPath() for s in self._fs(path).globStatus(path) or []]
        return [(p.getParent().getName(), p.getName()) for p in found]

    def read(self, name: str) -> str:
        path = self._path(name)
        stream = self._fs(path).open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Writes a new file as a whole; False if there is one of that name."""
        target, fresh = self._path(name), self._path(f"{name}.{uuid4().hex}.tmp")
        stream = self._fs(fresh).create(fresh, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        plain = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fresh, target, plain)
        except Exception as error:
            self._fs(fresh).delete(fresh, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        path = self._path(name)
        self._fs(path).delete(path, True)


_Parts = dict[str, dict[str, list[str]]]


class _Reader:
    """Reading tables whose parts are known."""

    spark: SparkSession
    root: str

    def parts(self, name: str) -> dict[str, list[str]]:
        """The parts of a table by partition value; the value is blank in a table without partitions."""
        raise NotImplementedError

    def path(self, name: str) -> str:
        """Folder of a table."""
        return f"{self.root}/{name}"

    def _stored_schema(self, name: str) -> T.StructType:
        fields = list(schemas.STORED[name].fields)
        if (partition := _partition(name)) is not None:
            fields.append(T.StructField(partition[0], T.StringType()))
        return T.StructType(fields)

    def _folder(self, name: str, value: str, part: str) -> str:
        partition = _partition(name)
        inner = f"{partition[0]}={value}/" if partition else ""
        return f"{self.path(name)}/{inner}{PART}={part}"

    def _frame(self, name: str, parts: dict[str, list[str]]) -> DataFrame:
        schema = self._stored_schema(name)
        folders = [self._folder(name, value, part) for value, held in parts.items() for part in held]
        if not folders:
            return self.spark.createDataFrame([], schema)
        typed = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
        reader = self.spark.read.schema(typed).option("basePath", literal_path(self.path(name)))
        return reader.parquet(*map(literal_path, folders)).select(*schema.fieldNames())

    def stored(self, name: str) -> DataFrame:
        """A table with its partition column, for filters on ``month``."""
        return self._frame(name, self.parts(name))

    def read(self, name: str) -> DataFrame:
        """A table; empty before its first load. Columns added later read as NULL."""
        return self.stored(name).select(*schemas.STORED[name].fieldNames())

    def read_months(self, name: str, months: Sequence[str]) -> DataFrame:
        """The rows of some months, or of some other partition values; the rest is not even listed."""
        held = self.parts(name)
        chosen = {m: held[m] for m in months if m in held}
        return self._frame(name, chosen).select(*schemas.STORED[name].fieldNames())


class Tables(_Reader):
    """The tables under one root folder, as last published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._store = Store(spark)
        self._known: tuple[int, dict] = (0, {})

    def _versions(self) -> list[int]:
        names = self._store.names(f"{self.root}/{_VERSIONS}/*.json")
        return sorted(int(n.removesuffix(".json")) for n in names)

    def _version_file(self, version: int) -> str:
        return f"{self.root}/{_VERSIONS}/{version:012d}.json"

    def _published(self) -> tuple[int, dict]:
        """The newest list and its number, 0 before the first one."""
        versions = self._versions()
        if not versions:
            return 0, {"parts": {}, "streams": {}, "keyed": None, "buckets": None}
        if versions[-1] != self._known[0]:
            self._known = (versions[-1], json.loads(self._store.read(self._version_file(versions[-1]))))
        return self._known

    @property
    def version(self) -> int:
        """How often the tables were published."""
        return self._published()[0]

    def parts(self, name: str) -> dict[str, list[str]]:
        return self._published()[1]["parts"].get(name, {})

    def crowded(self, name: str, most: int) -> list[tuple[str, list[str]]]:
        """Partition values with at least ``most`` parts of one size class, and these parts."""
        found = []
        for value, parts in self.parts(name).items():
            for level in sorted({_level(p) for p in parts}):
                alike = [p for p in parts if _level(p) == level]
                if len(alike) >= most:
                    found.append((value, alike))
                    break
        return found

    def match_keys(self) -> MatchKeys:
        """The match keys of the stored shipments, in place of the shipments in reports.

        Kept by loads; where shipments were written otherwise, they are made from them.
        """
        published = self._published()[1]
        if published.get("keyed") != _signature(published["parts"]):
            return MatchKeys(key_counts(self.read("shipments")))
        parts = self.parts("match_keys").get("", [])
        if not parts:
            return MatchKeys(self.read("match_keys"))
        return MatchKeys(self._buckets(parts).drop(PART))

    def _bucketed(self) -> str:
        """The catalog's name of the match keys, whose files it knows to be bucketed by key."""
        name = "claimtrace_keys_" + hashlib.sha256(self.path("match_keys").encode()).hexdigest()[:16]
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.MATCH_KEYS.fields)
            where = self.path("match_keys").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {PART} STRING) USING parquet PARTITIONED BY ({PART})"
                f" CLUSTERED BY (match_key) INTO {self._bucket_count()} BUCKETS LOCATION '{where}'"
            )
        return name

    def _bucket_count(self) -> int:
        """As many as a shuffle had partitions when the first keys were written."""
        stored = self._published()[1].get("buckets")
        return stored or max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def _buckets(self, parts: list[str]) -> DataFrame:
        name = self._bucketed()
        known = {r[0].removeprefix(f"{PART}=") for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        fresh = [p for p in parts if p not in known]
        if fresh:
            named = " ".join(f"PARTITION ({PART} = '{p}')" for p in fresh)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {named}")
        return self.spark.table(name).filter(F.col(PART).isin(*parts))

    def last_batch(self, stream: str) -> int:
        """The number of the last published batch of a stream, -1 before the first."""
        return self._published()[1]["streams"].get(stream, -1)

    def begin(self) -> Load:
        """A load on the state as it is now."""
        return Load(self, *self._published())

    def append(self, name: str, df: DataFrame) -> None:
        """Adds rows, published at once."""
        with self.begin() as load:
            load.append(name, df)

    def rewrite_months(self, name: str, df: DataFrame) -> None:
        """Replaces the months that occur in ``df``, published at once; others stay as they are."""
        with self.begin() as load:
            load.rewrite_months(name, df)

    def replace(self, name: str, df: DataFrame) -> None:
        """Replaces a whole table, published at once."""
        with self.begin() as load:
            load.replace(name, df)

    def reset(self) -> None:
        """Empties all tables at once."""
        with self.begin() as load:
            for name in schemas.STORED:
                load.empty(name)

    def vacuum(self) -> int:
        """Removes what loads that ended early left behind, and says how many parts; not while a load is running."""
        lists = [json.loads(self._store.read(self._version_file(v)))["parts"] for v in self._versions()]
        needed = frozenset().union(*map(_named, lists))
        removed = 0
        for name in schemas.STORED:
            partition = _partition(name)
            inner = f"{partition[0]}=*/" if partition else ""
            for folder, last in self._store.ends(f"{self.path(name)}/{inner}{PART}=*"):
                value = folder.removeprefix(f"{partition[0]}=") if partition else ""
                part = last.removeprefix(f"{PART}=")
                if (name, value, part) not in needed:
                    self._store.remove(self._folder(name, value, part))
                    removed += 1
        self._store.remove(f"{self.root}/_scratch")
        return removed

    def _clear(self, version: int) -> None:
        """Removes parts and lists that the last ``KEEP`` lists do not need."""
        versions = [v for v in self._versions() if v <= version]
        if len(versions) <= KEEP:
            return
        lists = {v: json.loads(self._store.read(self._version_file(v)))["parts"] for v in versions}
        kept = {_named(lists[v]) for v in versions[-KEEP:]}
        needed = frozenset().union(*kept)
        for old in versions[:-KEEP]:
            for name, value, part in _named(lists[old]) - needed:
                self._store.remove(self._folder(name, value, part))
            self._store.remove(self._version_file(old))


def _signature(parts: _Parts) -> str:
    """What the stored shipments are made of."""
    return hashlib.sha256(json.dumps(parts.get("shipments", {}), sort_keys=True).encode()).hexdigest()


def _level(part: str) -> int:
    """The size class of a part, from its name."""
    return int(part.rpartition(_LEVEL)[2])


def _named(parts: _Parts) -> frozenset[tuple[str, str, str]]:
    return frozenset((name, value, part) for name, held in parts.items() for value, ps in held.items() for part in ps)


class Load(_Reader):
    """Changes of several tables that are published together, and the tables with them.

    As a context it publishes at the end, unless an error leaves it.
    """

    def __init__(self, tables: Tables, version: int, published: dict):
        self.tables, self.spark, self.root = tables, tables.spark, tables.root
        self._version = version
        self._id = f"{version + 1:08d}-{uuid4().hex[:12]}"
        self._parts: _Parts = {n: {v: list(ps) for v, ps in held.items()} for n, held in published["parts"].items()}
        self._streams = dict(published["streams"])
        self._buckets = published.get("buckets")
        # Whether the match keys are those of the shipments.
        self.keyed = not self._parts.get("shipments") or published.get("keyed") == _signature(self._parts)
        self._written: dict[str, dict[str, list[str]]] = {}
        self._count = 0

    def __enter__(self) -> Load:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.publish()

    def parts(self, name: str) -> dict[str, list[str]]:
        return self._parts.get(name, {})

    @property
    def scratch(self) -> str:
        """A folder for rows that only this load needs."""
        return f"{self.root}/_scratch/{self._id}"

    def _write(self, name: str, df: DataFrame, level: int = 0) -> tuple[list[str], str, int]:
        """Writes rows as a new part: the partition values they have, its name, their number."""
        self._count += 1
        part = f"{self._id}-{self._count}{_LEVEL}{level}"
        shaped = schemas.conform(df, schemas.STORED[name]).withColumn(PART, F.lit(part))
        # Counted behind the last shuffle, where a task that is run again counts once.
        counted, rows = Observation(), F.count(F.lit(1)).alias("rows")
        partition = _partition(name)
        if name == "match_keys":
            self._buckets = self.tables._bucket_count()
            # Few rows of a task share a key, so they are added up behind the shuffle to their bucket only.
            dealt = added_up(schemas.conform(df, schemas.STORED[name]).repartition(self._buckets, "match_key"))
            dealt = dealt.withColumn(PART, F.lit(part)).observe(counted, rows)
            dealt.write.mode("append").insertInto(self.tables._bucketed())
            found = [""] if self.tables._store.names(self._folder(name, "", part)) else []
        elif partition is None:
            shaped.observe(counted, rows).write.partitionBy(PART).mode("append").parquet(self.path(name))
            found = [""] if self.tables._store.names(self._folder(name, "", part)) else []
        else:
            column, value = partition
            # One value per task at first; AQE splits those that are large.
            dealt = shaped.withColumn(column, value).hint("rebalance", column).observe(counted, rows)
            dealt.write.partitionBy(column, PART).mode("append").parquet(self.path(name))
            pattern = f"{self.path(name)}/{column}=*/{PART}={part}"
            found = [f.removeprefix(f"{column}=") for f, _ in self.tables._store.ends(pattern)]
        for value in found:
            self._written.setdefault(name, {}).setdefault(value, []).append(part)
        # Spark plans no pass for rows known to be none, and then nothing is observed.
        return found, part, counted.get["rows"] if found else 0

    def append(self, name: str, df: DataFrame) -> int:
        """Adds rows and says how many."""
        values, part, rows = self._write(name, df)
        held = self._parts.setdefault(name, {})
        for value in values:
            held.setdefault(value, []).append(part)
        self.keyed = self.keyed and not (name == "shipments" and values)
        return rows

    def rewrite_months(self, name: str, df: DataFrame) -> int:
        """Replaces the partitions that occur in ``df``, which may be made from this table."""
        values, part, rows = self._write(name, df)
        held = self._parts.setdefault(name, {})
        for value in values:
            held[value] = [part]
        self.keyed = self.keyed and not (name == "shipments" and values)
        return rows

    def replace(self, name: str, df: DataFrame) -> int:
        """Replaces a whole table, from which ``df`` may be made."""
        values, part, rows = self._write(name, df)
        self._parts[name] = {value: [part] for value in values}
        self.keyed = self.keyed and name != "shipments"
        return rows

    def read_parts(self, name: str, value: str, parts: list[str]) -> DataFrame:
        """The rows of some parts of a partition."""
        return self._frame(name, {value: parts}).select(*schemas.STORED[name].fieldNames())

    def merge(self, name: str, value: str, parts: list[str], df: DataFrame) -> None:
        """Puts one part of the next size class, with the rows of ``df``, in the place of ``parts``."""
        _, part, _ = self._write(name, df, 1 + max(map(_level, parts)))
        held = self._parts[name][value]
        place = held.index(parts[0])
        held[place] = part
        self._parts[name][value] = [p for p in held if p not in parts]

    def empty(self, name: str) -> None:
        self._parts[name] = {}
        self.keyed = not self._parts.get("shipments") and not self._parts.get("match_keys")

    def written(self, name: str) -> DataFrame:
        """The rows that this load wrote to a table."""
        return self._frame(name, self._written.get(name, {})).select(*schemas.STORED[name].fieldNames())

    def publish(self, stream: tuple[str, int] | None = None) -> None:
        """Makes the changes visible, all at once; ``stream`` names a stream and the number of its batch."""
        if stream is not None:
            self._streams[stream[0]] = stream[1]
        keyed = _signature(self._parts) if self.keyed else None
        text = json.dumps({"parts": self._parts, "streams": self._streams, "keyed": keyed, "buckets": self._buckets})
        if not self.tables._store.publish(self.tables._version_file(self._version + 1), text):
            raise RuntimeError("another load was published in the meantime; run this one again")
        self.tables._clear(self._version + 1)


def months_of(df: DataFrame, name: str) -> list[str]:
    """Months that rows fall into: at most twelve per year of data, so safe to collect."""
    rows = df.select(month_text(F.col(MONTH_OF[name])).alias(MONTH)).distinct().collect()
    return sorted(r[MONTH] for r in rows)
