"""What the operators share: the shared folder, sizes of shuffles, and helpers for Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)  # fixed values of the splitmix64 finaliser
GOLDEN = 0x9E3779B97F4A7C15  # fixed value: its increment


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's.

    Only a local session with neither gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: computed once, lineage cut."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle makes in this session; a cluster sets it by its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def seed(n: int) -> np.uint64:
    """The n-th of a fixed row of random-looking numbers."""
    return mix(np.array([(n + 1) * GOLDEN & 0xFFFFFFFFFFFFFFFF], U64))[0]


def pair(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """One number for an ordered pair of numbers."""
    return mix(mix(a + seed(salt)) * U64(3) + b)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` bytes of one binary column, a row at least.

    Keeps what numpy holds at once small, however long the texts of a batch are.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(lengths(batch.column(column)))
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def lengths(values: pa.Array) -> np.ndarray:
    """Bytes of each value of a binary or text column without nulls."""
    wide = pa.types.is_large_binary(values.type) or pa.types.is_large_string(values.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(values.buffers()[1], kind)[values.offset : values.offset + len(values) + 1]
    return np.diff(offsets.astype(np.int64))


def blobs(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for each run of the array that ends at the given places."""
    raw, width = np.ascontiguousarray(data).view(np.uint8).tobytes(), data.dtype.itemsize
    offsets = np.concatenate([[0], ends]).astype(np.int64) * width
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw)]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)
