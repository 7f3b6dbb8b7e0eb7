"""Secret scans by one automaton of all rules (see ``automata``).

The rules are compiled on the driver, once; tasks get the arrays and pass over the bytes of their
texts, about ``SLICE`` at a time or one text, so that a scan reads and shuffles nothing else. Spans count
code points.

Nulls: a null text counts as empty, without spans; null ids are kept. Repeated rows are scanned
each. Matches of one rule never overlap, matches of different rules may; spans with the same start are
in the order of the rules. Very long texts are scanned whole, in memory for about 15 bytes a byte. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimtrace.llm.automata import Automaton, Rule
from claimtrace.llm.common import lengths, slices, whole_text

SLICE = 4 << 20
_NAME = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"

# The three kinds every scan has.
BASE = [
    Rule("assign", _NAME + "[A-Za-z0-9+/_.=-]+", _NAME + "[A-Za-z0-9+/_.=-]{12,}"),
    Rule("access", "AKIA[A-Z0-9]+", "[A-Z0-9]{18,}"),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{16,}", inside=True),
]
# Public formats of credentials.
MORE = [
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("private_key", "-----BEGIN ((RSA|EC|DSA|OPENSSH|PGP) )?PRIVATE KEY( BLOCK)?-----"),
    Rule("slack", "xox[abeoprs]-[A-Za-z0-9-]+", "xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", "(sk|rk)_live_[A-Za-z0-9]+", "(sk|rk)_live_[A-Za-z0-9]{16,}"),
]
RULES = [*BASE, *MORE]

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def _spans(automaton: Automaton, texts: pa.Array) -> list[list[dict]]:
    """The spans of each text, by start, then rule."""
    sizes = lengths(texts)
    ends = np.cumsum(sizes)
    first = texts.offset
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    begin = np.frombuffer(texts.buffers()[1], kind)[first] if len(texts) else 0
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begin : begin + (ends[-1] if len(ends) else 0)]
    rows: list[list[dict]] = [[] for _ in range(len(texts))]
    found = sorted((text, at, rule, end) for text, rule, at, end in automaton.found(data, ends))
    if not found:
        return rows
    points = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with each byte
    for text, at, rule, end in found:
        base = int(ends[text] - sizes[text])
        before = int(points[base - 1]) if base else 0
        start = (int(points[base + at - 1]) if base + at else 0) - before
        rows[text].append({"kind": automaton.kinds[rule], "start": start, "end": int(points[base + end - 1]) - before})
    return rows


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id and ``spans``, an array of (kind, start, end)."""
    automaton = Automaton(list(rules))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(f"`{text_col}`").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("spans", T.ArrayType(SPAN))])
    arrow = to_arrow_schema(schema)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            spans = pa.array(_spans(automaton, part.column("text")), arrow.field("spans").type)
            yield pa.RecordBatch.from_arrays([part.column("id").cast(arrow.field("id").type), spans], schema=arrow)

    return rows.mapInArrow(scanned, schema).withColumnRenamed("id", id_col)


def listed(spans: Column) -> Column:
    """The spans as text: ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redacted(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text, each span or run of overlapping spans replaced by the first one's kind in brackets.

    Needs unique ids that are not null.
    """
    spans = scan(docs, rules, id_col, text_col).where(F.size("spans") > 0).withColumnRenamed(id_col, "_id")
    text = whole_text(f"`{text_col}`")
    found = docs.select(F.col(f"`{id_col}`"), text.alias("_text")).join(spans, F.col(f"`{id_col}`") == F.col("_id"), "left")
    # Folded from the start: what is written so far, and up to which character.
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def put(held: Column, span: Column) -> Column:
        between = F.substring(F.col("_text"), (held["at"] + 1).cast("int"), F.greatest(span["start"] - held["at"], F.lit(0)).cast("int"))
        mark = F.when(span["start"] >= held["at"], F.concat(F.lit("["), span["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.concat(held["out"], between, mark).alias("out"), F.greatest(held["at"], span["end"]).alias("at"))

    last = F.aggregate(F.coalesce("spans", F.array().cast(T.ArrayType(SPAN))), state, put)
    rest = F.substring(F.col("_text"), (F.col("_last.at") + 1).cast("int"), F.length("_text"))
    return found.withColumn("_last", last).select(f"`{id_col}`", F.concat("_last.out", rest).alias("text"))
