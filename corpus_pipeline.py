"""A training corpus from raw documents: five stages, each on what the one before kept.

``STAGES`` names the stages and their functions of (spark, docs, sf_dir). All but the last return the
columns of ``documents``; each result is written as Parquet and read again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtrace.llm import exact, language, near, packing, substrings
from claimtrace.llm.common import written
from claimtrace.llm.queries import WORDS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REST = ("lang", "source", "n_chars")
ABOVE_CHANCE = 1.35  # a prediction is kept if its score is so many times that of chance


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are surely of no learned language go: no letters, or no likely language.

    Without labels no language is learned, and only those without letters go.
    """
    docs = docs.select(*COLUMNS)
    model = language.fit(docs.where(~language.held_out("doc_id")))
    found = language.predicted(docs, model)
    if model.languages:
        keep = language.accepted(F.col("language.lang_pred"), F.col("language.score"), min(0.9, ABOVE_CHANCE / len(model.languages)))
    else:
        keep = F.col("language.score") < 1  # only a text without features is surely of none
    return found.where(keep).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id stays."""
    return exact.survivors(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity, one stays: with the least id, and of these the one whose row sorts first.

    Documents are told apart as rows, so equal or null ids never drag a clean document along.
    """
    return near.representatives(docs.select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; a document that had nothing else goes too."""
    found = substrings.remove(docs.select(*COLUMNS), carry=REST).where("n_removed = 0 OR n_removed < n_words")
    cut = F.col("n_removed") > 0
    return found.select(
        F.col("id").alias("doc_id"), "text", "rest.lang", "rest.source", F.when(cut, F.length("text").cast("long")).otherwise(F.col("rest.n_chars")).alias("n_chars")
    ).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens."""
    return packing.pack(docs.select(*COLUMNS), public_tokenizers.path(WORDS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("substrings", cut_repeats),
    ("packing", pack),
]

# SQL knows neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
