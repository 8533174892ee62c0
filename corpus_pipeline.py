"""The corpus pipeline: five stages from raw documents to encoded ones.

Each stage takes what its predecessor kept, read again from Parquet, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import table, written
from scriptorium.llm.decontamination import drop_contaminated
from scriptorium.llm.language_id import accepted
from scriptorium.llm.line_dedup import deduplicated
from scriptorium.llm.near_copies import without_near_copies
from scriptorium.llm.piece_codec import Shared, round_trip
from scriptorium.llm.queries import piece_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network determines; texts without letters and those in no clear language go."""
    return accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose five-word shingles are verified to have a similarity of 0.8 or more, the one with the smallest id."""
    return without_near_copies(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of sentences that an earlier document has; a document may be left empty."""
    return deduplicated(docs).withColumn("n_chars", F.length("text").cast("long"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of pieces and the digests of its ids and of their decoded text."""
    encoded = docs.select("doc_id", "lang", "source", round_trip("text", Shared.of(spark, piece_model())).alias("r"))
    return encoded.select("doc_id", "lang", "source", "r.*")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("line_dedup", repeated_lines),
    ("benchmark_decontamination", benchmark),
    ("sentencepiece_encoding", encoding),
]

#: SQL cannot express the network, the fingerprints and the piece encoding; tests/llm compares with plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the documents are a table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
