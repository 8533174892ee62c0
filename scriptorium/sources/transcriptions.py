"""Transcription and validation corpora: one JSON document per object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contract, json_parts, violations
from ..operators.contract import Node
from ..session import checkpointed


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def read_text_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Whole text files as (object_id, value); object_id is the file stem."""
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return files.select(file_stem(F.col("_metadata.file_name")).alias("object_id"), "value")


def read_corpus(spark: SparkSession, path: str, large: int = contract.LARGE_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, pages, errors) of a folder; the errors file itself is skipped.

    Files of ``large`` bytes or more are read in ranges and chunks and their documents hold an empty list of pages; their pages
    come out like those of any other file.
    """
    size = F.col("_metadata.file_size")
    small = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True).filter(size < large)
    small = small.select(file_stem(F.col("_metadata.file_name")).alias("object_id"), "value").filter("object_id <> 'errors'")
    whole = checkpointed(contract.parse_documents(small, large).drop("large"))
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).filter(F.col("length") >= large)
    if names.select("path").isEmpty():
        documents, pages = whole, contract.document_pages(whole)
    else:
        chunks = json_parts.chunks_of_files(spark, path, file_stem, large).filter("object_id <> 'errors'")
        documents, pages = contract.with_parts(whole, chunks)
    named = F.col("readable") & Node(F.col("doc"))["object_id"].string.eqNullSafe(F.col("object_id"))
    errors = documents.filter(~named).select(
        "object_id",
        F.when(F.col("readable"), "name_mismatch").otherwise("unreadable").alias("error"),
        F.when(F.col("readable"), "contract").otherwise("read").alias("stage"),
    )
    documents = documents.filter(named)
    return documents, pages.join(documents.select("object_id"), "object_id", "left_semi"), errors


def read_transcriptions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of a folder."""
    documents, _, errors = read_corpus(spark, path)
    return documents, errors


def read_validated(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Validated documents that pass the stricter gate, and error rows for the rest."""
    from ..plans.validated import validated_violations

    documents, pages, errors = read_corpus(spark, path)
    found = validated_violations(documents, pages)
    return (
        violations.without_violations(documents, found),
        errors.unionByName(violations.quarantine(found)),
    )


def count_pages(files: DataFrame) -> DataFrame:
    """Pages per transcription file; 1 when unreadable or without a pages list."""
    documents, _ = contract.parsed(files)
    return documents.withColumn("pages", F.greatest(F.coalesce("n_pages", F.lit(1)), F.lit(1)))
