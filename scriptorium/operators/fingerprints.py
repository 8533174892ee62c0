"""State fingerprints of pages and objects (see functions.hashing)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..functions import hashing


def with_page_state(pages: DataFrame) -> DataFrame:
    """Add the hash a human decision is bound to."""
    return pages.withColumn(
        "state_hash",
        hashing.page_state_hash(
            F.col("page"), F.col("transcription"), F.col("notes"), F.col("page_type"), F.col("foreign_paragraphs")
        ),
    )


def raw_digest(pages: DataFrame) -> DataFrame:
    """Per object: digest of the ordered immutable machine text."""
    return pages.groupBy("object_id").agg(
        hashing.set_digest(hashing.fields_hash(F.col("page"), F.col("transcription_raw"))).alias("raw_hash")
    )


def transcription_digest(objects: DataFrame, pages: DataFrame, object_fields: list[str]) -> DataFrame:
    """Per object: digest of its fields and of every page state."""
    body = with_page_state(pages).groupBy("object_id").agg(hashing.set_digest(F.col("state_hash"), None).alias("pages_hash"))
    fields = [F.col(f) for f in object_fields]
    return objects.join(body, "object_id", "left").select(
        "object_id", hashing.fields_hash(F.col("object_id"), *fields, F.col("pages_hash"), length=12).alias("state_hash")
    )


def validation_digest(assessed: DataFrame, findings: DataFrame) -> DataFrame:
    """Per object: digest of the status and the findings behind it."""
    found = findings.groupBy("object_id").agg(
        hashing.set_digest(hashing.fields_hash(F.col("rule"), F.col("count"), F.col("severity")), None).alias("findings_hash")
    )
    return assessed.join(found, "object_id", "left").select(
        "object_id",
        hashing.fields_hash(F.col("overall_status"), F.col("findings_hash"), length=12).alias("result_hash"),
    )


def image_digest(images: DataFrame) -> DataFrame:
    """Per object: digest of the ordered facsimile bytes."""
    return images.groupBy("object_id").agg(
        hashing.set_digest(hashing.image_hash(F.col("page"), F.col("filename"), F.col("sha256"))).alias("images_hash")
    )


def vocabulary_hash() -> Column:
    """Identifies the verdict vocabulary a run accepts."""
    words = [
        ",".join(sorted(values))
        for values in (vocab.VERDICT_CONFIDENCE, vocab.ISSUE_TYPES, vocab.ISSUE_PERSPECTIVES)
    ]
    return hashing.fields_hash(*[F.lit(w) for w in words], length=12)


def config_hash(spark: SparkSession, config: dict[str, str]) -> Column:
    """Identifies the project configuration behind a derivation."""
    parts = [F.lit(f"{key}={config[key]}") for key in sorted(config)]
    return hashing.fields_hash(*parts, length=12)


def catalog_digest(project_title: str, documents: DataFrame) -> DataFrame:
    """One digest over the title and every published document (object_id, markup)."""
    child = hashing.fields_hash(F.col("object_id"), F.sha2("markup", 256))
    return documents.agg(hashing.set_digest(child, None).alias("_all")).select(
        hashing.fields_hash(F.lit(project_title), F.col("_all"), length=12).alias("source_hash")
    )
