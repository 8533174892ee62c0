"""Selection and projection of objects and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text


def select_objects(
    objects: DataFrame, object_id: str | None = None, everything: bool = False, sample: int | None = None
) -> DataFrame:
    """One object, all, or the first N of all in id order.

    An unknown id and a selection without choice are errors of the call.
    """
    if sample is not None and (not everything or sample < 1):
        raise ValueError("sample needs a positive number and all objects")
    if (object_id is None) == (not everything):
        raise ValueError("choose either one object or all")
    if object_id is not None:
        chosen = objects.filter(F.col("object_id") == object_id)
        if chosen.isEmpty():
            raise ValueError(f"unknown object: {object_id}")
        return chosen
    return objects if sample is None else objects.orderBy("object_id").limit(sample)


def explode_pages(objects: DataFrame, pages: str = "pages") -> DataFrame:
    """One row per nested page with its position."""
    return objects.select("object_id", F.posexplode(pages).alias("position", "_page")).select(
        "object_id", "position", "_page.*"
    )


def text_pages(pages: DataFrame) -> DataFrame:
    """Pages with visible text."""
    return pages.filter(text.has_text(F.coalesce("transcription", F.lit(""))))


def initialise_machine_layer(pages: DataFrame) -> DataFrame:
    """Fresh model pages: raw text equals text, review not started."""
    return pages.withColumn("transcription_raw", F.col("transcription")).withColumn(
        "review_status", F.lit(vocab.INITIAL_STATUS)
    )


def without_null_fields(pages: DataFrame) -> DataFrame:
    """Null optional page fields read like omitted ones."""
    return (
        pages.withColumn("page_type", F.coalesce("page_type", F.lit("")))
        .withColumn("notes", F.coalesce("notes", F.lit("")))
        .withColumn("foreign_paragraphs", F.coalesce("foreign_paragraphs", F.array().cast("array<int>")))
    )


def excluded(documents: DataFrame, others: DataFrame, key: str = "object_id") -> DataFrame:
    """Rows without a counterpart."""
    return documents.join(others.select(key), key, "left_anti")


def documents_of_sources(**sources: DataFrame) -> DataFrame:
    """(object_id, sources): every document of any source once, with the names of the sources that have it, in order."""
    found = None
    for name, rows in sources.items():
        own = rows.select("object_id", F.lit(name).alias("source")).distinct()
        found = own if found is None else found.unionByName(own)
    return found.groupBy("object_id").agg(F.array_sort(F.collect_set("source")).alias("sources"))


def unexpected_fields(fields: Column, allowed: list[str]) -> Column:
    """Field names outside the allowed set."""
    return F.array_except(fields, F.array(*[F.lit(a) for a in allowed]))


def same_fields(fields: Column, required: list[str]) -> Column:
    """Exactly the required field names, in any order."""
    return F.array_sort(F.array_distinct(fields)) == F.array(*[F.lit(r) for r in sorted(required)])


def is_duplicate_free(items: Column) -> Column:
    return F.size(F.array_distinct(items)) == F.size(items)
