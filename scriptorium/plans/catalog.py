"""Catalogue of published documents, publication gate, search and export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.ordered import PART_BYTES, ordered_concat
from ..operators.violations import Check, violations

CATALOG_COLUMNS = ["id", "title", "date", "language", "signature", "status", "page_count", "has_images"]


def catalog(metadata: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per document in case-folded id order."""
    counted = pages.groupBy("object_id").agg(
        F.count(F.lit(1)).alias("page_count"), F.bool_or(F.coalesce("image", F.lit("")) != "").alias("has_images")
    )
    rows = metadata.join(counted, "object_id", "left").select(
        F.col("object_id").alias("id"), "title", "date", "language", "signature", "status",
        F.coalesce("page_count", F.lit(0)).alias("page_count"),
        F.coalesce("has_images", F.lit(False)).alias("has_images"),
    )
    return rows.orderBy(F.lower("id"), "id")


def input_state_timestamp(metadata: DataFrame) -> DataFrame:
    """Newest input state of the catalogue, empty without documents."""
    return metadata.agg(F.coalesce(F.max("input_state_timestamp"), F.lit("")).alias("input_state_timestamp"))


def search(catalog_rows: DataFrame, needle: str) -> DataFrame:
    """Case-insensitive substring search over the row text."""
    shown = F.concat_ws(
        "", "title", "signature", "date", "language", F.col("page_count").cast("string"), "status"
    )
    return catalog_rows.filter(F.contains(F.lower(shown), F.lower(F.lit(needle))))


def sort_catalog(catalog_rows: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """User sort: numbers by value, texts in German order, id as tie-break."""
    kind = dict(catalog_rows.dtypes)[column]
    key = F.collate(F.coalesce(F.col(column), F.lit("")), "de") if kind == "string" else F.col(column)
    return catalog_rows.orderBy(key.asc() if ascending else key.desc(), "id")


def plain_text_export(pages: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Plain text with page headings, in numbered parts of bounded bytes per object."""
    label = F.coalesce(text.non_empty(F.col("label")), F.col("page").cast("string"))
    block = F.concat(F.lit("--- Seite "), label, F.lit(" ---\n"), F.coalesce("text", F.lit("")))
    return ordered_concat(pages.withColumn("_block", block), ["object_id"], "page", "_block", "\n\n", part_bytes)


def derivation_check(metadata: DataFrame, reports: DataFrame) -> DataFrame:
    """Documents whose derivation report names another state; no report is fine."""
    joined = metadata.join(reports.select("object_id", "expected_hash"), "object_id")
    return joined.filter(
        F.col("expected_hash").isNull() | ~F.col("validation_state_hash").eqNullSafe(F.col("expected_hash"))
    ).select(
        "object_id",
        F.lit("document does not derive from the validated state its report names").alias("error"),
        F.lit("stale").alias("stage"),
    )


def binding_state(objects: DataFrame, annotations: DataFrame) -> DataFrame:
    """absent, unbound, current, stale or unreadable annotation per object.

    objects(object_id, transcription_sha256) with a null hash when the
    canonical text is unavailable; annotations(object_id, readable, binding).
    """
    joined = objects.join(annotations.withColumn("_here", F.lit(True)), "object_id", "left")
    binding = text.non_empty(F.coalesce("binding", F.lit("")))
    state = (
        F.when(F.col("_here").isNull(), "absent")
        .when(~F.col("readable"), "unreadable")
        .when(binding.isNull(), "unbound")
        .when(F.col("transcription_sha256").isNull(), "unreadable")
        .when(binding == F.col("transcription_sha256"), "current")
        .otherwise("stale")
    )
    return joined.select("object_id", state.alias("state"))


def publication_blockers(
    documents: DataFrame, conformance: DataFrame, acceptance: DataFrame, bindings: DataFrame
) -> DataFrame:
    """Why a document may not be published; no rows means publishable.

    documents(object_id, status); conformance(object_id, status);
    acceptance(object_id, conformant, all_accepted); bindings(object_id, state).
    """
    joined = (
        documents.select("object_id", F.col("status").alias("review_status"))
        .join(conformance.select("object_id", (F.col("status") == "valid").alias("valid")), "object_id", "left")
        .join(acceptance.withColumn("_known", F.lit(True)), "object_id", "left")
        .join(bindings, "object_id", "left")
    )
    valid = F.coalesce("valid", F.lit(False))
    known = F.col("_known").isNotNull()
    conformant = F.coalesce("conformant", F.lit(False))
    return violations(
        joined,
        [
            Check("invalid", ~valid),
            Check("no_transcription", valid & ~known),
            Check("contract", valid & known & ~conformant),
            Check(
                "not_accepted",
                valid & known & conformant & ~F.coalesce("all_accepted", F.lit(False)),
            ),
            Check(
                "annotations",
                valid & ~F.coalesce(F.col("state"), F.lit("absent")).isin("absent", "current"),
            ),
            Check(
                "status",
                valid & (F.coalesce("review_status", F.lit("")) != "accepted"),
            ),
        ],
        "object_id",
    )


def safe_images(pages: DataFrame, column: str = "image") -> DataFrame:
    """Only web addresses reach a viewer."""
    return pages.withColumn(column, F.when(text.is_safe_url(F.col(column)), F.col(column)).otherwise(""))


def has_any_image(image: Column) -> Column:
    return F.bool_or(F.coalesce(image, F.lit("")) != "")
