"""Contract audit: all rules of a corpus of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import calls, contract, fingerprints, quality, reviews, violations
from ..operators.contract import Node


def recorded_calls(documents: DataFrame) -> DataFrame:
    """Step-3 call log entries of documents of model origin."""
    doc = Node(F.col("doc"))
    origin = origin_meta()
    executed = origin["executed_prompts"].items
    rows = documents.filter(
        F.col("readable") & F.coalesce(origin["pipeline_step"].integer == 3, F.lit(False))
        & (origin["provider"].filled | origin["model"].filled) & doc["pages"].is_array
    ).select("object_id", F.explode(executed).alias("call"))
    call = Node(F.col("call"))
    return rows.select(
        "object_id",
        call["chunk"].integer.cast("int").alias("chunk"),
        call["attempt"].integer.cast("int").alias("attempt"),
        call["pages"].cast("array<int>").alias("pages"),
    )


def origin_meta() -> Node:
    """A validated document keeps its transcription provenance in transcription_meta."""
    doc = F.col("doc")
    origin = F.try_variant_get(doc, "$.transcription_meta", "variant")
    return Node(F.coalesce(origin, F.try_variant_get(doc, "$._meta", "variant")))


def bound_violations(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Recorded values that must equal what the pages give: raw text, signals, images."""
    doc, origin = Node(F.col("doc")), origin_meta()
    typed = contract.typed_pages(pages)
    raw = fingerprints.raw_digest(typed)
    recomputed = quality.quality_signals(quality.object_measures(typed, rules=[]))
    model_origin = F.coalesce(origin["pipeline_step"].integer == 3, F.lit(False)) & (
        origin["provider"].filled | origin["model"].filled
    )
    signals = doc["quality_signals"]
    counters = ["blank_pages", "undeclared_empty_pages", "gate_pages", "foreign_pages", "content_pages"]
    recorded = documents.filter("readable").select(
        "object_id",
        model_origin.alias("model_origin"),
        origin["raw_transcription_hash"].string.alias("recorded_raw"),
        doc["source_images"].missing.alias("no_images"),
        F.size(origin["source_images"].items).alias("image_states"),
        signals.is_object.alias("has_signals"),
        *[signals[c].integer.alias(f"recorded_{c}") for c in counters],
    )
    joined = recorded.join(raw, "object_id").join(recomputed, "object_id")
    stale = ~F.lit(True)
    for c in counters:
        stale = stale | ~F.col(f"recorded_{c}").eqNullSafe(F.col(c))
    return violations.violations(
        joined,
        [
            violations.Check(
                "origin.images", F.col("model_origin") & F.col("no_images")
            ),
            violations.Check(
                "origin.raw_hash",
                F.col("model_origin") & ~F.col("recorded_raw").eqNullSafe(F.col("raw_hash")),
            ),
            violations.Check(
                "origin.image_count",
                F.col("model_origin") & (F.col("image_states") != F.col("page_count")),
            ),
            violations.Check(
                "quality.stale", F.col("has_signals") & stale
            ),
        ],
        "object_id",
    )


def missing_raw_text(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages of a model run without the machine text."""
    origin = origin_meta()
    runs = documents.filter(
        F.col("readable") & F.coalesce(origin["pipeline_step"].integer == 3, F.lit(False))
        & (origin["provider"].filled | origin["model"].filled)
    ).select("object_id")
    page = Node(F.col("raw"))
    return (
        pages.filter(page.is_object & ~page["transcription_raw"].present)
        .select("object_id", (F.col("position") + 1).alias("page"))
        .join(runs, "object_id", "left_semi")
        .select("object_id", "page", F.lit("origin.raw_missing").alias("code"))
    )


def audit(files: DataFrame) -> DataFrame:
    """Every broken rule of a corpus: object_id, page, code.

    ``files`` carries (object_id, value): file stem and JSON text.
    """
    # Parsed once; nine rule families read the result.
    documents, pages = contract.parsed(files)
    typed = fingerprints.with_page_state(contract.typed_pages(pages))
    log = contract.raw_review_events(pages)
    edits = contract.raw_edit_events(pages)
    page_counts = pages.groupBy("object_id").agg(F.count(F.lit(1)).cast("int").alias("page_count"))
    per_object = calls.call_log_violations(recorded_calls(documents), page_counts).unionByName(
        bound_violations(documents, pages)
    )
    state = reviews.audit_review_state(typed.filter("review_status IS NOT NULL"), log).filter(
        ~F.col("code").isin("review_status_unknown", "review_without_history")
    )
    found = contract.audit_documents(documents, pages)
    for part in (
        per_object.withColumn("page", F.lit(None).cast("int")),
        missing_raw_text(documents, pages),
        reviews.audit_reviews(log).drop("seq"),
        state,
        reviews.audit_edits(edits, typed).drop("seq"),
        contract.edit_shape_violations(pages),
    ):
        found = found.unionByName(part)
    return found


def split_by_audit(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conformant files, error rows)."""
    found = audit(files)
    return violations.without_violations(files, found), violations.quarantine(found)


def digest_of(*hashes):
    """Digest of a few known child hashes, for writers that hold them in one row."""
    return hashing.array_digest(F.array(*hashes))
