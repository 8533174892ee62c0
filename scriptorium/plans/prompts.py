"""Instruction assembly, chunk plan and chunk cache."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import hashing, text


def context_lines(pages: Column) -> Column:
    """Labelled non-empty metadata lines; the extent defaults to the page count."""

    def shown(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"- {label}: "), value)

    lines = []
    for label, field in vocab.CONTEXT_FIELDS:
        value = text.non_empty(F.col(field))
        line = F.when(value.isNotNull(), shown(label, value))
        if field == "extent":
            line = F.coalesce(line, F.when(pages > 0, shown(label, F.concat(pages.cast("string"), F.lit(" page(s)")))))
        lines.append(line)
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def assemble_instructions(
    documents: DataFrame, base: str, profiles: DataFrame, overrides: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(instructions, errors) per document.

    profiles(prompt_profile, profile_text) and overrides(object_id,
    override_text) are joined by key; a declared profile without text is an
    error of the document.
    """
    joined = documents.join(profiles, "prompt_profile", "left").join(overrides, "object_id", "left")
    profile = text.non_empty(F.coalesce("prompt_profile", F.lit("")))
    context = text.non_empty(context_lines(F.col("pages")))
    sections = F.array_compact(
        F.array(
            F.lit(base.strip()),
            F.when(profile.isNotNull(), F.concat(F.lit("## Document-type profile\n\n"), text.strip(F.col("profile_text")))),
            F.when(context.isNotNull(), F.concat(F.lit("## Document metadata\n\n"), context)),
            F.concat(F.lit("## Object-specific instructions\n\n"), text.strip(F.col("override_text"))),
        )
    )
    layers = F.array_compact(
        F.array(
            F.lit("transcription.md"),
            F.when(profile.isNotNull(), F.concat(F.lit("profiles/"), profile, F.lit(".md"))),
            F.when(context.isNotNull(), F.lit("inventory:metadata")),
            F.when(F.col("override_text").isNotNull(), F.concat(F.lit("objects/"), "object_id", F.lit(".md"))),
        )
    )
    missing = profile.isNotNull() & (F.col("profile_text").isNull() | (F.lower(profile) == "readme"))
    ready = joined.filter(~missing).select(
        "object_id",
        F.array_join(sections, "\n\n").alias("instructions"),
        layers.alias("layers"),
    ).withColumn("prompt_hash", hashing.text_hash(F.col("instructions")))
    errors = joined.filter(missing).select(
        "object_id",
        F.concat(F.lit("declared prompt profile not found: "), "prompt_profile").alias("error"),
        F.lit("prompt").alias("stage"),
    )
    return ready, errors


def chunk_of(page: Column, chunk_size: int) -> Column:
    """0-based chunk of a page number."""
    return F.floor((page - 1) / chunk_size).cast("int")


def chunk_plan(images: DataFrame, chunk_size: int = vocab.DEFAULT_CHUNK_SIZE) -> DataFrame:
    """One row per chunk: first and last page and the digest of its images."""
    return images.groupBy("object_id", chunk_of(F.col("page"), chunk_size).alias("chunk")).agg(
        F.min("page").alias("start_page"),
        F.max("page").alias("end_page"),
        F.count(F.lit(1)).alias("pages"),
        hashing.set_digest(hashing.image_hash(F.col("page"), F.col("filename"), F.col("sha256")), None).alias("images_hash"),
    )


def chunk_identity(run: dict[str, str]) -> Column:
    """Key of a chunk answer: run settings, instructions, images and position."""
    settings = [F.lit(f"{key}={run[key]}") for key in sorted(run)]
    return hashing.fields_hash(
        *settings, F.col("prompt_hash"), F.col("images_hash"), F.col("object_id"), F.col("chunk"), F.col("start_page")
    )


def cache_lookup(plan: DataFrame, cache: DataFrame) -> DataFrame:
    """hit, miss or contradictory per planned chunk.

    cache(identity, content_hash, recorded_hash): an entry whose content no
    longer has its recorded hash blocks the chunk.
    """
    joined = plan.join(cache, "identity", "left")
    state = (
        F.when(F.col("recorded_hash").isNull() & F.col("content_hash").isNull(), "miss")
        .when(F.col("content_hash").eqNullSafe(F.col("recorded_hash")), "hit")
        .otherwise("contradictory")
    )
    return joined.withColumn("state", state).drop("content_hash", "recorded_hash")


def output_budget(chunk_size: Column, limit: Column) -> Column:
    """Whether an answer limit can hold a full chunk."""
    return chunk_size * vocab.OUTPUT_TOKENS_PER_PAGE <= limit
