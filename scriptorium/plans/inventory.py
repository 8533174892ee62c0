"""Corpus inventory, image extraction audit and image fetch planner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text


def merge_declared(found: DataFrame, declared: DataFrame) -> DataFrame:
    """Files and declared documents: the manifest enriches or adds (full join).

    declared(doc_id, declared_pages, source_type?, format?, language,
    prompt_profile): its values win.
    """
    have = set(declared.columns)

    def declared_or(name: str, default: str) -> Column:
        return F.coalesce(F.col(f"d.{name}"), F.lit(default)) if name in have else F.lit(default)

    joined = found.alias("f").join(declared.alias("d"), "doc_id", "full")
    return joined.select(
        "doc_id",
        F.coalesce("f.source_type", declared_or("source_type", "remote_images")).alias("source_type"),
        F.coalesce("f.pages", F.col("d.declared_pages").cast("bigint"), F.lit(0)).alias("pages"),
        F.coalesce("f.format", declared_or("format", "remote")).alias("format"),
        F.coalesce("f.path", F.lit("manifest.json")).alias("path"),
        F.when(F.col("d.declared_pages") > 0, F.col("d.declared_pages")).alias("declared_pages"),
        F.col("d.language").alias("language"),
        F.col("d.prompt_profile").alias("prompt_profile"),
    )


def merge_images(documents: DataFrame, images: DataFrame) -> DataFrame:
    """Documents and materialised images (doc_id, materialized_pages, image_format): full join."""
    joined = documents.join(images, "doc_id", "full")
    return joined.select(
        "doc_id",
        F.coalesce("source_type", F.lit("extracted_image")).alias("source_type"),
        F.coalesce("pages", F.col("materialized_pages").cast("bigint")).alias("pages"),
        F.coalesce("format", "image_format").alias("format"),
        F.coalesce("path", F.concat(F.lit("images/"), "doc_id")).alias("path"),
        "declared_pages",
        F.when(F.col("source_type").isNotNull(), F.col("materialized_pages")).alias("materialized_pages"),
        "language",
        "prompt_profile",
    )


def page_count_problems(documents: DataFrame) -> DataFrame:
    """Documents whose local or materialised pages differ from the declaration."""
    local = (F.col("source_type") == "image") & (F.col("pages") != F.col("declared_pages"))
    materialised = F.col("materialized_pages") != F.col("declared_pages")
    code = F.when(F.coalesce(local, F.lit(False)), "local_pages").when(
        F.coalesce(materialised, F.lit(False)), "materialized_pages"
    )
    return documents.select("doc_id", code.alias("code")).filter("code IS NOT NULL")


def effective_pages() -> Column:
    """Declared before materialised before counted pages."""
    return F.coalesce(F.col("declared_pages").cast("bigint"), F.col("materialized_pages").cast("bigint"), F.col("pages"))


def transcribable(has_urls: Column) -> Column:
    return (
        F.col("source_type").isin(vocab.IMAGE_SOURCE_TYPES)
        | (F.coalesce("materialized_pages", F.lit(0)) > 0)
        | F.coalesce(has_urls, F.lit(False))
    )


def inventory(documents: DataFrame, remote: DataFrame | None = None) -> DataFrame:
    """Inventory rows in id order. ``remote`` lists doc_ids with image addresses."""
    rows = documents
    has_urls = F.lit(False)
    if remote is not None:
        rows = rows.join(remote.select("doc_id").distinct().withColumn("_urls", F.lit(True)), "doc_id", "left")
        has_urls = F.col("_urls")
    return rows.select(
        F.col("doc_id").alias("id"), "source_type", effective_pages().alias("pages"), "format", "path",
        "language", "prompt_profile", transcribable(has_urls).alias("transcribable"),
    ).orderBy("id")


def summary(rows: DataFrame) -> DataFrame:
    """Documents and pages per source type."""
    return rows.groupBy("source_type").agg(F.count(F.lit(1)).alias("documents"), F.sum("pages").alias("pages"))


def markdown_rows(rows: DataFrame) -> DataFrame:
    """Inventory rows as lines of a Markdown table."""
    step = F.when(F.col("transcribable"), "yes").otherwise("no, no page images")
    cells = [F.col("id"), F.col("source_type"), F.col("pages").cast("string"), F.col("format"), F.col("path"), step]
    return rows.select("id", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def extraction_audit(manifest: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Per object: pages, failed pages and complete / failed; optionally current by source hash.

    manifest(object_id, page, error, recorded_sha256?, dpi?);
    sources(object_id, source_sha256, wanted_dpi).
    """
    per_object = manifest.groupBy("object_id").agg(
        F.count(F.lit(1)).alias("pages"), F.count("error").alias("failed_pages"),
        *([F.max("recorded_sha256").alias("recorded_sha256"), F.max("dpi").alias("dpi")] if sources is not None else []),
    ).withColumn("state", F.when(F.col("failed_pages") > 0, "failed").otherwise("complete"))
    if sources is None:
        return per_object
    same = F.col("recorded_sha256").eqNullSafe(F.col("source_sha256")) & F.col("dpi").eqNullSafe(F.col("wanted_dpi"))
    return sources.join(per_object, "object_id", "left").withColumn(
        "skip", same & F.coalesce(F.col("state") == "complete", F.lit(False))
    )


def fetch_plan(worklist: DataFrame, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """State of every wanted page: current, ambiguous or fetch.

    worklist(object_id, page, url); manifest(object_id, page, filename, sha256,
    url) from the last fetch; files(object_id, page, filename, sha256) on disk.
    """
    key = ["object_id", "page"]
    local = files.groupBy(*key).agg(
        F.count(F.lit(1)).alias("local_files"), F.min_by(F.struct("filename", "sha256"), "filename").alias("_file")
    )
    previous = manifest.select(
        *key, F.col("filename").alias("_name"), F.col("sha256").alias("_sha"), F.col("url").alias("_url")
    )
    joined = worklist.join(local, key, "left").join(previous, key, "left")
    current = (
        (F.col("_url") == F.col("url"))
        & (F.col("_name") == F.col("_file.filename"))
        & (F.col("_sha") == F.col("_file.sha256"))
    )
    state = (
        F.when(F.col("local_files") > 1, "ambiguous")
        .when(F.coalesce(current, F.lit(False)), "current")
        .otherwise("fetch")
    )
    return joined.select(*key, "url", state.alias("state"))


def nonconsecutive_worklists(worklist: DataFrame) -> DataFrame:
    """Objects whose wanted pages are not numbered 1..n."""
    from ..operators.contract import page_number_violations

    return page_number_violations(worklist).select("object_id")


def stale_files(files: DataFrame, plan: DataFrame, manifest: DataFrame) -> DataFrame:
    """Local files of planned objects that the finished manifest does not name."""
    planned = plan.select("object_id").distinct()
    return files.join(planned, "object_id", "left_semi").join(
        manifest.select("object_id", "filename"), ["object_id", "filename"], "left_anti"
    )


def url_differences(declared: DataFrame, manifest: DataFrame) -> DataFrame:
    """Declared against recorded page addresses, by position."""
    joined = declared.select("object_id", "page", F.col("url").alias("declared_url")).join(
        manifest.select("object_id", "page", F.col("url").alias("recorded_url")), ["object_id", "page"], "full"
    )
    return joined.filter(~F.col("declared_url").eqNullSafe(F.col("recorded_url")))


def safe_worklist(pairs: DataFrame) -> DataFrame:
    return pairs.filter(text.is_safe_url(F.col("url")))
