"""File listings: source classification, page images, image manifests."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..functions import hashing, text


def list_files(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """Files below a folder as (path relative to it, length[, content]).

    Without content only the listing metadata is read, never the bytes.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    prefix = root.rstrip("/") + "/"
    relative = F.regexp_replace(F.regexp_replace("path", r"^file:/+", "/"), "^" + _quoted(prefix), "")
    columns = [relative.alias("path"), F.col("length").alias("size")]
    return files.select(*columns, "content") if content else files.select(*columns)


def _quoted(value: str) -> str:
    return "\\Q" + value + "\\E"


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def source_type(path: Column) -> Column:
    """Source type by file extension, null for other files."""
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in vocab.SOURCE_TYPES.items()))
    return lookup[extension(path)]


def document_id(path: Column) -> Column:
    """PDF and top-level files by stem, others by their folder."""
    parts = F.split(path, "/", -1)
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    folder = F.get(parts, F.lit(0))
    return (
        F.when(extension(path) == ".pdf", stem)
        .when(F.size(parts) > 2, F.get(parts, F.lit(1)))
        .when((F.size(parts) == 2) & ~folder.isin("images", "text", "pdf"), folder)
        .otherwise(stem)
    )


def is_manifest(path: Column) -> Column:
    """The source manifest, or the manifest of an image folder."""
    return path.rlike(r"^manifest\.json$") | path.rlike(r"^images/[^/]+/manifest\.json$")


def classify_sources(files: DataFrame, page_counts: DataFrame | None = None) -> DataFrame:
    """One row per document found in the files: type, pages, format, folder.

    ``files`` carries path; ``page_counts`` (path, pages) gives the pages of
    transcription files, every other file counts one page. The first path in
    order decides type and format.
    """
    found = files.withColumn("source_type", source_type(F.col("path"))).filter(
        F.col("source_type").isNotNull() & ~is_manifest(F.col("path"))
    )
    pages = F.lit(1)
    if page_counts is not None:
        found = found.join(page_counts.select("path", F.col("pages").alias("_pages")), "path", "left")
        pages = F.when(F.col("source_type") == "transcription", F.coalesce("_pages", F.lit(1))).otherwise(1)
    rows = found.select(
        document_id(F.col("path")).alias("doc_id"),
        "path",
        "source_type",
        F.regexp_replace(extension(F.col("path")), r"^\.", "").alias("format"),
        F.regexp_replace("path", r"/?[^/]*$", "").alias("folder"),
        pages.alias("file_pages"),
    )
    first = F.min_by(F.struct("source_type", "format", "folder"), "path")
    return rows.groupBy("doc_id").agg(
        first.alias("_first"), F.sum("file_pages").alias("pages"), F.count(F.lit(1)).alias("files")
    ).select(
        "doc_id", "_first.source_type", "pages", "_first.format",
        F.when(F.col("_first.folder") == "", ".").otherwise(F.col("_first.folder")).alias("path"), "files",
    )


def page_images(files: DataFrame) -> DataFrame:
    """Image files by suffix, in any letter case; file name added."""
    name = text.basename(F.col("path"))
    return files.withColumn("filename", name).filter(
        F.regexp_extract(F.lower("filename"), r"\.([^.]+)$", 1).isin(vocab.IMAGE_SUFFIXES)
    )


def natural_order(df: DataFrame, column: str, *first: str) -> DataFrame:
    """Sort by natural file name order (digit runs by value, text case-folded)."""
    return df.orderBy(*first, text.natural_key(F.col(column)), column)


def preferred_folder(images: DataFrame) -> DataFrame:
    """Images of the folder that wins per object: the lowest priority number.

    images(object_id, priority, ...): supplied images before processed ones.
    """
    winner = images.groupBy("object_id").agg(F.min("priority").alias("_winner"))
    return images.join(winner, "object_id").filter(F.col("priority") == F.col("_winner")).drop("_winner")


def dominant_format(images: DataFrame) -> DataFrame:
    """Extension of the first image in natural order per object, png without one."""
    suffix = F.regexp_extract("filename", r"\.([^.]+)$", 1)
    return images.groupBy("object_id").agg(
        F.coalesce(F.min_by(suffix, F.struct(text.natural_key(F.col("filename")), "filename")), F.lit("png")).alias("format")
    )


def verified_manifest(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest pages with the first deviation each shows, null when verified.

    manifest(object_id, page, filename, sha256, error), files(object_id,
    filename, actual): equi-join on object and file name.
    """
    joined = manifest.join(files.select("object_id", "filename", "actual"), ["object_id", "filename"], "left")
    problem = (
        F.when(F.coalesce(F.col("page") < 1, F.lit(True)), "page")
        .when(F.col("error").isNotNull(), "extraction_error")
        .when(~text.is_local_filename(F.col("filename")), "filename")
        .when(F.col("actual").isNull(), "missing")
        .when(~text.is_hex(F.col("sha256"), 64), "sha256")
        .when(F.col("actual") != F.col("sha256"), "changed")
    )
    return joined.select("object_id", "page", "filename", "sha256", problem.alias("problem"))


def image_hashes(files: DataFrame) -> DataFrame:
    """Hashes of file bytes: files(path, content)."""
    return files.select("path", F.sha2("content", 256).alias("actual"))


def file_state(files: DataFrame, key: str = "path") -> DataFrame:
    """Digest of a folder: one hash over all names and byte hashes."""
    return files.agg(hashing.set_digest(hashing.fields_hash(F.col(key), F.col("actual"))).alias("state_hash"))
