"""Sinks: tables, exports, error tables and changed-only publishing.

Every writer lets Spark write many files; ordered exports are range-sorted, so
the files in name order are the whole export and nothing passes one task.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental
from ..plans.inventory import markdown_rows
from ..session import checkpointed

MARKDOWN_HEAD = ["| ID | Type | Pages | Format | Path | Step 3 |", "|---|---|---|---|---|---|"]


def write_inventory(rows: DataFrame, path: str) -> None:
    """Inventory as JSON rows, and as a Markdown table in id order."""
    rows.orderBy("id").write.mode("overwrite").json(f"{path}/inventory")
    lines = markdown_rows(rows).select(F.lit(1).alias("part"), "id", "line")
    head = rows.sparkSession.createDataFrame(
        [(0, str(i), line) for i, line in enumerate(MARKDOWN_HEAD)], "part int, id string, line string"
    )
    head.unionByName(lines).orderBy("part", "id").select("line").write.mode("overwrite").text(f"{path}/markdown")


def write_pages(pages: DataFrame, path: str) -> None:
    """Pages table, clustered by object and page; texts pass through unchanged."""
    pages.repartitionByRange("object_id", "page").sortWithinPartitions("object_id", "page").write.mode(
        "overwrite"
    ).parquet(path)


def write_validated(assessed: DataFrame, findings: DataFrame, pages: DataFrame, path: str) -> None:
    """Validated corpus: object status, findings and the unchanged pages."""
    assessed.write.mode("overwrite").parquet(f"{path}/objects")
    findings.write.mode("overwrite").parquet(f"{path}/findings")
    write_pages(pages, f"{path}/pages")


def write_markup(documents: DataFrame, path: str) -> None:
    """One folder per object with its document text."""
    documents.select("object_id", "markup").write.mode("overwrite").option("lineSep", "\n").partitionBy(
        "object_id"
    ).text(path)


def write_fragments(fragments: DataFrame, path: str) -> None:
    """Documents of any size as ordered fragments; a huge object spans many files."""
    order = ["object_id", "section", "ordinal"]
    fragments.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_catalog(rows: DataFrame, records: DataFrame, path: str) -> None:
    """Catalogue in case-folded id order, and the page records of all objects."""
    rows.orderBy(F.lower("id"), "id").write.mode("overwrite").json(f"{path}/catalog")
    records.write.mode("overwrite").json(f"{path}/records")


def write_errors(errors: DataFrame, path: str, run: str = "") -> None:
    """Error table of the last run; an empty run clears it."""
    errors.select("object_id", "error", "stage", F.lit(run).alias("run")).write.mode("overwrite").parquet(path)


def write_evaluation(records: DataFrame, aggregates: DataFrame, errors: DataFrame, path: str) -> None:
    """Evaluation report as JSON sections and as Markdown lines."""
    for name, frame in (("results", records), ("aggregates", aggregates), ("errors", errors)):
        frame.write.mode("overwrite").json(f"{path}/{name}")
    report_lines(records, aggregates, errors).orderBy("section", "position").select("line").write.mode(
        "overwrite"
    ).text(f"{path}/report")


def report_lines(records: DataFrame, aggregates: DataFrame, errors: DataFrame) -> DataFrame:
    """Markdown report: (section, position, line)."""

    def shown(column: str):
        # format_string rounds the shortest decimal text half up; this rounds the binary value, half to even on exact ties
        return F.coalesce(F.call_function("format_number", F.col(column), F.lit("0.000000")), F.lit(""))

    def text_of(column: str):
        return F.coalesce(F.col(column), F.lit(""))

    def row(*cells):
        return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))

    spark = records.sparkSession
    heads = [
        (0, "", "## Aggregates"), (1, "", "| Metric | Profile | Method | n | Value |"), (2, "", "|---|---|---|---:|---:|"),
        (4, "", "## Results"), (5, "", "| Fixture | Metric | Status | Value | n | Profile |"), (6, "", "|---|---|---|---:|---:|---|"),
        (8, "", "## Errors"),
    ]
    lines = spark.createDataFrame(heads, "section int, position string, line string")
    value = F.when(F.col("metric") == "cer", shown("value")).otherwise(
        F.format_string("%d/%d valid", F.col("value").cast("bigint"), F.col("n_fixtures"))
    )
    totals = aggregates.select(
        F.lit(3).alias("section"), text_of("profile").alias("position"),
        row(F.col("metric"), text_of("profile"), F.col("method"), F.col("n_fixtures").cast("string"), value).alias("line"),
    )
    results = records.select(
        F.lit(7).alias("section"), F.col("fixture_id").alias("position"),
        row(F.col("fixture_id"), F.col("metric"), F.col("status"), shown("value"), F.col("n").cast("string"), text_of("profile")).alias("line"),
    )
    failed = errors.select(
        F.lit(9).alias("section"), F.col("fixture_id").alias("position"),
        F.format_string("- %s (%s): %s", "fixture_id", "stage", "message").alias("line"),
    )
    return lines.unionByName(totals).unionByName(results).unionByName(failed)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The live rows of a published snapshot."""
    return spark.read.parquet(path).filter("NOT removed").drop("removed", "bucket")


def publish_changed(current: DataFrame, path: str, key: str = "object_id", digest: str = "sha256", buckets: int = 64) -> DataFrame:
    """Rewrite only the buckets that hold new, changed or removed rows; returns those keys.

    Rows are partitioned by a hash bucket of their key. Removed keys stay as
    marked rows, so a bucket that empties is rewritten like any other. Writers
    take ranges of (bucket, key), so a large bucket is written by many tasks.
    """
    spark = current.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    rows = current.withColumn("removed", F.lit(False)).withColumn("bucket", bucket)
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        rows.repartitionByRange("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(path)
        return current.select(key)
    live = stored.filter("NOT removed")
    changed = incremental.changed_rows(current, live, key, digest).select(key)
    gone = incremental.removed_keys(current, live, key)
    touched = checkpointed(changed.unionByName(gone).withColumn("bucket", bucket))
    dirty = touched.select("bucket").distinct()  # at most ``buckets`` rows
    tombstones = stored.join(F.broadcast(dirty), "bucket", "left_semi").join(current.select(key), key, "left_anti")
    fresh = rows.join(F.broadcast(dirty), "bucket", "left_semi")
    out = checkpointed(fresh.unionByName(tombstones.withColumn("removed", F.lit(True))))
    out.repartitionByRange("bucket", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "bucket"
    ).parquet(path)
    return touched.select(key)
