"""Sinks: write to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans import assessment, evaluation
from ..operators import quality
from ..session import checkpoint_dir
from ..sinks import writers
from .assessment import blocks
from .evaluation import SCORED, pairs
from .markup import CATALOG_BLOCKS, catalog_rows
from .registry import query


def folder(t) -> str:
    return f"{checkpoint_dir(t.spark)}/sink-{uuid.uuid4().hex}"


@query("snk02_validated_corpus", "SELECT object_id, page, transcription FROM pages_v")
def _(t):
    path = folder(t)
    assessed = assessment.assess(t.pages_v, t.objects_v)
    writers.write_validated(assessed, quality.rule_findings(assessed), t.pages_v, path)
    return t.spark.read.parquet(f"{path}/pages").select("object_id", "page", "transcription")


@query("snk02_validated_findings", "SELECT object_id, rule, count, severity FROM findings", blocks("findings"))
def _(t):
    path = folder(t)
    assessed = assessment.assess(t.pages_v, t.objects_v)
    writers.write_validated(assessed, quality.rule_findings(assessed), t.pages_v, path)
    return t.spark.read.parquet(f"{path}/findings")


@query("snk03_markup_documents", "SELECT page_id AS object_id, len(string_split(html, chr(10))) AS lines FROM pages")
def _(t):
    path = folder(t)
    rows = t.pages.select(F.col("page_id").cast("string").alias("object_id"), F.col("html").alias("markup"))
    writers.write_fragments(
        rows.select("object_id", F.lit(80).alias("section"), F.lit(0).cast("bigint").alias("ordinal"), F.col("markup").alias("fragment")), path
    )
    return t.spark.read.parquet(path).select(
        F.col("object_id").cast("bigint").alias("object_id"), F.size(F.split("fragment", "\n", -1)).cast("bigint").alias("lines")
    )


@query(
    "snk04_catalog_export",
    """SELECT 'catalog' AS file, id, title, date, language, signature, status, page_count, has_images, CAST(NULL AS INT) AS page FROM catalog
       UNION ALL SELECT 'records', object_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, page FROM pages_v""",
    CATALOG_BLOCKS,
)
def _(t):
    path = folder(t)
    writers.write_catalog(catalog_rows(t), t.pages_v.select("object_id", "page"), path)
    schema = "id string, title string, date string, language string, signature string, status string, page_count long, has_images boolean"
    rows = t.spark.read.schema(schema).json(f"{path}/catalog").withColumn("file", F.lit("catalog"))
    records = t.spark.read.schema("object_id string, page int").json(f"{path}/records").select(
        F.lit("records").alias("file"), F.col("object_id").alias("id"), "page"
    )
    return rows.unionByName(records, allowMissingColumns=True)


@query("snk05_error_table", "SELECT object_id, error, 'render' AS stage, 'r1' AS run FROM manifest_v WHERE error IS NOT NULL")
def _(t):
    path = folder(t)
    errors = t.manifest_v.filter("error IS NOT NULL").select("object_id", "error", F.lit("render").alias("stage"))
    writers.write_errors(errors, path, "r1")
    return t.spark.read.parquet(path)


@query(
    "snk06_evaluation_report",
    """SELECT '| ' || fixture_id || ' | cer | ok | ' || printf('%.6f', distance / reference_chars) || ' | ' || CAST(reference_chars AS STRING) || ' | hsa-strict |' AS line
       FROM scored WHERE reference_chars > 0 AND profile = 'hsa-strict'
       UNION ALL SELECT '- ' || fixture_id || ' (cer): empty_reference' FROM scored WHERE reference_chars = 0""",
    {"scored": SCORED},
)
def _(t):
    path = folder(t)
    records, errors = evaluation.cer_records(pairs(t))
    writers.write_evaluation(records, evaluation.aggregates(records), errors, path)
    # lines of the written report; the other profile's values depend on the alignment
    return t.spark.read.text(f"{path}/report").select(F.col("value").alias("line")).filter("line LIKE '%| hsa-strict |' AND line LIKE '%| cer | ok |%' OR line LIKE '- %'")


@query("snk07_published_snapshot", "SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, sha256(text) AS sha256 FROM documents WHERE doc_id % 7 <> 3")
def _(t):
    path = folder(t)
    n = F.col("doc_id")
    rows = t.documents.select(F.concat(F.lit("doc-"), n.cast("string")).alias("object_id"), F.sha2("text", 256).alias("sha256"), "doc_id")
    first = rows.filter(n % 5 != 1).withColumn("sha256", F.when(n % 4 == 2, "old").otherwise(F.col("sha256"))).drop("doc_id")
    writers.publish_changed(first, path)
    writers.publish_changed(rows.filter(n % 7 != 3).drop("doc_id"), path)
    return writers.read_published(t.spark, path)
