"""Streams over the test tables, run to their end and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..bindings import as_stream, bound
from ..session import checkpoint_dir
from ..streaming import assessment, corrections, reviews
from .assessment import MEASURES, blocks
from .registry import query
from .reviews import HISTORY, REVIEW_AUDIT


def run_to_end(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Write everything available to the shared folder and read it back."""
    spark = stream.sparkSession
    folder = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        writer.outputMode("append").format("parquet").start(f"{folder}/out").awaitTermination()
    else:
        def replace(batch: DataFrame, _batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/out")

        writer.outputMode(mode).foreachBatch(replace).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query(
    "str01_str03_review_stream",
    """SELECT h.object_id, h.page, h.seq, h.previous_status, coalesce(a.codes, '') AS codes, a.codes IS NULL AS accepted
       FROM history h LEFT JOIN (SELECT seq, string_agg(code, ',' ORDER BY code) AS codes FROM audited GROUP BY seq) a ON a.seq = h.seq""",
    {"history": HISTORY, "audited": REVIEW_AUDIT},
)
def _(t):
    events = bound(t.spark, t.sf_dir, "review_v", as_stream)
    judged = reviews.judge_events(events).select(
        "object_id", "page", "seq", "previous_status", F.array_join(F.array_sort("codes"), ",").alias("codes"), "accepted"
    )
    return run_to_end(judged)


@query(
    "str02_correction_stream",
    """SELECT object_id, page, seq, seq % 3 <> 2 AND seq % 6 <> 3 AS accepted FROM (
         SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id, CAST(turn + 1 AS INT) AS page, conv_id + turn AS seq FROM conversations)""",
)
def _(t):
    def edits_of(rows: DataFrame) -> DataFrame:
        seq = F.col("conv_id") + F.col("turn")
        digest = F.sha2("text", 256)
        return rows.select(
            F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("object_id"), (F.col("turn") + 1).cast("int").alias("page"),
            seq.alias("seq"), F.when(seq % 3 == 2, "stale").otherwise(digest).alias("version"),
            F.when(seq % 6 == 3, digest).otherwise(F.sha2(F.concat("text", F.lit("!")), 256)).alias("new_version"),
        )

    current = t.conversations.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("object_id"), (F.col("turn") + 1).cast("int").alias("page"),
        F.sha2("text", 256).alias("current_version"),
    )
    stream = edits_of(as_stream(t.spark, t.sf_dir, "conversations"))
    return run_to_end(corrections.guard_versions(stream, current).select("object_id", "page", "seq", "accepted"))


#: Objects whose text changes before the second batch arrives.
CHANGED = "CAST(substr(object_id, 6) AS INT) % 4 = 1"


@query(
    "str04_incremental_assessment",
    f"""SELECT * FROM (
         SELECT 0 AS batch, object_id, errors, warnings, CASE WHEN errors > 2 THEN 'problematic' WHEN warnings > 0 OR needs_review OR unverified_pages > 0 THEN 'needs_review' ELSE 'confident' END AS overall_status FROM assessed)
       UNION ALL SELECT * FROM (
         SELECT 1 AS batch, object_id, errors, warnings, CASE WHEN errors > 2 THEN 'problematic' WHEN warnings > 0 OR needs_review OR unverified_pages > 0 THEN 'needs_review' ELSE 'confident' END AS overall_status FROM assessed
         WHERE {CHANGED} AND object_id IN (SELECT object_id FROM pages_v WHERE regexp_matches(transcription, '\\S')))""",
    blocks("assessed"),
)
def _(t):
    folder = f"{checkpoint_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    first = t.pages_v
    first.write.parquet(f"{folder}/in")
    pages = t.spark.readStream.schema(first.schema).parquet(f"{folder}/in")
    assessment.assess_stream(pages, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    longer = F.when(F.expr(CHANGED) & F.col("transcription").rlike(r"\S"), F.concat("transcription", F.lit(" ganz neu"))).otherwise(F.col("transcription"))
    first.withColumn("transcription", longer).write.mode("append").parquet(f"{folder}/in")
    assessment.assess_stream(pages, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{folder}/out").select("batch", "object_id", "errors", "warnings", "overall_status")


@query(
    "str06_running_status_counts",
    """SELECT d.overall_status, count(m.object_id) AS objects FROM (VALUES ('confident'), ('needs_review'), ('problematic')) d(overall_status)
       LEFT JOIN (SELECT object_id, CASE WHEN errors > 2 THEN 'problematic' WHEN warnings > 0 OR needs_review OR unverified_pages > 0 THEN 'needs_review' ELSE 'confident' END AS overall_status
                  FROM assessed) m ON m.overall_status = d.overall_status GROUP BY d.overall_status""",
    blocks("assessed"),
)
def _(t):
    # a quarter of the objects is empty at first, so its status changes with the second batch
    folder = f"{checkpoint_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    last = t.pages_v
    first = last.withColumn("transcription", F.when(F.expr(CHANGED), "").otherwise(F.col("transcription")))
    for version in (first, last):
        version.write.mode("append").parquet(f"{folder}/in")
        pages = t.spark.readStream.schema(last.schema).parquet(f"{folder}/in")
        assessment.assess_stream(pages, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        results = t.spark.readStream.schema("object_id string, overall_status string, batch int").parquet(f"{folder}/out")
        assessment.count_stream(results.withColumnRenamed("batch", "seq"), f"{folder}/counts", f"{folder}/counted").awaitTermination()
    return assessment.status_counts(t.spark, f"{folder}/counts")


@query(
    "str05_overtaken_proposals",
    """SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id, CAST(turn + 1 AS INT) AS page, (conv_id + turn) % 4 AS hours, sha256(text || '!') AS current_version
       FROM conversations WHERE (conv_id + turn) % 4 IN (1, 2)""",
)
def _(t):
    def timed(rows: DataFrame, hours) -> DataFrame:
        start = F.lit("2024-01-01 10:00:00").cast("timestamp")
        return rows.select(
            F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("object_id"), (F.col("turn") + 1).cast("int").alias("page"),
            F.sha2("text", 256).alias("version"), F.sha2(F.concat("text", F.lit("!")), 256).alias("new_version"), ((F.col("conv_id") + F.col("turn")) % 4).alias("hours"),
            F.timestamp_add("hour", hours, F.timestamp_add("minute", (F.col("turn") % 50).cast("int"), start)).alias("at"),
        )

    n = (F.col("conv_id") + F.col("turn")) % 4
    # corrections one or two hours after the proposal, one before it, and one of another version
    hours = F.when(n == 0, -1).otherwise(n).cast("int")
    rows = as_stream(t.spark, t.sf_dir, "conversations")
    proposals = timed(rows, F.lit(0)).select("object_id", "page", "hours", "version", F.col("at").alias("proposed_at"))
    made = timed(as_stream(t.spark, t.sf_dir, "conversations"), hours).select(
        "object_id", "page", F.when(F.col("hours") == 3, "other").otherwise(F.col("version")).alias("base_version"), "new_version", F.col("at").alias("accepted_at")
    )
    return run_to_end(corrections.overtaken_proposals(proposals, made).select("object_id", "page", "hours", "current_version"))
