"""Call logs of model runs: chunk coverage and consistent retries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .violations import Check, violations


def chunk_coverage(calls: DataFrame) -> DataFrame:
    """First attempts per chunk with the last page of the chunk before."""
    first = calls.filter("attempt = 1").select(
        "object_id",
        "chunk",
        F.get("pages", F.lit(0)).alias("start_page"),
        F.element_at("pages", -1).alias("end_page"),
        F.size("pages").alias("pages_in_chunk"),
        F.coalesce(
            F.col("pages") == F.sequence(F.get("pages", F.lit(0)), F.element_at("pages", -1)), F.lit(False)
        ).alias("consecutive"),
    )
    previous = first.select("object_id", (F.col("chunk") + 1).alias("chunk"), F.col("end_page").alias("previous_end"))
    return first.join(previous, ["object_id", "chunk"], "left")


def call_log_violations(calls: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Chunks from 1, every page covered once in order, retries 1..k over the same pages.

    Each chunk is compared with its neighbour by an equi-join on (object, chunk),
    so a long log spreads over the cluster.
    """
    chunks = chunk_coverage(calls)
    continues = F.col("start_page") == F.coalesce(F.col("previous_end"), F.lit(0)) + 1
    per_object = (
        chunks.groupBy("object_id", "chunk")
        .agg(
            F.count(F.lit(1)).alias("uses"),
            F.bool_and("consecutive").alias("consecutive"),
            F.bool_and(F.coalesce(continues, F.lit(False))).alias("continues"),
            F.max("end_page").alias("end_page"),
        )
        .groupBy("object_id")
        .agg(
            F.sum("uses").alias("calls"),
            F.count(F.lit(1)).alias("chunks"),
            F.min("chunk").alias("low"),
            F.max("chunk").alias("high"),
            F.bool_and("consecutive").alias("consecutive"),
            F.bool_and("continues").alias("continues"),
            F.max("end_page").alias("end_page"),
        )
    )
    joined = page_counts.select("object_id", "page_count").join(per_object, "object_id", "left")
    numbered = (F.col("low") == 1) & (F.col("high") == F.col("chunks")) & (F.col("calls") == F.col("chunks"))
    covered = numbered & F.col("consecutive") & F.col("continues") & (F.col("end_page") == F.col("page_count"))
    logged = joined.join(calls.select("object_id").distinct(), "object_id", "left_semi")
    whole = violations(
        logged,
        [
            Check(
                "calls_chunks",
                F.col("chunks").isNotNull() & ~F.coalesce(numbered, F.lit(False)),
            ),
            Check(
                "calls_coverage",
                ~F.coalesce(covered, F.lit(False)),
            ),
        ],
        "object_id",
    )
    retries = calls.groupBy("object_id", "chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("attempt").alias("distinct_attempts"),
        F.min("attempt").alias("low"),
        F.max("attempt").alias("high"),
        F.min("pages").alias("first_pages"),
        F.max("pages").alias("last_pages"),
    )
    broken = retries.filter(
        (F.col("low") == 1)
        & ~(
            (F.col("high") == F.col("n"))
            & (F.col("distinct_attempts") == F.col("n"))
            & (F.col("first_pages") == F.col("last_pages"))
        )
    ).select(
        "object_id",
        F.lit("calls_retries").alias("code"),
    )
    return whole.unionByName(broken)


def judge_coverage_violations(verdicts: DataFrame, calls: DataFrame, pages: DataFrame) -> DataFrame:
    """Verdicts for all pages, calls exactly for text pages, matching prompt hashes.

    verdicts(object_id, page, prompt_hash), calls(object_id, page, prompt_hash),
    pages(object_id, page, transcription). All joins are on (object_id, page).
    """
    from ..functions import text

    key = ["object_id", "page"]
    side = pages.select(*key, text.has_text(F.coalesce("transcription", F.lit(""))).alias("has_text"))
    joined = (
        side.join(verdicts.select(*key, F.col("prompt_hash").alias("verdict_hash"), F.lit(True).alias("judged")), key, "full")
        .join(calls.select(*key, F.col("prompt_hash").alias("call_hash"), F.lit(True).alias("called")), key, "full")
    )
    judged, called = (F.coalesce(F.col(c), F.lit(False)) for c in ("judged", "called"))
    text_page = F.coalesce(F.col("has_text"), F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(F.col("has_text").isNotNull() & ~judged, "judge_missing"),
            F.when(F.col("has_text").isNull() & judged, "judge_unknown_page"),
            F.when(text_page != called, "judge_calls"),
            F.when(judged & called & ~F.col("verdict_hash").eqNullSafe(F.col("call_hash")), "judge_hash"),
        )
    )
    return joined.select(*key, F.explode(found).alias("code"))
