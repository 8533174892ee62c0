"""The stricter gate of validated documents and the table-level staleness joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import hashing
from ..operators import calls, contract, quality
from ..operators.contract import Node
from ..operators.violations import Check, violations
from ..session import checkpointed

PAGE = ["object_id", "page"]
STATE_FIELDS = ["metadata", "pages", "confidence", "confidence_notes", "quality_signals", "source_images"]


def document_state_hash(doc: Column) -> Column:
    """Hash of everything of a document the findings depend on."""
    origin = F.coalesce(F.try_variant_get(doc, "$.transcription_meta", "variant"), F.try_variant_get(doc, "$._meta", "variant"))
    fields = [F.try_variant_get(doc, f"$.{f}", "variant") for f in STATE_FIELDS]
    return hashing.fields_hash(
        F.try_variant_get(doc, "$.object_id", "string"), F.to_json(origin), *[F.to_json(f) for f in fields], length=12
    )


def document_result_hash(doc: Column) -> Column:
    return hashing.fields_hash(
        F.try_variant_get(doc, "$.overall_status", "string"), F.to_json(F.try_variant_get(doc, "$.validation", "variant")), length=12
    )


def stale_page_stats(recorded: DataFrame, pages: DataFrame) -> DataFrame:
    """Recorded against recomputed page statistics: full join on the page."""
    fields = ["char_count", "word_count", "line_count"]
    current = quality.page_stats(pages).withColumn("_now", F.lit(True))
    joined = recorded.select(*PAGE, *[F.col(f).alias(f"_{f}") for f in fields], F.lit(True).alias("_was")).join(current, PAGE, "full")
    code = (
        F.when(F.col("_was").isNull(), "stats_missing")
        .when(F.col("_now").isNull(), "stats_unknown_page")
    )
    for f in fields:
        code = code.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), f"stats_{f}")
    return joined.select(*PAGE, code.alias("code")).filter("code IS NOT NULL")


def stale_totals(recorded: DataFrame, pages: DataFrame) -> DataFrame:
    """Objects whose recorded character total is not the sum over their pages."""
    total = pages.groupBy("object_id").agg(F.sum(F.length("transcription")).alias("_total"))
    return recorded.join(total, "object_id", "left").filter(
        ~F.col("total_characters").eqNullSafe(F.coalesce("_total", F.lit(0)))
    ).select("object_id")


def stale_signals(recorded: DataFrame, pages: DataFrame) -> DataFrame:
    """Objects whose recorded page-class counters differ from a recomputation."""
    fields = ["blank_pages", "undeclared_empty_pages", "gate_pages", "foreign_pages", "content_pages"]
    current = quality.quality_signals(quality.object_measures(pages, rules=[])).select("object_id", *fields)
    joined = recorded.select("object_id", *[F.col(f).alias(f"_{f}") for f in fields]).join(current, "object_id", "left")
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f).eqNullSafe(F.col(f"_{f}"))
    return joined.filter(differs).select("object_id")


def validated_violations(documents: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Rules of validated documents beyond the contract: object_id, code. ``pages``: raw pages, where documents come without theirs."""
    base = checkpointed(documents).filter("readable")
    doc = Node(F.col("doc"))
    meta, validation = doc["_meta"], doc["validation"]
    fields = contract.Fields("doc")
    node = fields.node()
    whole = violations(
        fields_of(base, fields, node),
        [
            Check("validated.step", ~F.col("_step4")),
            Check("validated.state_hash", F.col("_step4") & ~F.col("_recorded_state").eqNullSafe(F.col("_state"))),
            Check("validated.result_hash", ~F.col("_recorded_result").eqNullSafe(F.col("_result"))),
            Check("validated.origin", ~F.col("_origin")),
            Check("validated.status", ~F.coalesce(F.col("_status").isin(vocab.OVERALL_STATUSES), F.lit(False))),
            Check("validated.findings", ~F.col("_has_validation")),
            Check("validated.rules", F.col("_has_validation") & ~F.col("_has_rules")),
            Check("validated.stats", F.col("_has_validation") & ~F.col("_has_stats")),
            Check("validated.judge_alone", ~F.col("_judged") & F.col("_has_judge")),
            Check("validated.judge", F.col("_judged") & ~F.col("_has_judge")),
        ],
        "object_id",
    )
    pages = contract.typed_pages(contract.document_pages(base) if pages is None else pages)
    stat = Node(F.col("stat"))
    recorded = base.select("object_id", F.explode(validation["per_page_stats"].items).alias("stat")).select(
        "object_id", *[stat[f].integer.cast("int").alias(f) for f in ("page", "char_count", "word_count", "line_count")]
    )
    with_stats = base.filter(validation["per_page_stats"].is_array).select("object_id")
    stats = stale_page_stats(recorded, pages.join(with_stats, "object_id", "left_semi"))
    totals = stale_totals(
        base.filter(validation.is_object).select("object_id", validation["total_characters"].integer.alias("total_characters")), pages
    )
    judged = base.filter(meta["provider"].filled & validation["llm_judge"].is_array)
    verdict, call = Node(F.col("verdict")), Node(F.col("call"))
    verdicts = judged.select("object_id", F.explode(validation["llm_judge"].items).alias("verdict")).select(
        "object_id", verdict["page"].integer.cast("int").alias("page"), verdict["_prompt_hash"].string.alias("prompt_hash")
    )
    executed = judged.select("object_id", F.explode(meta["executed_prompts"].items).alias("call")).select(
        "object_id", call["page"].integer.cast("int").alias("page"), call["prompt_hash"].string.alias("prompt_hash")
    )
    judge = calls.judge_coverage_violations(verdicts, executed, pages.join(judged.select("object_id"), "object_id", "left_semi"))
    return (
        whole.unionByName(stats.select("object_id", "code"))
        .unionByName(totals.select("object_id", F.lit("stats_total").alias("code")))
        .unionByName(judge.select("object_id", "code"))
    )


def fields_of(base: DataFrame, fields: contract.Fields, node: Node) -> DataFrame:
    """The few document facts the gate compares, as columns."""
    meta, validation = node["_meta"], node["validation"]
    wanted = {
        "_step4": F.coalesce(meta["pipeline_step"].integer == 4, F.lit(False)),
        "_recorded_state": meta["input_state_hash"].string,
        "_recorded_result": meta["validation_result_hash"].string,
        "_origin": node["transcription_meta"].present,
        "_status": node["overall_status"].string,
        "_has_validation": validation.is_object,
        "_has_rules": validation["rules"].is_array,
        "_has_stats": validation["per_page_stats"].is_array,
        "_has_judge": validation["llm_judge"].is_array,
        "_judged": meta["provider"].filled,
    }
    extracted = fields.extract(base)
    return extracted.select(
        "object_id",
        *[column.alias(name) for name, column in wanted.items()],
        document_state_hash(F.col("doc")).alias("_state"),
        document_result_hash(F.col("doc")).alias("_result"),
    )
