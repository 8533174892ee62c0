"""Page measures, rule counts, severities, quality signals and overall status."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import markers, text
from ..functions.values import round_one


@dataclass(frozen=True)
class Rule:
    """A counting rule with the counts above which it warns or fails."""

    name: str
    count: Callable[[Column], Column]
    warning_above: int
    error_above: int | None = None


# Registry of text rules; a project appends its own. Thresholds are fixed values.
RULES: list[Rule] = [
    Rule("uncertain_markers", markers.count_uncertain, 3, 10),
    Rule("illegible_markers", markers.count_illegible, 1, 5),
    Rule("ocr_artifacts", markers.count_artifacts, 0, 3),
    Rule("double_spaces", markers.count_double_spaces, 10),
]

PAGES_PER_SEGMENT = 4096


def severity(rule: Rule, count: Column) -> Column:
    out = F.when(count > rule.error_above, "error") if rule.error_above is not None else F.when(F.lit(False), "error")
    return out.when(count > rule.warning_above, "warning").otherwise("info")


def page_stats(pages: DataFrame) -> DataFrame:
    """Characters, words and lines per page."""
    body = F.coalesce(F.col("transcription"), F.lit(""))
    return pages.select(
        "object_id",
        "page",
        F.length(body).alias("char_count"),
        text.word_count(body).alias("word_count"),
        (F.regexp_count(body, F.lit("\n")) + F.when(body != "", 1).otherwise(0)).alias("line_count"),
    )


def derived_page_type(transcription: Column, page_type: Column) -> Column:
    """The declared type, else content or undeclared_empty by the text."""
    declared = text.non_empty(F.coalesce(page_type, F.lit("")))
    return F.coalesce(
        declared, F.when(text.is_blank(transcription), "undeclared_empty").otherwise("content")
    )


def is_unverified(transcription: Column, page_type: Column) -> Column:
    """A gated page, or an empty page that is not declared blank."""
    kind = F.coalesce(page_type, F.lit(""))
    return (kind == "gate_low_resolution") | (text.is_blank(transcription) & (kind != "blank"))


def page_measures(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Everything the object level needs from a page, in one pass over its text."""
    body = F.coalesce(F.col("transcription"), F.lit(""))
    kind = F.coalesce(F.col("page_type"), F.lit(""))
    return pages.select(
        "object_id",
        "page",
        F.length(text.strip(body)).alias("stripped_chars"),
        F.length(body).alias("char_count"),
        derived_page_type(body, kind).alias("derived_type"),
        is_unverified(body, kind).alias("unverified"),
        F.when(text.has_text(body), markers.edge_code(body)).alias("edge"),
        *[rule.count(body).alias(rule.name) for rule in (RULES if rules is None else rules)],
    )


def _edge_matches() -> Column:
    """Illegible markers completed across page edges within one segment.

    ``window`` holds the codes of the non-blank pages of a segment in page
    order, from ``offset`` on, after those of the last pages before it. Blank
    pages are white space inside a marker and drop out, so a broken marker
    spans at most four non-blank pages.
    """
    window = F.col("window")

    def tail(code: Column) -> Column:
        return code.bitwiseAND(3)

    def field(code: Column, shift: int) -> Column:
        return F.shiftright(code, shift).bitwiseAND(3)

    def entry(i: Column, depth: int) -> Column:
        """Open state in front of position i, looking back at most depth pages."""
        code = F.get(window, i - 1)
        own = tail(code)
        if depth == 0:
            return F.coalesce(own, F.lit(0))
        passes = field(code, 4)
        inherited = F.when(entry(i - 1, depth - 1) == passes, field(code, 6)).otherwise(0)
        return F.coalesce(F.when(passes > 0, inherited).otherwise(own), F.lit(0))

    def completes(i: Column) -> Column:
        head = field(F.get(window, i), 2)
        return (head > 0) & (entry(i, 2) == head)

    positions = F.sequence(F.col("offset"), F.size(window) - 1)
    return F.when(F.size(window) > F.col("offset"), F.size(F.filter(positions, completes))).otherwise(0)


def object_measures(
    pages: DataFrame, rules: list[Rule] | None = None, pages_per_segment: int = PAGES_PER_SEGMENT
) -> DataFrame:
    """Rule counts and quality signals per object.

    Counts add up per page, and pages combine on the map side in segments of
    consecutive page numbers. The one thing a page sum misses is an illegible
    marker that a page edge cuts in two: its pieces are followed through the
    small edge codes of the neighbouring pages.
    """
    rules = RULES if rules is None else rules
    segment = F.floor((F.col("page") - 1) / pages_per_segment).cast("bigint")
    measured = page_measures(pages, rules).withColumn("segment", segment)
    edge = F.when(F.col("edge").isNotNull(), F.struct("page", "edge"))

    def kind_count(kind: str) -> Column:
        return F.count_if(F.col("derived_type") == kind)

    per_segment = measured.groupBy("object_id", "segment").agg(
        F.count(F.lit(1)).alias("page_count"),
        F.sum("stripped_chars").alias("total_chars"),
        F.sum("char_count").alias("total_characters"),
        kind_count("blank").alias("blank_pages"),
        kind_count("undeclared_empty").alias("undeclared_empty_pages"),
        kind_count("gate_low_resolution").alias("gate_pages"),
        kind_count("foreign_text").alias("foreign_pages"),
        F.count_if("unverified").alias("unverified_pages"),
        *[F.sum(rule.name).alias(rule.name) for rule in rules],
        # a set, so copies of a page combine on the map side
        F.transform(F.array_sort(F.collect_set(edge)), lambda e: e["edge"]).alias("edges"),
    )
    # One row per 4096 pages reaches this window; its rows are small.
    last_three = F.when(
        F.size("edges") > 0, F.slice("edges", F.greatest(F.size("edges") - 2, F.lit(1)), 3)
    )
    sums = [
        "page_count", "total_chars", "total_characters", "blank_pages", "undeclared_empty_pages",
        "gate_pages", "foreign_pages", "unverified_pages", *[r.name for r in rules],
    ]
    earlier = [
        F.expr(f"lag(last_three, {n}) IGNORE NULLS OVER (PARTITION BY object_id ORDER BY segment)")
        for n in (3, 2, 1)
    ]
    empty = F.array().cast("array<int>")
    with_window = (
        per_segment.withColumn("last_three", last_three)
        .withColumn("prior", F.concat(*[F.coalesce(codes, empty) for codes in earlier]))
        .withColumn("window", F.concat("prior", "edges"))
        .withColumn("offset", F.size("prior"))
        .withColumn("edge_matches", _edge_matches())
    )
    totals = with_window.groupBy("object_id").agg(
        *[F.sum(name).alias(name) for name in sums], F.sum("edge_matches").alias("edge_matches")
    )
    if any(rule.name == "illegible_markers" for rule in rules):
        totals = totals.withColumn("illegible_markers", F.col("illegible_markers") + F.col("edge_matches"))
    return totals.drop("edge_matches")


def quality_signals(measures: DataFrame, image_count: Column | None = None) -> DataFrame:
    """The derived quality block of an object (without the per-page type list)."""
    images = F.col("page_count") if image_count is None else image_count
    content = (
        F.col("page_count") - F.col("blank_pages") - F.col("undeclared_empty_pages")
        - F.col("gate_pages") - F.col("foreign_pages")
    )
    average = F.when(F.col("page_count") > 0, F.col("total_chars") / F.col("page_count")).otherwise(0.0)
    return (
        measures.withColumn("chars_per_page", round_one(average))
        .withColumn("content_pages", content)
        .withColumn(
            "needs_review",
            (F.col("undeclared_empty_pages") > 0) | ((images > 0) & (F.col("blank_pages") == images)),
        )
    )


def rule_findings(measures: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row (object_id, rule, count, severity) per object and rule."""
    rules = RULES if rules is None else rules
    findings = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.col(rule.name).alias("count"),
                severity(rule, F.col(rule.name)).alias("severity"),
            )
            for rule in rules
        ]
    )
    return measures.select("object_id", F.inline(findings))


def severity_count(level: str, rules: list[Rule] | None = None) -> Column:
    rules = RULES if rules is None else rules
    return sum((F.when(severity(r, F.col(r.name)) == level, 1).otherwise(0) for r in rules), F.lit(0))


def overall_status(
    errors: Column,
    warnings: Column,
    needs_review: Column,
    unverified_pages: Column,
    confidence: Column,
    uncertain: Column | None = None,
    likely: Column | None = None,
    unreviewed: Column | None = None,
) -> Column:
    """problematic before needs_review before confident."""
    no = F.lit(False)
    uncertain, likely, unreviewed = (no if c is None else F.coalesce(c, no) for c in (uncertain, likely, unreviewed))
    return (
        F.when(uncertain | (errors > 2), "problematic")
        .when(
            likely | unreviewed | (warnings > 0) | F.coalesce(needs_review, no)
            | (unverified_pages > 0) | (F.coalesce(confidence, F.lit("")) == "low"),
            "needs_review",
        )
        .otherwise("confident")
    )


def verdict_flags(verdicts: DataFrame) -> DataFrame:
    """Per object: any uncertain, likely or unreviewed verdict, and their count."""
    return verdicts.groupBy("object_id").agg(
        F.bool_or(F.col("confidence") == "uncertain").alias("any_uncertain"),
        F.bool_or(F.col("confidence") == "likely").alias("any_likely"),
        F.bool_or(F.col("confidence") == vocab.VERDICT_UNREVIEWED).alias("any_unreviewed"),
        F.count_if(F.col("confidence") == vocab.VERDICT_UNREVIEWED).alias("unreviewed_pages"),
    )


def status_histogram(assessed: DataFrame) -> DataFrame:
    """Objects per overall status, zero-filled."""
    counts = assessed.groupBy("overall_status").agg(F.count(F.lit(1)).alias("objects"))
    statuses = vocab.status_dimension(assessed.sparkSession)
    return statuses.join(counts, "overall_status", "left").select(
        "overall_status", F.coalesce("objects", F.lit(0)).cast("bigint").alias("objects")
    )
