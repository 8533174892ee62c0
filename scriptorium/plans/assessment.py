"""Text quality assessment: page texts to one status per object."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality


def assess(
    pages: DataFrame,
    objects: DataFrame | None = None,
    verdicts: DataFrame | None = None,
    rules: list[quality.Rule] | None = None,
) -> DataFrame:
    """One row per object with rule counts, quality signals and overall status.

    ``objects`` may carry ``confidence``; ``verdicts`` carries one row per
    judged page. Texts are reduced to numbers before the only page-sized shuffle.
    """
    signals = quality.quality_signals(quality.object_measures(pages, rules))
    if objects is not None:
        signals = signals.join(objects.select("object_id", "confidence"), "object_id", "left")
    else:
        signals = signals.withColumn("confidence", F.lit(""))
    if verdicts is not None:
        signals = signals.join(quality.verdict_flags(verdicts), "object_id", "left")
        flags = [F.col("any_uncertain"), F.col("any_likely"), F.col("any_unreviewed")]
    else:
        flags = [None, None, None]
    errors = quality.severity_count("error", rules)
    warnings = quality.severity_count("warning", rules)
    return signals.withColumn("errors", errors).withColumn("warnings", warnings).withColumn(
        "overall_status",
        quality.overall_status(
            F.col("errors"), F.col("warnings"), F.col("needs_review"),
            F.col("unverified_pages"), F.col("confidence"), *flags,
        ),
    )


def status_overview(pages: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """How many objects are confident, need review or are problematic."""
    return quality.status_histogram(assess(pages, objects))
