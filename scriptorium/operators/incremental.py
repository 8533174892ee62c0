"""Freshness: what to keep, recompute, refuse or remove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify(current: DataFrame, previous: DataFrame, key: str = "object_id", force: Column | bool = False) -> DataFrame:
    """new, current or stale per object by comparing state hashes.

    current(key, state_hash), previous(key, state_hash, valid?). A previous
    output that is itself invalid is stale. Forced objects become ``forced``
    unless they are new.
    """
    before = previous.select(
        key,
        F.col("state_hash").alias("_before"),
        (F.col("valid") if "valid" in previous.columns else F.lit(True)).alias("_valid"),
        F.lit(True).alias("_known"),
    )
    forced = F.lit(force) if isinstance(force, bool) else force
    state = (
        F.when(F.col("_known").isNull(), "new")
        .when(forced, "forced")
        .when(F.col("_valid") & F.col("state_hash").eqNullSafe(F.col("_before")), "current")
        .otherwise("stale")
    )
    return current.join(before, key, "left").withColumn("state", state).drop("_before", "_known", "_valid")


def to_compute(classified: DataFrame) -> DataFrame:
    """Only new and forced objects go on to the expensive work."""
    return classified.filter(F.col("state").isin("new", "forced"))


def stale_errors(classified: DataFrame) -> DataFrame:
    return classified.filter("state = 'stale'").select(
        "object_id", F.lit("existing output is stale or invalid; force a recomputation").alias("error"), F.lit("stale").alias("stage")
    )


def refuse_forced(requests: DataFrame, history: DataFrame, previous: DataFrame) -> DataFrame:
    """Forced objects that must not be recomputed: review history or invalid output.

    history(object_id) of any review event, previous(object_id, valid).
    """
    touched = history.select("object_id").distinct().withColumn("_reviewed", F.lit(True))
    joined = requests.join(previous.select("object_id", "valid"), "object_id").join(touched, "object_id", "left")
    stage = F.when(~F.col("valid"), "stale").when(F.col("_reviewed"), "review_history")
    return joined.select("object_id", stage.alias("stage")).filter("stage IS NOT NULL")


def overwrite_guard(generated: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """write, skip or refuse per generated document.

    generated(object_id, sha256), existing(object_id, sha256, recorded): an
    existing output may only be replaced when its bytes are the recorded ones.
    """
    old = existing.select("object_id", F.col("sha256").alias("_bytes"), F.col("recorded").alias("_recorded"))
    same = F.col("sha256") == F.col("_bytes")
    action = (
        F.when(F.col("_bytes").isNull() | F.lit(force), "write")
        .when(same, "skip")
        .when(F.col("_bytes").eqNullSafe(F.col("_recorded")), "write")
        .otherwise("refuse")
    )
    return generated.join(old, "object_id", "left").withColumn("action", action).drop("_bytes", "_recorded")


def dry_run(classified: DataFrame) -> DataFrame:
    """CURRENT, PENDING or BLOCKED per object without doing any work."""
    report = (
        F.when(F.col("state") == "current", "CURRENT")
        .when(F.col("state").isin("new", "forced"), "PENDING")
        .otherwise("BLOCKED")
    )
    return classified.select("object_id", report.alias("report"))


def changed_rows(current: DataFrame, previous: DataFrame, key: str = "object_id", digest: str = "sha256") -> DataFrame:
    """Rows that are new or differ from the previous snapshot."""
    old = previous.select(key, F.col(digest).alias("_old"))
    return current.join(old, key, "left").filter(~F.col(digest).eqNullSafe(F.col("_old"))).drop("_old")


def removed_keys(current: DataFrame, previous: DataFrame, key: str = "object_id") -> DataFrame:
    """Keys of the previous snapshot that this build did not produce."""
    return previous.select(key).join(current.select(key), key, "left_anti")


def refresh_one(catalog: DataFrame, record: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(new catalogue, errors): replace records that occur exactly once, reuse the rest."""
    uses = catalog.join(record.select(key), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("uses"))
    counted = record.select(key).join(uses, key, "left")
    errors = counted.filter(~F.col("uses").eqNullSafe(F.lit(1).cast("bigint"))).select(
        key, F.lit("document must occur exactly once in the catalogue").alias("error")
    )
    accepted = record.join(errors.select(key), key, "left_anti")
    kept = catalog.join(accepted.select(key), key, "left_anti")
    return kept.unionByName(accepted), errors
