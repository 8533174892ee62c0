"""Rules as data: code and condition; collected without shuffling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One contract rule. The condition is true (not null) where it is broken."""

    code: str
    broken: Column


def violation_array(checks: list[Check]) -> Column:
    """Array of the broken rules of a row, in rule order."""
    found = [
        F.when(check.broken, F.struct(F.lit(check.code).alias("code")))
        for check in checks
    ]
    return F.array_compact(F.array(*found))


def violations(df: DataFrame, checks: list[Check], *keys: str) -> DataFrame:
    """One row per broken rule: keys, code.

    The outer form keeps the optimizer from deriving a size filter out of the
    whole rule list and pushing a second copy of it below the projections.
    """
    return df.select(*keys, F.inline_outer(violation_array(checks))).filter("code IS NOT NULL")


def quarantine(found: DataFrame, stage: str = "contract") -> DataFrame:
    """Error rows (object_id, error, stage) of broken rules."""
    return found.select("object_id", F.col("code").alias("error"), F.lit(stage).alias("stage"))


def without_violations(df: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """The rows whose object broke no rule."""
    keys = keys or ("object_id",)
    return df.join(found.select(*keys).distinct(), list(keys), "left_anti")


def run_errors(*parts: DataFrame) -> DataFrame:
    """Error rows (object_id, error, stage) of all sources of a run; equal rows of two sources stay two."""
    found = parts[0].select("object_id", "error", "stage")
    for part in parts[1:]:
        found = found.unionByName(part.select("object_id", "error", "stage"))
    return found


def run_summary(objects: DataFrame, errors: DataFrame) -> DataFrame:
    """(stage, errors, failed, total): error rows and failed objects per stage, and over all stages (stage null).

    ``total`` is the number of objects of the run; stages without errors have no row, and the row of all stages is always there.
    """
    total = objects.agg(F.count_distinct("object_id").alias("total"))
    counts = [F.count(F.lit(1)).alias("errors"), F.count_distinct("object_id").alias("failed")]
    per_stage = errors.groupBy("stage").agg(*counts)
    whole = errors.agg(*counts).select(F.lit(None).cast("string").alias("stage"), "errors", "failed")
    # one row on the right
    return per_stage.unionByName(whole).join(F.broadcast(total.withColumn("_one", F.lit(1))), F.col("_one") == 1).drop("_one")
