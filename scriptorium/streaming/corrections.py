"""Corrections as a stream with optimistic concurrency."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from .reviews import use_rocksdb

STATE = StructType([StructField("version", StringType())])


class VersionGuard(StatefulProcessor):
    """Accepts a correction only when it was made against the current version."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("version", STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.state.update((initialState["current_version"].iloc[0],))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        edits = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable", ignore_index=True)
        version = self.state.get()[0] if self.state.exists() else None
        accepted = []
        for base, new in zip(edits["version"], edits["new_version"]):
            fits = version is not None and base == version and new != version
            accepted.append(fits)
            version = new if fits else version
        if version is not None:
            self.state.update((version,))
        yield edits.assign(accepted=accepted)

    def close(self) -> None:
        pass


def guard_versions(edits: DataFrame, current: DataFrame) -> DataFrame:
    """Tag every correction of a stream as accepted or rejected.

    edits(object_id, page, seq, version, new_version, ...);
    current(object_id, page, current_version) seeds the state.
    """
    use_rocksdb(edits.sparkSession)
    schema = StructType([*edits.schema.fields, StructField("accepted", BooleanType())])
    seed = current.select("object_id", "page", "current_version").groupBy("object_id", "page")
    return edits.groupBy("object_id", "page").transformWithStateInPandas(
        VersionGuard(), schema, outputMode="Append", timeMode="None", initialState=seed
    )


def proposal_staleness(proposals: DataFrame, current: DataFrame) -> DataFrame:
    """Mark proposals whose base version is no longer the current one.

    proposals(object_id, page, version, ...) may be a stream;
    current(object_id, page, current_version) is a table.
    """
    joined = proposals.join(current.select("object_id", "page", "current_version"), ["object_id", "page"], "left")
    return joined.withColumn("stale", ~F.col("version").eqNullSafe(F.col("current_version")))


def overtaken_proposals(proposals: DataFrame, corrections: DataFrame, within: str = "30 days", late: str = "1 day") -> DataFrame:
    """Proposals that a correction of their page overtook, as a join of two streams.

    proposals(object_id, page, version, proposed_at, ...) and corrections(object_id, page, base_version, new_version, accepted_at) are streams.
    A proposal turns stale when a correction of the version it was made for is accepted after it, at most ``within`` later; then it comes
    out once with the time and version of that correction, whichever side arrived first. Both sides are kept for ``within``
    plus ``late``, the time by which rows may come late, and no longer.
    """
    left = proposals.withWatermark("proposed_at", late)
    right = corrections.select(
        F.col("object_id").alias("_object"), F.col("page").alias("_page"), F.col("base_version").alias("_base"),
        F.col("new_version").alias("current_version"), F.col("accepted_at"),
    ).withWatermark("accepted_at", late)
    between = (F.col("accepted_at") > F.col("proposed_at")) & (F.col("accepted_at") <= F.col("proposed_at") + F.expr(f"INTERVAL {within}"))
    same = (F.col("object_id") == F.col("_object")) & (F.col("page") == F.col("_page")) & (F.col("version") == F.col("_base"))
    return left.join(right, same & between).drop("_object", "_page", "_base")
