"""Incremental assessment of arriving objects and running status counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import vocab
from ..operators import fingerprints, incremental
from ..plans.assessment import assess
from .reviews import use_rocksdb


def object_states(pages: DataFrame) -> DataFrame:
    """State hash per object of a pages table."""
    return fingerprints.raw_digest(pages.withColumnRenamed("transcription", "transcription_raw")).withColumnRenamed(
        "raw_hash", "state_hash"
    )


STATE_SCHEMA = "object_id string, state_hash string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the given schema; empty where it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _latest(spark: SparkSession, folder: str, before: int) -> int:
    """The latest batch below ``before`` whose states are complete, -1 if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return -1
    done = [s.getPath() for s in files.listStatus(path) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return max((n for n in (int(p.getName()) for p in done) if n < before), default=-1)


def assess_stream(pages: DataFrame, output: str, checkpoint: str, states: str | None = None) -> StreamingQuery:
    """Assess the objects of every micro-batch that are new or changed.

    Objects arrive whole. Batch ``n`` is judged against the state of batches below ``n`` alone, and writes its results and then the
    state after it under its own number, both with overwriting: a repeated batch gives the same rows again. The state is
    one row per object, so neither results nor earlier batches are read; of the states the latest two are kept.
    """
    spark = pages.sparkSession
    states = states or f"{checkpoint}-states"

    def run(batch: DataFrame, batch_id: int) -> None:
        before = _latest(spark, states, batch_id)
        earlier = _read(spark, f"{states}/{before}", STATE_SCHEMA) if before >= 0 else spark.createDataFrame([], STATE_SCHEMA)
        now = object_states(batch).select("object_id", "state_hash")
        fresh = incremental.classify(now, earlier).filter("state <> 'current'").select("object_id", "state_hash")
        todo = batch.join(fresh.select("object_id"), "object_id", "left_semi")
        assess(todo).join(fresh, "object_id").write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        unchanged = earlier.join(now.select("object_id"), "object_id", "left_anti")
        unchanged.unionByName(now).write.mode("overwrite").parquet(f"{states}/{batch_id}")
        _drop_states(spark, states, before)

    return (
        pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _drop_states(spark: SparkSession, states: str, before: int) -> None:
    """Remove states below ``before``; the one before the current batch stays for a repetition."""
    path = spark._jvm.org.apache.hadoop.fs.Path(states)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        if int(status.getPath().getName()) < before:
            files.delete(status.getPath(), True)


STATUS = StructType([StructField("status", StringType()), StructField("seq", LongType())])
CHANGES = "object_id string, overall_status string, change long"


class LastStatus(StatefulProcessor):
    """Holds the last status of an object and takes it back when another one comes.

    Rows of one object may arrive in any order and over many batches; the highest ``seq`` counts, and of a batch nothing but that row is kept.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("status", STATUS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        status, seq = self.state.get() if self.state.exists() else (None, None)
        before = status
        for part in rows:
            top = part.loc[part["seq"].idxmax()]
            if seq is None or top["seq"] > seq:
                status, seq = top["overall_status"], int(top["seq"])
        self.state.update((status, seq))
        moved = [] if status == before else [(key[0], before, -1)] * (before is not None) + [(key[0], status, 1)]
        yield pd.DataFrame(moved, columns=["object_id", "overall_status", "change"]).astype({"change": "int64"})

    def close(self) -> None:
        pass


def status_changes(assessed: DataFrame) -> DataFrame:
    """(object_id, overall_status, change) of a stream (object_id, seq, overall_status): +1 for a new status, -1 for the one it replaces.

    The sum of the changes by status is at any time the number of objects that have it last.
    """
    use_rocksdb(assessed.sparkSession)
    rows = assessed.select("object_id", F.col("seq").cast("long").alias("seq"), "overall_status")
    return rows.groupBy("object_id").transformWithStateInPandas(LastStatus(), CHANGES, outputMode="Append", timeMode="None")


COUNTS = "overall_status string, objects long"


def count_stream(assessed: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Keep the number of objects per last status of a stream; see ``status_counts``.

    Batch ``n`` adds its changes to the counts of the batches below ``n`` and writes them, a row per status, under its own number with
    overwriting, so a repeated batch gives the same counts.
    """
    spark = assessed.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        before = _latest(spark, output, batch_id)
        earlier = _read(spark, f"{output}/{before}", COUNTS) if before >= 0 else spark.createDataFrame([], COUNTS)
        changed = batch.groupBy("overall_status").agg(F.sum("change").alias("objects"))
        counts = earlier.unionByName(changed).groupBy("overall_status").agg(F.sum("objects").alias("objects"))
        counts.write.mode("overwrite").parquet(f"{output}/{batch_id}")
        _drop_states(spark, output, before)

    changes = status_changes(assessed)
    return changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def status_counts(spark: SparkSession, output: str) -> DataFrame:
    """The latest counts of ``count_stream`` with all categories."""
    last = _latest(spark, output, 1 << 62)
    return zero_filled(_read(spark, f"{output}/{last}", COUNTS) if last >= 0 else spark.createDataFrame([], COUNTS))


def zero_filled(counts: DataFrame) -> DataFrame:
    """Counts with all categories, for the sink of a counting stream."""
    return vocab.status_dimension(counts.sparkSession).join(counts, "overall_status", "left").select(
        "overall_status", F.coalesce("objects", F.lit(0)).cast("bigint").alias("objects")
    )
