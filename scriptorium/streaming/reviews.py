"""Review log as a stream: the state of every page is its last valid status and time."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from .. import vocab
from ..functions import values
from ..operators.reviews import review_checks
from ..operators.violations import violation_array

STATE = StructType([StructField("status", StringType()), StructField("instant", TimestampType())])
#: The page of an event as one text, and its group (no leading underscores, the state operator renames those);
#: the number of groups is part of a query's checkpoint.
PAGE, BUCKET, BUCKETS = "page_key", "page_group", 4096
KNOWN = frozenset(vocab.REVIEW_STATUSES)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state of arbitrary size lives in RocksDB and is checkpointed with the query."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def carried_statuses(statuses: list, status: str) -> tuple[list, str]:
    """The last known status in front of each event, and behind all."""
    previous = []
    for value in statuses:
        previous.append(status)
        if value in KNOWN:
            status = value
    return previous, status


def carried_instants(instants: np.ndarray, instant: datetime | None) -> tuple[np.ndarray, datetime | None]:
    """The last readable time in front of each event, and behind all."""
    line = np.concatenate([[np.datetime64("NaT") if instant is None else np.datetime64(instant)], instants]).astype(instants.dtype)
    last = np.maximum.accumulate(np.where(np.isnat(line), 0, np.arange(len(line))))
    filled = line[last]
    return filled[:-1], None if np.isnat(filled[-1]) else pd.Timestamp(filled[-1]).to_pydatetime()


class ReviewHistory(StatefulProcessor):
    """Adds to each event the status and time it continues from.

    Pages share a group by their hash, since a group costs a few milliseconds however small it is; the state is that of each
    page. One micro-batch of a group is ordered by its sequence number; admission
    limits of the source bound its size. Unknown states and unreadable times do
    not advance, exactly as in the batch operator.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("review", StructType([StructField("page", StringType())]), STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows), ignore_index=True).sort_values([PAGE, "seq"], kind="stable", ignore_index=True)
        pages, statuses, instants = events[PAGE].to_numpy(), events["status"].tolist(), events["instant"].to_numpy()
        starts = [0, *(np.flatnonzero(pages[1:] != pages[:-1]) + 1), len(pages)]
        previous, before = [], []
        for start, end in zip(starts, starts[1:]):
            page = (pages[start],)
            status, instant = self.state.getValue(page) or (vocab.INITIAL_STATUS, None)
            carried, status = carried_statuses(statuses[start:end], status)
            times, instant = carried_instants(instants[start:end], instant)
            self.state.updateValue(page, (status, instant))
            previous += carried
            before.append(times)
        events["previous_status"], events["previous_instant"] = previous, np.concatenate(before)
        yield events.drop(columns=[BUCKET, PAGE])

    def close(self) -> None:
        pass


def with_history(events: DataFrame) -> DataFrame:
    """Stateful counterpart of operators.reviews.with_history for a stream."""
    use_rocksdb(events.sparkSession)
    timed = events.withColumn("instant", values.aware_timestamp(F.col("event_time")))
    schema = StructType(
        [*timed.schema.fields, StructField("previous_status", StringType()), StructField("previous_instant", TimestampType())]
    )
    page = F.to_json(F.struct("object_id", "page"))
    placed = timed.withColumns({PAGE: page, BUCKET: F.pmod(F.xxhash64(page), F.lit(BUCKETS)).cast("int")})
    return placed.groupBy(BUCKET).transformWithStateInPandas(ReviewHistory(), schema, outputMode="Append", timeMode="None")


def judge_events(events: DataFrame) -> DataFrame:
    """Accepted and rejected events of a stream, with the codes of the broken rules.

    An event that arrives out of order is rejected, never silently reordered
    into the past.
    """
    broken = F.transform(violation_array(review_checks()), lambda v: v["code"])
    return with_history(events).withColumn("codes", broken).withColumn("accepted", F.size("codes") == 0)
