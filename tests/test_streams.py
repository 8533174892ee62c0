"""Incremental assessment: a repeated batch gives the same rows, changed objects come again, unchanged ones do not."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from scriptorium.bindings import bound
from scriptorium.functions import values
from scriptorium.operators.reviews import with_history as ordered_history
from scriptorium.queries.streams import run_to_end
from scriptorium.streaming import reviews
from scriptorium.streaming.assessment import assess_stream

SMALLEST = "/root/testdata/sf0.001"


def rows(spark, out):
    found = spark.read.parquet(out).select("batch", "object_id", "state_hash", "overall_status").collect()
    return sorted(tuple(r) for r in found)


def test_a_repeated_batch_gives_the_same_rows(spark, tmp_path):
    folder, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    first = bound(spark, SMALLEST, "pages_v")
    objects = first.select("object_id").distinct().count()
    first.coalesce(1).write.parquet(folder)
    pages = spark.readStream.schema(first.schema).parquet(folder)
    run = lambda: assess_stream(pages, out, checkpoint).awaitTermination()
    run()
    assert len(rows(spark, out)) == objects
    changed = first.withColumn("transcription", F.when(F.col("object_id") == "conv-1", "anders").otherwise(F.col("transcription")))
    changed.coalesce(1).write.mode("append").parquet(folder)
    run()
    after = rows(spark, out)
    assert [r[1] for r in after if r[0] == 1] == ["conv-1"] and len(after) == objects + 1
    for commit in Path(checkpoint, "commits").glob("*1*"):  # as if the run had ended before batch 1 was committed
        commit.unlink()
    run()
    assert rows(spark, out) == after


@pytest.mark.parametrize("name", ["str01_str03_review_stream", "str02_correction_stream", "str05_overtaken_proposals"])
def test_a_stream_reads_a_table_of_several_files(spark, tmp_path, name):
    for table in ("conversations", "events"):
        spark.read.parquet(f"{SMALLEST}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    found = queries()[name](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, queries()[name](spark, SMALLEST).collect()))


def test_pages_of_one_group_keep_their_own_state_over_micro_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reviews, "BUCKETS", 3)
    events = bound(spark, SMALLEST, "review_v").filter("seq < 390")
    for first in (0, 130, 260):
        events.filter(f"seq >= {first} AND seq < {first + 130}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    columns = ["object_id", "page", "seq", "previous_status", "previous_instant"]
    found = run_to_end(reviews.with_history(stream).select(*columns)).collect()
    table = ordered_history(events.withColumn("instant", values.aware_timestamp(F.col("event_time")))).select(*columns).collect()
    assert len(found) == 390 and sorted(map(str, found)) == sorted(map(str, table))
