"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the session comes from spark-submit; nothing in the library
    depends on the settings below beyond AQE, which Spark enables by default.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("scriptorium")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only on local masters."""
    declared = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if declared:
        if current is None:
            spark.sparkContext.setCheckpointDir(declared)
        return declared
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the reliable checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is made and run inside are removed when it ends; Spark else waits for a garbage collection of the driver."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A function that writes a table to the shared checkpoint folder and reads it from there, for large tables on the way to a result.

    Tables are compressed by column. The shuffle files behind a table go when it is written, the tables go at the end, but for
    those written with ``keep=True``.
    """
    made: list[str] = []

    def table(df: DataFrame, keep: bool = False) -> DataFrame:
        path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
        if not keep:
            made.append(path)
        with shuffles_removed(spark):
            # sizes are looked at from the first row on, as a row can be large
            df.write.option("compression", "zstd").option("parquet.page.size.row.check.min", "1").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield table
    finally:
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
