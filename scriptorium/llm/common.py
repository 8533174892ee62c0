"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Texts of one Arrow batch are handled in pieces of about this many characters, so memory follows this and not the batch.
PIECE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone; ``lower`` does the same for texts that are all ASCII and is quicker."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def bound(value: Column, use) -> Column:
    """``use(variable)`` with ``value`` computed once, whatever the optimizer does with the expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: lineage ends there and lost executors do not matter."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``written`` for tables that are only needed on the way: they are removed at the end, but for those written with ``keep=True``."""
    made: list[str] = []

    def table(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        if not keep:
            made.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield table
    finally:
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pieces(texts: list, size: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` that hold about ``size`` characters each (one text at least)."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > size:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def run_starts(changed: np.ndarray) -> np.ndarray:
    """Indices at which a run begins, for flags between neighbours."""
    return np.concatenate([[0], np.flatnonzero(changed) + 1])


def sampled_by_hash(rows: DataFrame, label: str, sizes: dict, per_label: dict | int, *keys: str) -> DataFrame:
    """Rows of each label whose hash of ``keys`` falls in a share that leaves about 1.5 times ``per_label`` of its ``sizes``."""
    steps = 1 << 20
    share = F.lit(0)
    for value, n in sizes.items():
        wanted = per_label if isinstance(per_label, int) else per_label[value]
        share = F.when(F.col(label) == value, int(min(1.0, 1.5 * wanted / max(n, 1)) * steps) + 1).otherwise(share)
    return rows.where(F.pmod(F.xxhash64(*keys), F.lit(steps)) < share)


def passage(text: Column, chars: int) -> Column:
    """A passage of at most ``chars`` characters that begins at a place given by the text's hash."""
    spare = F.greatest(F.length(text) - chars // 2, F.lit(1))
    return F.substring(text, F.pmod(F.shiftright(F.xxhash64(text), 20), spare).cast("int") + 1, F.lit(chars))
