"""Order-dependent operators that survive hot keys.

A plain window over one key puts the whole key into one task. Here the rows are
split by ranges of (key, order) instead, so a key with a third of all rows is
spread over many segments. Within a segment an ordinary window runs; what a
segment needs from the ones before it travels in a carry table with at most one
row per segment.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

SEGMENT = "_segment"


@dataclass(frozen=True)
class Prior:
    """A column computed from the earlier rows of the same key.

    kind: ``lag`` value of the previous row, ``last`` last non-null value of the
    earlier rows, ``count`` number of earlier rows, ``sum`` sum of the value over
    the earlier rows (0 for the first).
    """

    name: str
    kind: str
    value: Column | None = None


def range_segments(df: DataFrame, keys: list[str], order: list[str], keep: Callable[[DataFrame], DataFrame] = checkpointed) -> DataFrame:
    """Split by ranges of (keys, order) and fix the split in the checkpoint folder, with ``keep``.

    The order columns must make rows unique within a key; then every key, also
    one with duplicates of its other columns, can be cut anywhere. The
    checkpoint keeps the split the same for every later stage, also after an
    executor is lost.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = df.repartitionByRange(parts, *keys, *order)
    return keep(split.withColumn(SEGMENT, F.spark_partition_id()))


def with_prior(df: DataFrame, keys: list[str], order: list[str], *priors: Prior) -> DataFrame:
    """Add columns that depend on the earlier rows of each key."""
    rows = df if SEGMENT in df.columns else range_segments(df, keys, order)
    inside = Window.partitionBy(SEGMENT, *keys).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)

    local, summary, carried = [], [], []
    across = Window.partitionBy(*keys).orderBy(SEGMENT)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    position = F.struct(*order)
    for prior in priors:
        column = f"_carry_{prior.name}"
        if prior.kind == "lag":
            boxed = F.struct(prior.value.alias("v"))
            local.append(F.lag(boxed).over(inside).alias(prior.name))
            summary.append(F.max_by(boxed, position).alias(column))
            carried.append(F.lag(column).over(across).alias(column))
        elif prior.kind == "last":
            local.append(F.last(prior.value, ignorenulls=True).over(before).alias(prior.name))
            known = F.when(prior.value.isNotNull(), position)
            summary.append(F.max_by(prior.value, known).alias(column))
            carried.append(F.last(column, ignorenulls=True).over(earlier).alias(column))
        elif prior.kind == "sum":
            local.append(F.coalesce(F.sum(prior.value).over(before), F.lit(0)).cast("bigint").alias(prior.name))
            summary.append(F.coalesce(F.sum(prior.value), F.lit(0)).cast("bigint").alias(column))
            carried.append(F.sum(column).over(earlier).alias(column))
        elif prior.kind == "count":
            local.append((F.row_number().over(inside) - 1).cast("bigint").alias(prior.name))
            summary.append(F.count(F.lit(1)).alias(column))
            carried.append(F.sum(column).over(earlier).alias(column))
        else:
            raise ValueError(f"unknown kind {prior.kind!r}")

    # Only the first key of a segment can continue an earlier segment, so the
    # carry table has at most one row per segment and is safe to broadcast.
    carry = (
        rows.groupBy(SEGMENT, *keys)
        .agg(*summary)
        .select(SEGMENT, *keys, F.row_number().over(across).alias("_nth"), *carried)
        .filter(F.col("_nth") > 1)
        .drop("_nth")
    )
    out = rows.select("*", *local).join(F.broadcast(carry), [SEGMENT, *keys], "left")
    for prior in priors:
        column = f"_carry_{prior.name}"
        if prior.kind in ("count", "sum"):
            merged = F.col(prior.name) + F.coalesce(F.col(column), F.lit(0))
        else:
            merged = F.coalesce(F.col(prior.name), F.col(column))
            if prior.kind == "lag":
                merged = merged["v"]
        out = out.withColumn(prior.name, merged)
    return out.drop(*[f"_carry_{p.name}" for p in priors])


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """1-based position of each row within its key."""
    out = with_prior(df, keys, order, Prior(name, "count"))
    return out.withColumn(name, F.col(name) + 1).drop(SEGMENT)


def in_order(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """1-based position of each row in the order of the whole table, without bringing it into one task."""
    return numbered(df.withColumn("_whole", F.lit(0)), ["_whole"], order, name).drop("_whole")


#: Bytes of a part of joined texts, about; a longer text is a part of its own.
PART_BYTES = 1 << 20


def ordered_concat(
    df: DataFrame,
    keys: list[str],
    ordinal: str,
    text: str,
    separator: str,
    part_bytes: int = PART_BYTES,
    out: str = "text",
) -> DataFrame:
    """Join texts in order, as numbered parts of a bounded number of bytes: (keys, part, rows, out).

    The bytes in front of a text within its key, separators included, divided by ``part_bytes`` give its part, so every object
    is the ordered sequence of its parts, whatever its size; part numbers ascend and may skip some after a long text.
    Joining the parts with the same separator gives the whole text. ``ordinal`` is unique within a key. Null texts
    count as rows and add nothing.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)) + len(separator.encode())
    placed = with_prior(df.select(*keys, ordinal, text), keys, [ordinal], Prior("_bytes", "sum", size))
    part = F.floor(F.col("_bytes") / part_bytes).cast("bigint")
    piece = F.struct(F.col(ordinal).alias("o"), F.col(text).alias("t"))
    return (
        placed.groupBy(*keys, part.alias("part"))
        .agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["t"]), separator).alias(out),
            F.count(F.lit(1)).alias("rows"),
        )
    )
