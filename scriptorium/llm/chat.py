"""Chat formatting after cumulative snapshots have collapsed.

Conversations are often logged again after every turn. Each turn gets the hash of the conversation up to it, a running
sum of position-dependent turn hashes; a conversation that ends in a hash which another one passes through is a prefix of
that one and goes by an anti-join. Of equal conversations the one with the smallest id stays.

Running sums are made in chunks of turns and carried over from chunk to chunk, so a very long conversation is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 256
TEMPLATE = ("<|", "|>\n", "\n<|end|>\n")


def positions(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, position, role, text): turns in the order of (turn, role, text), nulls first, counted from 1."""
    chunked = turns.where(F.col("conv_id").isNotNull()).select("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk"), "turn", "role", "text")
    inside = F.row_number().over(Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text"))
    before = _carried(chunked.groupBy("conv_id", "chunk").agg(F.count("*").alias("n")), "n", "long")
    placed = chunked.withColumn("inside", inside).join(before, _same_chunk())
    return placed.select("conv_id", "chunk", (F.col("inside") + F.col("n")).alias("position"), "role", "text")


def _same_chunk() -> Column:
    return (F.col("conv_id") == F.col("of_conv")) & F.col("chunk").eqNullSafe(F.col("of_chunk"))


def _carried(chunks: DataFrame, *columns: str) -> DataFrame:
    """(of_conv, of_chunk, ...): per chunk the sums of all earlier chunks of the conversation."""
    *names, kind = columns
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.select(F.col("conv_id").alias("of_conv"), F.col("chunk").alias("of_chunk"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast(kind).alias(c) for c in names])


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, position, h1, h2): the hash of each conversation up to each of its turns."""
    kind = "decimal(38,0)"
    content = ["position", F.coalesce("role", F.lit("")), F.col("role").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull()]
    each = positions(turns).select(
        "conv_id", "chunk", "position",
        F.xxhash64(*content).cast("decimal(20,0)").alias("t1"),
        F.xxhash64(F.lit("second"), *reversed(content)).cast("decimal(20,0)").alias("t2"),
    )
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    sums = _carried(each.groupBy("conv_id", "chunk").agg(F.sum("t1").alias("c1"), F.sum("t2").alias("c2")), "c1", "c2", kind)
    running = each.select("conv_id", "chunk", "position", *[F.sum(t).over(so_far).cast(kind).alias(t) for t in ("t1", "t2")])
    return running.join(sums, _same_chunk()).select(
        "conv_id", "position", (F.col("t1") + F.col("c1")).cast(kind).alias("h1"), (F.col("t2") + F.col("c2")).cast(kind).alias("h2")
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal): conversations that are no prefix of another one, one of each group of equal ones."""
    each = prefixes(turns)
    last = each.groupBy("conv_id").agg(F.max(F.struct("position", "h1", "h2")).alias("end")).select("conv_id", "end.*")
    ends = last.groupBy("position", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    sizes = last.select(F.col("conv_id").alias("of_conv"), F.col("position").alias("n_turns"))
    inner = each.join(sizes, (F.col("conv_id") == F.col("of_conv")) & (F.col("position") < F.col("n_turns")), "left_semi")
    passed = inner.select("position", "h1", "h2").distinct()
    kept = ends.join(passed, ["position", "h1", "h2"], "left_anti")
    return kept.select("conv_id", F.col("position").alias("n_turns"), "n_equal")


def rendered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, n_turns, n_equal, piece) of the maximal conversations; pieces in order make up the text."""
    before, between, after = TEMPLATE
    piece = F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(between), F.coalesce("text", F.lit("")), F.lit(after))
    return positions(turns).join(maximal(turns), "conv_id").select("conv_id", "position", "n_turns", "n_equal", piece.alias("piece"))


def rendered(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal, text): a row per maximal conversation.

    ``turns`` needs conv_id, turn, role and text; other columns are ignored. Turns without a conv_id belong to no
    conversation and are left out. Turns with equal numbers are ordered by role and text, null numbers come first; repeated
    rows are turns of their own. Null roles and texts are rendered empty but differ from empty ones in comparisons. An empty
    table gives an empty result. A rendered conversation is one row; where it may not fit one, use ``rendered_turns``.
    """
    pieces = F.array_sort(F.collect_list(F.struct("position", "piece")))
    found = rendered_turns(turns).groupBy("conv_id", "n_turns", "n_equal").agg(pieces.alias("p"))
    return found.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_equal", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text")
    )
