"""Hard negatives by segment summary filtering.

Every vector is cut into segments, and the mean and deviation of each segment are stored. In a segment of w components the inner
product of two vectors is w times the product of their means plus or minus w times the product of their deviations at most, so sums over
segments bound a score. Pairs whose bounds miss what is wanted go; the others are bounded again over segments of half the
length, and only what passes all levels is scored exactly, in integers.

Anchors are a stated query set. They are dealt in groups of some two thousand, and all rows in slots of bounded size; a group meets
every slot once. A task keeps the best rows of each anchor, and what the tasks found is merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import as_lists, matrix

#: Numbers of segments, coarse to fine.
LEVELS = (4, 8, 16)
#: Anchors of a group and rows of a slot, about; a task holds one of each.
GROUP, SLOT = 2_000, 50_000
#: Rows of a slot at least, where there are tasks for more slots: each slot hands on its own best rows.
LEAST_SLOT = 5_000
#: Rows of a slot that are bounded at a time.
CHUNK = 2_000
#: Pairs that are refined and scored at a time.
PAIRS = 1 << 16
NO_SCORE = np.iinfo(np.int64).min
SUMMARY = "summary"


def summaries(x: np.ndarray, levels: tuple[int, ...] = LEVELS) -> np.ndarray:
    """Per vector the means and then the deviations of the segments of each level."""
    parts = []
    for n in levels:
        cut = x.reshape(len(x), n, -1).astype(np.float64)
        parts += [cut.mean(axis=2), cut.std(axis=2)]
    return np.concatenate(parts, axis=1)


class Side:
    """Vectors with their stored summaries."""

    def __init__(self, x: np.ndarray, summary: np.ndarray, levels: tuple[int, ...] = LEVELS) -> None:
        self.x, self.means, self.deviations, at = x, [], [], 0
        for n in levels:  # weighted, so that products need no factor
            weight = math.sqrt(x.shape[1] / n)
            self.means.append(summary[:, at : at + n] * weight)
            self.deviations.append(summary[:, at + n : at + 2 * n] * weight)
            at += 2 * n


def passing(a: Side, b: Side, rows: slice, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the allowed pairs of ``a`` and b[rows] whose score may lie between least[i] and most[i]."""
    mean, spread = a.means[0] @ b.means[0][rows].T, a.deviations[0] @ b.deviations[0][rows].T
    slack = 1 + 1e-9 * (np.abs(mean) + spread)  # above what doubles lose
    i, j = np.nonzero(allowed & (mean + spread + slack >= least[:, None]) & (mean - spread - slack <= most[:, None]))
    j = j + rows.start
    found = [_refined(a, b, i[p : p + PAIRS], j[p : p + PAIRS], least, most) for p in range(0, len(i), PAIRS)]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (i, j, np.zeros(0, np.int64))


def _refined(a: Side, b: Side, i: np.ndarray, j: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What is left of some pairs after the finer segments, with exact scores."""
    for level in range(1, len(a.means)):
        mean = np.einsum("ij,ij->i", a.means[level][i], b.means[level][j])
        spread = np.einsum("ij,ij->i", a.deviations[level][i], b.deviations[level][j])
        slack = 1 + 1e-9 * (np.abs(mean) + spread)
        keep = (mean + spread + slack >= least[i]) & (mean - spread - slack <= most[i])
        i, j = i[keep], j[keep]
    return i, j, np.einsum("ij,ij->i", a.x[i], b.x[j])


def first_of(key: np.ndarray, score: np.ndarray, vec: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` entries of each key: highest score, then smallest id, then smallest row."""
    order = np.lexsort((row, vec, -score, key))
    starts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else np.zeros(0, np.int64)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < k]


class Best:
    """The first ``k`` entries of each of ``n`` keys so far."""

    def __init__(self, n: int, k: int) -> None:
        self.n, self.k = n, k
        self.key, self.score, self.vec, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, key: np.ndarray, score: np.ndarray, vec: np.ndarray, row: np.ndarray) -> None:
        joined = [np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.vec, vec), (self.row, row))]
        kept = first_of(*joined, self.k)
        self.key, self.score, self.vec, self.row = (x[kept] for x in joined)

    def floor(self) -> np.ndarray:
        """Per key the score that a further entry must reach; minus infinity while there is room."""
        full = np.bincount(self.key, minlength=self.n) >= self.k
        least = np.full(self.n, np.inf)
        np.minimum.at(least, self.key, self.score.astype(np.float64))
        return np.where(full, least, -np.inf)


def _side(table: pa.Table, dims: int) -> Side:
    width = 2 * sum(LEVELS)
    return Side(matrix(table.column("x"), dims), matrix(table.column(SUMMARY), width, np.float64))


def _longs(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.asarray(table.column(n)).astype(np.int64) for n in names]


def _nearest_of_label(dims: int, k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        a, b = _side(anchors, dims), _side(rows, dims)
        (own, own_label), (row, vec, label) = _longs(anchors, "row", "label"), _longs(rows, "row", "vec_id", "label")
        best = Best(len(own), k)
        for at in range(0, len(row), CHUNK):
            part = slice(at, min(at + CHUNK, len(row)))
            allowed = (own_label[:, None] == label[part]) & (own[:, None] != row[part])
            i, j, score = passing(a, b, part, allowed, best.floor(), np.full(len(own), np.inf))
            best.add(i, score, vec[j], row[j])
        return pa.table({"row": own[best.key], "score": best.score, "other_id": best.vec, "other_row": best.row})

    return run


def _negatives(dims: int, k: int, low: int, high: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        a, b = _side(anchors, dims), _side(rows, dims)
        (own, own_label), (row, vec, label) = _longs(anchors, "row", "label"), _longs(rows, "row", "vec_id", "label")
        lists = anchors.column("positives").combine_chunks()
        width = max(1, max(lists.value_lengths().to_pylist(), default=1))
        wanted = np.full((len(own), width), NO_SCORE)
        holder = np.repeat(np.arange(len(own)), lists.value_lengths().to_numpy())
        place = np.arange(len(holder)) - np.repeat(lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(), lists.value_lengths().to_numpy())
        wanted[holder, place] = np.asarray(lists.flatten().field("score"))
        possible = wanted >= 0  # a negative score leaves no room between its parts
        least = np.where(possible, wanted * (low / 100), np.inf)
        most = np.where(possible, wanted * (high / 100), -np.inf).max(axis=1)
        best = Best(len(own) * width, k)
        for at in range(0, len(row), CHUNK):
            part = slice(at, min(at + CHUNK, len(row)))
            floor = np.maximum(best.floor().reshape(-1, width), least).min(axis=1)
            i, j, score = passing(a, b, part, own_label[:, None] != label[part], floor, most)
            aim = wanted[i]
            pair, p = np.nonzero((aim >= 0) & (low * aim <= 100 * score[:, None]) & (100 * score[:, None] <= high * aim))
            best.add(i[pair] * width + p, score[pair], vec[j[pair]], row[j[pair]])
        return pa.table({"row": own[best.key // width], "place": best.key % width, "score": best.score, "other_id": best.vec, "other_row": best.row})

    return run


def _with_summaries(rows: DataFrame, dims: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = summaries(matrix(batch.column("x"), dims))
            yield pa.RecordBatch.from_arrays([*batch.columns, as_lists(found, pa.float64())], [*batch.schema.names, SUMMARY])

    return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + f", {SUMMARY} array<double>")


def _met(anchors: DataFrame, rows: DataFrame, groups: int, slots: int, run, schema: str) -> DataFrame:
    """``run`` over every group of anchors and every slot of rows."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # both sides come from one table: columns of its own
    left = own.withColumn("slot", every(slots)).groupBy("grp", "slot")
    right = rows.withColumn("grp", every(groups)).groupBy("grp", "slot")
    return left.cogroup(right).applyInArrow(lambda a, b: run(a, b) if len(a) and len(b) else _none(schema), schema)


def _none(schema: str) -> pa.Table:
    return pa.table({part.split()[0]: pa.array([], pa.int64()) for part in schema.split(", ")})


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id", "other_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(
    rows: DataFrame, anchor: Column, dims: int, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, group: int = GROUP, slot: int = SLOT
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``rows`` (vec_id, label, x array<long>).

    Scores are inner products. ``anchor`` picks the anchors. The positives of an anchor are its first other rows of the same label;
    for each, the first rows of other labels follow whose score is ``low`` to ``high`` percent of the positive's. Order: highest score, then
    smallest id, then (for different rows of one id) an order fixed within the run. Equal rows count once; rows with a null id, label
    or vector take no part. An anchor without positives, or a positive without negatives, gives no row; an empty table gives
    an empty result. Other columns are ignored.
    """
    spark = rows.sparkSession
    used = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "x")
    used = used.dropDuplicates(["vec_id", "label", "x"])
    numbered = used.select(F.monotonically_increasing_id().alias("row"), "*", F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    # numbers and slots hold once they are written
    kept = written(_with_summaries(numbered, dims), "vectors")
    n, chosen = kept.agg(F.count("*"), F.count_if("is_anchor")).first()
    groups = max(1, math.ceil(chosen / group))
    tasks = math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / groups)
    slots = max(1, math.ceil(n / slot), min(tasks, math.ceil(n / LEAST_SLOT)))
    slotted = kept.withColumn("slot", F.pmod(F.col("row") + F.shiftright("row", 33), F.lit(slots)).cast("int")).drop("is_anchor")
    asked = kept.where("is_anchor").drop("is_anchor").withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
    pairs = "row long, score long, other_id long, other_row long"
    near = _ranked(_met(asked, slotted, groups, slots, _nearest_of_label(dims, positives), pairs), ["row"], positives)
    own = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "other_id"))).alias("positives"))
    own = written(own, "positives")
    asked = asked.join(own, "row")
    numbers = asked.select("row", "vec_id", F.posexplode("positives").alias("place", "p"))
    asked = asked.withColumn("positives", F.transform("positives", lambda p: F.struct(p["score"].alias("score"))))
    found = _met(asked, slotted, groups, slots, _negatives(dims, negatives, low, high), "row long, place long, score long, other_id long, other_row long")
    best = _ranked(found, ["row", "place"], negatives)
    joined = best.join(numbers.withColumn("place", F.col("place").cast("long")), ["row", "place"])
    return joined.select(
        F.col("vec_id").alias("anchor_id"),
        F.col("p.other_id").alias("positive_id"),
        "rank",
        F.col("other_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
