"""Centroid clustering with integer centroids, filtered by an n-simplex projection.

A few pivots span a simplex. From its distances to the pivots every vector becomes an apex: its coordinates in the space of the
pivots and its altitude over it. For two apexes the distance of the true vectors is at least the Euclidean distance of the apexes and
at most that distance with one altitude mirrored. Distances to the pivots are computed once and the apexes kept in a table; a round
compares apexes, and only centroids whose lower bound does not exceed the best upper bound are compared exactly, in integers.

Rounds send a partial sum per task and centroid; centroids, pivots and sums that reach the driver are k * dims numbers each,
whatever the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import as_lists, matrix

#: Pivots at most; they are the first centroids.
PIVOTS = 6
#: A pivot must stand over the others by this part of its distance at least, or it adds rounding errors and no coordinate.
LEAST_ALTITUDE = 0.05
#: Bounds give way by this part of the squared distances to the first pivot: far above what doubles lose.
SLACK = 1e-4


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


class Simplex:
    """The simplex of some pivots; degenerate ones are left out."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.used, self.lower, self.sides = [0], np.zeros((0, 0)), np.zeros(0)
        self.pivots = pivots[:1]
        for i in range(1, len(pivots)):
            apex = self.apexes(pivots[i : i + 1])[0]
            side = float(squared(pivots[i : i + 1], pivots[:1])[0, 0])
            if apex[-1] > LEAST_ALTITUDE * side**0.5:
                n = len(self.lower)
                grown = np.zeros((n + 1, n + 1))
                grown[:n, :n], grown[n] = self.lower, apex
                self.lower, self.sides = grown, np.append(self.sides, side)
                self.used.append(i)
                self.pivots = pivots[self.used]

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """From the distances to the pivots: coordinates among them, then the altitude."""
        far = squared(vectors, self.pivots).astype(np.float64)
        out = np.zeros((len(vectors), len(self.lower) + 1))
        for i, row in enumerate(self.lower):
            product = (far[:, 0] + self.sides[i] - far[:, i + 1]) / 2
            out[:, i] = (product - out[:, :i] @ row[:i]) / row[i]
        out[:, -1] = np.sqrt(np.maximum(far[:, 0] - (out[:, :-1] ** 2).sum(axis=1), 0))
        return out


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of two sets of apexes."""
    base = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    slack = SLACK * ((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :]) + 1
    return base + (a[:, None, -1] - b[None, :, -1]) ** 2 - slack, base + (a[:, None, -1] + b[None, :, -1]) ** 2 + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each vector; of equally near ones the smaller number."""
    low, high = bounds(apexes, tops)
    row, column = np.nonzero(low <= high.min(axis=1, keepdims=True))
    exact = np.full(low.shape, np.iinfo(np.int64).max)
    exact[row, column] = ((vectors[row] - centroids[column]) ** 2).sum(axis=1)
    best = exact.argmin(axis=1)
    return best, exact[np.arange(len(best)), best]


def with_apexes(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``points`` (id, x) with the apex of every vector."""
    dims = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        simplex = Simplex(pivots)
        for batch in batches:
            found = simplex.apexes(matrix(batch.column("x"), dims))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), as_lists(found, pa.float64())], ["id", "x", "apex"])

    return points.select("id", "x").mapInArrow(run, f"id {dict(points.dtypes)['id']}, x array<long>, apex array<double>")


def _assigned(pivots: np.ndarray, centroids: np.ndarray) -> Callable:
    dims = pivots.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        tops = Simplex(pivots).apexes(centroids)
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            yield batch, x, *nearest(x, matrix(batch.column("apex"), tops.shape[1], np.float64), centroids, tops)

    return assign


def _moved(points: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floor of the mean; a centroid without vectors stays."""
    k, dims = centroids.shape
    assign = _assigned(pivots, centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x, best, _ in assign(batches):
            count += np.bincount(best, minlength=k)
            order = np.argsort(best, kind="stable")
            ends = np.searchsorted(best[order], np.arange(k + 1))
            for c in range(k):
                total[c] += x[order[ends[c] : ends[c + 1]]].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(count), as_lists(total, pa.int64())], ["cluster", "n", "total"])

    part = points.mapInArrow(sums, "cluster int, n long, total array<long>")
    each = part.select("cluster", "n", F.posexplode("total").alias("at", "total"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(28,0)"))
    found = each.groupBy("cluster", "at").agg(exact("n").alias("n"), exact("total").alias("total")).collect()
    moved = centroids.copy()
    for r in found:
        if r["n"]:
            moved[r["cluster"], r["at"]] = int(r["total"]) // int(r["n"])
    return moved


def clustered(points: DataFrame, order: Column, k: int = 8, rounds: int = 10, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """(assignments, centroids): id, cluster and squared distance of every row of ``points`` (id, x array<long>), and the final centroids.

    The first centroids are the ``k`` rows that come first in ``order`` (nulls last, ties by vector); with fewer rows there are as many
    centroids as rows. ``x`` holds no nulls and has one length. Repeated rows and equal vectors are rows like others; equally
    near centroids give the smaller number; a null id is kept. An empty table gives an empty result. Other columns
    are ignored.
    """
    rows = points.select("id", "x", order.alias("o"))
    first = np.array([r["x"] for r in rows.orderBy(F.col("o").asc_nulls_last(), "x").limit(k).collect()], np.int64)
    kind = dict(points.dtypes)["id"]
    if not len(first):
        return points.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), first
    base, centroids = first[:pivots], first
    kept = written(with_apexes(points, base), "apexes")
    for _ in range(rounds):
        centroids = _moved(kept, base, centroids)
    assign = _assigned(base, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, best, distance in assign(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    return written(kept.mapInArrow(run, f"id {kind}, cluster int, distance long"), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assignments with the summed distance of the cluster and of all, and the digest of the cluster's centroid (a row per centroid is sent)."""
    summed = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).cast("long").alias("s")).collect()
    own = {r["cluster"]: r["s"] for r in summed}
    rows = [
        (c, own.get(c, 0), sum(own.values()), hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest())
        for c, row in enumerate(centroids)
    ]
    facts = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster")
