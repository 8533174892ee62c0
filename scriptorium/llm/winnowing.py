"""Document fingerprints by winnowing, and documents beside their successor.

The text is reduced to its code points in lower case (A-Z) without white space; hashes of all ``gram``-long runs
are rolled together by doubling, and every window of ``window`` hashes gives its smallest one, the rightmost
among equals. Two texts that share ``gram + window - 1`` reduced code points share a selected hash; a shared run
shorter than ``gram`` is never seen. Positions are those of the gram's first code point in the text as it came.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM, WINDOW = 12, 16
#: Id ranges per partition; several even out what hashing the ranges deals unevenly.
RANGES_PER_TASK = 4
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
#: White space that the reduction leaves out.
SPACES = np.array([9, 10, 11, 12, 13, 32, 133, 160], np.uint32)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def rolled(points: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of all runs of ``gram`` values, put together from runs of powers of two."""
    n = len(points) - gram + 1
    block, size = points.astype(np.uint64), 1
    total, done = np.zeros(n, np.uint64), 0
    while True:
        if gram & size:
            total = total * _power(size) + block[done : done + n]
            done += size
        if done == gram:
            break
        block, size = block[:-size] * _power(size) + block[size:], 2 * size
    total ^= total >> np.uint64(29)
    total *= MIX
    return total ^ (total >> np.uint64(32))


def selected(hashes: np.ndarray, window: int) -> np.ndarray:
    """Indices of each window's smallest hash, rightmost among equals; fewer hashes than a window are one window."""
    window = min(window, len(hashes))
    if not window:
        return np.zeros(0, np.int64)
    low, at, size = hashes, np.arange(len(hashes), dtype=np.int64), 1
    while size < window:
        step = min(size, window - size)
        second = low[step:] <= low[:-step]
        at = np.where(second, at[step:], at[:-step])
        low = np.minimum(low[step:], low[:-step])
        size += step
    return at[np.append(True, at[1:] != at[:-1])]


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a text. A text with fewer reduced code points than a gram has one hash of them all; with none, none."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kept = ~np.isin(points, SPACES) if len(points) < 64 else _kept(points)
    places = np.flatnonzero(kept)
    points = points[places]
    points = np.where((points >= 65) & (points <= 90), points + 32, points)
    if not len(points):
        return np.zeros(0, np.uint64), places
    hashes = rolled(points, min(gram, len(points)))
    at = selected(hashes, window)
    return hashes[at], places[at]


def _kept(points: np.ndarray) -> np.ndarray:
    low = points <= 160
    kept = np.ones(len(points), bool)
    kept[low] = ~_IS_SPACE[points[low]]
    return kept


_IS_SPACE = np.isin(np.arange(161), SPACES)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """32 hexadecimal digits over selected hashes and positions; equal texts have equal ones."""
    raw = hashes.astype("<u8").tobytes() + b"|" + positions.astype("<i8").tobytes()
    return hashlib.blake2b(raw, digest_size=16).hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of two sets of distinct hashes; two empty ones are alike."""
    both = len(a) + len(b)
    if not both:
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (both - shared)


def fingerprints(text: Column | str, gram: int = GRAM, window: int = WINDOW) -> Column:
    """array<struct<hash, position>> of selected hashes in text order; null counts as empty and has none."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[(int(h), int(p)) for h, p in zip(hs.view(np.int64), ps)] for hs, ps in (winnow(t or "", gram, window) for t in texts)])

    return F.pandas_udf(run, "array<struct<hash: bigint, position: bigint>>")(text)


def _position(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are not above the value, by binary search."""
    listed = F.array(*[F.lit(c).cast("long") for c in cuts])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = (acc["lo"] < acc["hi"]) & (F.get(listed, middle) <= value)
        return F.struct(
            F.when(below, middle + 1).otherwise(acc["lo"]).alias("lo"),
            F.when(below | (acc["lo"] == acc["hi"]), acc["hi"]).otherwise(middle).alias("hi"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(len(cuts).bit_length())), start, halve, lambda acc: acc["lo"])


def beside_next(docs: DataFrame, use: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str, parts: int | None = None) -> DataFrame:
    """Run ``use`` over (doc_id, text, next_text) in ascending order of (doc_id, text), nulls first; the last row's next is the first.

    Ids are cut into ranges at approximate quantiles. A range gets its rows, and the first rows of the range behind
    it as guests that only serve as a successor, so the order needs one shuffle of the texts and no global window.
    Only the cuts and each range's smallest id reach the driver: some numbers per partition. Rows stream through a task one by one.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = RANGES_PER_TASK * parts
    quantiles = F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)
    cuts = sorted(set(docs.agg(quantiles).first()[0] or []))
    range_of = F.when(F.col("doc_id").isNull(), 0).otherwise(_position(F.col("doc_id"), cuts)) if cuts else F.lit(0)
    found = docs.select(range_of.alias("r"), "doc_id").groupBy("r").agg(
        F.when(F.max(F.col("doc_id").isNull()), None).otherwise(F.min("doc_id")).alias("least")
    ).orderBy("r").collect()
    if not found:
        return spark.createDataFrame([], schema)
    least, before = [None] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    for i, row in enumerate(found):
        least[row["r"]], before[row["r"]] = row["least"], found[i - 1]["r"]
    own = F.element_at(F.array(*[F.lit(x).cast("long") for x in least]), range_of + 1)
    guest = F.when(F.col("doc_id").eqNullSafe(own), F.element_at(F.array(*map(F.lit, before)), range_of + 1))
    dealt = docs.select(
        F.explode(F.filter(F.array(
            F.struct(range_of.alias("r"), F.lit(False).alias("guest")), F.struct(guest.alias("r"), F.lit(True).alias("guest"))
        ), lambda s: s["r"].isNotNull())).alias("to"), "doc_id", "text",
    ).select("to.r", "to.guest", "doc_id", "text")
    # a partition's order: range, own rows before guests, id, text
    ordered = dealt.repartition(parts, "r").sortWithinPartitions("r", "guest", F.col("doc_id").asc_nulls_first(), "text")
    names = [p.split()[0] for p in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def triples() -> Iterator[tuple]:
            held = None
            for batch in batches:
                for r, is_guest, doc_id, text in zip(batch["r"], batch["guest"], batch["doc_id"], batch["text"]):
                    if held is not None and held[0] == r:
                        yield held[1], held[2], text
                    held = None if is_guest else (r, None if pd.isna(doc_id) else int(doc_id), text)

        rows: list[tuple] = []
        for row in use(triples()):
            rows.append(row)
            if len(rows) == 2000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)

    return ordered.mapInPandas(run, schema)


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many, or all, of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Per document row its fingerprint beside those of an edited text and of the next document.

    ``docs`` needs doc_id and text, other columns are ignored. Null texts count as empty. Rows with one id follow
    each other by text; a single row is its own successor. An empty table gives an empty result.
    Likeness is the shared part (Jaccard) of the distinct selected hashes, 1 for two texts without any.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_selected long"
    )

    def use(triples: Iterator[tuple]) -> Iterator[tuple]:
        last: tuple | None = None
        for doc_id, text, following in triples:
            own = last[1] if last is not None and last[0] is text else _print(text, gram, window)
            after = own if following == text else _print(following, gram, window)
            other = edited(text, following)
            changed = own if other == text else _print(other, gram, window)
            last = (following, after)
            yield (
                doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), own[0], changed[0],
                likeness(own[1], changed[1]), likeness(own[1], after[1]), own[2],
            )

    return beside_next(docs, use, schema)


def _print(text: str, gram: int, window: int) -> tuple[str, np.ndarray, int]:
    hashes, positions = winnow(text, gram, window)
    return digest(hashes, positions), np.unique(hashes), len(hashes)
