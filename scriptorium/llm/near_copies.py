"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Every text has a SimHash fingerprint over its shingles. Two such texts differ in ten of 64 bits on average, far more than shards cut
from the fingerprint itself can bridge, so shards are cut from the shingles: texts of one shard agree in one of BANDS groups of
ROWS min-hashes (two texts at a similarity of 0.8 share none in two of ten thousand cases). In a shard the fingerprints form a BK-tree.
Texts come in the order of their ids; each asks the tree for fingerprints within RADIUS, following only the edges that can lead there,
and is verified against what it finds on the sets of shingles, exactly. If a near copy is found the text goes, else it joins the tree.

So a group of many copies costs one verification a text. A shard with more than LARGEST texts is dealt in parts of that size first; what
stays in its parts then meets in one tree, or, if it is too much for one task, in trees of every two parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch
from .simhash import BITS, Tree, bit_counts, shingle_hashes, signed

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
#: Bands that are settled first: nine of ten near copies go by them, and with them most rows of the other bands.
FIRST_BANDS = 4
#: Bits in which near copies can differ: at a similarity of 0.8 10 on average, with a deviation of 3.
RADIUS = 20
#: Texts of a shard in one task.
LARGEST = 1_000
CHUNK = 1 << 13
_rng = np.random.default_rng(42)
#: Odd factors and offsets of the min-hashes, one of each for every row of every band.
FACTORS = _rng.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)
ORDER = ["none", "id", "text_hash"]


def shingles(text: str | None) -> np.ndarray:
    """The different hashes of a text's shingles, sorted."""
    return np.unique(np.array(shingle_hashes(text or "", WIDTH), np.uint64))


def is_near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity is 0.8 at least; two texts without words are equal."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * common >= 4 * (len(a) + len(b) - common)


def fingerprint(own: np.ndarray) -> int:
    """The SimHash of a set of shingles."""
    return int(np.packbits(2 * bit_counts(own) > len(own), bitorder="little").view("<u8")[0])


def bands(own: np.ndarray) -> list[int]:
    """A key for each band, which holds the band's number; texts without words have keys of their own kind."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), CHUNK):
        mixed = own[at : at + CHUNK] * FACTORS + OFFSETS
        mixed ^= mixed >> np.uint64(32)
        np.minimum(least, (mixed * np.uint64(0x9E3779B97F4A7C15)).min(axis=1), out=least)
    return [signed(xxhash.xxh64_intdigest(row.tobytes(), i)) for i, row in enumerate(least.reshape(BANDS, ROWS))]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[bytes, tuple[int, list[int]]] = {}
        digests = batch.column("digest").to_pylist()
        for key, text in zip(digests, batch.column("text")):
            if key not in known:
                own = shingles(text.as_py())
                known[key] = signed(fingerprint(own)), bands(own)
        columns = [batch.column(c) for c in ("digest", *ORDER)]
        columns += [pa.array([known[k][0] for k in digests], pa.int64()), pa.array([known[k][1] for k in digests], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["digest", *ORDER, "fp", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [shingles(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(own, pa.binary())], ["digest", "shingles"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and order to the digests that have a near copy in front of them in their shard."""
    shard, tree, kept = None, Tree(), []
    mask = (1 << BITS) - 1
    for batch in batches:
        gone = []
        for key, digest, fp, packed in zip(*(batch.column(c) for c in ("shard", "digest", "fp", "shingles"))):
            if key.as_py() != shard:
                shard, tree, kept = key.as_py(), Tree(), []
            value, own = fp.as_py() & mask, np.frombuffer(packed.as_py(), np.uint64)
            near = sorted(tree.near(value, RADIUS), key=lambda i: (tree.values[i] ^ value).bit_count())
            if any(is_near(kept[i], own) for i in near):
                gone.append(digest.as_py())
            else:
                tree.add(value)
                kept.append(own)
        yield pa.RecordBatch.from_arrays([pa.array(gone, pa.binary())], ["digest"])


def _settled(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(digest) of ``rows`` (shard, order, digest, fp) that go; a shard is one task."""
    whole = rows.join(sets, "digest").select("shard", *ORDER, "digest", "fp", "shingles")
    return whole.repartition("shard").sortWithinPartitions("shard", *ORDER).mapInArrow(_settle, "digest binary")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of shards that hold two rows at least, with their number."""
    return rows.join(rows.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "shard")


def _parts(n: Column, largest: int) -> Column:
    return F.ceil(n / largest).cast("int")


def _gone(rows: DataFrame, sets: DataFrame, largest: int, table) -> list[DataFrame]:
    """Tables (digest) of the texts that go by the shards of ``rows``."""
    shared = table(_shared(rows), "shared")
    part = F.pmod(F.xxhash64("digest"), _parts(F.col("n"), largest))
    dealt = shared.withColumn("shard", F.when(F.col("n") > largest, F.xxhash64("shard", part)).otherwise(F.col("shard")))
    found = [table(_settled(dealt, sets), "gone")]
    hot = shared.where(F.col("n") > largest).drop("n")
    if hot.isEmpty():
        return found
    left = table(_shared(hot.join(found[0], "digest", "left_anti")), "left")
    found.append(table(_settled(left.where(F.col("n") <= largest), sets), "gone"))
    parts = _parts(F.col("n"), largest)
    others = F.filter(F.sequence(F.lit(0), parts - 1), lambda o: o != F.col("part"))
    # every two parts of what is left meet once
    met = left.where(F.col("n") > largest).withColumn("part", F.pmod(F.xxhash64("digest"), parts)).withColumn("other", F.explode(others))
    met = met.withColumn("shard", F.xxhash64("shard", F.least("part", "other"), F.greatest("part", "other")))
    found.append(table(_settled(met, sets), "gone"))
    return found


def _digest() -> Column:
    """What equal texts have in common; null and empty texts are told apart, as their rows are."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("n"))))


def row_key() -> list[Column]:
    """What orders documents: ids, null ones last, then the text's hash. No field is null, so keys can be joined."""
    return [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.xxhash64("text").alias("text_hash")]


def staying(docs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """The keys (none, id, text_hash) of the documents that stay; all other tables made on the way are removed again."""
    keyed = docs.select(_digest().alias("digest"), *row_key(), "text")
    with scratch(docs.sparkSession) as table:
        made = keyed.mapInArrow(_features, "digest binary, none boolean, id long, text_hash long, fp long, bands array<long>")
        first = F.min(F.struct(*ORDER))
        merged = made.groupBy("digest").agg(first.alias("k"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
        texts = table(merged.select("digest", "k.*", "fp", "bands"), "features")
        banded = lambda df, a, b: df.select(F.explode(F.slice("bands", a + 1, b - a)).alias("shard"), *ORDER, "digest", "fp")
        asked = _shared(banded(texts, 0, BANDS)).select("digest").distinct()
        once = keyed.select("digest", "text").join(asked, "digest").groupBy("digest").agg(F.first("text").alias("text"))
        sets = table(once.mapInArrow(_sets, "digest binary, shingles binary"), "shingles")
        for a, b in ((0, FIRST_BANDS), (FIRST_BANDS, BANDS)):
            for gone in _gone(banded(texts, a, b), sets, largest, table):
                texts = texts.join(gone.distinct(), "digest", "left_anti")
            texts = table(texts, "features")
        return table(texts.select(*ORDER), "staying", keep=True)


def without_near_copies(docs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """``docs`` (doc_id, text and other columns) with one row of each group of near copies: the smallest id, then text hash.

    No two rows that stay are near copies of which a shard and a tree know, and a row goes only if a smaller row is its verified near copy.
    Identical rows count once, null ids come last, and texts without words (null, empty, blank) are copies of each other. Very long
    texts are compared whole. An empty table gives an empty result; all columns are kept.
    """
    names = docs.columns
    rows = docs.select(*row_key(), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    copies = rows.join(staying(docs, largest), ORDER).groupBy(*ORDER).agg(F.first("row").alias("row"))
    return copies.select("row.*")
