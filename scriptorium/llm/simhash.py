"""SimHash near-duplicates: 64-bit fingerprints linked by BK-trees over shards of bounded size.

Two fingerprints that differ in two bits at most agree on six of their eight bytes at least, so they meet in one of
the 28 shards "all bytes but these two". A shard varies in 16 bits only: it can hold 65,536 different fingerprints
and no more, whatever the corpus. Equal fingerprints are one node, so a group of copies is one row here.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import run_starts, written
from .components import components

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
#: Masks of what a shard has in common, for a radius of two: all bytes but a pair.
SHARD_MASKS = [((1 << BITS) - 1) & ~(0xFF << 8 * i) & ~(0xFF << 8 * j) for i, j in combinations(range(8), 2)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shingle_hashes(text: str, width: int = SHINGLE) -> list[int]:
    """XXH64 of every run of ``width`` words joined by a space; one of the whole text if it has fewer words."""
    words = text.encode().lower().split()  # bytes: lower-cases A-Z alone, splits at \x20 and \x09-\x0D
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [digest(joined[s:e], SEED) for s, e in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist())]


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each bit (lowest first) is set."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.ascontiguousarray(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """A bit is set if it is set in more than half of the shingle hashes; no words: zero."""
    hashes = np.array(shingle_hashes(text or "", width), np.uint64)
    bits = 2 * bit_counts(hashes) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([signed(fingerprint(t)) for t in texts], dtype="int64")


def fingerprints(text: Column | str) -> Column:
    """The fingerprint as a signed 64-bit number."""
    return F.pandas_udf(_fingerprints, "long")(text)


class Tree:
    """A BK-tree: a node's children are keyed by their Hamming distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new, node = len(self.values) - 1, 0
        while new:
            d = (self.values[node] ^ value).bit_count()
            if d not in self.children[node]:
                self.children[node][d] = new
                return
            node = self.children[node][d]

    def near(self, value: int, radius: int = RADIUS) -> list[int]:
        """Indices of the values within ``radius``; only edges whose key can lead there are followed."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            below = self.children[node]
            if below:
                open_nodes += [below[k] for k in range(d - radius, d + radius + 1) if k in below]
        return found


def shard_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that join what is connected within one shard: each value to its group's first one."""
    tree, parent = Tree(), list(range(len(values)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values):
        for j in tree.near(value, radius):
            a, b = top(i), top(j)
            parent[max(a, b)] = min(a, b)
        tree.add(value)
    return [(values[i], values[top(i)]) for i in range(len(values)) if top(i) != i]


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (shard, key, fp) rows to links; a shard that goes on in the next batch is held until it ends."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        yield _links_of(batch, last=False)
        shard, key = batch["shard"].to_numpy(), batch["key"].to_numpy()
        starts = run_starts((shard[1:] != shard[:-1]) | (key[1:] != key[:-1])) if len(batch) else [0]
        rest = batch.iloc[starts[-1] :]
    if rest is not None:
        yield _links_of(rest, last=True)


def _links_of(batch: pd.DataFrame, last: bool) -> pd.DataFrame:
    out: list[tuple[int, int]] = []
    if len(batch):
        shard, key, fp = (batch[c].to_numpy() for c in ("shard", "key", "fp"))
        starts = run_starts((shard[1:] != shard[:-1]) | (key[1:] != key[:-1]))
        ends = np.append(starts[1:], len(batch))
        for s, e in zip(starts, ends):
            if e - s > 1 and (last or e < len(batch)):
                out += shard_links([int(x) & ((1 << 64) - 1) for x in fp[s:e]])
    return pd.DataFrame({"a": [signed(a) for a, _ in out], "b": [signed(b) for _, b in out]}, dtype="int64")


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) over distinct fingerprints ``fp`` within two bits: enough links to join everything that is connected."""
    keys = F.array(*[F.struct(F.lit(i).alias("shard"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(SHARD_MASKS)])
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sharded = nodes.select("fp", F.explode(keys).alias("k")).select("k.shard", "k.key", "fp")
    dealt = sharded.repartition(parts, "shard", "key").sortWithinPartitions("shard", "key", "fp")
    return dealt.mapInPandas(_linked, "a long, b long")


def grouped(prints: DataFrame) -> DataFrame:
    """(fp, component_id) for (doc_id, fp) rows: the smallest doc_id of each component of fingerprints."""
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document row; ``docs`` needs doc_id and text, other columns are ignored.

    Null, empty and blank texts have the fingerprint zero, which links like any other. Repeated rows share
    their fingerprint and component. ``component_id`` is null only if every id of a component is null. An
    empty table gives an empty result.
    """
    prints = written(docs.select("doc_id", fingerprints("text").alias("fp")), "prints")
    return prints.join(grouped(prints), "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document row of each component: the one with the smallest id, among rows of that id the smallest text hash.

    All columns are returned. Identical rows count once; null ids come last in a component.
    """
    prints = written(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprints("text").alias("fp")), "prints")
    by_print = grouped_rows(prints)
    kept = by_print.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k")
    ).select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash")).distinct()
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    joined = row.join(kept, row["row.doc_id"].eqNullSafe(kept["kept_id"]) & F.xxhash64("row.text").eqNullSafe(kept["kept_hash"]))
    first = F.row_number().over(Window.partitionBy("kept_id", "kept_hash").orderBy(F.lit(1)))
    return joined.withColumn("copy", first).where("copy = 1").select("row.*")


def grouped_rows(prints: DataFrame) -> DataFrame:
    """(component, doc_id, text_hash): component is the smallest fingerprint of the component."""
    nodes = written(prints.select("fp").distinct(), "fingerprints")
    roots = components(links(nodes))
    joined = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return joined.select(F.coalesce("root", "fp").alias("component"), "doc_id", "text_hash")

