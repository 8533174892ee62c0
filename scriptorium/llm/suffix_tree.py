"""Language-model scores from a probabilistic suffix tree.

The tree reads bytes: a text is its words in lower case (A-Z), each followed by a space, and a line end. States are contexts
of up to five bytes. A context is retained if it makes up a given part of all training symbols and if the
next-symbol distribution diverges from that of its suffix: count times Kullback-Leibler divergence has to pass a multiple
of log N. Next symbols are smoothed towards the longest retained suffix with the number of different next symbols as its
weight (Witten-Bell), down to a root over all bytes, so every state is a distribution. The longest retained suffix of
what came before scores each symbol; a text's score is the sum, a proper distribution over all texts.

Counting covers every training document: tasks send counts of words and of six-byte runs, combined before the shuffle.
The part a context must make up bounds the tree (``1 / LEAST_PART`` states a depth), whatever the corpus, and so do the frequent
words that are sent to tasks; all other words meet their counts in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_remainder, pieces, written

DEPTH = 5
#: Part of all training symbols that a retained context makes up at least, and the divergence it needs in units of log N.
LEAST_PART, CUTOFF = 2e-6, 0.25
#: Words that make up at least this part of all training tokens are sent to every task.
FREQUENT_PART = 2e-6
END = "\n"
CHUNK = 1_000_000
HELD_WORDS, HELD_GRAMS = 300_000, 4_000_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: lower-cases A-Z alone, splits at \x20 and \x09-\x0D


def spelled(words: list[bytes]) -> bytes:
    """The bytes of a text's tokens: each word and a space, then the end."""
    return b" ".join([*words, b"\n"])


def grams_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Runs of DEPTH + 1 bytes ending at each symbol of the texts, about CHUNK at a time; longer texts go on in the next piece."""
    parts: list[bytes] = []
    held = 0
    for text in texts:
        data = b"\n" * DEPTH + text
        for at in range(DEPTH, len(data), CHUNK):
            parts.append(data[at - DEPTH : at + CHUNK])
            held += len(parts[-1])
            if held >= CHUNK:
                yield _grams(parts)
                parts, held = [], 0
    if parts:
        yield _grams(parts)


def _grams(parts: list[bytes]) -> np.ndarray:
    symbols = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    grams = symbols[DEPTH:].copy()
    for j in range(1, DEPTH + 1):
        grams |= symbols[DEPTH - j : len(symbols) - j] << (8 * j)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    keep = np.ones(len(symbols), bool)
    keep[((np.cumsum(sizes) - sizes)[:, None] + np.arange(DEPTH)).ravel()] = False
    return grams[keep[DEPTH:]]


def counted(docs: DataFrame) -> DataFrame:
    """(word, gram, n) over all ``docs``: counts of words (gram -1; END once a text) and of byte runs (word empty)."""

    def frame(words: dict[bytes, int], grams: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
        own = pd.DataFrame({"word": [w.decode() for w in words], "gram": -1, "n": list(words.values())})
        return pd.concat([own, pd.DataFrame({"word": "", "gram": grams[0], "n": grams[1]})], ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter[bytes] = Counter()
        grams = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            joined = []
            for text in batch["text"]:
                own = words_of(text)
                words.update(own)
                words[END.encode()] += 1
                joined.append(spelled(own))
            for found in grams_of(joined):
                grams = _added(grams, np.unique(found, return_counts=True))
            if len(words) > HELD_WORDS or len(grams[0]) > HELD_GRAMS:
                yield frame(words, grams)
                words.clear()
                grams = (grams[0][:0], grams[1][:0])
        yield frame(words, grams)

    parts = docs.select("text").mapInPandas(run, "word string, gram long, n long")
    return parts.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def _added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, place[: len(a[0])], a[1])
    np.add.at(sums, place[len(a[0]) :], b[1])
    return keys, sums


def _mask(symbols: int) -> int:
    return (1 << 8 * symbols) - 1


def retained(grams: DataFrame) -> DataFrame:
    """(depth, gram, n): next-symbol counts of all retained contexts; the lowest ``depth + 1`` bytes of a gram are context and symbol."""
    level = {d: grams.groupBy(F.col("gram").bitwiseAND(_mask(d + 1)).alias("gram")).agg(F.sum("n").alias("n")) for d in range(DEPTH + 1)}
    symbols = level[0].agg(F.sum("n")).first()[0] or 1
    total = F.sum("n").over(Window.partitionBy(F.shiftright("gram", 8)))
    shares = {d: level[d].withColumn("total", total) for d in level}
    out = level[0].select(F.lit(0).alias("depth"), "gram", "n")
    for d in range(1, DEPTH + 1):
        frequent = shares[d].where(F.col("total") >= LEAST_PART * symbols)
        above = shares[d - 1].select(F.col("gram").alias("suffix"), F.col("n").alias("m"), F.col("total").alias("suffix_total"))
        both = frequent.join(above, frequent["gram"].bitwiseAND(_mask(d)) == F.col("suffix"))
        gain = F.sum(F.col("n") * F.log(F.col("n") * F.col("suffix_total") / (F.col("total") * F.col("m"))))
        kept = both.withColumn("gain", gain.over(Window.partitionBy(F.shiftright("gram", 8)))).where(F.col("gain") >= CUTOFF * math.log(symbols))
        out = out.unionByName(kept.select(F.lit(d).alias("depth"), "gram", "n"))
    return out


@dataclass
class Tree:
    """For each depth: sorted contexts with the log weight of their suffix, and sorted grams with their log10 probability."""

    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    grams: list[np.ndarray]
    logs: list[np.ndarray]

    @classmethod
    def of(cls, rows: pd.DataFrame) -> Tree:
        tree = cls([], [], [], [])
        for depth in range(DEPTH + 1):
            own = rows[rows["depth"] == depth].sort_values("gram")
            grams, n = own["gram"].to_numpy(np.int64), own["n"].to_numpy(np.float64)
            if not depth:
                full = np.zeros(256)
                full[grams] = n
                grams, probability = np.arange(256), (full + 0.5) / (full.sum() + 128)
                contexts, weight = np.zeros(1, np.int64), np.zeros(1)
            else:
                contexts, place, kinds = np.unique(grams >> 8, return_inverse=True, return_counts=True)
                totals = np.bincount(place, n, len(contexts)) if len(contexts) else np.zeros(0)
                below = 10 ** tree.log10(grams, depth - 1)
                probability = (n + kinds[place] * below) / (totals + kinds)[place]
                weight = np.log10(kinds / (totals + kinds))
            tree.contexts.append(contexts), tree.weights.append(weight), tree.grams.append(grams), tree.logs.append(np.log10(probability))
        return tree

    def log10(self, grams: np.ndarray, depth: int = DEPTH) -> np.ndarray:
        """Log probability of each gram's last byte after its longest retained context of at most ``depth`` bytes."""
        out, still = np.zeros(len(grams)), np.arange(len(grams))
        for d in range(depth, -1, -1):
            if not len(self.contexts[d]):
                continue
            context = (grams[still] >> 8) & _mask(d)
            at = np.minimum(np.searchsorted(self.contexts[d], context), len(self.contexts[d]) - 1)
            inside = np.flatnonzero(self.contexts[d][at] == context)
            own = grams[still[inside]] & _mask(d + 1)
            to = np.minimum(np.searchsorted(self.grams[d], own), len(self.grams[d]) - 1)
            found = self.grams[d][to] == own
            out[still[inside[found]]] += self.logs[d][to[found]]
            out[still[inside[~found]]] += self.weights[d][at[inside[~found]]]
            still = np.delete(still, inside[found])
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each of the spelled texts."""
        out, before = np.zeros(len(texts)), 0
        for grams in grams_of(texts):
            kinds, place = np.unique(grams, return_inverse=True)
            last = (grams & 0xFF) == 0x0A  # a text ends here, and only here
            text = before + np.cumsum(last) - last
            out[before : text[-1] + 1] += np.bincount(text - before, self.log10(kinds)[place])
            before += int(last.sum())
        return out


def scored(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``docs`` needs doc_id and text; other columns are ignored. Training takes the rows whose id hash is not divisible by
    ``folds``. Null texts count as empty: one token, the end. Repeated rows are all returned. Without training rows the base score
    is that of a count of 0 in an empty vocabulary, and the tree is a uniform root. An empty table gives an empty result. Scores are sums of logarithms to
    base 10; the base score is that of words alone, each with 0.1 added to its count.
    """
    spark = docs.sparkSession
    rest = id_remainder(F.col("doc_id"), folds)
    counts = written(counted(docs.where(rest != 0)), "counts")
    words = counts.where("gram = -1").select("word", F.col("n").alias("c"))
    n, v = (x or 0 for x in words.agg(F.sum("c"), F.count("*")).first())
    frequent = words.where((F.col("c") >= FREQUENT_PART * n) | (F.col("word") == END)).toArrow().to_pydict()
    known = dict(zip(map(str.encode, frequent["word"]), frequent["c"]))
    shared = spark.sparkContext.broadcast((Tree.of(retained(counts.where("word = ''")).toArrow().to_pandas()), known))
    fixed = float(np.log10(n + 0.1 * (v + 1)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, known = shared.value
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for start, end in pieces(texts, 2 * CHUNK):
                yield from _rows(batch.iloc[start:end], [words_of(t) for t in texts[start:end]], tree, known)

    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    joined = keyed.mapInPandas(run, ROWS).join(words.hint("shuffle_hash"), "word", "left")
    c, rare = F.coalesce("c", F.lit(0)), F.col("copy") == 0
    by_row = joined.groupBy("doc_id", "text_hash").agg(
        F.sum("copy").alias("copies"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(rare & (c > 0), 1).otherwise(0)).alias("known"),
        F.sum(F.when(rare, F.log10(c + 0.1)).otherwise(F.col("base"))).alias("base"),
        F.max(F.when(~rare, F.col("score"))).alias("score"),
    )
    return by_row.select(
        "doc_id",
        (rest == 0).alias("held_out"),
        "n_tokens",
        F.floor(F.col("known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies") - F.col("n_tokens") * fixed).alias("base_score"),
        "score",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


#: A row with copy 1 per document, with what is known in the task, and one with copy 0 per occurrence of a word that is not.
ROWS = "doc_id long, text_hash long, word string, n_tokens long, n_known long, base double, score double, copy int"


def _rows(docs: pd.DataFrame, split: list[list[bytes]], tree: Tree, known: dict[bytes, int]) -> Iterator[pd.DataFrame]:
    end = END.encode()
    flat = list(chain.from_iterable((*own, end) for own in split))
    sizes = np.fromiter(map(len, split), np.int64, len(split)) + 1
    c = np.fromiter(map(known.get, flat, repeat(-1)), np.float64, len(flat))
    rare, firsts = c < 0, np.cumsum(sizes) - sizes
    total = lambda values: np.add.reduceat(np.where(rare, 0, values), firsts)
    ids, hashes = docs["doc_id"].astype("Int64").array, docs["text_hash"].to_numpy()
    yield pd.DataFrame({
        "doc_id": ids, "text_hash": hashes, "word": [f"{END}{h}" for h in hashes], "n_tokens": sizes, "n_known": total(c > 0),
        "base": total(np.log10(np.maximum(c, 0) + 0.1)), "score": tree.scores([spelled(own) for own in split]), "copy": 1,
    })
    at, owner = np.flatnonzero(rare), np.repeat(np.arange(len(split)), sizes)
    for i in range(0, len(at), 200_000):
        own = at[i : i + 200_000]
        yield pd.DataFrame({
            "doc_id": ids[owner[own]], "text_hash": hashes[owner[own]], "word": [flat[j].decode() for j in own.tolist()], "n_tokens": 0,
            "n_known": 0, "base": 0.0, "score": np.nan, "copy": 0,
        })
