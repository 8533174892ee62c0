"""Toxicity by compression distance: windows of a text are compressed with two zstandard dictionaries.

The ordinary dictionary is trained on windows of ordinary documents, the toxic one on the words that mark toxic
documents: those that stand in a far larger part of them, in ever new surroundings (a word of a passage that is merely
copied keeps its neighbours). The compressor of the toxic side holds both dictionaries, so ordinary prose costs
the same on either side and a window's gain, the difference of the two lengths, comes from toxic matches alone. Thresholds on
the gains are calibrated by a logistic fit over their histogram, on other documents than those of the dictionaries.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, passage, sampled_by_hash

WINDOW_WORDS, WINDOW_BYTES = 10, 160
#: Documents of either kind that training may use, and the characters taken from each.
TRAIN_TOXIC, TRAIN_ORDINARY, TRAIN_CHARS = 2400, 4800, 4000
TOXIC_BYTES, ORDINARY_BYTES = 8192, 12288
#: A marking word: found in so large a part of the toxic documents (three at least), so many times as often as in ordinary
#: ones, with so large a part of new neighbours.
LEAST_PART, RATIO, NEW_NEIGHBOURS = 0.015, 12.0, 0.7
#: Lower ends of the bins in which gains (bytes) are counted.
BINS = np.array([-2, -1, 0, 1, 2, 3, 4, 5, 6, 8, 10])
MARKED = 4


def windows(text: str) -> list[bytes]:
    """Runs of ten words in lower case between spaces; what is longer than 160 bytes is cut there."""
    words = text.lower().encode().split()
    out = []
    for i in range(0, len(words), WINDOW_WORDS):
        window = b" " + b" ".join(words[i : i + WINDOW_WORDS]) + b" "
        if len(window) <= 2 * WINDOW_BYTES:
            out.append(window)
        else:
            out += [window[j : j + WINDOW_BYTES] for j in range(0, len(window), WINDOW_BYTES)]
    return out


@dataclass
class Model:
    """Contents of the two dictionaries and the calibration (weights of the features, the last one is the offset)."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(BINS) + 4))

    def __post_init__(self) -> None:
        self._pair: list | None = None

    def __getstate__(self) -> dict:
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights, "_pair": None}

    def compressors(self) -> list:
        if self._pair is None:
            self._pair = [_compressor(self.ordinary), _compressor(self.toxic + self.ordinary)]
        return self._pair

    def gains(self, text: str) -> np.ndarray:
        """Bytes that the toxic dictionary saves in each window."""
        plain, toxic = self.compressors()
        return np.array([len(plain.compress(w)) - len(toxic.compress(w)) for w in windows(text)], np.int64)

    def scores(self, texts: list[str]) -> np.ndarray:
        values = np.stack([features(self.gains(t)) for t in texts])
        return 1 / (1 + np.exp(-np.clip(values @ self.weights, -40, 40)))


def _compressor(content: bytes):
    parameters = zstandard.ZstdCompressionParameters(
        window_log=18, chain_log=16, hash_log=16, search_log=6, min_match=4, target_length=32, strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    if not content:
        return zstandard.ZstdCompressor(compression_params=parameters)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def features(gains: np.ndarray) -> np.ndarray:
    """Shares of windows at or above each bin, the number of marked windows, the largest gain, the length, and one."""
    n = len(gains)
    if not n:
        return np.append(np.zeros(len(BINS) + 3), 1.0)
    shares = (gains[:, None] >= BINS).mean(axis=0)
    marked = int((gains >= MARKED).sum())
    return np.array([*shares, np.log1p(marked), min(int(gains.max()), 16) / 8, np.log1p(n), 1.0])


def marking_words(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Words that mark toxic texts, most frequent last."""
    in_toxic, in_ordinary, neighbours = Counter(), Counter(), defaultdict(set)
    for text in toxic:
        words = text.lower().encode().split()
        in_toxic.update(set(words))
        for before, word in zip([b"", *words], words):
            neighbours[word].add(before)
    for text in ordinary:
        in_ordinary.update(set(text.lower().encode().split()))
    rate, least = len(toxic) / max(len(ordinary), 1), max(3, LEAST_PART * len(toxic))
    chosen = [
        w for w, n in in_toxic.items()
        if n >= least and n > RATIO * rate * (in_ordinary[w] + 0.5) and len(w) > 2 and len(neighbours[w]) >= NEW_NEIGHBOURS * n
    ]
    return sorted(chosen, key=lambda w: (in_toxic[w], w))


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents; where zstandard finds too little to train on, the samples themselves."""
    plain = [w for text in ordinary for w in windows(text)]
    marks = marking_words(toxic, ordinary)
    chosen = set(marks)
    samples = [b" " + w + b" " for text in toxic for w in text.lower().encode().split() if w in chosen]
    return _trained(plain, ORDINARY_BYTES), _trained(samples, TOXIC_BYTES, b" ".join([b"", *marks, b""]))


def _trained(samples: list[bytes], size: int, instead: bytes | None = None) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples) if instead is None else instead)[-size:]


def train(toxic: list[str], ordinary: list[str]) -> Model:
    """Dictionaries from two thirds of the texts of each kind, calibration on the rest."""
    own = [[t for i, t in enumerate(texts) if i % 3 != 0] for texts in (toxic, ordinary)]
    rest = [[t for i, t in enumerate(texts) if i % 3 == 0] for texts in (toxic, ordinary)]
    model = Model(*dictionaries(*own))
    if rest[0] and rest[1]:
        x = np.stack([features(model.gains(t)) for texts in rest for t in texts])
        y = np.repeat([1.0, 0.0], [len(rest[0]), len(rest[1])])
        model.weights = _logistic(x, y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the offset (last) is not penalised."""
    weights, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * weights)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def training_texts(docs: DataFrame, labels: DataFrame, folds: int = 5) -> tuple[list[str], list[str]]:
    """(toxic, ordinary) passages of labelled documents outside the held-out fold, a bounded number of each.

    Ids are chosen by hash, so the join with ``docs`` has a side of bounded size. An id labelled twice counts as toxic if
    any label says so; copies of a text count once.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), folds) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    bounds = {0: TRAIN_ORDINARY, 1: TRAIN_TOXIC}
    if not sizes:
        return [], []
    chosen = sampled_by_hash(known.where(F.col("toxic").isin(0, 1)), "toxic", {k: v for k, v in sizes.items() if k in bounds}, bounds, "doc_id")
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("h"), passage(F.col("text"), TRAIN_CHARS).alias("passage"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("passage").alias("passage"))
    found = sorted((r["toxic"], r["h"], r["passage"]) for r in rows.collect())
    own = {kind: [text for k, _, text in found if k == kind][: bounds[kind]] for kind in bounds}
    return own[1], own[0]


def toxicity(text: Column | str, model: Model) -> Column:
    """Score between 0 and 1 of a whole text; null counts as empty, and an empty text has the score of no windows."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores([t or "" for t in texts]) if len(texts) else [], dtype="float64")

    return F.pandas_udf(run, "double")(text)


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text); other columns are ignored.

    ``labels`` needs doc_id and toxic (0 or 1). Without labels of both kinds every score is 0.5, as nothing is known. Repeated
    rows are all returned; an empty table gives an empty result.
    """
    model = train(*training_texts(docs, labels, folds))
    rest = id_remainder(F.col("doc_id"), folds)
    scored = docs.select("doc_id", (rest == 0).alias("held_out"), toxicity("text", model).alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
