"""Language identification with a convolutional network over bytes.

Filters of several widths slide over windows of a fixed number of bytes; each filter's strongest answer in the
window (max pooling) goes through a softmax. A filter over one-hot bytes is a table with a weight for every byte at
every offset, so a convolution is a sum of table rows. The network is trained in numpy on the driver, on a bounded
number of labelled windows; whole texts are then cut into overlapping windows inside tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.rows import by_rows
from .common import id_remainder, passage, pieces, sampled_by_hash

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Labelled windows per language that training may use, one from each of so many different texts.
TRAIN_PER_LANGUAGE = 1500
EPOCHS, BATCH, RATE = 14, 64, 0.02
#: Windows whose answers are in memory together.
TOGETHER = 256
FOUND = StructType().add("lang_pred", "string").add("score", "double")


@dataclass
class Network:
    """Tables[k] has shape (width k, 256, filters); weights turn pooled answers into one value per language."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def pooled(self, windows: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Strongest answer of every filter in every window, and where it is if asked for."""
        best, where = [], []
        for table in self.tables:
            width, n = len(table), windows.shape[1] - len(table) + 1
            answer = table[0].take(windows[:, :n], axis=0)
            for j in range(1, width):
                answer += table[j].take(windows[:, j : j + n], axis=0)
            if places:
                at = answer.argmax(axis=1)
                where.append(at)
                best.append(np.take_along_axis(answer, at[:, None, :], axis=1)[:, 0])
            else:
                best.append(answer.max(axis=1))
        return np.concatenate(best, axis=1) + self.bias, np.concatenate(where, axis=1) if places else None

    def shares(self, windows: np.ndarray) -> np.ndarray:
        """Softmax over languages for every window."""
        out = [_softmax(np.maximum(self.pooled(windows[i : i + TOGETHER])[0], 0) @ self.weights + self.offset) for i in range(0, len(windows), TOGETHER)]
        return np.concatenate(out)


def _softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def windows_of(text: str, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a text's bytes in lower case, and how many bytes each is the first to cover.

    Neighbours overlap by the widest filter less one, so no run of bytes falls between two; the last is filled with zeros.
    """
    raw = text.lower().encode()
    step = window - max(WIDTHS) + 1
    count = max(1, -(-(len(raw) - max(WIDTHS) + 1) // step))
    padded = np.zeros((count - 1) * step + window, np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, np.uint8)
    covered = np.minimum(step, len(raw) - step * np.arange(count))
    return np.lib.stride_tricks.sliding_window_view(padded, window)[::step], np.maximum(covered, 1)


def train(texts: list[str], labels: list[str], window: int = WINDOW, seed: int = 7) -> Network:
    """Fit a network by Adam. Every text gives its first window; every second one is cut short, so short texts are learned too."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    x = np.stack([windows_of(t, window)[0][0] for t in texts])
    short = rng.integers(12, window, len(x))
    short[::2] = window
    x[np.arange(window)[None, :] >= short[:, None]] = 0
    y = np.searchsorted(languages, labels)
    total = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32),
        rng.normal(0, 0.3, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    values = [*net.tables, net.bias, net.weights, net.offset]
    means, squares, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            step += 1
            for v, g, m, s in zip(values, _gradients(net, x[rows], y[rows]), means, squares):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                v -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    pooled, where = net.pooled(x, places=True)
    active = np.maximum(pooled, 0)
    delta = _softmax(active @ net.weights + net.offset)
    delta[np.arange(len(y)), y] -= 1
    delta /= len(y)
    back = (delta @ net.weights.T) * (pooled > 0)
    tables = []
    for k, table in enumerate(net.tables):
        own = slice(k * FILTERS, (k + 1) * FILTERS)
        grad = np.zeros_like(table)
        for j in range(len(table)):
            np.add.at(grad[j], (np.take_along_axis(x, where[:, own] + j, axis=1), np.arange(FILTERS)[None, :]), back[:, own])
        tables.append(grad)
    return [*tables, back.sum(axis=0), active.T @ delta, delta.sum(axis=0)]


def _told(shares: np.ndarray) -> np.ndarray:
    """One less the shares' entropy as part of the largest possible one."""
    if shares.shape[1] == 1:
        return np.ones(len(shares))
    return 1 + (shares * np.log(np.maximum(shares, 1e-12))).sum(axis=1) / np.log(shares.shape[1])


def predict(net: Network, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text: the mean of its windows' shares, weighted by the bytes they cover and by how far the
    shares are from even, so stretches that tell nothing (numbers, junk) have little say."""
    names, scores = [], []
    for start, end in pieces(texts, 1_000_000):
        cut = [windows_of(t) for t in texts[start:end]]
        shares = net.shares(np.concatenate([w for w, _ in cut]))
        sizes = np.array([len(c) for _, c in cut])
        covered = np.concatenate([c for _, c in cut])[:, None]
        firsts = np.cumsum(sizes) - sizes
        weight = covered * (_told(shares)[:, None] + 1e-6)
        mean = np.add.reduceat(shares * weight, firsts) / np.add.reduceat(weight, firsts)
        names += [net.languages[i] for i in mean.argmax(axis=1)]
        scores += np.clip(mean.max(axis=1), 0, 1).tolist()
    return names, scores


def training_sample(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> tuple[list[str], list[str]]:
    """(texts, labels): at most ``per_language`` passages for each language, from different texts chosen by hash.

    ``docs`` are the rows that may be learned from. Copies of a text count once. What reaches the driver is bounded
    by the parameter, the window and the number of languages.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = usable.select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = {r["lang"]: r["n"] for r in hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not sizes:
        return [], []
    chosen = sampled_by_hash(hashed, "lang", sizes, per_language, "text")
    taken = chosen.select("lang", "h", passage(F.col("text"), WINDOW).alias("passage")).distinct()
    rows = sorted(tuple(r) for r in taken.collect())
    texts, labels = [], []
    for lang in sizes:
        own = [r for r in rows if r[0] == lang][:per_language]
        texts += [r[2] for r in own]
        labels += [lang] * len(own)
    return texts, labels


def fit(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> Network | None:
    """A network for the languages of ``docs`` (text, lang); None if no row has a language and a letter."""
    texts, labels = training_sample(docs, per_language)
    return train(texts, labels) if texts else None


def language(text: Column | str, net: Network | None) -> Column:
    """struct<lang_pred string, score double>.

    ``und`` with score 0 for null texts, texts without a letter, and where there is no network. Equal shares go to
    the first language in alphabetical order. Whole texts are used, however long.
    """
    text = F.col(text) if isinstance(text, str) else text

    def run(texts: list, letters: list) -> list[tuple[str, float]]:
        out = [(UNDETERMINED, 0.0)] * len(texts)
        use = [i for i, has in enumerate(letters) if has] if net is not None else []
        for i, *found in zip(use, *predict(net, [texts[i] for i in use])) if use else ():
            out[i] = tuple(found)
        return out

    return by_rows(run, FOUND)(text, text.rlike(r"\p{L}"))


def identify(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs`` (doc_id, text, lang); other columns are ignored.

    Rows whose id hash is divisible by ``folds`` are held out of training. Repeated rows are all returned; a null id
    counts as the empty text; an empty table gives an empty result.
    """
    rest = id_remainder(F.col("doc_id"), folds)
    net = fit(docs.where(rest != 0), per_language)
    return docs.select("doc_id", (rest == 0).alias("held_out"), language("text", net).alias("x")).select("doc_id", "held_out", "x.*")


def accepted(docs: DataFrame, least: float = 0.4, folds: int = 5) -> DataFrame:
    """The rows of ``docs`` in one language: determined, with a score of at least ``least``; all columns are kept."""
    net = fit(docs.where(id_remainder(F.col("doc_id"), folds) != 0))
    found = language("text", net)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), found.alias("found"))
    return row.where((F.col("found.lang_pred") != UNDETERMINED) & (F.col("found.score") >= least)).select("row.*")
