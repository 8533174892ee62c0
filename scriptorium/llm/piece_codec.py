"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

A batch is split into words (a run of word-start marks and what follows), and words not seen lately lie end
to end in flat symbol arrays. A round takes the best pair rank of every word by a segmented minimum, merges its
leftmost pairs in all words at once, recomputes the ranks beside the merges and compacts the arrays; finished
words leave. Several equal pairs of a word are merged in one round only if no merge creates a pair that is
as good, so the order of merges is that of one merge at a time, best first and leftmost among equals.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.rows import by_rows
from .common import pieces as text_pieces

MARK = "▁"
NONE = np.iinfo(np.int32).max
#: Words kept between batches in a worker, and the longest word kept; a larger store is emptied. Words that come once are not kept.
KEPT_WORDS, KEPT_CHARS = 400_000, 48
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
UNKNOWN_TEXT = " ⁇ "
#: Rows of an Arrow batch that are encoded together.
ROWS = 512
DIGESTS = StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")


@dataclass
class Vocabulary:
    """What encoding needs of a model file, as plain lists that can be sent to tasks."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool

    NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Read a model on the driver. Raises ValueError for models whose semantics are not covered here."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, kinds = model.normalizer_spec, [p.type for p in model.pieces]
        if model.trainer_spec.model_type != model.trainer_spec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that leave texts as they are can be used")
        if model.trainer_spec.treat_whitespace_as_suffix or set(kinds) - {cls.NORMAL, cls.UNKNOWN, cls.CONTROL, cls.BYTE}:
            raise ValueError("user-defined and unused pieces and suffix marks are not covered")
        names = [p.piece for p in model.pieces]
        if any(MARK in n.lstrip(MARK) or n.startswith(MARK * 2) and n.strip(MARK) for n, k in zip(names, kinds) if k == cls.NORMAL):
            raise ValueError("pieces must not reach beyond one word")
        return cls(names, [p.score for p in model.pieces], kinds, rules.add_dummy_prefix)


@dataclass
class Codec:
    """Encoder and decoder of one vocabulary; built once in each worker."""

    vocabulary: Vocabulary
    kept: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        number = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == v.NORMAL}
        # single characters that are no piece themselves but begin or end one get symbols behind the pieces
        symbol = dict(number)
        for piece in number:
            for char in piece:
                symbol.setdefault(char, len(v.pieces) + len(symbol) - len(number))
        self.n_symbols = len(v.pieces) + len(symbol) - len(number)
        order = {s: r for r, s in enumerate(sorted({v.scores[i] for i in number.values()}, reverse=True))}
        left, right, rank, merged = [], [], [], []
        for piece, i in number.items():
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(order[v.scores[i]]), merged.append(i)
        keys = np.array(left, np.int64) * self.n_symbols + np.array(right, np.int64)
        by_key = np.argsort(keys)
        self.keys = np.append(keys[by_key], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array(rank, np.int32)[by_key], NONE)
        self.merged = np.append(np.array(merged, np.int32)[by_key], -1)
        self.symbol_of_char = np.full(0x110000, -1, np.int32)
        for piece, i in symbol.items():
            if len(piece) == 1:
                self.symbol_of_char[ord(piece)] = i
        self.extra = {i: ord(p) for p, i in symbol.items() if i >= len(v.pieces)}
        self.byte_id = np.zeros(256, np.int32)
        for i, (piece, kind) in enumerate(zip(v.pieces, v.kinds)):
            if kind == v.BYTE:
                self.byte_id[int(piece[3:5], 16)] = i
        self.is_byte = np.array([k == v.BYTE for k in v.kinds])
        self.shown = [k != v.CONTROL for k in v.kinds]
        texts = {v.NORMAL: lambda p: p.replace(MARK, " ").encode(), v.CONTROL: lambda p: b"", v.UNKNOWN: lambda p: UNKNOWN_TEXT.encode()}
        self.surface = [bytes([int(p[3:5], 16)]) if k == v.BYTE else texts[k](p) for p, k in zip(v.pieces, v.kinds)]
        self.decimal = [str(i).encode() for i in range(len(v.pieces))]
        self.block = self._mark_block()

    def _mark_block(self) -> int:
        """Length of the blocks into which long runs of marks fall from the left, 0 if they don't."""
        longest = max((len(p) for p in self.vocabulary.pieces if p and not p.strip(MARK)), default=0)
        runs = self._merge([MARK * n for n in range(1, 4 * longest + 1)])
        one = runs[longest - 1] if longest else b""
        regular = longest > 1 and all(runs[n + longest - 1] == one + runs[n - 1] for n in range(1, 3 * longest + 1))
        return longest if regular and len(one) == 4 else 0

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; symbols of -1 never merge."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.n_symbols + right)
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), np.where(hit, self.merged[at], -1)

    def _merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers."""
        if not words:
            return []
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.symbol_of_char[chars]
        if (symbols < 0).any():
            symbols = np.where(symbols < 0, -1 - chars.astype(np.int64), symbols)
        symbols, word = symbols.astype(np.int64), np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self._pair_ranks(symbols, word, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(word)))
            if (best == NONE).any():
                over = np.repeat(best == NONE, sizes)
                done.append((word[over], symbols[over]))
                symbols, word, rank, best, sizes = symbols[~over], word[~over], rank[~over], best[best < NONE], sizes[best < NONE]
                if not len(symbols):
                    break
            chosen = self._chosen(symbols, word, rank, np.repeat(best, sizes))
            symbols[chosen] = self._look_up(symbols[chosen], symbols[chosen + 1])[1]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            new_at = np.cumsum(keep)[chosen] - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            rank[new_at] = self._pair_ranks(symbols, word, new_at)
            before = new_at[new_at > 0] - 1
            rank[before] = self._pair_ranks(symbols, word, before)
        word, symbols = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return self._ids(word[order], symbols[order], len(words))

    def _pair_ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each position; none at a word's end."""
        out = np.full(len(at), NONE, np.int32)
        inside = at < len(symbols) - 1
        inside[inside] = word[at[inside]] == word[at[inside] + 1]
        out[inside] = self._look_up(symbols[at[inside]], symbols[at[inside] + 1])[0]
        return out

    def _chosen(self, symbols: np.ndarray, word: np.ndarray, rank: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Positions merged in this round."""
        found = np.flatnonzero(rank == best)
        run = np.append(True, np.diff(found) != 1)
        within = np.arange(len(found)) - np.maximum.accumulate(np.where(run, np.arange(len(found)), 0))
        found = found[within % 2 == 0]  # of overlapping pairs, every second one from the left
        new_word = np.append(True, word[found[1:]] != word[found[:-1]])
        if new_word.all():
            return found
        merged = self._look_up(symbols[found], symbols[found + 1])[1]
        left = np.where((found > 0) & (word[found - 1] == word[found]), symbols[found - 1], -1)
        joined = np.append(False, (found[1:] - found[:-1] == 2) & ~new_word[1:])
        left[joined] = merged[:-1][joined[1:]]
        after = np.minimum(found + 2, len(symbols) - 1)
        right = np.where((found + 2 < len(symbols)) & (word[after] == word[found]), symbols[after], -1)
        better = np.minimum(self._look_up(left, merged)[0], self._look_up(merged, right)[0]) <= rank[found]
        earlier = np.cumsum(better) - better
        return found[earlier == np.repeat(earlier[new_word], np.diff(np.append(np.flatnonzero(new_word), len(found))))]

    def _ids(self, word: np.ndarray, symbols: np.ndarray, n_words: int) -> list[bytes]:
        strange = (symbols < 0) | (symbols >= len(self.vocabulary.pieces))
        if strange.any():
            at = np.flatnonzero(strange)
            own = [self._bytes_of(x) for x in symbols[at].tolist()]
            sizes = np.ones(len(symbols), np.int64)
            sizes[at] = list(map(len, own))
            word, symbols, strange = np.repeat(word, sizes), np.repeat(symbols, sizes), np.repeat(strange, sizes)
            symbols[strange] = self.byte_id[np.frombuffer(b"".join(own), np.uint8)]
        flat = symbols.astype("<i4").tobytes()
        ends = 4 * np.searchsorted(word, np.arange(n_words), side="right")
        starts = np.append(0, ends[:-1])
        return [flat[s:e] for s, e in zip(starts.tolist(), ends.tolist())]

    def _bytes_of(self, symbol: int) -> bytes:
        return chr(-1 - symbol if symbol < 0 else self.extra[symbol]).encode()

    def _words(self, text: str) -> list[str]:
        marked = (MARK if self.vocabulary.dummy_prefix and text else "") + text.replace(" ", MARK)
        words = WORD.findall(marked)
        if self.block and MARK * (self.block + 1) in marked:
            out: list[str] = []
            for w in words:
                run = len(w) - len(w.lstrip(MARK))
                blocks = max(0, (run - 1) // self.block)
                out += [MARK * self.block] * blocks + [w[blocks * self.block :]]
            return out
        return words

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray] = []
        for start, end in text_pieces(texts):
            split = [self._words(t) for t in texts[start:end]]
            if len(self.kept) > KEPT_WORDS:
                self.kept.clear()
            times = Counter(chain.from_iterable(split))
            new = list(times.keys() - self.kept.keys())
            own = dict(zip(new, self._merge(new)))
            self.kept.update((w, b) for w, b in own.items() if times[w] > 1 and len(w) <= KEPT_CHARS)
            own.update((w, self.kept[w]) for w in times if w not in own)
            out += [np.frombuffer(b"".join(map(own.__getitem__, words)), "<i4") for words in split]
        return out

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of ids: bytes that are no UTF-8 become U+FFFD, the mark before the first text goes."""
        ids = np.asarray(ids, np.int64)
        parts = list(map(self.surface.__getitem__, ids.tolist()))
        for i, id_ in enumerate(ids.tolist()):
            if self.vocabulary.dummy_prefix and not self.is_byte[id_] and self.vocabulary.kinds[id_] == Vocabulary.NORMAL and parts[i][:1] == b" ":
                parts[i] = parts[i][1:]
                break
            if parts[i]:
                break
        if not all(map(self.shown.__getitem__, ids.tolist())):
            return self._decode_bytes(ids, parts)  # what stands on both sides of a control piece must not become one character
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._decode_bytes(ids, parts)

    def _decode_bytes(self, ids: np.ndarray, parts: list[bytes]) -> str:
        out, at = [], 0
        is_byte = self.is_byte[ids].tolist()
        while at < len(parts):
            end = at
            while end < len(parts) and is_byte[end]:
                end += 1
            if end == at:
                out.append(parts[at].decode())
                at += 1
                continue
            raw, at = b"".join(parts[at:end]), end
            while raw:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(raw[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                raw = raw[size:]
        return "".join(out)


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec of a broadcast vocabulary."""
    if shared.id_ not in _codecs:
        _codecs.clear()
        _codecs[shared.id_] = Codec(shared.vocabulary.value)
    return _codecs[shared.id_]


@dataclass
class Shared:
    """A vocabulary sent to all executors (some tens of thousands of pieces, fixed by the model)."""

    vocabulary: object
    id_: int

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> Shared:
        sent = spark.sparkContext.broadcast(Vocabulary.read(path))
        return cls(sent, sent._jbroadcast.id())


def encode(text: Column | str, shared: Shared) -> Column:
    """array<int> of ids; null counts as empty and has none."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(_codec(shared).encode([t or "" for t in texts]))

    return F.pandas_udf(run, "array<int>")(text)


def decode(ids: Column | str, shared: Shared) -> Column:
    """The text of an id list; null for null. Ids outside the vocabulary raise IndexError."""

    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else _codec(shared).decode(x) for x in lists])

    return F.pandas_udf(run, "string")(ids)


def round_trip(text: Column | str, shared: Shared) -> Column:
    """struct<n_tokens, ids_sha256, decoded_sha256> of encoding a text and decoding its ids.

    Null counts as empty: no ids, and the digests of empty texts. Ids are digested as decimal numbers joined by commas.
    """

    def run(texts: list) -> list[tuple[int, str, str]]:
        codec = _codec(shared)
        rows = []
        values = [t or "" for t in texts]
        for start, end in text_pieces(values):
            for ids in codec.encode(values[start:end]):
                listed = b",".join(map(codec.decimal.__getitem__, ids.tolist()))
                rows.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()))
        return rows

    return by_rows(run, DIGESTS, ROWS)(text)
