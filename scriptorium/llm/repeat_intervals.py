"""Substring deduplication by the common-prefix interval tree of an enhanced suffix array.

Strings of ``length`` bytes that start at two places are found without sorting every suffix of the corpus in one place:

1. Each window of ``length`` bytes has an anchor, its leftmost run of ANCHOR * ``length`` bytes with the smallest hash. Equal windows have equal
   anchors at equal offsets, so the windows of an anchor meet all their copies under the anchor's hash. An anchor stands for
   some hundred windows; only hashes that occur twice go on, and texts are counted once however often they are copied.
2. The suffixes that begin at the anchors of one hash are sorted, with the lengths of their common prefixes: a sparse enhanced suffix
   array. A stack scan yields its intervals of a common prefix. Within an interval the texts before the anchors, read
   backwards, form such intervals too; a group of theirs whose members go on differently to the right (it spans several child
   intervals) and to the left is a maximal repeat, and its members are all its occurrences.
3. A hash with more than LARGEST_GROUP anchors is split by its strings: blocks of BLOCK neighbouring windows, and then the windows of
   blocks that stand alone, are grouped by digest over the whole cluster. Counts combine before the shuffle, and a string with many
   occurrences is one interval of equal suffixes.

Groups, lists and texts in one task are bounded by LARGEST_GROUP pieces or by one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PIECE_CHARS, run_starts, written

LENGTH = 400
#: Bytes of an anchor, as a part of the length.
ANCHOR = 8 / 25
#: Anchors of one hash that are sorted together; more are split.
LARGEST_GROUP = 1_000
#: Windows of a block that larger groups compare at once.
BLOCK = 16
#: Bytes of the rows that a task holds back before it hands them on.
OUTPUT_BYTES = 8_000_000

_rng = np.random.default_rng(11)
BYTES = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
FACTOR = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` bytes, put together from runs of powers of two."""
    value, factor, size, whole, done = BYTES[data], FACTOR, 1, None, 0
    while True:
        if width & size:  # the runs so far, and this one behind them
            count = len(data) - done - size + 1
            if count <= 0:
                return np.zeros(0, np.uint64)
            whole = value[:count] if whole is None else whole[:count] * np.uint64(factor) + value[done : done + count]
            done += size
            if done == width:
                mixed = whole ^ (whole >> np.uint64(29))
                return mixed * np.uint64(0xBF58476D1CE4E5B9)
        if len(value) <= size:
            return np.zeros(0, np.uint64)
        value = value[:-size] * np.uint64(factor) + value[size:]
        factor = factor * factor & (1 << 64) - 1
        size *= 2


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest value in every run of ``width`` values, of equal ones the first."""
    least, place, size = values, np.arange(len(values)), 1
    while 2 * size <= width:
        later = least[size:] < least[:-size]
        place = np.where(later, place[size:], place[:-size])
        least = np.where(later, least[size:], least[:-size])
        size *= 2
    rest = width - size
    return np.where(least[rest:] < least[: len(least) - rest], place[rest:], place[: len(place) - rest])


def anchors_of(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, low, high) of each anchor: it serves the windows that begin ``low`` to ``high`` bytes before it."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    width = max(1, int(length * ANCHOR))
    hashes = gram_hashes(np.frombuffer(data, np.uint8), width)
    own = leftmost_minima(hashes, length - width + 1)
    first = run_starts(own[1:] != own[:-1])
    last = np.append(first[1:], len(own)) - 1
    place = own[first]
    return hashes[place].view(np.int64), place, place - last, place - first


def _intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(value, first, last) of the intervals in which all neighbours have ``value`` in common at least, and some no more; values from ``least``."""
    stack: list[tuple[int, int]] = []
    for at, value in enumerate([*common, 0]):
        first = at
        while stack and stack[-1][0] > value:
            top, first = stack.pop()
            yield top, first, at
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def _sorted_prefixes(texts: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of ``texts`` and the common prefix of each with the next."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    size = np.array([len(texts[i]) for i in order])
    width = max(1, int(size.max()))
    table = np.frombuffer(b"".join(texts[i].ljust(width, b"\0") for i in order), np.uint8).reshape(-1, width)
    differ = table[1:] != table[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.minimum(common, np.minimum(size[1:], size[:-1])).tolist()


def maximal_groups(pieces: list[tuple[bytes, int]], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members): maximal repeats of ``length`` bytes at least around the anchors of one hash.

    A piece is its bytes and the place of the anchor in them. The members have ``left`` bytes before the anchor and ``right`` from the
    anchor in common, not all of them more on either side (within their pieces), and no other piece has both.
    """
    after, common = _sorted_prefixes([text[at:] for text, at in pieces])
    before, shared = _sorted_prefixes([text[:at][::-1] for text, at in pieces])
    rank = np.empty(len(pieces), np.int64)
    rank[before] = np.arange(len(pieces))
    rank, ends = rank[after], np.array([*shared, 0])
    most = max(at for _, at in pieces)
    for right, first, last in _intervals(common, max(1, length - most)):
        order = np.argsort(rank[first : last + 1])
        left = np.minimum.reduceat(ends, rank[first : last + 1][order])[:-1]
        if left.max() + right < length:
            continue
        # children of the interval: neighbours with no more than ``right`` in common part them
        child = np.concatenate([[0], np.cumsum(np.array(common[first:last]) == right)])[order]
        for value, low, high in _intervals(left.tolist(), max(0, length - right)):
            part = child[low : high + 1]
            if (part != part[0]).any():
                yield value, right, [after[first + i] for i in order[low : high + 1]]
        if right >= length and left.min() == 0:  # intervals above skip what has nothing in common before the anchor
            yield 0, right, after[first : last + 1]


def repeated_windows(pieces: list[tuple[bytes, int, int]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Per piece (bytes, low, high) the ranges (low, high) of offsets before the anchor at which a window begins that another has too."""
    numbers: dict[tuple[bytes, int, int], list[int]] = {}
    for i, piece in enumerate(pieces):
        numbers.setdefault(piece, []).append(i)
    different = list(numbers)
    marks = np.zeros((len(different), length + 2), np.int32)
    for n, (_, low, high) in enumerate(different):
        if len(numbers[different[n]]) > 1:
            marks[n, low] += 1
            marks[n, high + 1] -= 1
    if len(different) > 1:
        for left, right, members in maximal_groups([(text, high) for text, _, high in different], length):
            marks[members, max(0, length - right)] += 1
            marks[members, min(left, length) + 1] -= 1
    covered = marks.cumsum(axis=1) > 0
    found: list[list[tuple[int, int]]] = [[] for _ in pieces]
    for n, (_, low, high) in enumerate(different):
        own = np.flatnonzero(covered[n, low : high + 1])
        if len(own):
            first = run_starts(own[1:] != own[:-1] + 1)
            last = np.append(first[1:], len(own)) - 1
            ranges = list(zip((own[first] + low).tolist(), (own[last] + low).tolist()))
            for i in numbers[different[n]]:
                found[i] = ranges
    return found


def digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield value.as_py() or b""


_AT = pa.list_(pa.struct([("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]))
_ANCHORS = pa.schema([("digest", pa.binary()), ("h", pa.int64()), ("at", _AT)])
_ANCHORS_DDL = "digest binary, h long, at array<struct<place:int,low:int,high:int>>"


def _anchor_rows(length: int):
    """A row per text and anchor hash, with all places of the hash in the text: a text that repeats itself has few rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, keys, parts, held = set(), [], [], 0
            for key, text in zip(batch.column("digest").to_pylist(), _texts(batch.column("text"))):
                if key in seen or len(text) < length:
                    continue
                seen.add(key)
                keys.append(key)
                parts.append(anchors_of(text, length))
                held += len(text)
                if held > PIECE_CHARS:
                    yield _anchor_batch(keys, parts)
                    keys, parts, held = [], [], 0
            if parts:
                yield _anchor_batch(keys, parts)

    return run


def _anchor_batch(keys: list[bytes], parts: list) -> pa.RecordBatch:
    text = np.repeat(np.arange(len(keys)), [len(p[0]) for p in parts])
    h, place, low, high = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((place, h, text))
    text, h = text[order], h[order]
    first = run_starts((text[1:] != text[:-1]) | (h[1:] != h[:-1]))
    fields = [pa.array(x[order], pa.int32()) for x in (place, low, high)]
    at = pa.ListArray.from_arrays(pa.array(np.append(first, len(h)), pa.int32()), pa.StructArray.from_arrays(fields, ["place", "low", "high"]))
    return pa.RecordBatch.from_arrays([pa.array([keys[i] for i in text[first]], pa.binary()), pa.array(h[first]), at.cast(_AT)], schema=_ANCHORS)


class _Rows:
    """Rows of named lists, handed on as record batches of a bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.held = schema, [[] for _ in schema], 0

    def add(self, size: int, *values) -> bool:
        for column, value in zip(self.rows, values):
            column.append(value)
        self.held += size
        return self.held > OUTPUT_BYTES

    def batch(self) -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.rows, self.schema)], schema=self.schema)
        self.rows, self.held = [[] for _ in self.schema], 0
        return made


_PIECES = pa.schema([("h", pa.int64()), ("digest", pa.binary()), ("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("piece", pa.binary())])
_BLOCKS = pa.schema([("block", pa.binary()), ("core", pa.binary()), ("digest", pa.binary()), ("starts", pa.list_(pa.int32())), ("n", pa.int32()), ("content", pa.binary())])
_WINDOWS = pa.schema([("window", pa.binary()), ("digest", pa.binary()), ("start", pa.int32())])
_RANGES = pa.schema([("digest", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])


def _cut(length: int):
    """Pieces around the anchors of groups of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_PIECES)
        for batch in batches:
            for key, text, anchors in zip(batch.column("digest").to_pylist(), _texts(batch.column("text")), batch.column("anchors")):
                for a in anchors.as_py():
                    for at in () if a["hot"] else a["at"]:
                        place, low, high = at["place"], at["low"], at["high"]
                        piece = text[place - high : place - low + length]
                        if out.add(len(piece) + 40, a["h"], key, place, low, high, piece):
                            yield out.batch()
        yield out.batch()

    return run


def _blocks(length: int, size: int):
    """Blocks of up to ``size`` neighbouring windows of larger groups, cut at multiples of ``size`` before the anchor, so that copies are cut alike.

    The core of a block is what all its windows share; a window can only repeat where its core does.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_BLOCKS)
        for batch in batches:
            for key, text, anchors in zip(batch.column("digest").to_pylist(), _texts(batch.column("text")), batch.column("anchors")):
                found: dict[bytes, list] = {}
                for at in (at for a in anchors.as_py() if a["hot"] for at in a["at"]):
                    for base in range(at["low"] // size * size, at["high"] + 1, size):
                        low, high = max(at["low"], base), min(at["high"], base + size - 1)
                        start, n = at["place"] - high, high - low + 1
                        content = text[start : start + n - 1 + length]
                        core = text[at["place"] - base : at["place"] - base - size + 1 + length]
                        found.setdefault(hashlib.md5(content).digest(), [[], n, content, core])[0].append(start)
                for block, (starts, n, content, core) in found.items():
                    if out.add(len(content) + 4 * len(starts) + 80, block, hashlib.md5(core).digest(), key, starts, n, content):
                        yield out.batch()
        yield out.batch()

    return run


def _windows(length: int):
    """The single windows of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_WINDOWS)
        for batch in batches:
            for key, start, n, content in zip(*(batch.column(c).to_pylist() for c in ("digest", "start", "n", "content"))):
                for i in range(n):
                    if out.add(48, hashlib.md5(content[i : i + length]).digest(), key, start + i):
                        yield out.batch()
        yield out.batch()

    return run


def _by_hash(length: int, answer):
    """Applies ``answer`` (rows of one hash to output rows) to rows that come sorted by hash; a group may go over several batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, names = answer.schema, ("digest", "place", "low", "high", "piece")
        out, held, own = _Rows(schema), [], None
        for batch in batches:
            h = np.asarray(batch.column("h"))
            rows = list(zip(*[batch.column(n).to_pylist() for n in names]))
            starts = run_starts(h[1:] != h[:-1]).tolist() if len(h) else []
            for s, e in zip(starts, [*starts[1:], len(h)]):
                if held and h[s] != own:
                    for row in answer(held, own, length):
                        if out.add(32, *row):
                            yield out.batch()
                    held = []
                own = int(h[s])
                held += rows[s:e]
        if held:
            for row in answer(held, own, length):
                out.add(32, *row)
        yield out.batch()

    return run


class Ranges:
    """The ranges of starts of repeated windows, per text."""

    schema, ddl = _RANGES, "digest binary, first int, last int"

    def __call__(self, rows: list[tuple], h: int, length: int) -> Iterator[tuple]:
        if len(rows) > 1:
            for (key, place, *_), ranges in zip(rows, repeated_windows([(piece, low, high) for _, _, low, high, piece in rows], length)):
                for low, high in ranges:
                    yield key, place - high, place - low


class Groups:
    """The maximal repeats with all their occurrences."""

    schema = pa.schema([("group", pa.binary()), ("digest", pa.binary()), ("start", pa.int32()), ("end", pa.int32())])
    ddl = "group binary, digest binary, start int, end int"

    def __call__(self, rows: list[tuple], h: int, length: int) -> Iterator[tuple]:
        numbers: dict[tuple[bytes, int], list[int]] = {}
        for i, (_, _, _, high, piece) in enumerate(rows):
            numbers.setdefault((piece, high), []).append(i)
        different = list(numbers)
        groups = [(high, len(piece) - high, [n]) for n, (piece, high) in enumerate(different) if len(numbers[piece, high]) > 1]
        groups += maximal_groups(different, length) if len(different) > 1 else []
        for left, right, members in groups:
            piece, high = different[members[0]]
            name = hashlib.md5(piece[high - left : high + right]).digest()
            for i in (i for n in members for i in numbers[different[n]]):
                yield name, rows[i][0], rows[i][1] - left, rows[i][1] + right


class Candidates:
    """Texts with anchors whose hash occurs again, and what their groups tell."""

    def __init__(self, docs: DataFrame, length: int, largest: int) -> None:
        self.length = length
        keyed = docs.select(digest(F.coalesce("text", F.lit(""))).alias("digest"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
        anchors = written(keyed.where(F.length("text") >= length).mapInArrow(_anchor_rows(length), _ANCHORS_DDL), "anchors")
        # counts are tables of their own and copies meet after a shuffle, so that Spark can split the join of a frequent hash
        counted = lambda rows, name: written(rows.groupBy("h").agg(F.sum(F.size("at")).alias("n")).where("n > 1"), name)
        again = anchors.join(counted(anchors, "again").select("h"), "h")
        met = written(again.repartition("digest", "h").dropDuplicates(["digest", "h"]), "met")
        sizes = counted(met, "sizes").select("h", (F.col("n") > largest).alias("hot"))
        lists = met.join(sizes, "h").groupBy("digest").agg(F.collect_list(F.struct("h", "at", "hot")).alias("anchors"))
        once = keyed.groupBy("digest").agg(F.first("text").alias("text"))
        self.texts = written(once.join(lists, "digest"), "texts")

    def grouped(self, answer) -> DataFrame:
        """``answer`` over the groups of bounded size."""
        ddl = "h long, digest binary, place int, low int, high int, piece binary"
        pieces = self.texts.where(F.exists("anchors", lambda a: ~a["hot"])).mapInArrow(_cut(self.length), ddl)
        return pieces.repartition("h").sortWithinPartitions("h").mapInArrow(_by_hash(self.length, answer), answer.ddl)

    def split(self, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
        """(block, digest, starts, n) and (window, digest, start): what repeats in larger groups, whole blocks and then windows of the other blocks.

        With blocks of one window the second table is empty.
        """
        ddl = "block binary, core binary, digest binary, starts array<int>, n int, content binary"
        blocks = written(self.texts.where(F.exists("anchors", lambda a: a["hot"])).mapInArrow(_blocks(self.length, size), ddl), "blocks")
        counted = lambda key: blocks.groupBy(key).agg(F.sum(F.size("starts")).alias("times")).where("times > 1").select(key)
        twice = written(counted("block"), "twice")
        whole = blocks.join(twice, "block").select("block", "digest", "starts", "n")
        alone = blocks.join(twice, "block", "left_anti").join(counted("core"), "core", "left_semi")
        alone = alone.select("core", "digest", F.col("starts")[0].alias("start"), "n", "content")
        alone = written(alone if size > 1 else alone.limit(0), "alone")
        # one occurrence of each repeated block stands for all, so that windows of others find it
        shown = blocks.join(twice, "block").groupBy("block").agg(*[F.first(c).alias(c) for c in ("core", "n", "content")])
        shown = shown.join(alone.select("core").distinct(), "core", "left_semi")
        shown = shown.select(F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("start"), "n", "content")
        windows = alone.select("digest", "start", "n", "content").unionByName(shown)
        windows = written(windows.mapInArrow(_windows(self.length), "window binary, digest binary, start int"), "windows")
        again = windows.groupBy("window").count().where("count > 1").select("window")
        return whole, windows.where("digest IS NOT NULL").join(again, "window")


def repeats(docs: DataFrame, length: int = LENGTH, largest: int = LARGEST_GROUP) -> DataFrame:
    """(group, digest, start, end): maximal repeats of ``length`` bytes at least, a row per occurrence in a different text.

    ``digest`` is the MD5 of the text, ``group`` that of the repeated bytes, which are followed for up to ``length`` bytes around an anchor;
    longer repeats are several overlapping groups. Strings with more than ``largest`` occurrences are groups of exactly ``length`` bytes.
    Copies of a whole text count once. Null texts are empty; an empty table gives an empty result.
    """
    found = Candidates(docs, length, largest)
    whole, _ = found.split(1)
    split = whole.select(F.col("block").alias("group"), "digest", F.explode("starts").alias("start"))
    return found.grouped(Groups()).unionByName(split.withColumn("end", F.col("start") + length)).distinct()


def _kept(length: int):
    schema = pa.schema([("digest", pa.binary()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        for batch in batches:
            for key, text, ranges in zip(batch.column("digest").to_pylist(), _texts(batch.column("text")), batch.column("ranges")):
                spans: list[list[int]] = []
                for first, last in sorted((r["first"], r["last"] + length) for r in ranges.as_py()):
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], last)
                    else:
                        spans.append([first, last])
                at, rest = 0, []
                for first, last in spans:
                    rest.append(text[at:first])
                    at = last
                rest.append(text[at:])
                if out.add(len(text) + 100, key, sum(e - s for s, e in spans), spans, b"".join(rest)):
                    yield out.batch()
        yield out.batch()

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, largest: int = LARGEST_GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept, kept_sha256): every text without the bytes that lie in a string of ``length`` bytes which also starts elsewhere.

    Texts are UTF-8 bytes, ``spans`` array<array<long>> of removed (start, end) in order, ``kept`` the remaining bytes, or null for a text
    that keeps all, ``kept_sha256`` their digest in either case. Places are judged on the input, in the same and in other texts; no match goes from one text to another. Null texts
    are empty. Rows with equal texts are copies of each other, repeated rows too: from ``length`` bytes on they lose everything. A text of
    any length is one row. Other columns are ignored; an empty table gives an empty result.
    """
    found = Candidates(docs, length, largest)
    whole, windows = found.split()
    span = lambda start, n: F.struct(start.alias("first"), (start + n - 1).alias("last"))
    ranges = (
        found.grouped(Ranges()).select("digest", F.array(F.struct("first", "last")).alias("own"))
        .unionByName(whole.select("digest", F.transform("starts", lambda s: span(s, F.col("n"))).alias("own")))
        .unionByName(windows.select("digest", F.array(span(F.col("start"), F.lit(1))).alias("own")))
        .groupBy("digest").agg(F.flatten(F.collect_list("own")).alias("ranges"))
    )
    ddl = "digest binary, n_removed long, spans array<array<long>>, kept binary"
    changed = found.texts.select("digest", "text").join(ranges, "digest").mapInArrow(_kept(length), ddl)
    changed = written(changed.withColumn("kept_sha256", F.sha2("kept", 256)), "changed")
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    rows = docs.select("doc_id", digest(text).alias("digest"), size.alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("own_sha256"))
    copies = rows.where(F.col("n_bytes") >= length).groupBy("digest").count().where("count > 1").select("digest", F.lit(True).alias("copied"))
    none, all_of = F.array().cast("array<array<long>>"), F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    return (
        rows.join(changed, "digest", "left")
        .join(copies, "digest", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(F.col("copied"), all_of).otherwise(F.coalesce("spans", none)).alias("spans"),
            F.when(F.col("copied"), F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
            F.when(F.col("copied"), F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "own_sha256")).alias("kept_sha256"),
        )
    )
