"""Edit distance split into recognition errors and inserted blocks.

One minimal alignment decides the split, for pairs of every length. It is found with the bit-parallel column recurrence
of Myers and Hyyrö; Python integers serve as bit vectors. The traceback runs from the end and prefers a deletion, then an
insertion, then the diagonal. Of the columns only every k-th is kept (k is the root of their number) and the ones between
are computed again when the traceback gets there, so memory grows with the root of the second text's length.

Pairs that differ little are aligned along diagonals first (Ukkonen's furthest reaching points): their work grows with the
square of the distance and not with the lengths, and the traceback over these points is the same alignment.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

from pyspark.sql.types import IntegerType, StructField, StructType

from .rows import by_row

#: Vertical +1 and -1 differences of one column.
Column = tuple[int, int]


def _places(source: str) -> dict[str, int]:
    """The positions of each character as a bit vector."""
    listed: dict[str, list[int]] = {}
    for i, char in enumerate(source):
        listed.setdefault(char, []).append(i)
    return {char: _bits(at, len(source)) for char, at in listed.items()}


def _bits(positions: list[int], size: int) -> int:
    raw = bytearray(size // 8 + 1)
    for i in positions:
        raw[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(raw, "little")


def _columns(places: dict[str, int], full: int, start: Column, target: str) -> Iterator[tuple[Column, int]]:
    """The columns after each character of ``target``, from the column ``start`` on, and where each is one above the column before."""
    up, down = start
    for char in target:
        match = places.get(char, 0)
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right = down | (full & ~(diagonal | up))
        left = ((diagonal & up) << 1) & full
        above = ((right << 1) | 1) & full
        up, down = left | (full & ~(diagonal | above)), above & diagonal
        yield (up, down), right


def _operations(source: str, target: str, block: int | None = None) -> str:
    """Minimal alignment as one letter per step: d, i, r or = in text order; the same for every ``block``."""
    if not source or not target:
        return "d" * len(source) + "i" * len(target)
    places, full = _places(source), (1 << len(source)) - 1
    block = block or isqrt(len(target)) + 1
    kept = [(full, 0)]
    for j, (column, _) in enumerate(_columns(places, full, kept[0], target), 1):
        if j % block == 0:
            kept.append(column)
    steps: list[str] = []
    i, j, first, columns = len(source), len(target), len(target), []
    while i and j:
        if j <= first:  # columns first + 1 ... first + block of the block that ends at or behind j
            first = (j - 1) // block * block
            columns = [(up, right) for (up, _), right in _columns(places, full, kept[first // block], target[first : first + block])]
        deletes, inserts = columns[j - first - 1]
        if (deletes >> (i - 1)) & 1:
            i -= 1
            steps.append("d")
        elif (inserts >> (i - 1)) & 1:
            j -= 1
            steps.append("i")
        else:
            i, j = i - 1, j - 1
            steps.append("=" if source[i] == target[j] else "r")
    steps.extend("d" * i + "i" * j)
    return "".join(reversed(steps))


def _common(source: str, target: str, i: int, j: int) -> int:
    """Length of the common run of characters from ``source[i]`` and ``target[j]`` on."""
    run, size, left = 0, 16, min(len(source) - i, len(target) - j)
    while run < left and source[i + run] == target[j + run]:
        size = min(size, left - run)
        if source[i + run : i + run + size] == target[j + run : j + run + size]:
            run, size = run + size, size * 4
        elif size <= 16:
            run += 1
        else:
            size = size // 4
    return run


#: Furthest source position on each diagonal (source minus target position), one table per number of errors.
Points = list[dict[int, int]]


def _points(source: str, target: str, most: int) -> Points | None:
    """Furthest points up to the distance, null if it is above ``most``; diagonals that no alignment of ``most`` errors uses are left out."""
    apart = len(source) - len(target)
    points: Points = []
    for errors in range(most + 1):
        before, now = points[-1] if points else {}, {}
        for diagonal in range(max(-errors, apart - most + errors), min(errors, apart + most - errors) + 1):
            i = max(before.get(diagonal, -1) + 1, before.get(diagonal - 1, -1) + 1, before.get(diagonal + 1, -1))
            i = min(i, len(source), len(target) + diagonal)
            now[diagonal] = i + _common(source, target, i, i - diagonal)
        points.append(now)
        if now.get(apart) == len(source):
            return points
    return None


def _traced(source: str, target: str, points: Points) -> str:
    """The alignment of ``_operations`` from the furthest points: on a diagonal nothing but matches lies between two choices."""
    i, diagonal, steps = len(source), len(source) - len(target), []
    for before in reversed([{}, *points[:-1]]):
        # a deletion or insertion is possible up to these positions, a replacement at one alone
        deleted, inserted = min(i, before.get(diagonal - 1, -2) + 1), min(i, before.get(diagonal + 1, -1))
        replaced = before.get(diagonal, -2) + 1
        last = max(deleted, inserted, replaced, 0)
        steps.append("=" * (i - last))
        i = last
        if not before:
            break
        if deleted == last:
            i, diagonal = i - 1, diagonal - 1
            steps.append("d")
        elif inserted == last:
            diagonal += 1
            steps.append("i")
        else:
            i -= 1
            steps.append("r")
    return "".join(steps)[::-1]


def _aligned(source: str, target: str) -> str:
    """Minimal alignment: along diagonals as long as that is the lesser part of the work of all columns."""
    apart = abs(len(source) - len(target))
    spare, work = 4, len(target) * (8000 + len(source)) // 8000
    while (spare + 1) * (apart + spare + 1) <= work:
        points = _points(source, target, apart + spare)
        if points is not None:
            return _traced(source, target, points)
        spare *= 4
    return _operations(source, target)


def split_distance(reference: str, hypothesis: str, block_min: int) -> tuple[int, int]:
    """(errors, inserted characters of blocks of at least block_min)."""
    start, end = 0, 0
    shorter = min(len(reference), len(hypothesis))
    while start < shorter and reference[start] == hypothesis[start]:
        start += 1
    while end < shorter - start and reference[-1 - end] == hypothesis[-1 - end]:
        end += 1
    steps = _aligned(reference[start : len(reference) - end], hypothesis[start : len(hypothesis) - end])
    runs = [len(run) for run in steps.replace("=", " ").replace("d", " ").replace("r", " ").split()]
    scope = sum(run for run in runs if run >= block_min)
    return len(steps) - steps.count("=") - scope, scope


def edit_split(block_min: int):
    """Column function (reference, hypothesis) -> struct<fidelity, scope>, Arrow batches."""
    schema = StructType([StructField("fidelity", IntegerType()), StructField("scope", IntegerType())])

    def split(reference: str, hypothesis: str) -> dict[str, int]:
        return dict(zip(schema.names, split_distance(reference, hypothesis, block_min)))

    return by_row(split, schema)
