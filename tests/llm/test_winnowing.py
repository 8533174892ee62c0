"""Winnowing against a definition written out, and the successor order against a sorted list."""

from __future__ import annotations

import hashlib
import random

import pytest

from scriptorium.llm.common import table
from scriptorium.llm.winnowing import _print, compare_with_edits, digest, edited, likeness, rolled, selected, winnow

import numpy as np

from .conftest import SMALLEST


def plain_selection(hashes, window):
    window = min(window, len(hashes))
    out = []
    for i in range(len(hashes) - window + 1):
        part = hashes[i : i + window]
        at = i + max(j for j in range(window) if part[j] == min(part))
        if not out or out[-1] != at:
            out.append(at)
    return out


def test_selection_takes_the_rightmost_minimum():
    rng = random.Random(3)
    for _ in range(300):
        values = [rng.randrange(5) for _ in range(rng.randrange(1, 40))]
        window = rng.randrange(1, 12)
        assert selected(np.array(values, np.uint64), window).tolist() == plain_selection(values, window)


@pytest.mark.parametrize("gram", [1, 2, 3, 5, 12, 16])
def test_rolled_hashes_depend_on_their_run_alone(gram):
    rng = np.random.default_rng(1)
    points = rng.integers(97, 100, 400).astype(np.uint32)
    hashes = rolled(points, gram)
    assert len(hashes) == 401 - gram
    by_run = {}
    for i, h in enumerate(hashes.tolist()):
        by_run.setdefault(points[i : i + gram].tobytes(), set()).add(h)
    assert all(len(v) == 1 for v in by_run.values())
    assert len({h for v in by_run.values() for h in v}) == len(by_run)


def test_shared_run_of_the_guaranteed_length_shares_a_hash():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    for _ in range(100):
        shared = word(12 + 16 - 1)
        a, b = (winnow(word(40) + shared + word(30))[0] for _ in range(2))
        assert set(a.tolist()) & set(b.tolist())


def test_case_and_space_do_not_matter_and_positions_are_of_the_text():
    plain, spaced = winnow("abcdefghijklmnopqrstuvwxyz"), winnow("ABC def\nghi jkl mno\tpqr stu vwx yz")
    assert plain[0].tolist() == spaced[0].tolist()
    assert all("ABC def\nghi jkl mno\tpqr stu vwx yz"[p] not in " \n\t" for p in spaced[1].tolist())
    assert [len(x) for x in winnow("  ")] == [0, 0] and len(winnow("ab")[0]) == 1


def expected(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        a, e, n = (_print(x, 12, 16) for x in (t, edited(t, after), after))
        sha = hashlib.sha256(edited(t, after).encode()).hexdigest()
        out.append((i, len(t), sha, a[0], e[0], likeness(a[1], e[1]), likeness(a[1], n[1]), a[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(4, "alone text")],
        [(None, "b"), (None, None), (2, ""), (2, ""), (2, "zz"), (9, "the end of it all, and more than a gram of it")],
        [(i * 7 % 101, f"text {i} " * (i % 9)) for i in range(101)],
    ],
)
def test_successors(spark, docs, rows):
    found = [tuple(r) for r in compare_with_edits(docs(rows)).collect()]
    assert sorted(found, key=repr) == expected(rows)


def test_whole_table(spark):
    documents = table(spark, SMALLEST, "documents")
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in compare_with_edits(documents).collect()), key=repr) == expected(rows)
    assert len({digest(*winnow(t)) for _, t in rows}) <= len({t for _, t in rows})
