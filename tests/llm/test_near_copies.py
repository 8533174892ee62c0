"""Near copies against all pairs."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest

from scriptorium.llm.near_copies import without_near_copies
from scriptorium.session import checkpoint_dir

from .conftest import SMALLEST


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(words, rng, n):
    words = list(words)
    for at in rng.sample(range(0, len(words), 6), n):
        words[at] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def test_near_copies_go_whatever_their_fingerprints(spark, docs):
    rng = random.Random(3)
    rows, sets = [], {}
    for group in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for i, edits in enumerate([0, 5, 5, 6, 20, 30]):
            rows.append((100 * group + i, edited(base, rng, edits)))
    rows += [(3000, None), (3001, " \n"), (None, rows[0][1]), (0, rows[0][1])]
    kept = sorted(r["doc_id"] for r in without_near_copies(docs(rows)).collect())
    sets = {i: plain_shingles(t) for i, t in rows if i is not None}
    assert all(similarity(sets[a], sets[b]) < 0.8 for a in kept for b in kept if a < b)
    for i in set(sets) - set(kept):
        assert any(similarity(sets[i], sets[k]) >= 0.8 for k in sets if k < i)
    assert [i for i in kept if i < 100 and i % 100 in (0, 4, 5)] == [0, 4, 5]
    assert without_near_copies(docs([])).count() == 0


@pytest.mark.parametrize("largest", [1000, 4])
def test_a_large_shard_is_dealt_in_parts_that_meet(spark, docs, largest):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, edited(base, rng, 8)) for i in range(40)] + [(100 + i, edited(base, rng, 0)) for i in range(5)]
    rows += [(200 + i, edited(base, rng, 1)) for i in range(30)]
    sets = {i: plain_shingles(t) for i, t in rows}
    kept = [r["doc_id"] for r in without_near_copies(docs(rows), largest).collect()]
    assert all(similarity(sets[a], sets[b]) < 0.8 for a in kept for b in kept if a < b)
    for i in set(sets) - set(kept):
        assert any(similarity(sets[i], sets[k]) >= 0.8 for k in sets if k < i)


def test_long_texts_ties_and_tables_on_the_way(spark, docs, tmp_path):
    rng = random.Random(6)
    long = [f"w{rng.randrange(10**6)}" for _ in range(30_000)]
    rows = [(2, " ".join(long)), (1, edited(long, rng, 500)), (7, "same words here for all of them"), (7, "same words here for all of them!")]
    rows += [(8, rows[2][1]), (9, ""), (9, None), (10, " ")]
    before = set(Path(checkpoint_dir(spark).removeprefix("file://")).glob("*"))
    found = without_near_copies(docs(rows))
    kept = sorted((r["doc_id"], r["text"]) for r in found.collect())
    assert [(i, t[:20]) for i, t in kept if t] == [(1, rows[1][1][:20]), (7, rows[2][1][:20]), (7, rows[2][1][:20])]
    assert [i for i, t in kept if not t] == [9]
    made = set(Path(checkpoint_dir(spark).removeprefix("file://")).glob("*")) - before
    assert {p.name.rpartition("-")[0].partition("-")[0] for p in made} <= {"staying"} | {p.name for p in made if not p.name[0].isalpha()}


def test_recall_at_the_least_similarity(spark):
    """All pairs of sf0.01 with a similarity of 0.8 or more: nine of ten at least have one row less afterwards."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    sets = {i: plain_shingles(t) for i, t in rows}
    holders = {}
    for i, own in sets.items():
        for gram in own:
            holders.setdefault(gram, []).append(i)
    shared = Counter((a, b) for held in holders.values() if len(held) < 200 for n, b in enumerate(held) for a in held[:n])
    pairs = [(a, b) for (a, b), n in shared.items() if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8]
    kept = {r["doc_id"] for r in without_near_copies(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    assert len(pairs) > 50 and sum(not (a in kept and b in kept) for a, b in pairs) >= 0.98 * len(pairs)


def test_stage_leaves_no_near_copies(spark):
    documents = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    kept = stage(spark, documents, SMALLEST)
    assert kept.columns == documents.columns
    sets = [plain_shingles(r["text"]) for r in kept.collect()]
    assert all(similarity(a, b) < 0.8 for i, a in enumerate(sets) for b in sets[:i])
