"""Fingerprints, shard trees and components against all pairs."""

from __future__ import annotations

import random

import xxhash

from scriptorium.llm.common import table
from scriptorium.llm.components import components
from scriptorium.llm.simhash import Tree, fingerprint, keep_one, links, near_duplicates, shard_links, signed

from .conftest import SMALLEST


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(nodes, joined):
    root = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in joined:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                moved = True
    return root


def plain_pairs(values, radius=2):
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= radius]


def random_prints(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 8)]
    return sorted({rng.choice(centres) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & ((1 << 64) - 1) for _ in range(n)})


def test_fingerprints():
    for text in [None, "", "  \n", "One", "one two", "A b C", "the cat sat on the mat " * 30, "É é ß", "a b c d", "x " * 70000]:
        assert fingerprint(text) == plain_fingerprint(text)


def test_tree_finds_all_within_the_radius():
    values = random_prints(400, 1)
    tree = Tree()
    for v in values:
        tree.add(v)
    for v in values[::7]:
        assert sorted(tree.values[i] for i in tree.near(v)) == [w for w in values if (v ^ w).bit_count() <= 2]
    assert plain_roots(values, shard_links(values)) == plain_roots(values, plain_pairs(values))


def test_links_join_what_all_pairs_join(spark):
    values = random_prints(600, 2) + [0, 1, 3, 7, 15]
    values = sorted(set(values))
    found = links(spark.createDataFrame([(signed(v),) for v in values], "fp long")).collect()
    joined = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in found]
    assert all((a ^ b).bit_count() <= 16 for a, b in joined)
    assert plain_roots(values, joined) == plain_roots(values, plain_pairs(values))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (7, 3), (3, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    assert found == plain_roots(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = plain_roots(set(prints), plain_pairs(sorted(set(prints))))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted(((i, signed(p), least.get(root[p])) for (i, _), p in zip(rows, prints)), key=repr)


def test_documents(spark, docs):
    base = "the quick brown fox jumps over the lazy dog and runs far away from all of the others in the wide green field"
    rows = [(5, base), (3, base.upper()), (9, base), (9, base), (None, base), (1, None), (4, ""), (8, "x"), (2, base + " now " + base)]
    assert sorted((tuple(r) for r in near_duplicates(docs(rows)).collect()), key=repr) == expected(rows)
    assert near_duplicates(docs([])).count() == 0


def test_one_document_of_each_group_stays(spark, docs):
    base = "a b c d e f g h"
    rows = [(5, base), (3, base), (3, base), (None, base), (7, None), (6, ""), (8, "something else entirely")]
    kept = keep_one(docs(rows))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(3, base), (6, ""), (8, "something else entirely")]
    assert keep_one(docs([])).count() == 0


def test_whole_table(spark):
    documents = table(spark, SMALLEST, "documents")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert sorted((tuple(r) for r in near_duplicates(documents).collect()), key=repr) == expected(rows)
