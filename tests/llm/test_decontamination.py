"""Decontamination on small tables, with the window set in the plan and joined."""

from __future__ import annotations

import re

import pytest

from scriptorium.llm.decontamination import contamination, drop_contaminated

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEM = "One two three four five six seven eight nine ten eleven twelve"
DOCS = [
    (1, f"before it {ITEM.upper()} and after it"),
    (2, "one two three four five six seven eight nine TEN, eleven"),
    (3, "one two three four five six seven eight nine other ten"),
    (4, "so Short, item! here"),
    (5, None),
    (6, ""),
    (7, "..."),
    (7, "short item"),
    (7, "short item"),
    (None, f"{ITEM} {ITEM} short ITEM"),
    (8, "Éa one"),
    (9, "word " * 5000 + ITEM),
]
ITEMS = [(1, ITEM), (2, "short item"), (3, None), (4, "--"), (5, ITEM), (None, "éA one"), (7, "Éa ONE")]


def expected(docs, items, n=10):
    split = lambda t: WORD.findall("".join(c.lower() if c < "\x80" else c for c in t or ""))
    windows = {}
    for item, text in items:
        w = split(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w = split(text)
        hit, found = set(), set()
        for window, own in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= {str(x) for x in own if x is not None}
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_set", [1000, 0])
def test_words_and_items(spark, docs, max_set):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc_id int")
    found = contamination(docs(DOCS), items, max_set=max_set).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=repr) == expected(DOCS, ITEMS)
    spans = {r["doc_id"]: [tuple(s) for s in r["hit_spans"]] for r in found if r["doc_id"] in (1, 2, 3, 9)}
    assert spans == {1: [(3, 14)], 2: [(1, 11)], 3: [], 9: [(5001, 5012)]}


@pytest.mark.parametrize("max_set", [1000, 0])
def test_clean_documents_stay_with_all_columns(spark, docs, max_set):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = drop_contaminated(docs(DOCS), items, max_set=max_set)
    assert kept.columns == ["doc_id", "text", "fp"]
    clean = sorted((d, t) for (d, t) in DOCS if d is not None and not any(r[2] for r in expected([(d, t)], ITEMS)) and t is not None)
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("text IS NOT NULL").collect()) == clean
    assert kept.where("text IS NULL").count() == 1


@pytest.mark.parametrize("max_set", [1000, 0])
def test_empty_tables(spark, docs, max_set):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in contamination(docs([(1, "a b")]), none, max_set=max_set).collect()] == [0]
    assert drop_contaminated(docs([(1, "a b")]), none, max_set=max_set).count() == 1
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination(docs([]), items, max_set=max_set).count() == 0
