"""Line deduplication and conversation collapse, case by case."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import groupby

from scriptorium.llm.chat import maximal, rendered
from scriptorium.llm.common import table
from scriptorium.llm.line_dedup import deduplicated, without_repeats

A, B, C = "The first of these sentences has nine words in it.", "A second one follows it with eight more words!", "And then there is a third with nine words here?"
PASSAGE = f"{A} {B} {C}"


def plain(rows, run_words=25):
    """Texts by (doc_id, text), sentence by sentence."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        units, gone = [m for m in re.finditer(r"[^.!?\n]*[.!?]+|[^.!?\n]+|\n+", text or "") if m.group().strip()], []
        for m in units:
            key = b" ".join(m.group().encode().lower().split())
            gone.append(key in seen)
            seen.add(key)
        kept, at = "", 0
        for again, group in groupby(zip(gone, units), key=lambda x: x[0]):
            run = [m for _, m in group]
            if again and sum(len(m.group().split()) for m in run) >= run_words:
                kept += text[at : run[0].start()]
                at = run[-1].end()
        out[doc_id, text] = None if text is None else kept + text[at:]
    return out


def test_runs_of_sentences(spark, docs):
    rows = [
        (2, f"Own words here. {PASSAGE} And an end."),
        (1, f"begin {A}\n{B.upper()}  {C}\nlast"),
        (3, PASSAGE),
        (4, None),
        (5, ""),
        (6, f"{A} Between the two stands something else. {B}"),
        (7, f"{A}\n\n{B}\n{C} tail"),
        (8, "Nothing repeated in this text, not one of all these many words that it has, however long it may go on and on."),
        (8, "Nothing repeated in this text, not one of all these many words that it has, however long it may go on and on."),
        (None, f"{PASSAGE} kept"),
    ]
    found = without_repeats(docs(rows)).select("row.*", "removed").collect()
    texts = sorted(((r["doc_id"], r["text"]) for r in found), key=repr)
    assert texts == sorted([(i, plain(rows)[i, t]) for i, t in rows], key=repr)
    assert dict((i, t) for i, t in texts)[3] == "" and dict(texts)[7].endswith(" tail") and dict(texts)[None] == " kept"
    removed = {r["doc_id"]: [(x["start"], x["end"], x["kept_doc_id"]) for x in r["removed"]] for r in found if r["removed"]}
    assert removed[3] == [(0, len(A), 2), (len(A), len(A) + 1 + len(B), 1), (len(A) + 1 + len(B), len(PASSAGE), 1)]
    assert deduplicated(docs(rows)).columns == ["doc_id", "text", "fp"]
    assert deduplicated(docs([])).count() == 0


def test_a_passage_that_all_share_and_a_very_long_text(spark, docs):
    rows = [(i, f"{PASSAGE}\nOwn line number {i} of this text") for i in range(300)] + [(1000, "\n".join([PASSAGE] * 7000))]
    kept = {r["doc_id"]: r["text"] for r in deduplicated(docs(rows)).collect()}
    assert [i for i, t in kept.items() if B in t] == [0]
    assert kept[1000] == "" and all(f"Own line number {i} of" in kept[i] for i in range(300))


def test_passages_of_fifty_words_go_and_clean_documents_stay(spark):
    """Of documents that hold 50 words of an earlier one nine in ten lose them; of those that share no 51 words with another nine in ten lose nothing."""
    rows = sorted((r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.01", "documents").collect())
    holders = defaultdict(set)
    for i, text in rows:
        words = text.lower().split()
        for p in range(len(words) - 50):
            holders[" ".join(words[p : p + 51])].add(i)
    sharing = {i for held in holders.values() if len(held) > 1 for i in held}
    later = {i for held in holders.values() for i in held if i != min(held)}
    lost = {r[0]["doc_id"] for r in without_repeats(table(spark, "/root/testdata/sf0.01", "documents")).collect() if r["removed"]}
    clean = {i for i, _ in rows} - sharing
    assert len(later) > 50 and len(later & lost) >= 0.9 * len(later)
    assert len(clean) > 500 and len(clean & lost) <= 0.1 * len(clean)


def talk(conv, *texts, start=0):
    return [(conv, start + i, "user" if i % 2 == 0 else "assistant", t, "x") for i, t in enumerate(texts)]


def test_snapshots_collapse(spark):
    rows = [
        *talk(1, "a"), *talk(2, "a", "b"), *talk(3, "a", "b", "c"), *talk(4, "a", "x"),
        *talk(6, "a", "b", "c"), *talk(5, "a", "b", "c", start=10), *talk(7, None, "b"), *talk(8, "", "b"),
        (9, None, None, None, "x"), (9, 3, "user", "q", "x"), (None, 0, "user", "a", "x"), (10, 0, "user", "a", "x"), (10, 0, "user", "a", "x"),
        *talk(11, *[f"turn {i}" for i in range(700)]), *talk(12, *[f"turn {i}" for i in range(650)]), *talk(13, *[f"turn {i}" for i in range(256)]),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position string")
    found = {r["conv_id"]: (r["n_turns"], r["n_equal"]) for r in maximal(turns).collect()}
    assert found == {3: (3, 3), 4: (2, 1), 7: (2, 1), 8: (2, 1), 9: (2, 1), 10: (2, 1), 11: (700, 1)}
    texts = {r["conv_id"]: r["text"] for r in rendered(turns).collect()}
    assert texts[4] == "<|user|>\na\n<|end|>\n<|assistant|>\nx\n<|end|>\n" and texts[11].count("<|end|>") == 700
    assert texts[11].index("turn 255\n") < texts[11].index("turn 256\n") < texts[11].index("turn 699\n")
    assert rendered(turns.limit(0)).count() == 0
