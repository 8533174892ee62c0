"""Repeated strings against every window of every text."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from scriptorium.llm.common import table
from scriptorium.llm.queries import QUERIES
from scriptorium.llm.repeat_intervals import anchors_of, gram_hashes, leftmost_minima, maximal_groups, repeated_windows, repeats, without_repeats

from .conftest import SMALLEST


def expected(rows, length):
    """(doc_id, n_bytes, n_removed, spans, kept) by counting every window."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if counts[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.uint8), [0]]).astype(int)))
        spans = edges.reshape(-1, 2).tolist()
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


def found(frame, length, **how):
    rows = []
    for r in without_repeats(frame, length, **how).collect():
        kept = None if r["kept"] is None else bytes(r["kept"])
        rows.append((r["doc_id"], r["n_bytes"], r["n_removed"], r["spans"], kept, r["kept_sha256"]))
    return rows


def compare(rows, got, length):
    plain = expected(rows, length)
    assert sorted([(i, n, m, s) for i, n, m, s, *_ in got], key=repr) == [x[:4] for x in sorted([p[:4] for p in plain], key=repr)]
    digests = Counter((i, hashlib.sha256(k).hexdigest()) for i, _, _, _, k in plain)
    assert Counter((i, d) for i, *_, d in got) == digests
    assert all(k is None or hashlib.sha256(k).hexdigest() == d for *_, k, d in got)
    return plain


def test_grams_and_minima():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 3, 500).astype(np.uint8)
    for width in (1, 2, 7, 16, 37):
        hashes = gram_hashes(data, width)
        assert len(hashes) == 501 - width
        same = {}
        for i, h in enumerate(hashes.tolist()):
            assert same.setdefault(data[i : i + width].tobytes(), h) == h
        assert len(set(same.values())) == len(same)
        assert leftmost_minima(hashes, width).tolist() == [i + int(np.argmin(hashes[i : i + width])) for i in range(len(hashes) - width + 1)]
    assert len(gram_hashes(data[:5], 6)) == 0
    h, place, low, high = anchors_of(data.tobytes(), 50)
    starts = [p - d for p, a, b in zip(place, low, high) for d in range(b, a - 1, -1)]
    assert starts == list(range(451)) and (low >= 0).all() and (high <= 34).all()


def random_pieces(rng, n):
    """Texts around one anchor that share parts before and behind it."""
    anchor = b"ANCHOR"
    parts = lambda k: bytes(rng.choice(b"ab") for _ in range(k))
    heads, tails = [parts(14) for _ in range(3)], [parts(14) for _ in range(3)]
    out = []
    for _ in range(n):
        head, tail = bytearray(rng.choice(heads)), bytearray(rng.choice(tails))
        if rng.random() < 0.6:
            head[rng.randrange(14)] = 120
        if rng.random() < 0.6:
            tail[rng.randrange(14)] = 120
        out.append((bytes(head) + anchor + bytes(tail), 0, 14))
    return out


def test_windows_of_one_anchor_against_all_pairs():
    rng = random.Random(2)
    for _ in range(150):
        pieces = random_pieces(rng, rng.randrange(1, 25))
        windows = Counter(text[14 - d : 34 - d] for text, _, _ in pieces for d in range(15))
        for (text, low, high), ranges in zip(pieces, repeated_windows(pieces, 20)):
            assert [d for a, b in ranges for d in range(a, b + 1)] == [d for d in range(15) if windows[text[14 - d : 34 - d]] > 1]


def test_groups_are_maximal_and_hold_all_occurrences():
    rng = random.Random(3)
    for _ in range(60):
        pieces = [(text, high) for text, _, high in dict.fromkeys(random_pieces(rng, 12))]
        seen = set()
        for left, right, members in maximal_groups(pieces, 20):
            text, at = pieces[members[0]]
            own = text[at - left : at + right]
            assert sorted(members) == [i for i, (t, a) in enumerate(pieces) if t[a - left : a + right] == own and a >= left]
            around = [(t[a - left - 1 : a - left], t[a + right : a + right + 1]) for t, a in (pieces[i] for i in members)]
            assert len({x for x, _ in around} | ({"end"} if left == 14 else set())) > 1
            assert len({y for _, y in around}) > 1 or right == 20
            seen.add((left, own))
        for i, (a, _) in enumerate(pieces):
            for b, _ in pieces[:i]:
                left = next((k for k in range(14) if a[13 - k] != b[13 - k]), 14)
                right = next((k for k in range(20) if a[14 + k] != b[14 + k]), 20)
                assert left + right < 20 or (left, a[14 - left : 14 + right]) in seen


def documents(rng):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(16), prose(11)
    rows = [(i, f"{prose(rng.randrange(0, 30))} {passage if i % 2 else other} {prose(rng.randrange(0, 20))}") for i in range(40)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (3, rows[3][1]), (102, None), (103, ""), (104, passage), (105, passage[:49]), (None, rows[5][1][:120])]
    rows.append((400, prose(40)))
    base = prose(60)
    for i in range(20):
        at = rng.randrange(len(base))
        rows.append((200 + i, base[:at] + "#" + base[at + 1 :]))
    rows += [(300, "ab" * 150), (301, "x" * 500), (302, f"{passage} {passage}"), (303, "the one and only " * 20)]
    return rows


@pytest.mark.parametrize("largest", [1000, 8, 1])
def test_texts(spark, docs, largest):
    rows = documents(random.Random(largest))
    got = found(docs(rows), 50, largest=largest)
    plain = compare(rows, got, 50)
    assert sum(m for _, _, m, _, _ in plain) > 2000 and any(m == 0 < n for _, n, m, _, _ in plain)
    groups = repeats(docs(rows), 50, largest=largest).collect()
    by_digest = {hashlib.md5((t or "").encode()).digest(): (t or "").encode() for _, t in rows}
    members = {}
    for r in groups:
        members.setdefault(bytes(r["group"]), set()).add((bytes(r["digest"]), r["start"]))
        assert hashlib.md5(by_digest[bytes(r["digest"])][r["start"] : r["end"]]).digest() == bytes(r["group"])
    assert all(len(m) > 1 for m in members.values())


def test_no_documents_and_short_ones(spark, docs):
    assert without_repeats(docs([])).count() == 0 and repeats(docs([])).count() == 0
    assert found(docs([(1, "short"), (1, "short")]), 400) == [(1, 5, 0, [], None, hashlib.sha256(b"short").hexdigest())] * 2


def test_a_frequent_hash_is_split_over_tasks(spark, docs, monkeypatch):
    from scriptorium.llm import repeat_intervals

    rng = random.Random(4)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = prose(60)
    rows = [(i, prose(30) + passage + prose(150)) for i in range(600)]
    plans, real = {}, repeat_intervals.written

    def watched(df, name):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(repeat_intervals, "written", watched)
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        compare(rows, found(docs(rows), 50), 50)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plans["met"] and "skew=true" in plans["texts"]


def test_query_on_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SMALLEST, "documents").collect()]
    got = QUERIES["op11_interval_tree_repeats"](spark, SMALLEST).collect()
    plain = [(i, n, m, len(s), hashlib.sha256(k).hexdigest()) for i, n, m, s, k in expected(rows, 400)]
    assert sorted(tuple(r) for r in got) == sorted(plain)
