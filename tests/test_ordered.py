"""Range-split windows against plain Python, with one key holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import quality, reviews
from scriptorium.operators.ordered import Prior, numbered, ordered_concat, range_segments, with_prior


@pytest.fixture(scope="module")
def skewed():
    random.seed(3)
    rows = []
    for seq in range(3000):
        key = "hot" if random.random() < 0.4 else f"k{random.randint(0, 20)}"
        rows.append((key, seq, random.choice([None, "a", "b", "c"])))
    return rows


def test_hot_key_spans_segments(spark, skewed):
    df = spark.createDataFrame(skewed, "k string, seq int, v string")
    parts = range_segments(df, ["k"], ["seq"]).filter("k = 'hot'").select("_segment").distinct().count()
    assert parts > 1


def test_prior_values_match_a_loop(spark, skewed):
    df = spark.createDataFrame(skewed, "k string, seq int, v string")
    out = with_prior(
        df, ["k"], ["seq"], Prior("lagged", "lag", F.col("v")), Prior("known", "last", F.col("v")), Prior("n", "count"),
        Prior("total", "sum", F.col("seq")),
    )
    state, expected = {}, {}
    for key, seq, value in sorted(skewed, key=lambda r: r[1]):
        before, known, n, total = state.get(key, (None, None, 0, 0))
        expected[seq] = (before, known, n, total)
        state[key] = (value, known if value is None else value, n + 1, total + seq)
    assert {r["seq"]: (r["lagged"], r["known"], r["n"], r["total"]) for r in out.collect()} == expected


def test_numbered_and_concat(spark):
    df = spark.createDataFrame([("a", i, f"t{i}") for i in range(1, 12)], "k string, i int, t string")
    assert [r["n"] for r in numbered(df, ["k"], ["i"], "n").orderBy("i").collect()] == list(range(1, 12))
    parts = ordered_concat(df, ["k"], "i", "t", "|", part_bytes=12).orderBy("part").collect()
    assert [p["rows"] for p in parts] == [4, 4, 3]
    assert "|".join(p["text"] for p in parts) == "|".join(f"t{i}" for i in range(1, 12))


@pytest.mark.parametrize("segment", [1, 2, 3, 4096])
def test_markers_cut_by_page_edges(spark, segment):
    """Counts equal those of the joined text, whatever the segment size."""
    import re

    pattern = r"\[\.\.\.(?:\s*~\s*\d+\s*chars?)?\]"
    pieces = ["a [...", "~", "12", "chars] b", " ~ 7 chars] [...", "", "  ", "x [...] y", "~ 5", "char]", "[... ~", "9 chars]", "1"]
    random.seed(segment)
    pages, expected = [], {}
    for number in range(400):
        texts = [random.choice(pieces) for _ in range(random.randint(1, 9))]
        expected[f"o{number}"] = len(re.findall(pattern, "\n\n".join(texts)))
        pages += [(f"o{number}", i, t, "") for i, t in enumerate(texts, 1)]
    assert sum(expected.values()) > 100
    df = spark.createDataFrame(pages, "object_id string, page int, transcription string, page_type string")
    found = quality.object_measures(df, pages_per_segment=segment).select("object_id", "illegible_markers").collect()
    assert {r["object_id"]: r["illegible_markers"] for r in found} == expected


def test_five_page_fixture(spark):
    pages = [
        ("o", 1, "Erste Zeile\nZweite Zeile\n\nZweiter Absatz\n\nFremder Absatz", ""), ("o", 2, "", "blank"),
        ("o", 3, "Anderer Beitrag", "foreign_text"), ("o", 4, "", "gate_low_resolution"), ("o", 5, "", ""),
    ]
    df = spark.createDataFrame(pages, "object_id string, page int, transcription string, page_type string")
    row = quality.quality_signals(quality.object_measures(df)).first()
    assert (row["total_chars"], row["chars_per_page"], row["needs_review"]) == (71, 14.2, True)
    assert [row[f"{k}_pages"] for k in ("blank", "undeclared_empty", "gate", "foreign", "content")] == [1] * 5
    from scriptorium.plans.assessment import assess

    assert assess(df).first()["overall_status"] == "needs_review"


def review(seq, source, status, time, kind="human", digest="a" * 64, actor="p"):
    return ("o", 1, seq, source, status, actor, kind, time, digest, None)


SCHEMA = (
    "object_id string, page int, seq bigint, from_status string, status string, actor string, actor_kind string, "
    "event_time string, page_state_hash string, note string"
)
DAY = "2024-01-01T10:0{}:00+02:00"


@pytest.mark.parametrize(
    "events, codes",
    [
        ([("machine_unreviewed", "in_review", 0), ("in_review", "human_verified", 1), ("human_verified", "accepted", 2)], set()),
        ([("machine_unreviewed", "accepted", 0)], {"review_not_allowed"}),
        ([("machine_unreviewed", "in_review", 5), ("in_review", "human_verified", 1)], {"review_out_of_order"}),
        ([("in_review", "in_review", 0)], {"review_discontinuous"}),
        ([("machine_unreviewed", "gone", 0), ("machine_unreviewed", "in_review", 1)], {"review_unknown_status", "review_not_allowed"}),
    ],
)
def test_review_history_cases(spark, events, codes):
    rows = [review(i, source, status, DAY.format(minute)) for i, (source, status, minute) in enumerate(events)]
    found = reviews.audit_reviews(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["code"] for r in found} == codes


def test_agent_may_not_decide(spark):
    rows = [
        review(0, "machine_unreviewed", "in_review", DAY.format(0), kind="agent"),
        review(1, "in_review", "human_verified", DAY.format(1), kind="agent", digest="zz"),
        review(2, "human_verified", "in_review", "2024-01-01T10:00:00", kind="robot", actor=" "),
    ]
    found = reviews.audit_reviews(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["seq"], r["code"]) for r in found} == {
        (1, "review_agent_decision"), (1, "review_no_state_hash"), (2, "review_no_actor"),
        (2, "review_unknown_actor_kind"), (2, "review_no_aware_time"),
    }
