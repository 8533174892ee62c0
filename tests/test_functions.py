import json
import random

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import alignment, hashing, text, values
from scriptorium.plans import ingestion
from scriptorium.sinks import writers

T = F.col("t")


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-01-01T10:00:00+02:00", True), ("2024-01-01T10:00:00Z", True), ("2024-01-01T10:00:00", False),
        ("2024-13-01T10:00:00Z", False), ("gestern", False), ("2024-01-01 10:00+0200", True),
        ("2024-01-01T10:00:00.123456-05", True), ("2024-01-01T10:00:00,5Z", True), ("2024-01-01", False),
    ],
)
def test_aware_timestamps(column_value, value, expected):
    assert column_value(values.is_aware_timestamp(T), t=value) is expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1901", "1901"), ("0000", ""), ("1901-02", "1901-02"), ("1901-13", ""), ("1901-02-28", "1901-02-28"),
        ("1901-02-30", ""), ("um 1901", ""), ("", ""),
    ],
)
def test_partial_dates(column_value, value, expected):
    assert column_value(values.date_when(T), t=value) == expected


def test_symmetric_normalisation(column_value):
    assert column_value(text.normalise_zbz(T), t="«Ah»  „b“ ‹c› d ; e—f so­ft é") == "\"Ah\" \"b\" 'c' d; e-f soft é"


def test_redaction(column_value):
    masked = column_value(text.redact_secrets(T, ["s3cret"]), t="https://x/?a=1&API_KEY=abc&b=2 s3cret")
    assert masked == "https://x/?a=1&API_KEY=[redacted]&b=2 [redacted]"


def test_natural_order(spark):
    names = ["p10.png", "p2.png", "P1.png", "p02a.png", "a.png", "10.png", "9.png"]
    rows = spark.createDataFrame([(n,) for n in names], "t string").orderBy(text.natural_key(T), "t").collect()
    assert [r["t"] for r in rows] == ["9.png", "10.png", "a.png", "P1.png", "p2.png", "p02a.png", "p10.png"]


def test_url_entries_of_map_and_list(spark):
    rows = spark.createDataFrame(
        [('{"10":"https://c","2":"http://b","x":"http://d"}',), ('["http://a","ftp://b",null]',), ("5",)], "t string"
    )
    found = [r["v"] for r in rows.select(values.url_entries(F.parse_json(T)).alias("v")).collect()]
    assert [[(e["page"], e["url"]) for e in entries] for entries in found] == [
        [(2, "http://b"), (10, "https://c")], [(1, "http://a")], [],
    ]


def test_set_digest_is_independent_of_partitioning_but_not_of_order(spark):
    rows = spark.range(1000).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("t"))
    digest = hashing.set_digest(hashing.fields_hash(F.col("id"), T))
    one = rows.coalesce(1).agg(digest.alias("d")).first()["d"]
    many = rows.repartition(13).agg(digest.alias("d")).first()["d"]
    shifted = rows.select((F.col("id") + 1).alias("id"), "t").agg(digest.alias("d")).first()["d"]
    listed = rows.agg(F.collect_list(hashing.fields_hash(F.col("id"), T)).alias("h")).select(
        hashing.array_digest(F.col("h")).alias("d")
    ).first()["d"]
    assert one == many == listed != shifted


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


@pytest.mark.parametrize(
    "reference, hypothesis, expected",
    [
        ("kitten", "sitting", (3, 0)), ("abc def", "abc xdef", (1, 0)), ("", "", (0, 0)), ("", "x", (1, 0)),
        ("Text.", "Text." + " Zusatz" * 13, (0, 91)), ("ab", "abcdefgh", (6, 0)),
    ],
)
def test_split_literals(reference, hypothesis, expected):
    assert alignment.split_distance(reference, hypothesis, 50) == expected


def test_split_sums_to_the_distance():
    random.seed(7)
    for _ in range(300):
        a = "".join(random.choices("abc ", k=random.randint(0, 30)))
        b = "".join(random.choices("abc ", k=random.randint(0, 30)))
        fidelity, scope = alignment.split_distance(a, b, 4)
        assert fidelity + scope == levenshtein(a, b)


def test_the_alignment_along_diagonals_is_that_of_the_columns():
    rng = random.Random(11)
    for _ in range(3000):
        letters = "abcde"[: rng.randrange(1, 6)]
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(2))
        whole = alignment._operations(a, b)
        distance = len(whole) - whole.count("=")
        for most in (distance, distance + 1, distance + 4):
            assert alignment._traced(a, b, alignment._points(a, b, most)) == whole
        assert distance == 0 or alignment._points(a, b, distance - 1) is None
    for _ in range(30):
        a = "".join(rng.choice("abcdefghij ") for _ in range(2000))
        b = list(a)
        for at in rng.sample(range(1900), rng.randrange(60)):
            b[at : at + rng.randrange(3)] = "x" * rng.randrange(9)
        assert alignment._aligned(a, "".join(b)) == alignment._operations(a, "".join(b))


def test_the_alignment_takes_deletions_then_insertions_then_the_diagonal_from_the_end():
    def written_out(a, b):
        table = [[levenshtein(a[:i], b[:j]) for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        i, j, steps = len(a), len(b), []
        while i or j:
            if i and table[i - 1][j] < table[i][j]:
                i, step = i - 1, "d"
            elif j and table[i][j - 1] < table[i][j]:
                j, step = j - 1, "i"
            else:
                i, j = i - 1, j - 1
                step = "=" if a[i] == b[j] else "r"
            steps.append(step)
        return "".join(reversed(steps))

    rng = random.Random(5)
    for _ in range(500):
        letters = "abcde"[: rng.randrange(1, 6)]
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(2))
        whole = written_out(a, b)
        assert alignment._operations(a, b) == whole
        assert alignment._traced(a, b, alignment._points(a, b, len(whole) - whole.count("="))) == whole


@pytest.mark.parametrize("text_", ["aa", "....", "§a", "a§a", "a" * 400])
def test_a_block_behind_a_text_of_few_letters_is_one_insertion(text_):
    assert alignment.split_distance(text_, "#" + text_[1:] + "§" * 60, 50) == (1, 60)


def test_long_texts_that_differ_little_need_no_columns(monkeypatch):
    monkeypatch.setattr(alignment, "_operations", None)
    rng = random.Random(3)
    text_ = "".join(rng.choice("abcdefghij ") for _ in range(400_000))
    assert alignment.split_distance(text_, "#" + text_[1:] + "§" * 60, 50) == (1, 60)


def test_the_alignment_is_the_same_for_every_block_size():
    rng = random.Random(11)
    for _ in range(1000):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60)))
        b = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60)))
        whole = alignment._operations(a, b, 10_000)
        assert all(alignment._operations(a, b, block) == whole for block in (1, 2, 3, 7, 60))
        assert alignment._operations(a, b) == whole
        assert len(whole) - whole.count("=") == levenshtein(a, b)


def test_one_decimal_is_the_nearest_tenth_of_the_binary_value(spark):
    pairs = [(t, n) for n in (1, 2, 3, 4, 7, 8, 20, 40, 60, 1000) for t in range(0, 400)] + [(10**9 + 1, 4), (3, 20), (999_999_999, 20)]
    rows = spark.createDataFrame(pairs, "total long, pages long").select("total", "pages", values.round_one(F.col("total") / F.col("pages")).alias("r"))
    assert [r["r"] for r in rows.collect()] == [round(t / n, 1) for t, n in pairs]
    negative = spark.createDataFrame([(-0.25,), (-0.35,), (-2.0,)], "x double").select(values.round_one(F.col("x")).alias("r"))
    assert [r["r"] for r in negative.collect()] == [round(x, 1) for x in (-0.25, -0.35, -2.0)]


@pytest.mark.parametrize("inner", ["a,\nb", "{\nx", "x\n}", "[\n", "\n]", 'say \\"a\\",\nb', "back\\\\\nslash", "\n" * 3000 + ","])
def test_raw_newlines_in_strings_are_repaired_beside_structural_characters(spark, inner):
    answer = '{\n"pages":\n[{"page":1,\n"transcription":"' + inner + '"}\n]\n}'
    calls = spark.createDataFrame([(answer,)], "answer string")
    found = ingestion.with_parsed(calls).select(F.expr("doc:pages[0].transcription::string").alias("t")).collect()[0]["t"]
    assert found == json.loads('"' + inner.replace("\n", "\\n") + '"')


def test_report_values_round_the_binary_value(spark):
    values_ = [0.8203125, 0.7890625, 0.1234565, 0.0000005, 0.5, 0.0, 12.3456785, 2.0, 1 / 3, 1.0000015, 123456789.1234565]
    rng = random.Random(5)
    values_ += [rng.randrange(1, 3000) / rng.randrange(1, 2100) for _ in range(3000)] + [n / 128 for n in range(400)] + [(2 * n + 1) / 2e6 for n in range(500)]
    records = spark.createDataFrame(
        [(f"f{i:05d}", "cer", "ok", v, 1, "hsa-strict") for i, v in enumerate(values_)], "fixture_id string, metric string, status string, value double, n int, profile string"
    )
    totals = spark.createDataFrame([], "metric string, profile string, method string, n_fixtures long, value double")
    errors = spark.createDataFrame([], "fixture_id string, stage string, message string")
    lines = writers.report_lines(records, totals, errors).filter("section = 7").orderBy("position").collect()
    assert [r["line"].split(" | ")[3] for r in lines] == [f"{v:.6f}" for v in values_]
