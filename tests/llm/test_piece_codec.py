"""The piece codec against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
import sentencepiece

from scriptorium.llm.piece_codec import Codec, Shared, Vocabulary, decode, encode, round_trip
from scriptorium.llm.queries import piece_model


@pytest.fixture(scope="module")
def codec():
    return Codec(Vocabulary.read(piece_model()))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


FIXED = ["", "a", " ", "  a", " a b  c   ", "▁x", "<s>", "<0x0A>\n\n", "日本語テキスト" * 50, "a" * 3000, " " * 5000 + "the", "==" * 1500, "\x00a", "😀😀x"]


def test_encoding_and_decoding_of_texts(codec, library):
    rng = random.Random(4)
    alphabet, names = list("the anding  ▁▁éß日本😀=-.\n\t01aAeE<>"), codec.vocabulary.pieces[259:]
    texts = FIXED + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(1500)]
    texts += ["".join(rng.choice(names) for _ in range(rng.randrange(12))) for _ in range(1500)]
    texts += ["".join(rng.choice("ab=- ") * rng.randrange(1, 40) for _ in range(rng.randrange(12))) for _ in range(300)]
    expected = library.encode(texts, num_threads=1)
    assert [x.tolist() for x in codec.encode(texts)] == expected
    assert [codec.decode(x) for x in expected] == [library.decode(x) for x in expected]


def test_decoding_of_any_ids(codec, library):
    rng = random.Random(5)
    pick = lambda: rng.choice([rng.randrange(32000), rng.randrange(301), 259, rng.randrange(131, 259)])
    lists = [[pick() for _ in range(rng.randrange(9))] for _ in range(4000)]
    assert [codec.decode(x) for x in lists] == [library.decode(x) for x in lists]


def test_long_runs_take_no_quadratic_time(codec):
    started = time.process_time()
    for text in ["a" * 200_000, " " * 200_000 + "b", "=-" * 100_000]:
        assert codec.decode(codec.encode([text])[0]) == text
    assert time.process_time() - started < 20


def test_columns(spark, library):
    texts = [None, "", "Some text.\nMore of it", "x " * 20000, "Some text.\nMore of it"]
    shared = Shared.of(spark, piece_model())
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", encode("text", shared).alias("ids"), round_trip("text", shared).alias("r"))
    found = rows.select("*", decode("ids", shared).alias("back")).collect()
    for row in found:
        ids = library.encode(row["text"] or "")
        assert row["ids"] == ids and row["back"] == library.decode(ids) and row["r"]["n_tokens"] == len(ids)
        assert row["r"]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["r"]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_words_that_come_once_are_not_kept(codec, library):
    """What a worker holds after a batch follows the words that come again, not all words."""
    own = Codec(codec.vocabulary)
    texts = ["again once1 again", "again once2"]
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts)
    assert set(own.kept) == {"▁again"}
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts)
