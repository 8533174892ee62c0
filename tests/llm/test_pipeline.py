"""The pipeline's stages against plain versions, and the registered names."""

from __future__ import annotations

import corpus_pipeline
import sentencepiece

from scriptorium.llm.common import table, written
from scriptorium.llm.queries import QUERIES, piece_model

from .conftest import SMALLEST
from .test_decontamination import expected as contaminated
from .test_line_dedup_and_chat import plain as plain_lines
from .test_near_copies import plain_shingles, similarity


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = table(spark, SMALLEST, "documents")
    names, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SMALLEST), name)
        assert docs.columns == names
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    language, near, lines, clean = kept.values()
    sets = {i: plain_shingles(t) for i, t in language.items()}
    assert all(similarity(sets[a], sets[b]) < 0.8 for a in near for b in near if a < b)
    assert all(any(similarity(sets[i], sets[k]) >= 0.8 for k in sets if k < i) for i in set(language) - set(near))
    assert set(lines) == set(near)
    expected_lines = plain_lines(list(near.items()))
    assert lines == {i: t for (i, _), t in expected_lines.items()}
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALLEST, "benchmark").collect()]
    assert set(clean) == {r[0] for r in contaminated(list(lines.items()), items) if not r[2]}
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    found = corpus_pipeline.STAGES[-1][1](spark, docs, SMALLEST).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(library.encode(t)) for i, t in clean.items()}
    assert corpus_pipeline.run(spark, SMALLEST).count() == len(clean)
