"""Queries over foreign markup, for texts without a single ASCII letter."""

import pytest

from __spark_entry__ import queries


@pytest.mark.parametrize(
    "name, column, expected",
    [
        ("job12_foreign_title", "title", {"doc-1": "Brüder & ", "doc-2": "Brüder & wort", "doc-3": "Brüder & "}),
        ("job13_foreign_character_data", "text", {f"doc-{n}": word + ' <x & y> ü&#65;&lt; 😀 "q"' for n, word in ((1, ""), (2, "wort"), (3, ""))}),
    ],
)
def test_texts_without_ascii_letters(spark, tmp_path, name, column, expected):
    rows = [(1, "1234 ééé ¶"), (2, " wort und"), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries()[name](spark, str(tmp_path)).collect()
    assert {r["object_id"]: r[column] for r in found} == expected
