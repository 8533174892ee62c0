"""Metadata and pages from fragments equal those of whole documents, so the size of a document decides nothing."""

from __future__ import annotations

from scriptorium.plans import markup, reading
from scriptorium.queries.markup import fragments
from scriptorium.queries.registry import Tables

SMALLEST = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_fragments_give_what_whole_documents_give(spark):
    found = fragments(Tables(spark, SMALLEST), edits=True)
    whole, oversized = markup.assemble(found)
    headers = markup.skeletons(found)
    assert oversized.count() == 0
    columns = ["object_id", "title", "date", "language", "status", "signature", "input_state_timestamp", "validation_state_hash", "well_formed"]
    assert rows(reading.metadata(headers), *columns) == rows(reading.metadata(whole), *columns)
    pages = reading.pages_of_fragments(found.filter(f"section = {markup.PAGE}"), headers)
    columns = ["object_id", "page", "label", "text", "image"]
    assert rows(pages, *columns) == rows(reading.pages(whole), *columns)
    assert rows(reading.changes(headers), "object_id", "position", "actor", "text") == rows(
        reading.changes(whole), "object_id", "position", "actor", "text"
    )
