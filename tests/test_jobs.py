"""Jobs on files and small fixtures: sources, markup, evaluation, sinks, streams."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import contract, json_parts
from scriptorium.plans import audit, catalog, evaluation, markup, reading, review, structure
from scriptorium.session import checkpoint_dir, checkpointed, scratch
from scriptorium.sinks import writers
from scriptorium.sources import files, manifests, transcriptions


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture
def corpus(tmp_path):
    good = {"object_id": "a", "pages": [{"page": 1, "transcription": "x"}]}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({**good, "object_id": "c"}))
    (tmp_path / "d.json").write_text("{broken")
    (tmp_path / "errors.json").write_text("[]")
    return str(tmp_path)


def test_transcription_folder(spark, corpus):
    documents, errors = transcriptions.read_transcriptions(spark, corpus)
    assert rows_of(documents, "object_id") == [("a",)]
    assert rows_of(errors, "object_id", "stage") == [("b", "contract"), ("d", "read")]
    counts = transcriptions.count_pages(transcriptions.read_text_files(spark, corpus))
    assert rows_of(counts, "object_id", "pages") == [("a", 1), ("b", 1), ("d", 1), ("errors", 1)]


def test_malformed_documents_are_findings(spark):
    shapes = [
        "[]", "5", '""', "{", '{"pages":5}', '{"pages":[5,null,"x"]}', '{"object_id":[1],"_meta":7,"pages":[{"page":true,"review":[]}]}',
        '{"object_id":"h","_meta":{"timestamp":5,"pipeline_step":"3","source_images":[1]},"pages":[{"page":1,"transcription":{},"foreign_paragraphs":{"a":1},"edits":[3],"review":{"history":[4]}}]}',
    ]
    df = spark.createDataFrame([(f"o{i}", s) for i, s in enumerate(shapes)], "object_id string, value string")
    found = audit.audit(df)
    assert {r["object_id"] for r in found.collect()} == {f"o{i}" for i in range(len(shapes))}
    clean, errors = audit.split_by_audit(df)
    assert clean.count() == 0 and errors.filter("stage = 'contract'").count() > len(shapes)


def test_file_listing_and_manifest(spark, tmp_path):
    folder = tmp_path / "images" / "doc1"
    folder.mkdir(parents=True)
    for name in ("p10.png", "p2.PNG", "notes.md"):
        (folder / name).write_bytes(name.encode())
    (folder / "manifest.json").write_text("{}")
    (tmp_path / "letter.pdf").write_bytes(b"pdf")
    listed = files.list_files(spark, str(tmp_path))
    assert rows_of(files.classify_sources(listed), "doc_id", "source_type", "pages", "path") == [
        ("doc1", "image", 2, "images/doc1"), ("letter", "pdf", 1, "."),
    ]
    ordered = files.natural_order(files.page_images(listed), "filename").collect()
    assert [r["filename"] for r in ordered] == ["p2.PNG", "p10.png"]
    hashed = files.image_hashes(files.list_files(spark, str(tmp_path), content=True))
    digest = hashed.filter("path = 'letter.pdf'").first()["actual"]
    checks = [("o", 1, "letter.pdf", digest, None), ("o", 2, "gone.pdf", digest, None), ("o", 3, "../x", digest, None)]
    manifest = spark.createDataFrame(checks, "object_id string, page int, filename string, sha256 string, error string")
    disk = hashed.select(F.lit("o").alias("object_id"), F.col("path").alias("filename"), "actual")
    assert rows_of(files.verified_manifest(manifest, disk), "page", "problem") == [(1, None), (2, "missing"), (3, "filename")]


def test_other_readers(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"version": "0.2", "documents": []}))
    documents, errors = manifests.read_source_manifest(spark, str(tmp_path / "m.json"))
    assert documents.count() == 0 and errors.count() == 1
    calls = tmp_path / "calls" / "obj"
    calls.mkdir(parents=True)
    (calls / "1.json").write_text(json.dumps({"chunk": 1, "attempt": 1, "pages": [1, 2], "answer": "{}"}))
    assert rows_of(manifests.read_call_records(spark, str(tmp_path / "calls")), "object_id", "chunk", "answer") == [("obj", 1, "{}")]
    proposals = tmp_path / "proposals" / "obj"
    proposals.mkdir(parents=True)
    (proposals / "p1.json").write_text(json.dumps({"version": "v", "page": 1}))
    (proposals / "p2.json").write_text("nope")
    assert rows_of(manifests.read_proposals(spark, str(tmp_path / "proposals")), "id", "error") == [
        ("p1", None), ("p2", "Unreadable proposal"),
    ]


TEI = (
    '<?xml version="1.0"?>\n<tei:TEI xmlns:tei="http://www.tei-c.org/ns/1.0"><tei:teiHeader><tei:fileDesc><tei:titleStmt>'
    "<tei:title>A &amp; B</tei:title></tei:titleStmt><tei:sourceDesc><tei:date>um 1900</tei:date></tei:sourceDesc></tei:fileDesc>"
    '<tei:revisionDesc status="accepted"/></tei:teiHeader><tei:facsimile><tei:graphic xml:id="f1" url="https://x/1.jpg"/></tei:facsimile>'
    '<tei:text><tei:body><tei:p>lost</tei:p><tei:pb n="1r" facs="#f1"/><tei:p>eins<tei:lb/>zwei</tei:p><tei:note type="editorial">ed</tei:note>'
    '<tei:pb/><tei:head>Kopf</tei:head><tei:p>a<tei:choice><tei:sic>x</tei:sic><tei:corr>y</tei:corr></tei:choice>b</tei:p></tei:body></tei:text></tei:TEI>'
)


def test_reading_prefixed_markup(spark, tmp_path):
    (tmp_path / "t.xml").write_text(TEI)
    (tmp_path / "bad.xml").write_text("<TEI><p></TEI>")
    documents, errors = manifests.markup_documents(spark, str(tmp_path))
    assert rows_of(errors, "object_id", "stage") == [("bad", "read")]
    meta = reading.metadata(documents).first()
    assert (meta["title"], meta["date"], meta["status"]) == ("A & B", "um 1900", "accepted")
    assert rows_of(reading.pages(documents), "page", "label", "text", "image") == [
        (1, "1r", "eins\nzwei\n\ned", "https://x/1.jpg"), (2, "2", "Kopf\n\naxyb", ""),
    ]
    assert rows_of(manifests.remote_images_of_markup(documents), "object_id", "page", "url") == [("t", 1, "https://x/1.jpg")]
    body = F.col("markup")
    texts = documents.select(
        *[reading.comparison_reader(mode)(body).alias(mode) for mode in ("itertext", "edition", "comparison")]
    ).first()
    assert texts["itertext"] == "losteinszweiedKopfaxyb"
    assert texts["edition"] == "losteinszweiKopfaxyb"
    assert texts["comparison"] == "lost\n\neins zweied\n\nKopfayb"


def test_catalog_document_and_oversized_fragments(spark):
    objects = spark.createDataFrame([("o", "T", "accepted", "h", "2024-01-01T00:00:00Z")], "object_id string, title string, document_status string, state_hash string, input_timestamp string")
    pages = spark.createDataFrame(
        [("o", 1, "a[?] <b>\n\nc", "", "", [1]), ("o", 2, "", "", "", []), ("o", 3, "x", "foreign_text", "", [])],
        "object_id string, page int, transcription string, page_type string, notes string, foreign_paragraphs array<int>",
    )
    edits = spark.createDataFrame(
        [("o", 1, 1, "e1", "P & Q", "human", "2024-01-01T10:00:00Z", "Grund")],
        "object_id string, page int, seq int, edit_id string, actor string, actor_kind string, event_time string, note string",
    )
    fragments = markup.document_fragments(objects, pages, edits)
    documents, large = markup.assemble(fragments)
    text = documents.first()["markup"]
    assert '<p><unclear>a</unclear> &lt;b&gt;</p>' in text and '<note type="foreign">c</note>' in text
    assert '<pb n="1" xml:id="review-page-1"/>' in text and large.count() == 0
    assert structure.conformance(fragments).first()["status"] == "valid" == structure.conformance(structure.as_fragments(documents)).first()["status"]
    changes = reading.changes(documents).filter("type = 'transcription-correction'").first()
    assert (changes["actor"], changes["text"], changes["target"]) == ("P & Q", "Grund", "#review-page-1")
    none, all_fragments = markup.assemble(fragments, max_chars=10)
    assert none.count() == 0 and all_fragments.count() == fragments.count()
    assert markup.round_trip_totals(markup.round_trip(pages, fragments)).first()["plaintext_exact"]
    broken = fragments.withColumn("fragment", F.replace("fragment", F.lit("x</note>"), F.lit("y</note>")))
    assert rows_of(markup.round_trip(pages, broken).filter("NOT exact"), "page") == [(3,)]


def test_evaluation_of_mixed_kinds(spark):
    sides = [
        ("f1", "hsa-strict", "reference", "text", "kitten", None), ("f1", "hsa-strict", "hypothesis", "text", "sitting", None),
        ("f2", "zbz-fidelity", "reference", "tei-edition", TEI, None),
        ("f2", "zbz-fidelity", "hypothesis", "transcription-json", json.dumps({"pages": [{"page": 2, "transcription": "Kopf {a}yb"}, {"page": 1, "transcription": "lost eins zweied"}]}), [1, 2, 9]),
        ("f3", "hsa-strict", "reference", "text", "  ", None), ("f3", "hsa-strict", "hypothesis", "text", "x", None),
    ]
    df = spark.createDataFrame(sides, "fixture_id string, profile string, side string, kind string, content string, pages array<int>")
    records, errors = evaluation.cer_records(evaluation.pair_sides(df))
    assert rows_of(records, "fixture_id", "distance", "n") == [("f1", 3, 6), ("f2", 1, 24)]
    assert rows_of(errors, "fixture_id") == [("f3",)]
    combined = evaluation.with_error_records(records, errors)
    aggregates = {r["profile"]: r for r in evaluation.aggregates(combined).collect()}
    assert aggregates["hsa-strict"]["value"] == 0.5 and aggregates["zbz-fidelity"]["method"] == "fixture-mean"
    lines = writers.report_lines(combined, evaluation.aggregates(combined), errors).collect()
    assert "| cer | hsa-strict | char-weighted | 1 | 0.500000 |" in {r["line"] for r in lines}


def test_publishing_only_changes(spark, tmp_path):
    path = str(tmp_path / "published")
    schema = "object_id string, sha256 string"
    first = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], schema)
    writers.publish_changed(first, path, buckets=4)
    second = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], schema)
    assert rows_of(writers.publish_changed(second, path, buckets=4), "object_id") == [("b",), ("c",), ("d",)]
    assert rows_of(writers.read_published(spark, path), "object_id", "sha256") == [("a", "1"), ("b", "2"), ("d", "1")]
    assert writers.publish_changed(second, path, buckets=4).count() == 0


def test_plain_sinks(spark, tmp_path):
    errors = spark.createDataFrame([("o", "e", "read")], "object_id string, error string, stage string")
    path = str(tmp_path / "errors")
    writers.write_errors(errors, path)
    writers.write_errors(errors.filter("false"), path)
    assert spark.read.parquet(path).count() == 0
    inventory = spark.createDataFrame(
        [("b", "pdf", 1, "pdf", ".", True), ("a", "text", 2, "txt", "text", False)],
        "id string, source_type string, pages int, format string, path string, transcribable boolean",
    )
    writers.write_inventory(inventory, str(tmp_path / "inventory"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "inventory" / "markdown")).collect()]
    assert "| a | text | 2 | txt | text | no, no page images |" in lines and len(lines) == 4
    documents = spark.createDataFrame([("o", "<a>\n</a>\n")], "object_id string, markup string")
    writers.write_markup(documents, str(tmp_path / "tei"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "tei" / "object_id=o")).collect()][:2] == ["<a>", "</a>"]


def test_german_sort_and_search(spark):
    rows = spark.createDataFrame(
        [("1", "Zebra"), ("2", "Äpfel"), ("3", "Banane")], "id string, title string"
    ).selectExpr("id", "title", "'' AS signature", "'' AS date", "'' AS language", "1 AS page_count", "'' AS status")
    assert [r["title"] for r in catalog.sort_catalog(rows, "title").collect()] == ["Äpfel", "Banane", "Zebra"]
    assert rows_of(catalog.search(rows, "ÄPF"), "id") == [("2",)]


def test_transition_batch(spark):
    rows = [
        ("o", 1, "in_review", "p", "human", "machine_unreviewed"), ("o", 2, "accepted", "p", "human", "in_review"),
        ("o", 3, "human_verified", "p", "agent", "in_review"), ("o", 4, "in_review", " ", "human", "accepted"),
        ("o", 5, "in_review", "p", "human", None),
    ]
    df = spark.createDataFrame(rows, "object_id string, page int, requested_status string, actor string, actor_kind string, current_status string")
    accepted, rejected = review.apply_transitions(df)
    assert rows_of(accepted, "page") == [(1,)]
    assert rows_of(rejected, "page", "reason") == [(2, "not_allowed"), (3, "agent_decision"), (4, "no_actor"), (5, "unknown_page")]


def test_documents_in_chunks_equal_whole_ones(spark):
    """Every way of a large document on small ones: same documents, pages and broken rules."""
    from scriptorium.queries.contract import corpus as built, mutated
    from scriptorium.queries.registry import Tables

    files = mutated(Tables(spark, "/root/testdata/sf0.001")).select("object_id", "value")
    shown = ["object_id", F.to_json("raw").alias("raw"), "position", "recorded_type"]
    whole, pages = contract.parsed(files)
    found, elements = contract.parsed(files, large=0)
    assert rows_of(found, "object_id", "readable") == rows_of(whole, "object_id", "readable")
    assert sorted(map(str, elements.select(shown).collect())) == sorted(map(str, pages.select(shown).collect()))
    expected = rows_of(contract.audit_documents(whole, pages).fillna(0), "object_id", "page", "code")
    assert rows_of(contract.audit_documents(found, elements).fillna(0), "object_id", "page", "code") == expected
    assert built is not None and len(expected) > 100


JSON_TEXTS = [
    {"object_id": "a", "m": {"pages": [1, {"x": 2}]}, "s": '"pages":[{ }', "pages": [{"page": 1, "t": 'x}y{\\"', "r": [{"a": {}}]}, {"page": 2}, 5, "s, ]}", [1, 2], {"p": 3}], "z": {"q": [{}]}},
    {"pages": []}, {"pages": [1, 2]}, {"x": 1}, {"pages": 5}, {"pages": [{}]}, [], 5, {"a": {"pages": [{}]}}, {"pages": [{"a": "\\"}, {"b": "}"}], "c": "["},
]


def test_chunks_against_a_parser(spark):
    texts = [json.dumps(d) for d in JSON_TEXTS] + [json.dumps(d, indent=1) for d in JSON_TEXTS]
    texts += ['{"pages":[{"a":1} {"b":2}]}', '{"pages":[{"a":1},]}', '{"pages":[,{"a":1}]}', '{"pages":[{"a":1}', "", '{"a":{"b":1}', '{"pages":[{"a":1}]}}', '{"pages":[{"a":bad}]}', "}{", '{"a":"']
    rows = [(f"o{i}", t) for i, t in enumerate(texts)] + [("none", None)]
    documents, pages = json_parts.parse(json_parts.chunks_of_texts(spark.createDataFrame(rows, "object_id string, value string")))
    found = {r["object_id"]: (r["readable"], r["n_pages"] if r["readable"] else None) for r in documents.collect()}
    raw = {}
    for r in pages.select("object_id", "position", F.to_json("raw").alias("raw")).orderBy("object_id", "position").collect():
        raw.setdefault(r["object_id"], []).append(json.loads(r["raw"]))
    for name, text in rows:
        try:
            value = json.loads(text or "")
        except ValueError:
            value = None
        listed = value.get("pages") if isinstance(value, dict) else None
        listed = listed if isinstance(listed, list) else None
        assert found.get(name, (False, None)) == (isinstance(value, dict), None if listed is None else len(listed)), text
        assert raw.get(name, []) == (listed or []), text


def test_a_text_is_split_once(spark):
    chunks = json_parts.chunks_of_texts(spark.createDataFrame([("a", "x}y}z"), ("b", "}"), ("c", None)], "object_id string, value string"))
    assert chunks._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    expected = [("a", 0, "x", True), ("a", 1, "y", True), ("a", 2, "z", False), ("b", 0, "", True), ("b", 1, "", False), ("c", 0, "", False)]
    assert rows_of(chunks, "object_id", "n", "chunk", "ends") == expected


def bytes_of(folder):
    return sum(p.stat().st_size for p in Path(str(folder).removeprefix("file:")).rglob("*") if p.is_file())


def test_documents_in_chunks_leave_less_than_their_texts(spark):
    rng = random.Random(9)
    letters = "".join(rng.choice("abcdefghijklmnop ") for _ in range(100_000))

    def pages():
        return [{"page": i + 1, "transcription": letters[start : start + 10_000]} for i, start in enumerate(rng.sample(range(90_000), 10))]

    texts = [(f"o{i}", json.dumps({"object_id": f"o{i}", "pages": pages()})) for i in range(60)]
    files = checkpointed(spark.createDataFrame(texts, "object_id string, value string"))
    before = bytes_of(checkpoint_dir(spark))
    _, found = contract.parsed(files, large=0)
    assert found.count() == 600
    assert bytes_of(checkpoint_dir(spark)) - before < sum(len(value) for _, value in texts)


def test_scratch_tables_go_with_their_shuffles(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.collect_list("id").alias("l"))
    before = bytes_of(checkpoint_dir(spark))
    with scratch(spark) as table:
        first = table(rows)
        kept = table(first.select("k", F.size("l").alias("size")), keep=True)
        assert first.count() == 10
        written = bytes_of(checkpoint_dir(spark)) - before
    assert rows_of(kept, "k", "size") == [(k, 100) for k in range(10)]
    assert 0 < bytes_of(checkpoint_dir(spark)) - before < written
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_files_are_read_in_ranges(spark, tmp_path):
    """Files far above the size of a read range, with pages that lie across its edges; one is cut off."""
    values = {f"v{i}": {"object_id": f"v{i}", "pages": [{"page": n + 1, "transcription": f"}}{i} {n} " * (n % 40)} for n in range(300)]} for i in range(3)}
    for name, value in values.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=None if name == "v1" else 1))
    (tmp_path / "cut.json").write_text(json.dumps({**values["v0"], "object_id": "cut"})[:-1])
    (tmp_path / "small.json").write_text('{"object_id":"small","pages":[{"page":1,"transcription":"s"}]}')
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        documents, pages, errors = transcriptions.read_corpus(spark, str(tmp_path), large=1000)
        typed = contract.typed_pages(pages).select("object_id", "page", "transcription")
        got = {(r["object_id"], r["page"]): r["transcription"] for r in typed.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    expected = {(k, p["page"]): p["transcription"] for k, v in values.items() for p in v["pages"]}
    assert got == expected | {("small", 1): "s"}
    assert rows_of(documents, "object_id", "n_pages") == [("small", 1), ("v0", 300), ("v1", 300), ("v2", 300)]
    assert rows_of(errors, "object_id", "error") == [("cut", "unreadable")]


def test_a_document_beyond_the_variant_limit(spark, tmp_path):
    """135 MB in one document: all its pages come out, and none is too large."""
    text = "word " * 26_000
    with (tmp_path / "huge.json").open("w") as out:
        out.write('{"object_id":"huge","pages":[')
        for n in range(1, 1041):
            out.write(("," if n > 1 else "") + json.dumps({"page": n, "transcription": text}))
        out.write("]}")
    documents, pages, errors = transcriptions.read_corpus(spark, str(tmp_path))
    totals = contract.typed_pages(pages).selectExpr("count(DISTINCT page) AS n", "sum(length(transcription)) AS chars").first()
    assert (totals["n"], totals["chars"]) == (1040, 1040 * len(text))
    assert rows_of(documents, "object_id", "n_pages") == [("huge", 1040)] and errors.count() == 0


def test_readers_on_files(spark, tmp_path):
    """Every reader of a folder, from files to typed rows."""
    def folder(name, **files):
        path = tmp_path / name
        path.mkdir()
        for file, value in files.items():
            (path / f"{file}.json").write_text(value if isinstance(value, str) else json.dumps(value))
        return str(path)

    validated = folder("validated", a={"object_id": "a", "_meta": {"pipeline_step": 4}, "pages": [{"page": 1, "transcription": "x"}]}, b="{")
    documents, errors = transcriptions.read_validated(spark, validated)
    assert documents.count() == 0
    assert {("b", "read"), ("a", "contract")} == {(r["object_id"], r["stage"]) for r in errors.collect()}
    inventory = folder("inventory", inventory={"documents": [{"id": "d", "source_type": "pdf", "pages": 3, "transcribable": True}, 5, {"pages": 1}]})
    assert rows_of(manifests.read_inventory(spark, inventory), "id", "source_type", "pages", "transcribable") == [("d", "pdf", 3, True)]
    images = folder("images", o={"pages": [{"page": 1, "filename": "a.png", "image_url": "https://x"}, {"page": "2", "error": "gone"}]}, p="[]")
    found = manifests.image_manifest_rows(transcriptions.read_text_files(spark, images))
    assert sorted(map(tuple, found.select("object_id", "position", "page", "filename", "image_url", "error").collect()), key=str) == [
        ("o", 0, 1, "a.png", "https://x", None), ("o", 1, None, None, None, "gone"),
    ]
    fixtures = folder("fixtures", m={"name": "m", "profile": "hsa-strict", "fixtures": [
        {"id": "f", "checks": ["cer"], "hypothesis": {"kind": "text", "path": "h"}, "reference": {"kind": "text", "path": "r"}, "maturity": "draft"},
        {"id": "g", "checks": ["relaxng"], "profile": "zbz-fidelity", "tei": {"path": "t.xml"}, "scope": "page"},
    ]})
    read = manifests.read_evaluation_manifest(spark, fixtures)
    assert rows_of(read, "fixture_id", "profile", "scope", "reference_class", "has_hypothesis") == [
        ("f", "hsa-strict", "all", "none", True), ("g", "zbz-fidelity", "page", "none", False),
    ]
    assert rows_of(evaluation.manifest_violations(read), "fixture_id", "code") == [("g", "fixture_schema")]
    bound = folder("bound", a={"_meta": {"transcription_sha256": "h"}}, b={"_meta": 5}, c="{")
    assert sorted(map(tuple, manifests.read_annotations(spark, bound).collect()), key=str) == [("a", True, "h"), ("b", False, None), ("c", False, None)]


def test_own_rules_and_profiles(spark, monkeypatch):
    """A rule list and a comparison profile of one's own."""
    from scriptorium.operators import quality
    from scriptorium.plans.assessment import assess

    base = quality.RULES[0]
    own = [type(base)(**{**vars(base), "name": "crosses", "count": lambda c: F.regexp_count(c, F.lit("x"))})]
    pages = spark.createDataFrame([("o", 1, "x xx", ""), ("p", 1, "none", "")], "object_id string, page int, transcription string, page_type string")
    assert rows_of(assess(pages, rules=own), "object_id", "crosses") == [("o", 3), ("p", 0)]
    profile = next(iter(evaluation.PROFILES.values()))
    monkeypatch.setitem(evaluation.PROFILES, "loud", type(profile)(**{**vars(profile), "normalise": F.upper}))
    pairs = spark.createDataFrame([("f", "abc", "ABd", "loud")], "fixture_id string, reference string, hypothesis string, profile string")
    normal = pairs.select("fixture_id", "profile", *[evaluation.by_profile(lambda p, c=c: p.normalise(F.col(c)), F.col("profile")).alias(c) for c in ("reference", "hypothesis")])
    assert rows_of(evaluation.cer_records(normal)[0], "fixture_id", "distance", "profile") == [("f", 1, "loud")]
