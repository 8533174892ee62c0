"""Summaries of fragments against a parser of whole documents."""

from __future__ import annotations

import random
import xml.etree.ElementTree as ET

import pytest

from scriptorium.plans import structure

PIECES = ["<p>", "</p>", "<div>", "</div>", "<x:p xmlns:x='u'>", "</x:p>", "<lb/>", "text ", " \n", "&amp;", "<!-- </p> -->", "<![CDATA[</div>]]>", '<p a="x>y">', "<?pi </p>?>"]
RARE = ["&", "<", "&nope;", '<p a="1" a="2">', "<p a=1>", "]]>", "<!-- -- -->"]


def random_fragments(rng):
    """Mostly nested markup, cut into fragments between tags, sometimes with a fault."""
    out, stack = [], []

    def put(piece):
        out.append(piece)

    put("<TEI>")
    stack.append("</TEI>")
    for part in rng.choice([["teiHeader", "text"], ["text", "teiHeader"], ["text"], ["teiHeader", "div"], ["teiHeader", "text"]]):
        put(f"<{part}>")
        stack.append(f"</{part}>")
        inner = {"teiHeader": "fileDesc", "text": "body"}.get(part, "body")
        if rng.random() < 0.8:
            put(f"<{inner}>")
            stack.append(f"</{inner}>")
        for _ in range(rng.randrange(12)):
            piece = rng.choice(PIECES)
            if piece.startswith("</"):
                if stack[-1] == piece:
                    put(stack.pop())
            else:
                put(piece)
                if piece.startswith("<") and piece[1] not in "!?" and not piece.endswith("/>"):
                    stack.append(f"</{piece[1:].split()[0].rstrip('>')}>")
        while len(stack) > 1:
            put(stack.pop())
    put(stack.pop())
    if rng.random() < 0.4:
        at = rng.randrange(len(out) + 1)
        fault = rng.random()
        if fault < 0.4:
            out[at:at] = [rng.choice(RARE + PIECES)]
        elif fault < 0.8:
            del out[at : at + 1]
        else:
            out.append(rng.choice(["<TEI/>", "tail", "\n", "<!-- end -->"]))
    cuts = sorted(rng.sample(range(len(out) + 1), rng.randrange(min(6, len(out)))))
    edges = [0, *cuts, len(out)]
    return ["".join(out[a:b]) for a, b in zip(edges, edges[1:])]


def plain(markup):
    try:
        root = ET.fromstring(markup)
    except ET.ParseError:
        return False, False, {"not well-formed"}
    local = lambda e: e.tag.rpartition("}")[2]
    places = []

    def walk(e, path):
        places.append([*path, local(e)])
        for c in e:
            walk(c, [*path, local(e)])

    walk(root, [])
    found = ["/".join(p) for p in places]
    errors = {f"missing element {r}" for r in structure.REQUIRED if r not in found}
    if "TEI/text" in found and "TEI/teiHeader" in found and found.index("TEI/teiHeader") > found.index("TEI/text"):
        errors.add("header behind the text")
    return True, any(p[-1] == "teiHeader" for p in places), errors


@pytest.mark.parametrize("fan", [2, 512])
def test_random_documents(spark, fan):
    rng = random.Random(7)
    documents = {f"d{i}": random_fragments(rng) for i in range(400)}
    rows = [(k, 10 * (n // 2), n, f) for k, fs in documents.items() for n, f in enumerate(fs)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "object_id string, section int, ordinal long, fragment string")
    found = {r["object_id"]: (r["well_formed"], r["has_header"], set(r["errors"])) for r in structure.conformance(frame, fan).collect()}
    expected = {k: plain("".join(fs)) for k, fs in documents.items()}
    assert found == expected
    assert 60 < sum(w for w, _, _ in expected.values()) < 390 and any(not e for _, _, e in expected.values())


def test_prologues_and_edges(spark):
    good = "<TEI><teiHeader><fileDesc/></teiHeader><text><body><p>x</p></body></text></TEI>"
    cases = {
        f'<?xml version="1.0"?>\n<!-- c -->\n<!DOCTYPE TEI>\n{good}\n': "valid",
        f' <?xml version="1.0"?>{good}': "invalid",
        f"<![CDATA[a]]>{good}": "invalid",
        "<TEI><body><text><fileDesc/></text></body><teiHeader/></TEI>": "invalid",
        "": "invalid", "no markup": "invalid", "<TEI": "invalid",
        '<t:TEI xmlns:t="u"><t:teiHeader><t:fileDesc/></t:teiHeader><t:text><t:body/></t:text></t:TEI>': "valid",
        "<TEI><teiHeader><fileDesc/></teiHeader><text><body>" + "<p>" * 300 + "</p>" * 300 + "</body></text></TEI>": "valid",
    }
    frame = spark.createDataFrame([(m, m) for m in cases] + [("none", None)], "object_id string, markup string")
    found = {r["object_id"]: r["status"] for r in structure.conformance(structure.as_fragments(frame)).collect()}
    assert found == cases | {"none": "invalid"}
    assert structure.conformance(structure.as_fragments(frame.limit(0))).count() == 0


def test_an_object_of_many_fragments(spark):
    """An element that opens in the first page and closes in the last, over several levels of merging."""
    pages = spark.range(1, 3001).selectExpr("'o' AS object_id", "1 AS section", "id AS ordinal", "'<p>text</p>' AS fragment")
    frame = [("o", 0, 0, "<TEI><teiHeader><fileDesc/></teiHeader><text><body><div>"), ("o", 2, 0, "</div></body></text></TEI>")]
    ends = spark.createDataFrame(frame, pages.schema)
    assert [r["status"] for r in structure.conformance(pages.union(ends), fan=8).collect()] == ["valid"]
    assert [r["well_formed"] for r in structure.well_formed(pages.union(ends.limit(1)), fan=8).collect()] == [False]


def test_summaries_are_merged_once_and_in_many_tasks(spark):
    """Summaries are few bytes, which AQE would join into one task, and a condition on the result must not merge them again."""
    frame = spark.range(500).selectExpr("concat('o', id % 250) AS object_id", "1 AS section", "id AS ordinal", "if(id < 250, '<TEI>', '</TEI>') AS fragment")
    merged = structure.summaries(frame)
    assert merged.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert merged.count() == 250 and structure.with_well_formed(merged).filter("well_formed").count() == 250
    valid = structure.conformance(frame).filter("status IN ('valid', 'invalid')")
    assert "aggregate(" not in valid._jdf.queryExecution().optimizedPlan().toString()
