"""Reading markup documents: metadata, pages, workflow, conformance, comparison texts."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions import text
from ..functions.rows import by_row
from ..functions.text import provenance_value
from ..operators.ordered import numbered


#: What stands between a tag's name and its end; a quoted value may hold a ``>``.
ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
TAG = rf"<{ATTRS}>"


def tag_pattern(name: str) -> str:
    """Start tags of an element, or empty elements."""
    return rf"<{name}(?=[\s>/]){ATTRS}>"


def without_prefixes(markup: Column) -> Column:
    """Element names without namespace prefixes, comments dropped, CDATA sections as escaped text."""
    return F.regexp_replace(text.without_cdata(markup), r"(</?)[A-Za-z_][\w.-]*:(?=[A-Za-z_])", "$1")


def with_well_formed(documents: DataFrame, column: str = "markup") -> DataFrame:
    """Add ``well_formed``: whether the XML parser accepts the whole document."""
    parsed = F.from_xml(F.col(column), "unused STRING, _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    return documents.withColumn("_parsed", parsed).withColumn(
        "well_formed",
        F.col("_parsed").isNotNull() & F.col("_parsed._bad").isNull() & F.col(column).rlike(r"(?s)^\s*<.*>\s*$"),
    ).drop("_parsed")


def header_of(markup: Column) -> Column:
    """The header element alone, so that path expressions parse little."""
    return F.regexp_extract(without_prefixes(markup), r"(?s)<teiHeader\b.*?</teiHeader>", 0)


def metadata(documents: DataFrame) -> DataFrame:
    """Catalogue metadata of (object_id, markup); unreadable headers give empty values."""
    base = with_well_formed(documents).withColumn("_header", header_of(F.col("markup")))
    usable = F.col("well_formed") & (F.col("_header") != "")

    header = F.when(usable, F.col("_header")).otherwise("")

    def dated(block: Column, element: str) -> Column:
        tag = first_tag(block, element)
        return F.when(tag != "", F.coalesce(text.non_empty(attribute(tag, "when")), leading_text(block, element)))

    source = F.regexp_extract(header, r"(?s)<sourceDesc\b.*?</sourceDesc>", 0)
    language = F.regexp_extract(header, r"(?s)<langUsage\b.*?</langUsage>", 0)
    change = first_element(F.regexp_extract(header, r"(?s)<revisionDesc\b.*?</revisionDesc>", 0), "change")
    change_text = F.regexp_replace(change, TAG, "")
    shelfmark = r"""<idno\b[^>]*\stype\s*=\s*["']shelfmark["'][^>]*>([^<]*)"""
    return base.select(
        "object_id",
        "markup",
        "well_formed",
        leading_text(F.regexp_extract(header, r"(?s)<titleStmt\b.*?</titleStmt>", 0), "title").alias("title"),
        F.coalesce(dated(header, "origDate"), dated(source, "date"), dated(header, "date"), F.lit("")).alias("date"),
        F.coalesce(
            text.non_empty(attribute(first_tag(language, "language"), "ident")), leading_text(language, "language")
        ).alias("language"),
        attribute(first_tag(header, "revisionDesc"), "status").alias("status"),
        text.strip(
            text.xml_unescape(F.regexp_extract(F.regexp_extract(header, r"(?s)<msIdentifier\b.*?</msIdentifier>", 0), shelfmark, 1))
        ).alias("signature"),
        attribute(first_tag(change, "change"), "when").alias("input_state_timestamp"),
        provenance_value(change_text, "source_images_hash").alias("source_images_hash"),
        provenance_value(change_text, "validation_state_hash").alias("validation_state_hash"),
    )


def first_tag(block: Column, element: str) -> Column:
    """The first start tag of an element, empty when there is none."""
    return F.regexp_extract(block, tag_pattern(element), 0)


def first_element(block: Column, element: str) -> Column:
    """The first element with its content."""
    return F.regexp_extract(block, rf"(?s)<{element}(?=[\s>/]){ATTRS}(?:(?<=/)>|(?<!/)>.*?</{element}\s*>)", 0)


def leading_text(block: Column, element: str) -> Column:
    """Trimmed text of the first such element in front of its first child."""
    inner = F.regexp_extract(block, rf"<{element}(?=[\s>/])({ATTRS})>([^<]*)", 2)
    closed = first_tag(block, element).endswith("/>")
    return F.when(closed, "").otherwise(text.strip(text.xml_unescape(inner)))


def attribute(tag: Column, name: str) -> Column:
    """Attribute value of one tag text, empty when absent; either quote character."""
    double = F.regexp_extract(tag, rf'\s{name}\s*=\s*"([^"]*)"', 1)
    single = F.regexp_extract(tag, rf"\s{name}\s*=\s*'([^']*)'", 1)
    return text.xml_unescape(F.coalesce(text.non_empty(double), single))


def image_links(markup: Column) -> Column:
    """Map from ``#id`` to URL of the facsimile list."""
    block = F.regexp_extract(without_prefixes(markup), r"(?s)<facsimile\b.*?</facsimile>", 0)
    tags = F.regexp_extract_all(block, F.lit(tag_pattern("graphic")), F.lit(0))
    entries = F.transform(
        tags,
        lambda g: F.struct(F.concat(F.lit("#"), attribute(g, r"(?:xml:)?id")).alias("key"), attribute(g, "url").alias("value")),
    )
    usable = F.filter(entries, lambda e: (F.length(e["key"]) > 1) & (e["value"] != ""))
    return F.map_from_entries(usable)


def plain_text(inner: Column) -> Column:
    """Text of a markup stretch: line breaks, block ends as blank lines, tags dropped."""
    broken = F.regexp_replace(inner, tag_pattern("lb"), "\n")
    blocks = F.regexp_replace(broken, r"</(p|ab|head|item|note)\s*>", "\n\n")
    return text.display_text(text.xml_unescape(F.regexp_replace(blocks, TAG, "")))


def pages(documents: DataFrame) -> DataFrame:
    """Viewer pages of (object_id, markup): page, label, text, image.

    The body is split at its page breaks inside the row; text before the first
    break belongs to no page, and a body without breaks is one page.
    """
    plain = without_prefixes(F.col("markup"))
    body = F.regexp_extract(plain, rf"(?s){tag_pattern('body')}(.*)</body>", 1)
    found = documents.filter(F.col("markup").rlike(r"<([A-Za-z_][\w.-]*:)?body\b")).select(
        "object_id", body.alias("_body"), image_links(F.col("markup")).alias("_links")
    )
    rows = _split_at_breaks(found, "object_id", "_links")
    sequence = (F.col("_position") + 1).cast("int")
    return rows.select(
        "object_id",
        sequence.alias("page"),
        _label(sequence),
        plain_text(F.col("_inner")).alias("text"),
        F.coalesce(F.element_at("_links", F.col("_pointer")), F.col("_pointer")).alias("image"),
    )


def page_pointers(fragments: DataFrame) -> DataFrame:
    """(object_id, image) per page of page fragments, the image as the page break points at it: all that a catalogue counts."""
    bodies = fragments.select("object_id", without_prefixes(F.col("fragment")).alias("_body"))
    return _split_at_breaks(bodies, "object_id").select("object_id", F.col("_pointer").alias("image"))


def pages_of_fragments(fragments: DataFrame, skeletons: DataFrame) -> DataFrame:
    """The same pages from page fragments (object_id, ordinal, fragment) and skeletons, for objects of any size."""
    numbers = numbered(fragments.select("object_id", "ordinal"), ["object_id"], ["ordinal"], "page")
    bodies = fragments.select("object_id", "ordinal", without_prefixes(F.col("fragment")).alias("_body"))
    rows = _split_at_breaks(bodies, "object_id", "ordinal").join(numbers, ["object_id", "ordinal"])
    links = skeletons.select("object_id", F.explode(image_links(F.col("markup"))).alias("_pointer", "_url"))
    page = F.col("page").cast("int")
    return rows.join(links, ["object_id", "_pointer"], "left").select(
        "object_id", page.alias("page"), _label(page), plain_text(F.col("_inner")).alias("text"), F.coalesce("_url", "_pointer").alias("image")
    )


def _split_at_breaks(bodies: DataFrame, *keep: str) -> DataFrame:
    """Rows (keep, _position, _tag, _pointer, _inner) of ``_body`` between its page breaks."""
    tags = F.regexp_extract_all("_body", F.lit(tag_pattern("pb")), F.lit(0))
    parts = F.split("_body", tag_pattern("pb"), -1)
    paired = F.when(
        F.size(tags) > 0, F.arrays_zip(tags.alias("tag"), F.slice(parts, 2, F.size(tags)).alias("inner"))
    ).otherwise(F.array(F.struct(F.lit("").alias("tag"), F.col("_body").alias("inner"))))
    rows = bodies.select(*keep, F.posexplode(paired).alias("_position", "_page"))
    tag = F.col("_page.tag")
    return rows.select(*keep, "_position", tag.alias("_tag"), attribute(tag, "facs").alias("_pointer"), F.col("_page.inner").alias("_inner"))


def _label(sequence: Column) -> Column:
    return F.coalesce(text.non_empty(attribute(F.col("_tag"), "n")), sequence.cast("string")).alias("label")


def resolve_images(page_rows: DataFrame, local_images: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """Image of each page: a remote address, else the local file of that position.

    ``bound`` lists objects (object_id, bound) whose images are fixed by hash;
    for those only local files count.
    """
    rows = page_rows
    fixed = F.lit(False)
    if bound is not None:
        rows = rows.join(bound, "object_id", "left")
        fixed = F.coalesce("bound", F.lit(False))
    local = local_images.select("object_id", "page", F.col("filename").alias("_local"))
    path = F.concat(F.lit("images/"), "object_id", F.lit("/"), "_local")
    image = F.when(~fixed & text.is_safe_url(F.col("image")), F.col("image")).otherwise(F.coalesce(path, F.lit("")))
    return rows.join(local, ["object_id", "page"], "left").withColumn("image", image).drop("_local", "bound")


def changes(documents: DataFrame) -> DataFrame:
    """Recorded changes of each document with the responsible actor."""
    header = header_of(F.col("markup"))
    base = documents.select("object_id", header.alias("_header"))
    actor_tags = F.regexp_extract_all("_header", F.lit(r"(?s)<respStmt\b.*?</respStmt>"), F.lit(0))
    actors = base.select("object_id", F.explode(actor_tags).alias("s")).select(
        "object_id",
        F.concat(F.lit("#"), attribute(F.regexp_extract("s", rf"^{TAG}", 0), r"(?:xml:)?id")).alias("who"),
        text.xml_unescape(F.regexp_replace(F.regexp_extract("s", rf"(?s){tag_pattern('name')}(.*?)</name>", 1), TAG, "")).alias("actor"),
    )
    revision = F.regexp_extract("_header", r"(?s)<revisionDesc\b.*?</revisionDesc>", 0)
    change_tags = F.regexp_extract_all(revision, F.lit(rf"(?s)<change(?=[\s>/]){ATTRS}(?:(?<=/)>|(?<!/)>.*?</change>)"), F.lit(0))
    rows = base.select("object_id", F.posexplode(change_tags).alias("position", "c"))
    tag = F.regexp_extract("c", rf"^{TAG}", 0)
    listed = rows.select(
        "object_id",
        "position",
        F.coalesce(text.non_empty(attribute(tag, "type")), F.lit("derivation")).alias("type"),
        attribute(tag, "who").alias("who"),
        attribute(tag, "subtype").alias("actor_kind"),
        attribute(tag, "when").alias("when"),
        attribute(tag, "target").alias("target"),
        text.xml_unescape(F.regexp_replace("c", TAG, "")).alias("text"),
    )
    return listed.join(actors, ["object_id", "who"], "left").withColumn("actor", F.coalesce("actor", F.lit(""))).drop("who")


# ---------------------------------------------------------------------------
# Comparison texts; nesting matters here, so the tree is walked in Arrow batches.


def _body_of(markup: str) -> ET.Element | None:
    root = ET.fromstring(markup)
    for element in root.iter():
        if isinstance(element.tag, str):
            element.tag = element.tag.rpartition("}")[2]
    return root.find(".//body") if root.tag != "body" else root


def _walk(element: ET.Element, mode: str) -> Iterator[str]:
    """Text pieces of an element without its tail."""
    if mode == "comparison" and element.tag == "choice":
        chosen = element.find("corr")
        chosen = element.find("sic") if chosen is None else chosen
        if chosen is not None:
            yield from _walk(chosen, mode)
        return
    if mode == "comparison" and element.tag == "note" and element.get("place") == "foot":
        return
    yield element.text or ""
    for child in element:
        skipped = mode == "edition" and child.tag == "note" and child.get("type") == "editorial"
        if mode == "comparison" and child.tag == "lb":
            yield "" if child.get("break") == "no" else " "
        elif mode == "comparison" and child.tag == "pb":
            yield "\n\n"
        elif not skipped:
            yield from _walk(child, mode)
        yield child.tail or ""


def _read(markup: str | None, mode: str) -> str | None:
    if markup is None:
        return None
    try:
        body = _body_of(markup)
    except ET.ParseError:
        # the comparison reader falls back to dropping tags, the others fail
        import re

        return re.sub(r"<[^>]+>", "", markup) if mode == "comparison" else None
    return "" if body is None else "".join(_walk(body, mode))


def comparison_reader(mode: str):
    """Column function: ``itertext``, ``edition`` (editorial notes dropped) or ``comparison``."""

    return by_row(lambda markup: _read(markup, mode), StringType())


BLOCKS = ("p", "ab", "head", "item", "note")


class BlockRows:
    """Rows (page, kind, text) of the outermost text blocks of one document.

    ``page`` counts page breaks from 1, also those inside a block; a block
    starts on the page its start tag is on. Unreadable markup gives no rows.
    """

    def eval(self, markup: str):
        try:
            body = None if markup is None else _body_of(markup)
        except ET.ParseError:
            body = None
        if body is not None:
            yield from self._rows(body, [0])

    def _rows(self, element: ET.Element, page: list[int]):
        for child in element:
            if child.tag == "pb":
                page[0] += 1
            elif child.tag in BLOCKS:
                start = page[0]
                page[0] += sum(1 for _ in child.iter("pb"))
                yield start, child.tag, "".join(_pieces(child))
            else:
                yield from self._rows(child, page)


def _pieces(element: ET.Element) -> Iterator[str]:
    yield element.text or ""
    for child in element:
        if child.tag == "lb":
            yield "\n"
        else:
            yield from _pieces(child)
        yield child.tail or ""


def blocks(documents: DataFrame) -> DataFrame:
    """Text blocks of (object_id, markup) by a lateral join with the table function."""
    schema = StructType(
        [StructField("page", IntegerType()), StructField("kind", StringType()), StructField("text", StringType())]
    )
    table = F.udtf(BlockRows, returnType=schema)
    return documents.lateralJoin(table(F.col("markup").outer())).drop("markup")
