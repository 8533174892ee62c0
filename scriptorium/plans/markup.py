"""Markup generation and the round trip back to page texts.

A document is an ordered sequence of small fragments, at most one per page,
actor, edit or image. Every fragment is computed from its own row, so an object
with millions of pages is spread over the cluster; only objects below a checked
size are ever joined into one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, markers, text, values
from ..operators import reviews
from ..operators.ordered import numbered
from ..session import checkpointed

NAMESPACE = "http://www.tei-c.org/ns/1.0"
MAX_DOCUMENT_CHARS = 64 * 1024 * 1024

# Order of the fragments of one document.
HEAD, ACTOR, MIDDLE, EDIT, HEADER_END = 10, 20, 30, 40, 50
IMAGES_OPEN, IMAGE, IMAGES_CLOSE, BODY_OPEN, PAGE, END = 60, 61, 62, 70, 80, 90


def _lines(*parts: Column) -> Column:
    """Non-null lines joined by newlines, each ended by one."""
    present = F.array_compact(F.array(*parts))
    return F.concat(F.array_join(present, "\n"), F.when(F.size(present) > 0, "\n").otherwise(""))


def _element(open_tag: str, content: Column, close_tag: str) -> Column:
    return F.concat(F.lit(open_tag), content, F.lit(close_tag))


def paragraph_markup(paragraph: Column, diplomatic: bool = True) -> Column:
    """Inline markup of one paragraph."""
    if diplomatic:
        return F.array_join(F.transform(text.lines(paragraph), markers.markers_to_markup), "<lb/>")
    return markers.markers_to_markup(text.strip(F.regexp_replace(paragraph, r"(?U)\s*\n\s*", " ")))


def page_body(diplomatic: bool = True) -> Column:
    """Body lines after a page break, by page type."""
    body = F.coalesce(F.col("transcription"), F.lit(""))
    kind = F.coalesce(F.col("page_type"), F.lit(""))
    foreign = F.coalesce(F.col("foreign_paragraphs"), F.array().cast("array<int>"))
    note_open = '        <note type="foreign">'

    def paragraph_line(paragraph: Column, position: Column) -> Column:
        content = paragraph_markup(paragraph, diplomatic)
        as_note = (kind == "foreign_text") | F.array_contains(foreign, position.cast("int"))
        line = F.when(as_note, _element(note_open, content, "</note>")).otherwise(
            _element("        <p>", content, "</p>")
        )
        return F.when(content != "", line)

    contents = F.when(
        text.has_text(body), F.array_compact(F.transform(text.paragraphs(body), paragraph_line))
    ).otherwise(F.array().cast("array<string>"))
    reason = F.coalesce(
        text.non_empty(text.strip(F.coalesce("notes", F.lit("")))),
        F.lit("Image resolution insufficient for diplomatic transcription."),
    )
    gate = F.when(
        kind == "gate_low_resolution",
        _element('        <note type="gate" subtype="low_resolution">', text.xml_escape(reason), "</note>"),
    )
    empty = F.when(
        text.is_blank(body) & ~kind.isin("blank", "gate_low_resolution", "foreign_text"),
        F.lit('        <note type="empty">Empty page without declared page_type; verify against the facsimile.</note>'),
    )
    return F.array_compact(F.concat(F.array(gate, empty), contents))


def page_fragments(pages: DataFrame, diplomatic: bool = True) -> DataFrame:
    """One body fragment per page.

    ``pages`` may carry ``url`` (remote image), ``filename`` (local image) and
    ``edited`` (the page has recorded edits).
    """
    have = set(pages.columns)
    url = F.col("url") if "url" in have else F.lit(None).cast("string")
    filename = F.col("filename") if "filename" in have else F.lit(None).cast("string")
    edited = F.col("edited") if "edited" in have else F.lit(False)
    number = F.col("page").cast("string")
    pointer = F.when(text.non_empty(url).isNotNull(), F.concat(F.lit("#facs_"), number)).when(
        text.is_local_filename(filename),
        F.concat(F.lit("../images/"), text.xml_escape(F.col("object_id")), F.lit("/"), text.xml_escape(filename)),
    )
    page_break = F.concat(
        F.lit('        <pb n="'), number, F.lit('"'),
        F.when(pointer.isNotNull(), _element(' facs="', pointer, '"')).otherwise(""),
        F.when(edited, _element(' xml:id="review-page-', number, '"')).otherwise(""),
        F.lit("/>"),
    )
    lines = F.concat(F.array(page_break), page_body(diplomatic))
    return pages.select(
        "object_id",
        "page",
        F.lit(PAGE).alias("section"),
        F.col("page").cast("bigint").alias("ordinal"),
        F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias("fragment"),
    )


def image_fragments(pages: DataFrame) -> DataFrame:
    """Facsimile list: one line per page with a remote image, and its frame."""
    with_url = pages.filter(F.col("url") != "")
    number = F.col("page").cast("string")
    lines = with_url.select(
        "object_id",
        F.lit(IMAGE).alias("section"),
        F.col("page").cast("bigint").alias("ordinal"),
        F.concat(
            F.lit('    <graphic xml:id="facs_'), number, F.lit('" url="'), text.xml_escape(F.col("url")), F.lit('"/>\n')
        ).alias("fragment"),
    )
    frame = F.array(
        F.struct(F.lit(IMAGES_OPEN).alias("section"), F.lit("  <facsimile>\n").alias("fragment")),
        F.struct(F.lit(IMAGES_CLOSE).alias("section"), F.lit("  </facsimile>\n").alias("fragment")),
    )
    frames = (
        with_url.select("object_id").distinct().select("object_id", F.inline(frame))
        .select("object_id", "section", F.lit(0).cast("bigint").alias("ordinal"), "fragment")
    )
    return lines.unionByName(frames)


def derivation_note(provenance: dict[str, Column], state_hash: Column, config_hash: Column) -> Column:
    """Where a document comes from, as ``key=value`` pairs."""
    details = [
        F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}="), text.xml_escape(value)))
        for label, value in provenance.items()
    ]
    details += [
        F.concat(F.lit("validation_state_hash="), state_hash),
        F.concat(F.lit("project_config_hash="), config_hash),
    ]
    return F.concat(
        F.lit("Deterministic generation from the supplied transcription. Transcription provenance: "),
        F.array_join(F.array_compact(F.array(*details)), "; "),
        F.lit(". The timestamp identifies the validated input state used for derivation."),
    )


def header_fragments(objects: DataFrame, project: dict[str, str], provenance: dict[str, Column] | None = None) -> DataFrame:
    """Header, body frame and end of every object.

    ``objects`` carries the metadata fields, ``document_status``,
    ``state_hash`` and ``input_timestamp``.
    """

    def field(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in objects.columns else F.lit("")

    def line(open_tag: str, value: Column, close_tag: str) -> Column:
        return F.when(value != "", _element(open_tag, text.xml_escape(value), close_tag))

    identifier = F.col("object_id")
    title = F.coalesce(text.non_empty(field("title")), identifier)
    language = F.coalesce(text.non_empty(field("language")), F.lit(project.get("language", "")))
    editor, publisher = F.lit(project.get("editor", "")), F.lit(project.get("publisher", ""))
    licence = F.lit(project.get("license", ""))
    status = text.xml_escape(field("document_status"))
    date, when = field("date"), values.date_when(field("date"))
    config = hashing.fields_hash(*[F.lit(f"{k}={project[k]}") for k in sorted(project)], length=12)

    head = _lines(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>'),
        F.lit(f'<TEI xmlns="{NAMESPACE}">'),
        F.lit("  <teiHeader>\n    <fileDesc>\n      <titleStmt>"),
        _element("        <title>", text.xml_escape(title), "</title>"),
        line("        <editor>", editor, "</editor>"),
    )
    published = F.when(
        publisher != "",
        _lines(
            line("        <publisher>", publisher, "</publisher>"),
            line("        <availability><licence>", licence, "</licence></availability>"),
        ),
    ).otherwise(
        _lines(
            F.lit("        <p>No publisher is declared for this project.</p>"),
            line("        <p>Licence: ", licence, "</p>"),
        )
    )
    origin_date = F.when(
        date != "",
        F.concat(
            F.lit("          <history>\n            <origin>\n              <origDate"),
            F.when(when != "", _element(' when="', text.xml_escape(when), '"')).otherwise(""),
            F.lit(">"), text.xml_escape(date),
            F.lit("</origDate>\n            </origin>\n          </history>"),
        ),
    )
    middle = F.concat(
        F.lit("      </titleStmt>\n      <publicationStmt>\n"),
        published,
        _lines(
            F.lit("      </publicationStmt>\n      <sourceDesc>\n        <msDesc>\n          <msIdentifier>"),
            line("            <repository>", field("repository"), "</repository>"),
            line('            <idno type="shelfmark">', field("signature"), "</idno>"),
            _element('            <idno type="object-id">', text.xml_escape(identifier), "</idno>"),
            F.lit("          </msIdentifier>"),
            origin_date,
            F.lit("        </msDesc>\n      </sourceDesc>\n    </fileDesc>"),
            F.when(
                language != "",
                F.concat(
                    F.lit('    <profileDesc>\n      <langUsage><language ident="'), text.xml_escape(language), F.lit('">'),
                    text.xml_escape(language), F.lit("</language></langUsage>\n    </profileDesc>"),
                ),
            ),
            F.lit("    <encodingDesc>\n      <projectDesc><p>Generated from page transcriptions.</p></projectDesc>\n    </encodingDesc>"),
            _element('    <revisionDesc status="', status, '">'),
            F.concat(
                F.lit('      <change when="'), text.xml_escape(field("input_timestamp")), F.lit('" status="'), status, F.lit('">'),
                derivation_note(provenance or {}, field("state_hash"), config), F.lit("</change>"),
            ),
        ),
    )
    pieces = F.array(
        F.struct(F.lit(HEAD).alias("section"), head.alias("fragment")),
        F.struct(F.lit(MIDDLE).alias("section"), middle.alias("fragment")),
        F.struct(F.lit(HEADER_END).alias("section"), F.lit("    </revisionDesc>\n  </teiHeader>\n").alias("fragment")),
        F.struct(F.lit(BODY_OPEN).alias("section"), F.lit("  <text>\n    <body>\n      <div>\n").alias("fragment")),
        F.struct(F.lit(END).alias("section"), F.lit("      </div>\n    </body>\n  </text>\n</TEI>\n").alias("fragment")),
    )
    return objects.select("object_id", F.explode(pieces).alias("p")).select(
        "object_id", "p.section", F.lit(0).cast("bigint").alias("ordinal"), "p.fragment"
    )


def edit_fragments(edits: DataFrame) -> DataFrame:
    """Responsibility statements per actor and one change per recorded edit."""
    timed = edits.withColumn("instant", values.aware_timestamp(F.col("event_time")))
    actors = reviews.number_actors(timed, ["actor", "actor_kind"], "instant", "edit_id").select(
        "object_id", "actor", "actor_kind", "actor_number"
    )
    name = F.concat(F.lit("reviewer-"), F.col("actor_number").cast("string"))
    statements = actors.select(
        "object_id",
        F.lit(ACTOR).alias("section"),
        F.col("actor_number").alias("ordinal"),
        F.concat(
            F.lit('        <respStmt xml:id="'), name, F.lit('"><resp>Transcription correction ('),
            text.xml_escape(F.col("actor_kind")), F.lit(")</resp><name>"), text.xml_escape(F.col("actor")),
            F.lit("</name></respStmt>\n"),
        ).alias("fragment"),
    )
    ordered = numbered(timed, ["object_id"], ["instant", "edit_id", "page", "seq"], "ordinal")
    changes = ordered.join(actors, ["object_id", "actor", "actor_kind"]).select(
        "object_id",
        F.lit(EDIT).alias("section"),
        "ordinal",
        F.concat(
            F.lit('      <change xml:id="edit-'), text.xml_escape(F.col("edit_id")),
            F.lit('" type="transcription-correction" subtype="'), text.xml_escape(F.col("actor_kind")),
            F.lit('" when="'), text.xml_escape(F.col("event_time")), F.lit('" who="#'), name,
            F.lit('" target="#review-page-'), F.col("page").cast("string"), F.lit('">'),
            text.xml_escape(F.col("note")), F.lit("</change>\n"),
        ).alias("fragment"),
    )
    return statements.unionByName(changes)


def document_fragments(
    objects: DataFrame,
    pages: DataFrame,
    edits: DataFrame | None = None,
    project: dict[str, str] | None = None,
    provenance: dict[str, Column] | None = None,
) -> DataFrame:
    """All fragments of all documents: object_id, section, ordinal, fragment."""
    project = project or {}
    diplomatic = not any(s in project.get("edition_type", "").lower() for s in ("normalis", "normaliz"))
    out = header_fragments(objects, project, provenance)
    if edits is not None:
        touched = edits.select("object_id", "page").distinct().withColumn("edited", F.lit(True))
        pages = pages.join(touched, ["object_id", "page"], "left").withColumn("edited", F.coalesce("edited", F.lit(False)))
        out = out.unionByName(edit_fragments(edits))
    if "url" in pages.columns:
        out = out.unionByName(image_fragments(pages))
    return out.unionByName(page_fragments(pages, diplomatic).drop("page"))


def skeletons(fragments: DataFrame) -> DataFrame:
    """(object_id, markup) without the pages: header, image list and frame. What is joined does not grow with the texts."""
    piece = F.struct("section", "ordinal", "fragment")
    return fragments.filter(F.col("section") != PAGE).groupBy("object_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["fragment"]), "").alias("markup")
    )


def document_shapes(fragments: DataFrame) -> DataFrame:
    """(object_id, framed, page_breaks, images, body_chars) from fragments, one pass and partial sums, whatever an object's size."""
    place = F.struct("section", "ordinal")
    count = lambda tag, section: F.coalesce(F.sum(F.when(F.col("section") == section, F.regexp_count("fragment", F.lit(tag)))), F.lit(0))
    framed = F.min_by(F.col("fragment").startswith("<?xml"), place) & F.max_by(F.col("fragment").endswith("</TEI>\n"), place)
    return fragments.groupBy("object_id").agg(
        framed.alias("framed"),
        count("<pb ", PAGE).cast("bigint").alias("page_breaks"),
        count("<graphic ", IMAGE).cast("bigint").alias("images"),
        F.coalesce(F.sum(F.when(F.col("section") == PAGE, F.length("fragment"))), F.lit(0)).cast("bigint").alias("body_chars"),
    )


def assemble(fragments: DataFrame, max_chars: int = MAX_DOCUMENT_CHARS) -> tuple[DataFrame, DataFrame]:
    """(documents, oversized fragments).

    Document sizes are summed first; only objects within the limit are joined
    into one string, the others stay complete as ordered fragments. Fragments
    are written once, since the sizes and the texts both come from them.
    """
    fragments = checkpointed(fragments)
    sizes = fragments.groupBy("object_id").agg(F.sum(F.length("fragment")).alias("chars"))
    small = fragments.join(sizes.filter(F.col("chars") <= max_chars).select("object_id"), "object_id", "left_semi")
    large = fragments.join(sizes.filter(F.col("chars") > max_chars).select("object_id"), "object_id", "left_semi")
    piece = F.struct("section", "ordinal", "fragment")
    documents = small.groupBy("object_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["fragment"]), "").alias("markup")
    )
    return documents, large


# ---------------------------------------------------------------------------
# Back to text


def fragment_text(fragment: Column) -> Column:
    """Page text of a body fragment, without the generated verification notes."""
    blocks = F.regexp_extract_all(fragment, F.lit(r"(?s)<(p|note)\b[^>]*>.*?</\1>"), F.lit(0))
    kept = F.filter(blocks, lambda b: ~b.rlike(r'^<note type="(gate|empty)"'))

    def plain(block: Column) -> Column:
        inner = F.regexp_replace(F.regexp_replace(block, r"^<[^>]*>", ""), r"</(p|note)>$", "")
        return text.strip(text.xml_unescape(markers.markup_to_markers(inner)))

    return F.array_join(F.filter(F.transform(kept, plain), lambda x: x != ""), "\n\n")


def compare_pages(pages: DataFrame, regenerated: DataFrame, keep_line_breaks: bool = True) -> DataFrame:
    """Original against regenerated page texts; pages of only one side count as mismatch."""

    def side(df: DataFrame, column: str, canonical: bool) -> DataFrame:
        body = F.coalesce(F.col(column), F.lit(""))
        body = markers.canonical_illegible(body) if canonical else body
        return df.select("object_id", "page", text.comparison_text(body, keep_line_breaks).alias("body"))

    left = side(pages, "transcription", True).withColumnRenamed("body", "original")
    right = side(regenerated, "text", True).withColumnRenamed("body", "regenerated")
    joined = left.join(right, ["object_id", "page"], "full")
    return joined.withColumn(
        "exact", F.coalesce(F.col("original") == F.col("regenerated"), F.lit(False))
    )


def round_trip(pages: DataFrame, fragments: DataFrame, keep_line_breaks: bool = True) -> DataFrame:
    """Page comparison of body fragments with their source pages."""
    regenerated = fragments.filter(F.col("section") == PAGE).select(
        "object_id", F.col("ordinal").cast("int").alias("page"), fragment_text(F.col("fragment")).alias("text")
    )
    return compare_pages(pages, regenerated, keep_line_breaks)


def round_trip_totals(compared: DataFrame) -> DataFrame:
    """Per object: page and character counts of both sides and the exact flag."""
    # Pages are joined by a blank-form-feed-blank line, three characters each.
    def chars(column: str) -> Column:
        pages = F.count(column)
        return (F.coalesce(F.sum(F.length(column)), F.lit(0)) + F.greatest(pages - 1, F.lit(0)) * 3).cast("bigint")

    return compared.groupBy("object_id").agg(
        F.count("original").alias("page_count_original"),
        F.count("regenerated").alias("page_count_markup"),
        chars("original").alias("original_character_count"),
        chars("regenerated").alias("markup_character_count"),
        F.count_if(~F.col("exact")).alias("mismatched_pages"),
        F.bool_and("exact").alias("plaintext_exact"),
    )
