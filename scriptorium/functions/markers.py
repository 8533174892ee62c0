"""Transcription markers: count, strip, resolve, extract and rewrite.

Five things are marked in a page text: an uncertain reading ``[?]``, an
illegible passage ``[...]`` or ``[... ~N chars]``, struck text ``~~x~~`` and an
insertion ``{x}``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import UD, xml_escape

# The marker syntax.
UNCERTAIN = r"\[\?\]"
ILLEGIBLE = r"\[\.\.\.(?:\s*~\s*\d+\s*chars?)?\]"
STRUCK = r"~~(.*?)~~"
INSERTED = r"\{(.*?)\}"
ANY_ILLEGIBLE_NOTE = r"\[\.\.\.[^\]]*\]"
# Typed form, one leftmost pass: deletion, addition, illegible, unclear word.
TYPED = UD + (
    r"~~(?:.+?)~~"
    r"|\{(?:.+?)\}"
    r"|\[\.\.\.(?:\s*~\s*\d+\s*chars?)?\]"
    r"|[^\s{}\[\]~]+\[\?\]"
)
# Runs of three or more symbols that are neither letters, digits, blanks, dots
# nor dashes, not beside a dot or dash and not closed by a bracket.
ARTIFACT = UD + r"(?<!\.)(?<![—–-])[^\p{L}\p{N}_\s.—–\-]{3,}(?![\.)—–-])"


def count_uncertain(text: Column) -> Column:
    return F.regexp_count(text, F.lit(UNCERTAIN))


def count_illegible(text: Column) -> Column:
    return F.regexp_count(text, F.lit(UD + ILLEGIBLE))


def count_artifacts(text: Column) -> Column:
    """Symbol clusters that remain once the markers are gone.

    Most texts have neither a marker nor three symbols in a row; two cheap
    tests spare them the costly patterns.
    """
    plain = F.when(text.rlike(r"[\[{~]"), strip_markers(text)).otherwise(text)
    suspicious = plain.rlike(r"[^a-z A-Z0-9\p{L}\p{N}_\s.—–\-]{3}")
    return F.when(suspicious, F.regexp_count(plain, F.lit(ARTIFACT))).otherwise(
        F.when(plain.isNotNull(), 0)
    )


def count_double_spaces(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"  +"))


def strip_markers(text: Column) -> Column:
    """Remove every marker together with the text it wraps, in one pass."""
    return F.regexp_replace(text, UD + "|".join([UNCERTAIN, ILLEGIBLE, STRUCK, INSERTED]), "")


def resolve_markers(text: Column) -> Column:
    """Reading text: struck text goes, insertions stay, brackets vanish."""
    out = F.regexp_replace(text, UD + STRUCK, "")
    out = F.regexp_replace(out, UD + INSERTED, "$1")
    out = F.regexp_replace(out, UNCERTAIN, "")
    return F.regexp_replace(out, UD + ILLEGIBLE, "")


def resolve_for_evaluation(text: Column) -> Column:
    """Comparison text: struck text stays, any illegibility note vanishes."""
    out = F.regexp_replace(text, UNCERTAIN, "")
    out = F.regexp_replace(out, ANY_ILLEGIBLE_NOTE, "")
    out = F.regexp_replace(out, UD + STRUCK, "$1")
    return F.regexp_replace(out, UD + INSERTED, "$1")


def marker_kind(match: Column) -> Column:
    """Type of one match of TYPED; the alternatives differ in their first character."""
    return (
        F.when(match.startswith("~~"), "deletion")
        .when(match.startswith("{"), "addition")
        .when(match.startswith("["), "illegible")
        .otherwise("unclear")
    )


def marker_quantity(match: Column) -> Column:
    """The character estimate of an illegible marker, null without one."""
    digits = F.regexp_extract(match, UD + r"^\[\.\.\.\s*~\s*(\d+)", 1)
    return F.when(digits != "", digits)


def marker_content(match: Column) -> Column:
    """The text a marker wraps or qualifies; null for illegible passages."""
    length = F.length(match)
    return (
        F.when(match.startswith("~~"), match.substr(F.lit(3), length - 4))
        .when(match.startswith("{"), match.substr(F.lit(2), length - 2))
        .when(match.startswith("["), F.lit(None).cast("string"))
        .otherwise(match.substr(F.lit(1), length - 3))
    )


def typed_markers(text: Column) -> Column:
    """Array of (kind, quantity, content, marker) in text order."""
    matches = F.regexp_extract_all(text, F.lit(TYPED), F.lit(0))
    return F.transform(
        matches,
        lambda m: F.struct(
            marker_kind(m).alias("kind"),
            marker_quantity(m).alias("quantity"),
            marker_content(m).alias("content"),
            m.alias("marker"),
        ),
    )


def rewrite_markers(
    text: Column,
    marker: Callable[[Column], Column],
    between: Callable[[Column], Column] = lambda gap: gap,
) -> Column:
    """Replace every typed marker in one leftmost pass.

    The text between markers and the markers themselves are two arrays of the
    same scan, so a replacement is never scanned again.
    """
    gaps = F.split(text, TYPED, -1)
    matches = F.regexp_extract_all(text, F.lit(TYPED), F.lit(0))
    pieces = F.zip_with(
        gaps,
        matches,
        lambda gap, match: F.concat(between(gap), F.when(match.isNull(), "").otherwise(marker(match))),
    )
    return F.array_join(pieces, "")


def canonical_illegible(text: Column) -> Column:
    """Spell every illegible marker as ``[...]`` or ``[... ~N chars]``."""

    def spelled(match: Column) -> Column:
        quantity = marker_quantity(match)
        return (
            F.when(~match.startswith("["), match)
            .when(quantity.isNull(), "[...]")
            .otherwise(F.concat(F.lit("[... ~"), quantity, F.lit(" chars]")))
        )

    return rewrite_markers(text, spelled)


def markers_to_markup(text: Column) -> Column:
    """Escape the text and turn its markers into markup elements."""

    def element(match: Column) -> Column:
        content = xml_escape(marker_content(match))
        quantity = marker_quantity(match)
        gap = F.concat(
            F.lit('<gap reason="illegible"'),
            F.when(quantity.isNull(), "").otherwise(
                F.concat(F.lit(' quantity="'), quantity, F.lit('" unit="character"'))
            ),
            F.lit("/>"),
        )
        return (
            F.when(match.startswith("~~"), F.concat(F.lit("<del>"), content, F.lit("</del>")))
            .when(match.startswith("{"), F.concat(F.lit("<add>"), content, F.lit("</add>")))
            .when(match.startswith("["), gap)
            .otherwise(F.concat(F.lit("<unclear>"), content, F.lit("</unclear>")))
        )

    return rewrite_markers(text, element, xml_escape)


def markup_to_markers(markup: Column) -> Column:
    """Inverse of markers_to_markup on generated inline markup."""
    out = F.regexp_replace(markup, r"<lb/>", "\n")
    out = F.regexp_replace(out, r"</?del>", "~~")
    out = F.regexp_replace(F.regexp_replace(out, r"<add>", "{"), r"</add>", "}")
    out = F.regexp_replace(F.regexp_replace(out, r"<unclear>", ""), r"</unclear>", "[?]")
    out = F.regexp_replace(
        out, r'<gap reason="illegible" quantity="([^"]*)" unit="character"/>', "[... ~$1 chars]"
    )
    return F.regexp_replace(out, r'<gap reason="illegible"/>', "[...]")


# ---------------------------------------------------------------------------
# Illegible markers that are open at a page edge

_OPEN_TAIL = UD + r"\[\.\.\.\s*(~\s*)?(\d+\s*)?$"


def edge_code(text: Column) -> Column:
    """What one non-blank page does to an illegible marker open at its edges.

    ``tail`` is the open state the page leaves (0 none, 1 after ``[...``,
    2 after ``~``, 3 after the digits); ``head`` is the open state it would
    complete; ``pass_from``/``pass_to`` describe a page that is nothing but the
    middle of a marker (``~``, ``12`` or ``~ 12``).
    """
    tail = (
        F.when(text.rlike(UD + r"\[\.\.\.\s*$"), 1)
        .when(text.rlike(UD + r"\[\.\.\.\s*~\s*$"), 2)
        .when(text.rlike(UD + r"\[\.\.\.\s*~\s*\d+\s*$"), 3)
        .otherwise(0)
    )
    head = (
        F.when(text.rlike(UD + r"^\s*~\s*\d+\s*chars?\]"), 1)
        .when(text.rlike(UD + r"^\s*\d+\s*chars?\]"), 2)
        .when(text.rlike(UD + r"^\s*chars?\]"), 3)
        .otherwise(0)
    )
    pass_from = F.when(text.rlike(UD + r"^\s*~\s*(\d+\s*)?$"), 1).when(text.rlike(UD + r"^\s*\d+\s*$"), 2).otherwise(0)
    pass_to = (
        F.when(text.rlike(UD + r"^\s*~\s*$"), 2)
        .when(text.rlike(UD + r"^\s*(~\s*)?\d+\s*$"), 3)
        .otherwise(0)
    )
    # One small integer: tail + 4*head + 16*pass_from + 64*pass_to
    return (tail + head * 4 + pass_from * 16 + pass_to * 64).cast("int")
