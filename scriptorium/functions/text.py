"""Text functions: whitespace, normalisation profiles, escaping, redaction, repair."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .rows import by_row

# Unicode white space as str.split() sees it: the White_Space property plus the
# four information separators.
SPACE = r"[\s\x{1C}-\x{1F}]"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
U = "(?U)"  # Unicode character classes
UD = "(?Ud)"  # ... and "." stops at \n only

# Complement of the XML 1.0 Char production (fixed value of the XML standard).
XML_ILLEGAL = r"[^\t\n\r\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"


def strip(col: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(col, F.lit(SPACES))


def is_blank(col: Column) -> Column:
    """Null, empty or white space only."""
    return col.isNull() | ~col.rlike(rf"{U}[^\s\x{{1C}}-\x{{1F}}]")


def has_text(col: Column) -> Column:
    return ~is_blank(col)


def non_empty(col: Column) -> Column:
    """The value, or null when it is the empty string."""
    return F.when(col != "", col)


def word_count(col: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(col, F.lit(rf"{U}[^\s\x{{1C}}-\x{{1F}}]+"))


def collapse_whitespace(col: Column) -> Column:
    """All white space to single blanks, ends trimmed (profile hsa-strict)."""
    return F.btrim(F.regexp_replace(col, rf"{U}{SPACE}+", " "), F.lit(" "))


# A text of these characters alone is in NFC: none has a decomposition, a combining class or joins the one before it.
NOT_COMPOSED = r"[^\x{0}-\x{2FF}\x{2002}-\x{20CF}\x{4E00}-\x{9FFF}\x{1F000}-\x{1FAFF}]"


def _nfc(value: str | None) -> str | None:
    return None if value is None else unicodedata.normalize("NFC", value)


def nfc(col: Column, source: Column | None = None) -> Column:
    """Unicode NFC, which Spark has no built-in for; only texts that may change go to Python.

    ``source`` may give the text that ``col`` is made from, if that adds none of the characters looked for; it is cheaper to look at.
    """
    may_change = (col if source is None else source).rlike(NOT_COMPOSED)
    return F.coalesce(by_row(_nfc, StringType())(F.when(may_change, col)), col)


# Fixed values of the zbz profile: double quotes, single quotes, dashes; the
# soft hyphen has no counterpart and is dropped by translate.
_ZBZ_FROM = "«»„“”" + "‹›`´‘’" + "‐‑‒–—" + "\u00ad"
_ZBZ_TO = '"""""' + "''''''" + "-----"


def normalise_symmetric(col: Column) -> Column:
    """Quotes, dashes, soft hyphen, French punctuation, white space; without NFC."""
    unified = F.translate(col, _ZBZ_FROM, _ZBZ_TO)
    tight = F.regexp_replace(unified, r" +([;:?!])", "$1")
    return collapse_whitespace(tight)


def normalise_zbz(col: Column) -> Column:
    """The zbz profile: symmetric normalisation, then NFC."""
    return nfc(normalise_symmetric(col), col)


def comparison_text(col: Column, keep_line_breaks: bool = True) -> Column:
    """White-space normal form of a page text for the round-trip comparison."""
    if not keep_line_breaks:
        return collapse_whitespace(col)
    breaks = F.regexp_replace(col, r"\r\n|\r", "\n")
    runs = F.regexp_replace(breaks, r"[\t \f\x0B]+", " ")
    lines = F.transform(F.split(runs, "\n", -1), strip)
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def display_text(col: Column) -> Column:
    """Display form: lines trimmed, at most one blank line, ends trimmed."""
    lines = F.transform(F.split(col, "\n", -1), strip)
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def xml_escape(col: Column) -> Column:
    """The four XML-significant characters; null becomes empty."""
    out = F.replace(F.coalesce(col, F.lit("")), F.lit("&"), F.lit("&amp;"))
    for char, entity in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def xml_unescape(col: Column) -> Column:
    """Character references decoded once: decimal, hexadecimal and the five named ones; others stay as they are."""
    parts = F.split(col, "&#", -1)
    head, tail = F.get(parts, 0), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    out = F.when(col.contains("&#"), F.concat(head, F.array_join(F.transform(tail, _numeric_reference), ""))).otherwise(col)
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def _numeric_reference(part: Column) -> Column:
    """The character of ``123;`` or ``x7b;`` and what follows; an ampersand stays escaped for the named references."""
    number = F.regexp_extract(part, r"\A([0-9]{1,7}|x[0-9A-Fa-f]{1,6});", 1)
    point = F.when(number.startswith("x"), F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).try_cast("long")
    usable = (point >= 1) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(usable, point).otherwise(63)), 8, "0")), "UTF-32")
    rest = F.substr(part, F.length(number) + 2)
    return F.when(usable.eqNullSafe(True), F.concat(F.when(point == 38, "&amp;").otherwise(char), rest)).otherwise(F.concat(F.lit("&#"), part))


def without_cdata(col: Column) -> Column:
    """Comments dropped and CDATA sections turned into escaped text, each where the other does not hold it."""
    plain = F.regexp_replace(col, r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->", "$1")
    parts = F.split(plain, r"<!\[CDATA\[", -1)

    def section(part: Column) -> Column:
        end = F.locate("]]>", part)
        inside = F.when(end > 0, F.substr(part, F.lit(1), end - 1)).otherwise(part)
        for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            inside = F.replace(inside, F.lit(char), F.lit(reference))
        return F.concat(inside, F.when(end > 0, F.substr(part, end + 3)).otherwise(""))

    tail = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.when(plain.contains("<![CDATA["), F.concat(F.get(parts, 0), F.array_join(F.transform(tail, section), ""))).otherwise(plain)


def has_illegal_xml(col: Column) -> Column:
    return col.rlike(XML_ILLEGAL).eqNullSafe(True)


def paragraphs(col: Column) -> Column:
    """Array of paragraphs of a trimmed page text (blank lines separate)."""
    return F.split(strip(col), r"\n{2,}", -1)


def lines(col: Column) -> Column:
    """Array of trimmed non-empty lines."""
    return F.filter(F.transform(F.split(col, "\n", -1), strip), lambda x: x != "")


def paragraph_count(col: Column) -> Column:
    return F.when(has_text(col), F.size(paragraphs(col))).otherwise(F.lit(0))


def redact_secrets(col: Column, secrets: list[str] | tuple[str, ...] = ()) -> Column:
    """Hide key query parameters and the given literal secrets."""
    out = F.regexp_replace(
        F.coalesce(col, F.lit("")),
        r"(?i)([?&](?:key|api[_-]?key|access[_-]?token)=)[^&\s\"']+",
        "$1[redacted]",
    )
    for secret in secrets:
        if secret:
            out = F.replace(out, F.lit(secret), F.lit("[redacted]"))
    return out


def strip_code_fence(col: Column) -> Column:
    opened = F.regexp_replace(strip(col), r"^```(?:json)?\s*\n?", "")
    return F.regexp_replace(opened, r"\n?```\s*$", "")


def repair_raw_newlines(col: Column) -> Column:
    """Escape raw newlines of a JSON text, then restore the structural ones."""
    out = F.replace(col, F.lit("\n"), F.lit("\\n"))
    for escaped, structural in (
        ("{\\n", "{\n"), ("\\n}", "\n}"), ("[\\n", "[\n"), ("\\n]", "\n]"), (",\\n", ",\n"),
    ):
        out = F.replace(out, F.lit(escaped), F.lit(structural))
    return out


def escape_newlines_in_strings(col: Column) -> Column:
    """Escape raw newlines of a JSON text inside its strings alone, whatever stands beside them."""
    parts = F.regexp_extract_all(col, F.lit(r'(?s)"(?:[^"\\]++|\\.)*+"?|[^"]++'), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith('"'), F.replace(p, F.lit("\n"), F.lit("\\n"))).otherwise(p)), "")


def lower_trim(col: Column) -> Column:
    return F.lower(strip(col))


def keeps_line_breaks(edition_type: Column) -> Column:
    """Line breaks carry meaning unless the edition type declares normalisation."""
    return ~F.coalesce(edition_type, F.lit("")).rlike(r"(?i)normali[sz]")


def provenance_value(col: Column, key: str) -> Column:
    """The 12-hex value of ``key=...`` in a provenance note, or empty."""
    return F.coalesce(F.regexp_extract(col, rf"\b{key}=([0-9a-f]{{12}})\b", 1), F.lit(""))


def basename(col: Column) -> Column:
    return F.element_at(F.split(col, "/", -1), -1)


def is_local_filename(col: Column) -> Column:
    """A bare file name without any folder part."""
    return ((col != "") & ~col.contains("/") & ~col.isin(".", "..")).eqNullSafe(True)


def is_safe_record_path(col: Column) -> Column:
    """A relative POSIX path that cannot leave its root; null means not declared."""
    return col.isNull() | (
        has_text(col)
        & ~col.contains("\\")
        & ~col.startswith("/")
        & ~col.contains(":")
        & ~F.array_contains(F.split(col, "/", -1), "..")
    )


def is_hex(col: Column, length: int) -> Column:
    return col.rlike(rf"\A[0-9a-f]{{{length}}}\z").eqNullSafe(True)


def is_safe_url(col: Column) -> Column:
    return col.rlike(r"^https?://").eqNullSafe(True)


def natural_key(col: Column) -> Column:
    """Sort key with digit runs as numbers and text case-folded.

    Every digit run is prefixed with its significant length, so plain array
    comparison orders numbers of any size; numbers sort before text.
    """
    tokens = F.regexp_extract_all(F.lower(col), F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))

    def token_key(token: Column) -> Column:
        digits = F.regexp_replace(token, r"^0+(?=[0-9])", "")
        number = F.concat(F.lit("0"), F.lpad(F.length(digits).cast("string"), 6, "0"), digits)
        return F.when(token.rlike(r"^[0-9]"), number).otherwise(F.concat(F.lit("1"), token))

    return F.transform(tokens, token_key)
