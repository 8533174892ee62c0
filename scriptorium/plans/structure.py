"""Structure of markup documents of any size, from summaries of their fragments that merge.

A document is an ordered sequence of fragments that hold whole tags (comments and CDATA sections included); a document in one string
is one fragment. Each fragment is reduced on its own to a tag-stack summary: the end tags that close elements of earlier fragments,
the start tags that stay open, and which elements that matter were seen at which place, relative to the open elements around the
fragment. Two neighbouring summaries merge into one by matching what the left leaves open with what the right closes; the
operation is associative, so summaries of an object are merged in groups of FAN neighbours, level by level, and no task ever holds an object.

What a parser checks inside a fragment (names, attributes, references, characters) is checked by the parser, on the fragment completed
with the tags that the summary says are missing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from ..session import checkpointed
from .reading import ATTRS

#: Elements by their place in the tree; a document has them all, the header before the text.
REQUIRED = ["TEI", "TEI/teiHeader", "TEI/teiHeader/fileDesc", "TEI/text", "TEI/text/body"]
DEPTH = max(path.count("/") + 1 for path in REQUIRED)
NAMES = list(dict.fromkeys(path.rpartition("/")[2] for path in REQUIRED))
#: Marks among the places seen: an element or a second one outside the fragment's own elements, text there, a header anywhere.
ROOT, SECOND_ROOT, OUTSIDE_TEXT, HEADER = "*", "**", "#", "@"
#: Summaries merged in one task.
FAN = 512

SUMMARY = "struct<closes:array<string>,opens:array<string>,seen:array<struct<up:int,path:string>>,bad:boolean>"
#: White space of the format.
NOT_SPACE = r"[^ \t\r\n]"
PROLOG = r"(?s)^(?:<\?xml\s.*?\?>)?((?:\s|<!--.*?-->|<\?.*?\?>)*)(?:<!DOCTYPE(?:[^>\[]|\[.*?\])*>)?"


def _summary(closes: Column, opens: Column, seen: Column, bad: Column) -> Column:
    return F.struct(closes.alias("closes"), opens.alias("opens"), seen.alias("seen"), bad.alias("bad"))


def _nothing(bad: bool) -> Column:
    none = F.array().cast("array<string>")
    return _summary(none, none, F.array().cast("array<struct<up:int,path:string>>"), F.lit(bad)).cast(SUMMARY)


def _place(up: Column, path: Column) -> Column:
    return F.struct(up.cast("int").alias("up"), path.cast("string").alias("path"))


def _at(up: Column, mark: str, when: Column) -> Column:
    """The mark as an array of one place, or of none."""
    return F.when(when, F.array(_place(up, F.lit(mark)))).otherwise(F.array().cast("array<struct<up:int,path:string>>"))


def _local(name: Column) -> Column:
    return F.substring_index(name, ":", -1)


def _mended(s: Column) -> Column:
    """A broken summary carries nothing: the object is broken whatever else it holds."""
    return F.when(s["bad"], _nothing(True)).otherwise(s)


def _roots(before: Column, up: Column, when: Column) -> Column:
    """Marks for another element outside the open ones."""
    again = F.exists(before, lambda p: (p["up"] == up) & (p["path"] == ROOT))
    return F.concat(_at(up, ROOT, when & ~again), _at(up, SECOND_ROOT, when & again))


def tokens(fragment: Column) -> Column:
    """array<struct<name, kind, text>>: tags in order (kind o, c or e for open, close and empty) and whether text follows; text in front has no name."""
    plain = F.regexp_replace(F.regexp_replace(fragment, r"(?s)<!--.*?-->|<\?.*?\?>", ""), r"(?s)<!\[CDATA\[.*?\]\]>", "x")
    found = F.regexp_extract_all(plain, F.lit(rf"<[^\s<>!?\"'=]+{ATTRS}>[^<]*"), F.lit(0))
    start = rf"^<{ATTRS}>"

    def token(t: Column) -> Column:
        tag = F.regexp_extract(t, start, 0)
        kind = F.when(tag.startswith("</"), "c").when(tag.endswith("/>"), "e").otherwise("o")
        text = F.regexp_replace(t, start, "").rlike(NOT_SPACE)
        return F.struct(F.regexp_extract(tag, r"^</?([^\s<>/]+)", 1).alias("name"), kind.alias("kind"), text.alias("text"))

    leading = F.struct(F.lit("").alias("name"), F.lit("t").alias("kind"), F.regexp_extract(plain, "^[^<]*", 0).rlike(NOT_SPACE).alias("text"))
    return F.concat(F.array(leading), F.transform(found, token))


def _next(s: Column, t: Column) -> Column:
    """The summary with one more token."""
    depth, up = F.size(s["opens"]), F.size(s["closes"])
    starts = t["kind"].isin("o", "e")
    closes_own = (t["kind"] == "c") & (depth > 0)
    opens = (
        F.when(t["kind"] == "o", F.concat(s["opens"], F.array(t["name"])))
        .when(closes_own, F.slice(s["opens"], F.lit(1), depth - 1))
        .otherwise(s["opens"])
    )
    closes = F.when((t["kind"] == "c") & (depth == 0), F.concat(s["closes"], F.array(t["name"]))).otherwise(s["closes"])
    local = _local(t["name"])
    path = F.array_join(F.concat(F.transform(s["opens"], _local), F.array(local)), "/")
    matters = starts & local.isin(*NAMES) & (depth < DEPTH)
    seen = F.concat(
        F.when(matters, F.array(_place(up, path))).otherwise(F.array().cast("array<struct<up:int,path:string>>")),
        _at(F.lit(0), HEADER, starts & (local == "teiHeader")),
        _roots(s["seen"], up, starts & (depth == 0)),
        _at(F.size(closes), OUTSIDE_TEXT, t["text"] & (F.size(opens) == 0)),
    )
    bad = closes_own & (F.element_at(s["opens"], -1) != t["name"])
    return F.when(s["bad"], s).otherwise(_mended(_summary(closes, opens, F.array_union(s["seen"], seen), bad)))


def merged(a: Column, b: Column) -> Column:
    """The summary of two neighbouring stretches from their summaries."""
    n, up = F.size(a["opens"]), F.size(a["closes"])
    matched = F.least(n, F.size(b["closes"]))
    open_tail = F.reverse(F.slice(a["opens"], n - matched + 1, matched))
    bad = a["bad"] | b["bad"] | (open_tail != F.slice(b["closes"], F.lit(1), matched))
    rest = F.slice(b["closes"], matched + 1, F.size(b["closes"]))
    marks = (ROOT, SECOND_ROOT, OUTSIDE_TEXT)

    def placed(p: Column) -> Column:
        inside = F.slice(a["opens"], F.lit(1), F.greatest(n - p["up"], F.lit(0)))
        path = F.array_join(F.concat(F.transform(inside, _local), F.array(p["path"])), "/")
        moved = _place(up + F.greatest(p["up"] - n, F.lit(0)), F.when(F.size(inside) > 0, path).otherwise(p["path"]))
        return F.when(p["path"] == HEADER, p).otherwise(moved)

    def stays(p: Column) -> Column:
        return F.when(p["path"] == HEADER, F.lit(True)).when(p["path"].isin(*marks), p["up"] >= n).otherwise(
            n - p["up"] + F.size(F.split(p["path"], "/")) <= DEPTH
        )

    own = F.transform(F.filter(b["seen"], stays), placed)
    twice = F.filter(own, lambda p: (p["path"] == ROOT) & F.array_contains(a["seen"], p))
    seconds = F.transform(twice, lambda p: _place(p["up"], F.lit(SECOND_ROOT)))
    seen = F.array_union(F.array_union(a["seen"], own), seconds)
    opens = F.concat(F.slice(a["opens"], F.lit(1), n - matched), b["opens"])
    return _mended(_summary(F.concat(a["closes"], rest), opens, seen, bad))


def fragment_summaries(fragments: DataFrame, column: str = "fragment") -> DataFrame:
    """``fragments`` with ``summary`` in place of the text; an object's first fragment has a true column ``first``."""
    inner = F.when(F.col("first"), F.regexp_replace(column, PROLOG, "$1")).otherwise(F.col(column))
    rows = fragments.withColumn("_inner", F.coalesce(inner, F.lit("")))
    rows = rows.withColumn("_summary", F.aggregate(tokens(F.col("_inner")), _nothing(False), _next))
    tag = lambda names, left: F.array_join(F.transform(F.reverse(names), lambda c: F.concat(F.lit(left), c, F.lit(">"))), "")
    whole = F.concat(F.lit("<r>"), tag(F.col("_summary.closes"), "<"), F.col("_inner"), tag(F.col("_summary.opens"), "</"), F.lit("</r>"))
    parsed = F.from_xml(F.when(F.col("_summary.bad"), "").otherwise(whole), "unused STRING, _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    rows = rows.withColumn("_parsed", parsed)
    fine = F.col("_parsed").isNotNull() & F.col("_parsed._bad").isNull()
    return rows.withColumn("summary", F.when(fine, F.col("_summary")).otherwise(_nothing(True))).drop(column, "_inner", "_summary", "_parsed")


def summaries(fragments: DataFrame, fan: int = FAN) -> DataFrame:
    """(object_id, summary) of whole objects from ``fragments`` (object_id, section, ordinal, fragment)."""
    rows = numbered(fragments.select("object_id", "section", "ordinal", "fragment"), ["object_id"], ["section", "ordinal"], "n")
    rows = checkpointed(fragment_summaries(rows.withColumn("first", F.col("n") == 1)).select("object_id", "n", "summary"))
    most = rows.agg(F.max("n")).first()[0] or 1
    for _ in range(max(1, math.ceil(math.log(most, fan) - 1e-9))):
        rows = checkpointed(_merged_neighbours(rows, fan))
    return rows.drop("n")


def _merged_neighbours(rows: DataFrame, fan: int) -> DataFrame:
    """(object_id, n, summary) with ``fan`` neighbours in one summary.

    Summaries are few bytes and much work, so the number of tasks is given and not left to AQE, which joins small partitions into
    one. Callers checkpoint the result; otherwise each condition on a summary would merge again.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = rows.withColumn("group", F.floor((F.col("n") - 1) / fan) + 1).repartition(parts, "object_id", "group")
    members = F.array_sort(F.collect_list(F.struct("n", "summary")))
    grouped = grouped.groupBy("object_id", F.col("group").alias("n")).agg(members.alias("members"))
    first, rest = F.element_at("members", 1)["summary"], F.slice("members", F.lit(2), F.size("members"))
    return grouped.select("object_id", "n", F.aggregate(rest, first, lambda whole, m: merged(whole, m["summary"])).alias("summary"))


def as_fragments(documents: DataFrame) -> DataFrame:
    """Documents (object_id, markup) as fragments, one each."""
    return documents.select("object_id", F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("ordinal"), F.col("markup").alias("fragment"))


def with_well_formed(found: DataFrame) -> DataFrame:
    """Add ``well_formed`` to summaries of whole objects: all tags matched, one root and no text outside."""
    s, has = F.col("summary"), lambda mark: F.array_contains(F.col("summary.seen"), _place(F.lit(0), F.lit(mark)))
    closed = (F.size(s["closes"]) == 0) & (F.size(s["opens"]) == 0)
    return found.withColumn("well_formed", ~s["bad"] & closed & has(ROOT) & ~has(SECOND_ROOT) & ~has(OUTSIDE_TEXT))


def well_formed(fragments: DataFrame, fan: int = FAN) -> DataFrame:
    """(object_id, well_formed) of objects of any size."""
    return with_well_formed(summaries(fragments, fan)).select("object_id", "well_formed")


def conformance(fragments: DataFrame, fan: int = FAN) -> DataFrame:
    """(object_id, well_formed, has_header, status, errors) of ``fragments`` (object_id, section, ordinal, fragment).

    Required elements count at their place in the tree alone; ``has_header`` asks for a header anywhere. Fragments hold whole tags. Repeated
    (section, ordinal) pairs of an object are taken in any order; an object without text is not well-formed; entities declared in a document's own
    DOCTYPE are not known. An empty table gives an empty result.
    """
    base = with_well_formed(summaries(fragments, fan))
    place = lambda path: F.array_position(F.col("summary.seen"), _place(F.lit(0), F.lit(path)))
    header, body = place("TEI/teiHeader"), place("TEI/text")
    errors = F.array_compact(
        F.array(
            F.when(~F.col("well_formed"), "not well-formed"),
            *[F.when(F.col("well_formed") & (place(path) == 0), f"missing element {path}") for path in REQUIRED],
            F.when(F.col("well_formed") & (header > body) & (body > 0), "header behind the text"),
        )
    )
    return base.select(
        "object_id",
        "well_formed",
        (F.col("well_formed") & (place(HEADER) > 0)).alias("has_header"),
        F.when(F.size(errors) == 0, "valid").otherwise("invalid").alias("status"),
        errors.alias("errors"),
    )
