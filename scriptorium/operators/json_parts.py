"""JSON documents of any size, read in chunks: the pages one by one, and the document without them.

A file is cut behind every closing brace, wherever it stands, so Spark reads ranges of one file in many tasks and no chunk is longer than
what stands between two braces. What a chunk means depends on what is open where it begins. Three running sums over the chunks of an
object tell: quotes (inside a string or not), brackets (depth), and page objects closed so far (which page). Each is a sum over ranges
with one carried number per range (``ordered``), so an object may have any number of chunks. A brace cannot be escaped in JSON, so a cut
never falls into an escape.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from .ordered import SEGMENT, Prior, range_segments, with_prior

STRING = r'"(?:[^"\\]++|\\.)*+"'
#: The key of the list of pages, as it can only stand outside of strings.
PAGES_KEY = r'(?<!\\)"pages"[ \t\r\n]*:[ \t\r\n]*\['
#: What can stand in front of the end of the list: elements without braces.
LIST_END = rf"(?s)^((?:[^\"\[\]{{}}]++|{STRING}|\[(?:[^\"\[\]{{}}]++|{STRING})*+\])*+)\]"
KEYS = ["object_id"]


def chunks_of_texts(texts: DataFrame) -> DataFrame:
    """(object_id, n, chunk, ends) of texts (object_id, value): chunks in order, and whether a brace ended each."""
    # split once a text: an expression beside the rows that it is exploded into is computed for each of them, and the inner form, of no
    # use as there is a chunk at least, splits for a filter
    rows = texts.select("object_id", F.split(F.coalesce("value", F.lit("")), r"\}", -1).alias("_chunks"))
    rows = rows.withColumn("_parts", F.size("_chunks")).select("object_id", "_parts", F.posexplode_outer("_chunks").alias("n", "chunk"))
    return rows.select("object_id", F.col("n").cast("long").alias("n"), "chunk", (F.col("n") < F.col("_parts") - 1).alias("ends"))


def chunks_of_files(spark: SparkSession, path: str, stem, least_bytes: int = 0, glob: str = "*.json") -> DataFrame:
    """The same for files of ``least_bytes`` or more; ``stem`` maps a file name to the object.

    A file is read in ranges of ``spark.sql.files.maxPartitionBytes``.
    """
    read = spark.read.option("pathGlobFilter", glob).option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    rows = read.filter(meta.file_size >= least_bytes).select(
        stem(meta.file_name).alias("object_id"), meta.file_size.alias("_size"), meta.file_block_start.alias("_block"),
        F.monotonically_increasing_id().alias("_row"), F.col("value").alias("chunk"),
    )
    # the last chunk of a file ended with a brace if the bytes add up
    placed = with_prior(rows, KEYS, ["_block", "_row"], Prior("n", "count"), Prior("_before", "sum", F.octet_length("chunk") + 1))
    ends = F.col("_before") + F.octet_length("chunk") + 1 <= F.col("_size")
    return placed.select("object_id", "n", "chunk", ends.alias("ends"))


def _count(value: Column, chars: str) -> Column:
    return F.length(value) - F.length(F.translate(value, chars, ""))


def _structure(chunk: Column, inside: Column) -> Column:
    """The chunk without its strings; ``inside``: it begins in one."""
    clean = F.regexp_replace(chunk, r"(?s)\\.", "")
    return F.regexp_replace(F.regexp_replace(F.concat(F.when(inside, '"').otherwise(""), clean), '"[^"]*"', ""), '"[^"]*$', "")


def _quotes(chunk: Column) -> Column:
    return _count(F.regexp_replace(chunk, r"(?s)\\.", ""), '"')


def _change(structure: Column) -> Column:
    return _count(structure, "[{") - _count(structure, "]}")


def _opening(chunk: Column, inside: Column, depth: Column) -> Column:
    """Length of the chunk up to the opening of the document's list of pages, null if it is not in here."""
    parts, keys = F.split(chunk, PAGES_KEY, -1), F.regexp_extract_all(chunk, F.lit(PAGES_KEY), F.lit(0))

    def place(i: Column) -> Column:
        before = F.array_join(F.transform(F.sequence(F.lit(0), i), lambda j: F.concat(F.when(j > 0, F.get(keys, j - 1)).otherwise(""), F.get(parts, j))), "")
        outside = (_quotes(before) + inside.cast("int")) % 2 == 0
        fits = outside & (depth + _change(_structure(before, inside)) == 1)
        return F.when(fits, F.length(before) + F.length(F.get(keys, i)))

    found = F.when(F.size(keys) > 0, F.transform(F.sequence(F.lit(0), F.size(keys) - 1), place))
    return F.get(F.array_compact(found), F.lit(0))


def places_of(chunks: DataFrame, table: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What is open where each chunk begins, and where in it the list of pages opens (``here``, ``open``) and ends (``close``).

    The running sums see a few numbers a chunk, split by ranges once; ``table`` keeps what is needed on the way.
    """
    chunk = F.col("chunk")
    until_end = lambda text: F.when(text.rlike(LIST_END), F.length(F.regexp_extract(text, LIST_END, 1)))
    rows = chunks.select(
        *KEYS, "n", "ends", _quotes(chunk).alias("quotes"),
        _change(_structure(chunk, F.lit(False))).alias("outer"), _change(_structure(chunk, F.lit(True))).alias("inner"),
        until_end(chunk).alias("end"), F.when(chunk.contains('"pages"'), chunk).alias("text"),
    )
    # the split by ranges reads its rows twice, so what is counted in the texts is kept first
    rows = range_segments(table(rows), KEYS, ["n"], table)
    rows = with_prior(rows, KEYS, ["n"], Prior("before", "sum", F.col("quotes")))
    inside = F.col("before") % 2 == 1
    closes = (F.col("ends") & ((F.col("before") + F.col("quotes")) % 2 == 0)).cast("int")
    rows = rows.withColumns({"inside": inside, "closes": closes})
    rows = table(rows.withColumn("delta", F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer")) - F.col("closes")))
    rows = with_prior(rows, KEYS, ["n"], Prior("depth", "sum", F.col("delta")))
    rows = table(rows.withColumn("open", F.when(F.col("text").isNotNull(), _opening(F.col("text"), F.col("inside"), F.col("depth")))))
    rows = with_prior(rows, KEYS, ["n"], Prior("opened", "sum", F.col("open").isNotNull().cast("int")))
    rows = rows.withColumn("here", F.col("open").isNotNull() & (F.col("opened") == 0))
    # from the first opening on the list may end in chunks that stand between pages
    between = (F.col("opened") > 0) & (F.col("depth") == 2) & ~F.col("inside")
    close = F.when(F.col("here"), until_end(F.substr("text", F.col("open") + 1))).when(between, F.col("end"))
    rows = table(rows.withColumn("close", close).drop("text"))
    in_list = ((F.col("opened") > 0) | F.col("here")) & (F.col("closes") == 1) & (F.col("depth") + F.col("delta") == 2)
    rows = with_prior(
        rows, KEYS, ["n"], Prior("closed", "sum", F.col("close").isNotNull().cast("int")), Prior("element", "sum", in_list.cast("int"))
    )
    rows = rows.withColumn("region", F.when((F.col("opened") == 0) & ~F.col("here"), 0).when(F.col("closed") > 0, 2).otherwise(1))
    return rows.select(
        *KEYS, "n", "region", "element", "here", "open", "close", (F.col("depth") + F.col("delta")).alias("after"), (F.col("before") + F.col("quotes")).alias("strings")
    )


def located(chunks: DataFrame, places: DataFrame) -> DataFrame:
    """Chunks with ``region`` (0 before, 1 in, 2 behind the pages), ``head`` and ``tail`` (text of the document around them),
    ``body`` (text of the pages), ``element`` (page objects closed before), ``after`` (depth at the end) and ``strings`` (quotes so far).
    """
    # there are far more places than their compressed size lets Spark expect, so they are not broadcast
    found, chunk = places.hint("merge").join(chunks, [*KEYS, "n"]), F.col("chunk")
    brace = F.when(F.col("ends"), "}").otherwise("")
    listed = F.when(F.col("here"), F.substr("chunk", F.col("open") + 1)).otherwise(chunk)
    shut = F.col("close").isNotNull()
    return found.select(
        *KEYS, "n", "region", "element", "after", "strings",
        F.when(F.col("region") == 0, F.concat("chunk", brace)).when(F.col("here"), F.substr("chunk", F.lit(1), F.col("open"))).otherwise("").alias("head"),
        F.when(F.col("region") != 1, "").when(shut, F.substr(listed, F.lit(1), F.col("close"))).otherwise(F.concat(listed, brace)).alias("body"),
        F.when(F.col("region") == 2, F.concat("chunk", brace))
        .when((F.col("region") == 1) & shut, F.concat(F.substr(listed, F.col("close") + 1), brace)).otherwise("").alias("tail"),
    )


def parse(chunks: DataFrame, details: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, pages) of chunks (object_id, n, chunk, ends).

    documents: object_id, doc (VARIANT of the document with an empty list of pages), readable, n_pages (null without a list of pages).
    pages: object_id, position from 0, raw (VARIANT). A document that is no JSON object, or whose pages are not all JSON, is not readable and has no
    pages. Elements of the list that are no objects count as pages; lists among them may hold no lists. A document without its pages, and a
    single page, must fit a VARIANT. Empty texts are not readable; an empty table gives empty results.

    ``details`` makes further columns of the pages out of the documents: (object_id, position, columns), one row for a page at most.
    """
    with scratch(chunks.sparkSession) as table:
        with scratch(chunks.sparkSession) as once:
            chunks = once(chunks)  # read twice: to count and to cut
            with scratch(chunks.sparkSession) as before:
                places = once(places_of(chunks, before))
            rows = table(located(chunks, places))
        return _parsed(rows, table, details)


def _parsed(
    rows: DataFrame, table: Callable[..., DataFrame], details: Callable[[DataFrame], DataFrame] | None
) -> tuple[DataFrame, DataFrame]:
    """(documents, pages) of located chunks."""
    piece = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", c))), lambda x: x[c]), "")
    used = rows.groupBy("object_id").agg(
        F.max_by("after", "n").alias("depth"), F.min("after").alias("lowest"), (F.max("strings") % 2).alias("open_string"), F.max("region").alias("region")
    )
    frame = rows.filter((F.col("head") != "") | (F.col("tail") != "")).withColumn("text", F.concat("head", "tail"))
    frame = frame.groupBy("object_id").agg(piece("text").alias("value"))
    groups = rows.filter("region = 1").groupBy("object_id", "element").agg(piece("body").alias("text"))
    # elements are parted by commas: none in front of the first, one in front of each other
    comma = F.col("text").rlike(r"^[ \t\r\n]*,")
    inner = F.when((F.col("element") > 0) & comma, F.regexp_replace("text", r"^[ \t\r\n]*,", ""))
    inner = inner.when((F.col("element") == 0) & ~comma, F.col("text"))
    blank = F.col("text").rlike(r"^[ \t\r\n]*$")
    items = F.try_parse_json(F.concat(F.lit("["), inner, F.lit("]"))).try_cast("array<variant>")
    groups = groups.filter(~blank).select("object_id", "element", items.alias("items"))
    groups = table(groups.withColumn("size", F.when(F.col("items").isNotNull(), F.size("items")).otherwise(0)), keep=True)
    bad = groups.filter("size = 0").select("object_id").distinct().withColumn("broken", F.lit(True))
    counts = groups.groupBy("object_id").agg(F.sum("size").alias("elements"))
    doc = F.try_parse_json("value")
    sound = (F.col("depth") == 0) & (F.col("lowest") >= 0) & (F.col("open_string") == 0)
    documents = (
        used.join(frame, "object_id", "left").join(bad, "object_id", "left").join(counts, "object_id", "left")
        .withColumn("doc", doc)
        .select(
            "object_id", "doc",
            F.coalesce(sound & F.col("doc").isNotNull() & F.col("value").rlike(r"^\s*\{") & F.col("broken").isNull(), F.lit(False)).alias("readable"),
            F.when(F.col("region") > 0, F.coalesce("elements", F.lit(0))).cast("int").alias("n_pages"),
        )
    )
    documents = table(documents, keep=True)
    readable = documents.filter("readable").select("object_id")
    # the places of pages alone are put in order and get their details, so the pages are shuffled once
    sizes = groups.filter("size > 0").select("object_id", "element", "size").join(readable.hint("merge"), "object_id", "left_semi")
    places = with_prior(range_segments(table(sizes), KEYS, ["element"], table), KEYS, ["element"], Prior("start", "sum", F.col("size")))
    places = places.select("object_id", "element", "start", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("at"))
    places = places.select("object_id", "element", "at", (F.col("start") + F.col("at")).cast("int").alias("position"))
    if details is not None:
        places = places.join(details(documents).hint("merge"), ["object_id", "position"], "left")
    places = table(places, keep=True)
    pages = groups.select("object_id", "element", F.posexplode("items").alias("at", "raw"))
    pages = pages.join(places.hint("merge"), ["object_id", "element", "at"])
    return documents, pages.select("object_id", "position", "raw", *places.columns[4:])
