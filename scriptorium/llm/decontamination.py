"""Benchmark decontamination: a hash set of the test items' word windows, held against every document window.

Everything is a column expression. A document is turned into its word array once; the start of every
window of ``n`` words (and of every shorter whole item) is kept if the window's 64-bit hash is in the set,
then verified against the windows themselves. The set travels inside the plan, which is allowed only for
a checked number of windows (``max_set``); beyond it the hashes are joined in a shuffle instead, with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bound

#: Everything that is no word character: ASCII without digits and letters.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
MAX_SET = 100_000


def words(text: Column) -> Column:
    """Words of a text in order: runs of a-z, digits and non-ASCII after lower-casing A-Z; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


def item_windows(items: DataFrame, n: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(width, hash, gram, items): each distinct window with the ids of the items that hold it.

    An item of fewer words than ``n`` is one window of that width; an item without words has none.
    """
    by_item = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(n))
    by_item = by_item.select("item", "w", width.alias("width"), F.explode(F.sequence(F.lit(1), F.size("w") - width + 1)).alias("at"))
    gram = F.slice("w", F.col("at"), F.col("width"))
    return (
        by_item.select("item", "width", F.xxhash64(gram).alias("hash"), F.concat_ws(" ", gram).alias("gram"))
        .groupBy("width", "hash", "gram")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


@dataclass
class WindowSet:
    """The windows of a benchmark; ``rows`` is None beyond the size that may travel in a plan."""

    windows: DataFrame
    rows: list | None

    @classmethod
    def of(cls, items: DataFrame, n: int = WINDOW, max_set: int = MAX_SET) -> WindowSet:
        windows = item_windows(items, n)
        rows = windows.select("width", "hash", "gram").limit(max_set + 1).collect()
        return cls(windows, rows if len(rows) <= max_set else None)

    def widths(self) -> list[int]:
        found = self.rows if self.rows is not None else self.windows.select("width").distinct().collect()
        return sorted({row["width"] for row in found})

    def starts(self, w: Column, width: int) -> Column:
        """Starts (from 1) of verified windows of one width in the word array ``w``."""
        own = [row for row in self.rows if row["width"] == width]
        gram = lambda at: F.slice(w, at, F.lit(width))
        every = F.when(F.size(w) >= width, F.sequence(F.lit(1), F.size(w) - width + 1)).otherwise(F.array().cast("array<int>"))
        found = F.filter(every, lambda at: F.xxhash64(gram(at)).isin([row["hash"] for row in own]))
        return F.filter(found, lambda at: F.concat_ws(" ", gram(at)).isin([row["gram"] for row in own]))

    def hits(self, w: Column) -> Column:
        """array<struct<at, width, gram>> of all verified windows in the word array ``w``."""

        def of(width: int) -> Column:
            gram = lambda at: F.concat_ws(" ", F.slice(w, at, F.lit(width))).alias("gram")
            return F.transform(self.starts(w, width), lambda at: F.struct(at.alias("at"), F.lit(width).alias("width"), gram(at)))

        each = [of(width) for width in self.widths()]
        return F.concat(*each) if each else F.array().cast("array<struct<at:int,width:int,gram:string>>")


def _document_windows(docs: DataFrame, keys: list[str], widths: list[int]) -> DataFrame:
    """One row per document window, for window sets that do not fit in a plan."""

    def grams(w: Column, width: int) -> Column:
        gram = lambda at: F.concat_ws(" ", F.slice(w, at, F.lit(width))).alias("gram")
        every = F.transform(F.sequence(F.lit(1), F.size(w) - width + 1), lambda at: F.struct(at.alias("at"), gram(at)))
        return F.when(F.size(w) >= width, every)

    def of(width: int) -> DataFrame:
        found = bound(words(F.col("text")), lambda w: grams(w, width))
        return docs.select(*keys, F.explode(found).alias("x")).select(*keys, "x.at", F.lit(width).alias("width"), "x.gram")

    return reduce(DataFrame.unionByName, [of(width) for width in widths])


def _row_hits(docs: DataFrame, found: WindowSet) -> DataFrame:
    """(doc_id, text_hash, n_words, first, hit): a row per hit, or one with a null hit; ``first`` marks one row per document row."""
    keys = ["doc_id", "text_hash", "n_words"]
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    if found.rows is not None:
        scanned = bound(
            words(F.col("text")),
            lambda w: F.struct(F.size(w).alias("n_words"), found.hits(w).alias("hits")),
        )
        rows = base.select("doc_id", "text_hash", scanned.alias("s"))
        return rows.select("doc_id", "text_hash", "s.n_words", F.posexplode_outer("s.hits").alias("p", "hit")).select(
            *keys, (F.coalesce("p", F.lit(0)) == 0).cast("int").alias("first"), "hit"
        )
    plain = base.select("doc_id", "text_hash", F.size(words(F.col("text"))).alias("n_words"), "text")
    nothing = F.lit(None).cast("struct<at:int,width:int,gram:string>")
    every = plain.select(*keys, F.lit(1).alias("first"), nothing.alias("hit"))
    grams = found.windows.select("width", "gram")
    hits = _document_windows(plain, keys, found.widths()).join(grams, ["width", "gram"], "left_semi")
    return every.unionByName(hits.select(*keys, F.lit(0).alias("first"), F.struct("at", "width", "gram").alias("hit")))


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW, max_set: int = MAX_SET) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, hit_spans, items.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored.
    * A document word is hit if it lies inside any occurrence of a window; ``hit_spans`` are merged
      word ranges (first, last, from 1).
    * A null or empty text has no words and no hits; repeated rows are returned as often as they occur.
    * An empty table gives an empty result, an empty benchmark hits nothing. Items with a null id hit words
      but are not listed.
    """
    found = WindowSet.of(items, n, max_set)
    rows = _row_hits(docs, found)
    if not found.widths():
        rows = rows.withColumn("items", F.array().cast("array<string>"))
    else:
        by_gram = found.windows.select(F.col("width").alias("b_width"), F.col("gram").alias("b_gram"), "items")
        rows = rows.join(by_gram, (rows["hit.width"] == F.col("b_width")) & (rows["hit.gram"] == F.col("b_gram")), "left")
    grouped = rows.groupBy("doc_id", "text_hash", "n_words").agg(
        F.sum("first").alias("copies"),
        F.collect_set(F.struct(F.col("hit.at").alias("at"), F.col("hit.width").alias("width"))).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    spans = F.filter(F.sort_array("spans"), lambda s: s["at"].isNotNull())
    start = F.struct(F.array().cast("array<struct<first:int,last:int>>").alias("done"), F.lit(0).alias("first"), F.lit(-1).alias("last"))

    def add(acc: Column, s: Column) -> Column:
        end = s["at"] + s["width"] - 1
        joined = s["at"] <= acc["last"] + 1
        closed = F.when(acc["last"] > 0, F.concat(acc["done"], F.array(F.struct(acc["first"], acc["last"])))).otherwise(acc["done"])
        return F.struct(
            F.when(joined, acc["done"]).otherwise(closed).cast("array<struct<first:int,last:int>>").alias("done"),
            F.when(joined, acc["first"]).otherwise(s["at"]).alias("first"),
            F.when(joined, F.greatest(acc["last"], end)).otherwise(end).alias("last"),
        )

    def close(acc: Column) -> Column:
        return F.when(acc["last"] > 0, F.concat(acc["done"], F.array(F.struct(acc["first"], acc["last"])))).otherwise(acc["done"])

    merged = grouped.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.aggregate(spans, start, add, close).cast("array<struct<first:int,last:int>>").alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"] + 1)
    return merged.select("doc_id", "n_words", n_hit.alias("n_hit"), "hit_spans", "items")


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = WINDOW, max_set: int = MAX_SET) -> DataFrame:
    """The documents without a verified window, with all their columns.

    Nothing is shuffled while the window set fits in the plan. Null and empty texts stay.
    """
    found = WindowSet.of(items, n, max_set)
    widths = found.widths()
    if not widths:
        return docs
    if found.rows is not None:
        clean = bound(words(F.col("text")), lambda w: F.size(F.concat(*[found.starts(w, width) for width in widths])) == 0)
        return docs.where(clean)
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("h"))
    keyed = docs.select("doc_id", "text", F.to_json(key).alias("row_key"))
    hits = _document_windows(keyed, ["row_key"], widths).join(found.windows.select("width", "gram"), ["width", "gram"], "left_semi")
    return docs.join(hits.select("row_key").distinct(), F.to_json(key) == F.col("row_key"), "left_anti")
