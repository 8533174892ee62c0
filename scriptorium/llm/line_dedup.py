"""Substring deduplication by hashing sentences of lines.

A line is cut behind each run of ``.!?``; the pieces are the units. A unit is normalised (A-Z in lower case, white space to one space)
and reduced to a 128-bit digest; digests are grouped over the whole corpus and the earliest ranked occurrence of each stays. The
rank is the order of (doc_id, text hash, unit), null ids last. Single units repeat by chance, so what goes is a run: neighbouring
units of a text that all repeat earlier ones and hold RUN_WORDS words together. Grouping combines before the shuffle, so a
unit that a third of all documents share is one row per task; the join that brings decisions back is left to skew splitting.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Words that a run of repeated units holds at least. A passage of 50 words loses less than a sentence at either end.
RUN_WORDS = 25
#: A line up to its next end of a sentence, what is left of a line, or line ends.
UNIT = re.compile(r"[^.!?\n]*[.!?]+|[^.!?\n]+|\n+")
SCHEMA = "doc_id long, text_hash long, unit int, start long, end long, words int, digest binary"
REMOVED = "array<struct<unit:int,start:bigint,end:bigint,words:int,kept_doc_id:bigint>>"


def units_of(text: str) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(unit, start, end, words, digest) of every piece with words; offsets count characters of the text as it came."""
    n = 0
    for found in UNIT.finditer(text):
        words = found.group().encode().lower().split()
        if words:
            yield n, found.start(), found.end(), len(words), hashlib.blake2b(b" ".join(words), digest_size=16).digest()
            n += 1


def units(docs: DataFrame) -> DataFrame:
    """A row per unit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text_hash, text in zip(batch["doc_id"], batch["text_hash"], batch["text"]):
                own = None if pd.isna(doc_id) else int(doc_id)
                rows += [(own, text_hash, *unit) for unit in units_of(text)]
                if len(rows) > 10_000:
                    yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                    rows = []
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    used = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return used.mapInPandas(run, SCHEMA)


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, unit, start, end, words, kept_doc_id): every unit that repeats an earlier one, and where the earliest is."""
    found = units(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "unit")
    first = found.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).where("first <> last")
    # a table, so that both sides of the join are shuffled on their own and a unit that very many documents share can be split
    first = written(first.select("digest", "first"), "repeated-units")
    again = found.join(first, "digest").where(rank != F.col("first"))
    return again.select("doc_id", "text_hash", "unit", "start", "end", "words", F.col("first.doc_id").alias("kept_doc_id"))


def _runs(units_in_order: pd.Series, least: int) -> pd.Series:
    """The units that stand in long enough runs of neighbours."""
    kept = []
    for own in units_in_order:
        run, out, last = [], [], None
        for u in [*own, None]:
            if run and (u is None or u["unit"] != last + 1):
                if sum(x["words"] for x in run) >= least:
                    out += run
                run = []
            if u is not None:
                run.append(u)
                last = u["unit"]
        kept.append(out)
    return pd.Series(kept)


def _text(text: Column, removed: Column) -> Column:
    """The text without the stretches from the first to the last unit of each run."""
    def step(state: Column, r: Column) -> Column:
        # between neighbouring units only blanks and line ends stand, and they go with them
        joined = r["unit"] == state["unit"] + 1
        kept = F.when(joined, state["kept"]).otherwise(F.concat(state["kept"], F.array(F.substr(text, (state["at"] + 1).cast("int"), (r["start"] - state["at"]).cast("int")))))
        return F.struct(kept.alias("kept"), r["end"].alias("at"), r["unit"].alias("unit"))

    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).cast("long").alias("at"), F.lit(-2).alias("unit"))
    end = lambda s: F.concat(F.array_join(s["kept"], ""), F.substr(text, (s["at"] + 1).cast("int")))
    return F.aggregate(removed, start, step, end)


def without_repeats(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """(row, removed): each row of ``docs`` as a struct, its text without repeated runs, and the units that were removed.

    ``removed`` is null or array<struct<unit, start, end, words, kept_doc_id>> in text order; what stands between two removed neighbours goes
    with them and all else stays as it was. A text may become empty; a null text stays null. Rows with equal id and text are one
    document in several copies and all get the same result. A very long text is one row, its units are many. All columns are kept; an
    empty table gives an empty result.
    """
    runs = F.pandas_udf(lambda own: _runs(own, run_words), REMOVED)
    removed = (
        repeated(docs)
        .distinct()
        .groupBy("doc_id", "text_hash")
        .agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("unit", "start", "end", "words", "kept_doc_id"))).alias("units"))
        .where(F.col("words") >= run_words)
        .select(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"), runs("units").alias("removed"))
        .where(F.size("removed") > 0)
    )
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("r_id")) & (F.xxhash64("row.text") == F.col("r_hash"))
    joined = row.join(removed, same, "left")
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(_text(F.col("row.text"), F.col("removed")))
    return joined.select(F.col("row").withField("text", text).alias("row"), "removed")


def deduplicated(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """The documents with all columns and without repeated runs."""
    return without_repeats(docs, run_words).select("row.*")
