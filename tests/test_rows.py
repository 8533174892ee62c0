"""Python functions of rows: pieces of a batch, and texts that need no Python."""

import re
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from scriptorium.functions import rows, text


def test_a_batch_is_answered_in_pieces():
    seen = []
    values = [None if n % 7 == 0 else str(n) for n in range(3 * rows.PIECE + 5)]
    found = rows.in_pieces(lambda a, b: seen.append(a) or (None if a is None else a + b), (pa.array(values), pa.array(["x"] * len(values))), pa.string())
    assert found.to_pylist() == [None if v is None else v + "x" for v in values] and seen == values
    assert rows.in_pieces(str, (pa.array([], pa.string()),), pa.string()).to_pylist() == []


def test_characters_that_stay_outside_of_python_are_composed():
    characters = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    joining = {chr(int(d.split()[1], 16)) for d in map(unicodedata.decomposition, characters) if len(d.split()) == 2 and d[0] != "<"}
    wanted = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", text.NOT_COMPOSED))
    plain = [c for c in characters if not wanted.match(c)]
    assert len(plain) > 20_000
    assert all(unicodedata.is_normalized("NFC", c) and not unicodedata.combining(c) and c not in joining for c in plain)


def test_composition(spark):
    values = ["e\u0301te\u0301", "été", None, "", "\u1112\u1161\u11ab", "Å \u212b", "«a\u0308» ; \u2014 😀", "\u2000x", "\u0958"]
    found = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, t string").select("n", text.nfc(F.col("t")).alias("a"), text.normalise_zbz(F.col("t")).alias("z"))
    kept = found.orderBy("n").collect()
    assert [r["a"] for r in kept] == [None if v is None else unicodedata.normalize("NFC", v) for v in values]
    assert kept[6]["z"] == '"ä"; - 😀' and kept[5]["z"] == "Å Å" and kept[2]["z"] is None


def test_rows_longer_than_a_batch(spark):
    shout = rows.by_row(lambda t: None if t is None else t.upper(), StringType())
    frame = spark.range(0, 30_000, 1, 1).select(F.col("id"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("a"), F.col("id").cast("string"))).alias("t"))
    assert frame.filter(~shout("t").eqNullSafe(F.upper("t"))).count() == 0


def test_a_batch_is_handed_on_a_few_rows_at_a_time(spark):
    """Texts of a batch are not Python strings all at once: the language and the pieces are found for a few rows at a time."""
    kind = StructType().add("rows", "integer").add("value", "string")
    seen = rows.by_rows(lambda values, ids: [(len(values), f"{v}-{i}") for v, i in zip(values, ids)], kind, 100)
    frame = spark.range(1050).repartition(1).selectExpr("id", "if(id = 3, null, id) AS value")
    found = frame.select("id", seen(F.col("value"), F.col("id")).alias("x")).select("id", "x.*").collect()
    assert {r["id"]: r["value"] for r in found} == {i: f"{None if i == 3 else i}-{i}" for i in range(1050)}
    assert max(r["rows"] for r in found) <= 100
    assert frame.limit(0).select(seen(F.col("value"), F.col("id"))).count() == 0
