"""Registered queries of the text operators, with SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            ORACLE_SQL[name] = sql
        return build

    return add


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), k AS (
  SELECT DISTINCT k FROM g
), s AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k)
), h AS (
  SELECT r, s.k, i, item_id FROM s JOIN g ON s.k = g.k AND s.gram = g.gram
), n AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r
), t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""


@query("op10_benchmark_decontamination", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op6_simhash_components")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_sentencepiece_codec")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_codec import Shared, round_trip

    shared = Shared.of(spark, piece_model())
    found = table(spark, sf_dir, "documents").select("doc_id", round_trip("text", shared).alias("r"))
    return found.select("doc_id", "r.*")


def piece_model() -> str:
    """The public model that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op4_winnowing_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .winnowing import compare_with_edits

    return compare_with_edits(table(spark, sf_dir, "documents"))


@query("op1_byte_network_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify

    return identify(table(spark, sf_dir, "documents"))


@query("op2_compression_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score

    return score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id, text, regexp_extract_all(text, '[^.!?\n]*[.!?]+|[^.!?\n]+|\n+') AS pieces FROM documents
), u AS (
  SELECT r, doc_id, unnest(pieces) AS piece, unnest(range(0, len(pieces))) AS i FROM d
), k AS (
  SELECT *, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+', ' ', 'g')) AS n,
    sum(length(piece)) OVER (PARTITION BY r ORDER BY i) - length(piece) AS start
  FROM u
), w AS (
  SELECT *, len(string_split(n, ' ')) AS words, row_number() OVER (PARTITION BY r ORDER BY i) AS unit,
    row_number() OVER (PARTITION BY n ORDER BY r, i) > 1 AS again, first_value(doc_id) OVER (PARTITION BY n ORDER BY r, i) AS kept_doc_id
  FROM k WHERE n <> ''
), g AS (
  SELECT *, unit - row_number() OVER (PARTITION BY r ORDER BY i) AS island FROM w WHERE again
), l AS (
  SELECT r, island, min(i) AS low, max(i) AS high FROM g GROUP BY r, island HAVING sum(words) >= 25
), t AS (
  SELECT r, string_agg(piece, '' ORDER BY i) AS text FROM k WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.r = k.r AND i BETWEEN low AND high) GROUP BY r
), x AS (
  SELECT g.r, count(*) AS n_removed,
    string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(start AS BIGINT) + length(piece) AS VARCHAR) || ':' || CAST(kept_doc_id AS VARCHAR), ' ' ORDER BY i) AS removed
  FROM g JOIN l ON g.r = l.r AND g.island = l.island GROUP BY g.r
)
SELECT d.doc_id, coalesce(t.text, CASE WHEN d.text IS NOT NULL THEN '' END) AS text, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(length(d.text), 0) - coalesce(length(t.text), 0) AS BIGINT) AS removed_chars, coalesce(removed, '') AS removed
FROM d LEFT JOIN t USING (r) LEFT JOIN x USING (r)
"""


@query("op3_line_deduplication", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import REMOVED, without_repeats

    docs = table(spark, sf_dir, "documents").withColumn("size", F.coalesce(F.length("text"), F.lit(0)))
    found = without_repeats(docs)
    span = lambda r: F.concat(r["start"], F.lit("-"), r["end"], F.lit(":"), F.coalesce(r["kept_doc_id"].cast("string"), F.lit("")))
    removed = F.coalesce("removed", F.array().cast(REMOVED))
    return found.select("row.doc_id", "row.text", "row.size", removed.alias("x")).select(
        "doc_id",
        "text",
        F.size("x").cast("long").alias("n_removed"),
        (F.col("size") - F.coalesce(F.length("text"), F.lit(0))).cast("long").alias("removed_chars"),
        F.array_join(F.transform("x", span), " ").alias("removed"),
    )


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS p, role, text
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY p) AS turns,
    string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY p) AS text
  FROM t GROUP BY conv_id
), u AS (
  SELECT turns, min(conv_id) AS conv_id, count(*) AS n_equal, min(text) AS text FROM c GROUP BY turns
), p AS (
  SELECT DISTINCT turns[1:n] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS n FROM u)
)
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns, CAST(n_equal AS BIGINT) AS n_equal, text
FROM u ANTI JOIN p USING (turns)
"""


@query("op8_maximal_conversations", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import rendered

    return rendered(table(spark, sf_dir, "conversations"))


@query("op7_html_block_tree")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract

    return extract(table(spark, sf_dir, "pages"))


@query("op5_suffix_tree_scores")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_tree import scored

    return scored(table(spark, sf_dir, "documents"))


def kmeans_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds of op12 written one after another."""
    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
  SELECT r, min(CAST(list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v) + list_inner_product(c.v, c.v) AS BIGINT) * {k} + c.c) AS m
  FROM p, c{n} c GROUP BY r
)"""

    def moved(n: int) -> str:
        return f"""s{n} AS (
  SELECT m % {k} AS c, i, CAST(sum(CAST(x AS BIGINT)) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT m, unnest(v) AS x, unnest(range(64)) AS i FROM a{n - 1} JOIN p USING (r)) GROUP BY ALL
), c{n} AS MATERIALIZED (
  SELECT o.c, coalesce(f.v, o.v) AS v
  FROM c{n - 1} o LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS v FROM s{n} GROUP BY c) f ON o.c = f.c
)"""

    steps = [step for n in range(1, rounds + 1) for step in (assigned(n - 1), moved(n))]
    return f"""
WITH p AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, v FROM p ORDER BY h LIMIT {k})
), {", ".join(steps)}, {assigned(rounds)}, d AS (
  SELECT vec_id, m % {k} AS c, m // {k} AS distance FROM a{rounds} JOIN p USING (r)
), t AS (
  SELECT c, sum(distance) AS own FROM d GROUP BY c
)
SELECT vec_id, CAST(d.c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(own AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(distance) FROM d) AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(f.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM d JOIN t ON d.c = t.c JOIN c{rounds} f ON d.c = f.c
"""


@query("op12_simplex_centroids", kmeans_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import clustered, with_inertia
    from .vectors import complete, whole

    kept = table(spark, sf_dir, "embeddings").where(complete(F.col("embedding"), 64))
    points = kept.select(F.col("vec_id").alias("id"), whole(F.col("embedding"), 1024).alias("x"))
    found = with_inertia(*clustered(points, F.sha2(F.concat(F.lit("3:"), F.col("id").cast("string")), 256)))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


OP13_SQL = r"""
WITH e AS MATERIALIZED (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op13_segment_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import mined
    from .vectors import complete, whole

    kept = table(spark, sf_dir, "embeddings").where(F.col("label").isNotNull() & complete(F.col("embedding"), 64))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = kept.select("vec_id", label.alias("label"), whole(F.col("embedding"), 256).alias("x"))
    return mined(rows, F.col("vec_id") % 100 == 0, 64)


@query("op11_interval_tree_repeats")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeat_intervals import without_repeats

    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
