"""Edition tables bound to the test tables.

The test tables hold no editions, so conversations become page-structured
objects, events become the review log, labels become verdicts and so on. Every
binding is one SELECT in the SQL subset Spark and DuckDB share; the same text
serves the Spark queries and the SQL checks. Bindings cover whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

# The few functions whose names differ between the two dialects.
_DIALECT = {
    "spark": {
        "{iso(": "date_format(",
        "{isofmt}": "\"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"",
        "{sha256(": "sha2(",
        "{shaend}": ", 256)",
    },
    "duckdb": {
        "{iso(": "strftime(",
        "{isofmt}": "'%Y-%m-%dT%H:%M:%S.%f'",
        "{sha256(": "sha256(",
        "{shaend}": ")",
    },
}

_PAGE_TEXT = """
    CASE
      WHEN (conv_id + turn) % 11 = 5 OR (conv_id + turn) % 19 = 4 THEN ''
      WHEN conv_id % 7 = 0 THEN replace(marked, '. ', '[?]. ')
      WHEN conv_id % 7 = 1 THEN replace(marked, ', ', ' [...], ')
      WHEN conv_id % 7 = 2 THEN replace(replace(replace(marked, ' und ', ' ~~und~~ {oder} '), ' the ', ' {the} ~~a~~ '), ' la ', ' ~~la~~ {le} ')
      WHEN conv_id % 7 = 3 THEN replace(marked, '. ', '.  ')
      WHEN conv_id % 7 = 4 THEN replace(marked, '. ', '. [... ~12 chars] ')
      WHEN conv_id % 7 = 5 THEN replace(marked, '. ', ' ##@@ ')
      ELSE marked
    END"""

# name -> (tables and bindings it reads, SELECT)
BINDINGS: dict[str, tuple[list[str], str]] = {
    # one row per page: object_id, page, transcription, page_type, foreign_index, notes
    "pages_v": (
        ["conversations"],
        f"""
        SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id,
               CAST(turn + 1 AS INT) AS page,
               {_PAGE_TEXT} AS transcription,
               CASE WHEN (conv_id + turn) % 11 = 5 THEN 'blank'
                    WHEN (conv_id + turn) % 13 = 7 THEN 'gate_low_resolution'
                    WHEN (conv_id + turn) % 17 = 3 THEN 'foreign_text'
                    ELSE '' END AS page_type,
               CAST(CASE WHEN turn % 6 = 2 THEN 1 END AS INT) AS foreign_index,
               CASE WHEN turn % 5 = 2 THEN 'Notiz ' || CAST(turn AS STRING) ELSE '' END AS notes,
               role
        FROM (SELECT conv_id, turn, role,
                     CASE WHEN turn % 3 = 1 THEN replace(text, chr(10), chr(10) || chr(10)) ELSE text END AS marked
              FROM conversations) c""",
    ),
    # one row per object with its catalogue fields
    "objects_v": (
        ["conversations"],
        """
        SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id,
               CASE WHEN conv_id % 9 = 4 THEN '' ELSE 'Gespräch ' || CAST(conv_id AS STRING) END AS title,
               CASE WHEN conv_id % 4 = 0 THEN '' ELSE 'Sig. ' || CAST(conv_id % 40 AS STRING) END AS signature,
               CASE WHEN conv_id % 6 = 0 THEN '1901' WHEN conv_id % 6 = 1 THEN '1901-02'
                    WHEN conv_id % 6 = 2 THEN '1901-02-30' WHEN conv_id % 6 = 3 THEN '1901-02-28'
                    WHEN conv_id % 6 = 4 THEN 'um 1900' ELSE '' END AS date,
               CASE WHEN conv_id % 5 = 0 THEN '' WHEN conv_id % 5 < 3 THEN 'de' ELSE 'fr' END AS language,
               CASE WHEN conv_id % 3 = 0 THEN 'letter' ELSE '' END AS object_type,
               CASE WHEN conv_id % 8 = 1 THEN '4 Bl.' ELSE '' END AS extent,
               CASE WHEN conv_id % 2 = 0 THEN 'Archiv & Bibliothek' ELSE '' END AS repository,
               CASE WHEN conv_id % 7 = 2 THEN 'low' WHEN conv_id % 7 = 3 THEN 'high' ELSE '' END AS confidence
        FROM conversations WHERE turn = 0""",
    ),
    # append-only review log; seq is the append order
    "review_v": (
        ["events"],
        """
        SELECT 'user-' || CAST(user_id AS STRING) AS object_id,
               CAST(1 + event_id % 3 AS INT) AS page,
               event_id AS seq,
               CASE WHEN k % 5 = 0 THEN 'machine_unreviewed' WHEN k % 5 < 3 THEN 'in_review'
                    WHEN k % 5 = 3 THEN 'human_verified' ELSE 'accepted' END AS from_status,
               CASE WHEN k % 41 = 7 THEN 'archived'
                    WHEN event_type = 'signup' OR event_type = 'error' THEN 'in_review'
                    WHEN event_type = 'view' THEN 'human_verified'
                    WHEN event_type = 'purchase' THEN 'accepted'
                    ELSE 'machine_unreviewed' END AS status,
               CASE WHEN k % 17 = 3 THEN ' ' ELSE 'actor-' || CAST(k % 6 AS STRING) END AS actor,
               CASE WHEN k % 10 < 6 THEN 'human' WHEN k % 10 < 8 THEN 'agent' WHEN k % 10 = 8 THEN 'robot' END AS actor_kind,
               CASE WHEN k % 19 = 5 THEN {iso(ts, {isofmt})
                    WHEN k % 23 = 7 THEN {iso(ts - INTERVAL 1 DAY, {isofmt}) || '+00:00'
                    ELSE {iso(ts, {isofmt}) || '+00:00' END AS event_time,
               CASE WHEN k % 29 = 11 THEN 'abc' ELSE {sha256(CAST(k AS STRING){shaend} END AS page_state_hash,
               'Notiz ' || CAST(k AS STRING) AS note
        FROM (SELECT event_id, ts, user_id, event_type,
                     CAST(replace(replace(props, '{"k": ', ''), '}', '') AS INT) AS k
              FROM events) e""",
    ),
    # edit chain of one page per object: consecutive turns are its versions
    "edits_v": (
        ["conversations"],
        """
        SELECT 'conv-' || CAST(a.conv_id AS STRING) AS object_id,
               CAST(1 AS INT) AS page,
               a.turn + 1 AS seq,
               CASE WHEN a.conv_id % 31 = 3 THEN 'no-uuid'
                    ELSE substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)
               END AS edit_id,
               'actor-' || CAST(a.turn % 4 AS STRING) AS actor,
               CASE WHEN a.turn % 6 = 4 THEN 'agent' ELSE 'human' END AS actor_kind,
               CASE WHEN (a.conv_id + a.turn) % 13 = 2 THEN '2024-01-01T00:00:00'
                    WHEN (a.conv_id + a.turn) % 17 = 2 THEN '2023-01-01T00:00:00+00:00'
                    ELSE '2024-01-0' || CAST(1 + a.turn % 8 AS STRING) || 'T10:00:00+02:00' END AS event_time,
               CASE WHEN a.turn % 7 = 6 THEN '' ELSE 'Lesung korrigiert' END AS note,
               CASE WHEN (a.conv_id + a.turn) % 5 = 4 THEN a.text || '!' ELSE a.text END AS before_text,
               '' AS before_notes,
               CASE WHEN (a.conv_id + a.turn) % 9 = 8 THEN a.text ELSE b.text END AS after_text,
               CASE WHEN a.turn % 3 = 2 THEN 'Notiz' ELSE '' END AS after_notes
        FROM (SELECT conv_id, turn, text,
                     md5(CAST(conv_id AS STRING) || '/' || CAST(CASE WHEN turn % 5 = 3 THEN 0 ELSE turn END AS STRING)) AS h
              FROM conversations) a
        JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1""",
    ),
    # judge verdicts per page of the document objects
    "verdicts_v": (
        ["documents", "labels"],
        """
        SELECT 'doc-' || CAST(d.doc_id AS STRING) AS object_id, CAST(1 AS INT) AS page,
               CASE WHEN l.doc_id IS NULL THEN NULL
                    WHEN l.quality = 1 AND l.toxic = 0 THEN 'confident'
                    WHEN l.quality = 1 THEN 'likely'
                    WHEN l.toxic = 1 THEN 'uncertain' ELSE 'perhaps' END AS confidence,
               CASE WHEN d.doc_id % 37 = 5 THEN '' ELSE d.text END AS transcription,
               CASE WHEN d.doc_id % 74 = 5 THEN 'blank' ELSE '' END AS page_type
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    ),
    # source files, as paths below the source folder
    "files_v": (
        ["documents"],
        """
        SELECT CASE WHEN doc_id % 6 = 0 THEN 'pdf/scan-' || CAST(doc_id AS STRING) || '.pdf'
                    WHEN doc_id % 6 = 1 THEN 'images/album-' || CAST(doc_id % 50 AS STRING) || '/p' || CAST(doc_id AS STRING) || '.jpg'
                    WHEN doc_id % 6 = 2 THEN 'images/album-' || CAST(doc_id % 50 AS STRING) || '/P' || CAST(doc_id AS STRING) || '.TIFF'
                    WHEN doc_id % 6 = 3 THEN 'text/note-' || CAST(doc_id AS STRING) || '.txt'
                    WHEN doc_id % 12 = 4 THEN 'letter-' || CAST(doc_id AS STRING) || '.json'
                    WHEN doc_id % 12 = 10 THEN 'images/album-' || CAST(doc_id % 50 AS STRING) || '/manifest.json'
                    ELSE 'readme-' || CAST(doc_id AS STRING) || '.md' END AS path,
               n_chars AS size
        FROM documents""",
    ),
    # declared documents of the source manifest
    "declared_v": (
        ["documents"],
        """
        SELECT CASE WHEN doc_id % 6 = 0 THEN 'scan-' || CAST(doc_id AS STRING)
                    ELSE 'remote-' || CAST(doc_id AS STRING) END AS doc_id,
               lang AS language,
               source AS prompt_profile,
               CAST(doc_id % 4 AS INT) AS declared_pages
        FROM documents WHERE n_chars > 1000""",
    ),
    # materialised page images
    "images_v": (
        ["conversations"],
        """
        SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id,
               CAST(turn + 1 AS INT) AS page,
               'conv-' || CAST(conv_id AS STRING) || '_p' || CAST(turn + 1 AS STRING) ||
                 CASE WHEN conv_id % 2 = 0 THEN '.jpg' ELSE '.png' END AS filename,
               {sha256(text{shaend} AS sha256,
               'https://img.example.org/' || CAST(conv_id AS STRING) || '/' || CAST(turn + 1 AS STRING) || '.jpg' AS url
        FROM conversations
        WHERE (conv_id + turn) % 23 <> 6""",
    ),
    # page image manifest, some entries stale or in error
    "manifest_v": (
        ["conversations"],
        """
        SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id,
               CAST(turn + 1 AS INT) AS page,
               CASE WHEN (conv_id + turn) % 37 = 9 THEN '../x.png'
                    ELSE 'conv-' || CAST(conv_id AS STRING) || '_p' || CAST(turn + 1 AS STRING) ||
                    CASE WHEN conv_id % 2 = 0 THEN '.jpg' ELSE '.png' END END AS filename,
               CASE WHEN (conv_id + turn) % 29 = 3 THEN {sha256('old'{shaend} ELSE {sha256(text{shaend} END AS sha256,
               CASE WHEN (conv_id + turn) % 31 = 8 THEN 'ftp://img.example.org/x'
                    ELSE 'https://img.example.org/' || CAST(conv_id AS STRING) || '/' || CAST(turn + 1 AS STRING) || '.jpg' END AS url,
               CASE WHEN (conv_id + turn) % 41 = 7 THEN 'render failed' END AS error
        FROM conversations""",
    ),
    # hypothesis / reference text pairs: an answer against the turn before it,
    # ASCII-folded because the two dialects count different units beyond ASCII
    "pairs_v": (
        ["conversations"],
        """
        SELECT 'conv-' || CAST(a.conv_id AS STRING) || '/' || CAST(b.turn AS STRING) AS fixture_id,
               a.text AS reference,
               b.text AS hypothesis,
               CASE WHEN a.conv_id % 2 = 0 THEN 'hsa-strict' ELSE 'zbz-fidelity' END AS profile
        FROM (SELECT conv_id, turn, text FROM conversations) a
        JOIN (SELECT conv_id, turn, text FROM conversations) b
          ON b.conv_id = a.conv_id AND b.turn = a.turn + 1""",
    ),
    # current content version and update requests per page
    "requests_v": (
        ["conversations"],
        """
        SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id,
               CAST(turn + 1 AS INT) AS page,
               CASE WHEN conv_id % 6 = 5 THEN 'machine_unreviewed' WHEN conv_id % 6 < 3 THEN 'in_review'
                    WHEN conv_id % 6 = 3 THEN 'human_verified' ELSE 'accepted' END AS requested_status,
               CASE WHEN (conv_id + turn) % 9 = 4 THEN '  ' ELSE 'actor-' || CAST(turn AS STRING) END AS actor,
               CASE WHEN (conv_id + turn) % 5 = 0 THEN 'agent' WHEN (conv_id + turn) % 5 = 4 THEN 'robot' WHEN (conv_id + turn) % 5 = 2 THEN 'human' END AS actor_kind,
               CASE WHEN turn % 4 = 0 THEN 'machine_unreviewed' WHEN turn % 4 < 3 THEN 'in_review' ELSE 'human_verified' END AS current_status,
               CASE WHEN (conv_id + turn) % 3 = 0 THEN {sha256('stale'{shaend} ELSE {sha256(text{shaend} END AS version,
               CASE WHEN (conv_id + 2 * turn) % 13 <> 6 THEN {sha256(text{shaend} END AS current_version,
               text AS current_text,
               CASE WHEN turn % 3 = 1 THEN 'Rand' ELSE '' END AS current_notes,
               CASE WHEN conv_id % 2 = 0 THEN '' WHEN turn % 3 = 1 THEN 'Rand' ELSE '' END AS new_notes,
               CASE WHEN (conv_id + turn) % 7 = 2 THEN text ELSE text || ' (berichtigt)' END AS new_text,
               CASE WHEN (conv_id + turn) % 10 = 3 THEN '' ELSE 'Lesefehler' END AS reason,
               (turn % 6 = 2) AS has_foreign
        FROM conversations""",
    ),
}


def render(name: str, dialect: str) -> str:
    text = BINDINGS[name][1]
    for token, replacement in _DIALECT[dialect].items():
        text = text.replace(token, replacement)
    return text


def bound(
    spark: SparkSession, sf_dir: str, name: str, load: Callable[[SparkSession, str, str], DataFrame] | None = None
) -> DataFrame:
    """A binding, or a test table itself, as a DataFrame; ``load`` replaces the table reader."""
    if name not in BINDINGS:
        return load(spark, sf_dir, name) if load else spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables, _ = BINDINGS[name]
    text = render(name, "spark").replace("{", "{{").replace("}", "}}")
    frames = {}
    for table in tables:
        # named parameters of spark.sql: every FROM/JOIN table reference
        text = _reference(text, table)
        frames[table] = bound(spark, sf_dir, table, load)
    return spark.sql(text, **frames)


def as_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, one file or a folder of files, as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # a stream takes a single file only by a pattern; this one matches the table alone
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def _reference(text: str, table: str) -> str:
    for keyword in ("FROM", "JOIN"):
        for after in (" ", "\n", ")"):
            text = text.replace(f"{keyword} {table}{after}", f"{keyword} {{{table}}}{after}")
        if text.endswith(f"{keyword} {table}"):
            text = text[: -len(table)] + f"{{{table}}}"
    return text


def with_clause(names: Iterable[str]) -> str:
    """``WITH ... `` of the named bindings in DuckDB SQL."""
    parts = [f"{name} AS ({render(name, 'duckdb')})" for name in names]
    return "WITH " + ",\n".join(parts)
