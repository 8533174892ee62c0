"""Scalar functions over whole text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, markers, text, values
from .assessment import round_one_sql
from .evaluation import one_byte
from .registry import query

ILLEGIBLE = r"\[\.\.\.(?:\s*~\s*\d+\s*chars?)?\]"
TYPED = r"~~.+?~~|\{.+?\}|\[\.\.\.(?:\s*~\s*\d+\s*chars?)?\]|[^\s{}\[\]~]+\[\?\]"

# Conversations with one of each marker, so that no function sees only plain text.
MARKED = """
    SELECT conv_id, turn,
           'a  b ~~alt~~ {neu} ' || replace(text, '. ', '[?]. [...~ 40 chars] ') || ' [... Arabic, ~1 word]' AS body
    FROM conversations"""


def marked(t):
    return t.conversations.select(
        "conv_id",
        "turn",
        F.concat(
            F.lit("a  b ~~alt~~ {neu} "),
            F.replace(F.col("text"), F.lit(". "), F.lit("[?]. [...~ 40 chars] ")),
            F.lit(" [... Arabic, ~1 word]"),
        ).alias("body"),
    )


@query(
    "fn_marker_counts",
    rf"""SELECT conv_id, turn,
            CAST(len(regexp_extract_all(body, '\[\?\]')) AS INT) AS uncertain,
            CAST(len(regexp_extract_all(body, '{ILLEGIBLE}')) AS INT) AS illegible,
            CAST(len(regexp_extract_all(body, '  +')) AS INT) AS double_spaces FROM marked""",
    {"marked": MARKED},
)
def _(t):
    body = F.col("body")
    return marked(t).select(
        "conv_id", "turn",
        markers.count_uncertain(body).alias("uncertain"),
        markers.count_illegible(body).alias("illegible"),
        markers.count_double_spaces(body).alias("double_spaces"),
    )


@query(
    "fn_strip_markers",
    rf"""SELECT conv_id, turn,
            regexp_replace(body, '\[\?\]|{ILLEGIBLE}|~~(.*?)~~|\{{(.*?)\}}', '', 'g') AS stripped FROM marked""",
    {"marked": MARKED},
)
def _(t):
    return marked(t).select("conv_id", "turn", markers.strip_markers(F.col("body")).alias("stripped"))


@query(
    "fn_resolve_markers",
    rf"""SELECT conv_id, turn,
            regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '~~(.*?)~~', '', 'g'), '\{{(.*?)\}}', '\1', 'g'), '\[\?\]', '', 'g'), '{ILLEGIBLE}', '', 'g') AS reading,
            regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '\[\?\]', '', 'g'), '\[\.\.\.[^\]]*\]', '', 'g'), '~~(.*?)~~', '\1', 'g'), '\{{(.*?)\}}', '\1', 'g') AS comparison
         FROM marked""",
    {"marked": MARKED},
)
def _(t):
    return marked(t).select(
        "conv_id", "turn",
        markers.resolve_markers(F.col("body")).alias("reading"),
        markers.resolve_for_evaluation(F.col("body")).alias("comparison"),
    )


@query(
    "fn_typed_markers",
    rf"""SELECT conv_id, turn, CAST(pos - 1 AS INT) AS pos, m AS marker,
            CASE WHEN starts_with(m, '~~') THEN 'deletion' WHEN starts_with(m, '{{') THEN 'addition'
                 WHEN starts_with(m, '[') THEN 'illegible' ELSE 'unclear' END AS kind,
            CASE WHEN regexp_matches(m, '^\[\.\.\.\s*~\s*\d+') THEN regexp_extract(m, '(\d+)', 1) END AS quantity
         FROM (SELECT conv_id, turn, unnest(ms) AS m, generate_subscripts(ms, 1) AS pos
               FROM (SELECT conv_id, turn, regexp_extract_all(body, '{TYPED}') AS ms FROM marked))""",
    {"marked": MARKED},
)
def _(t):
    return marked(t).select(
        "conv_id", "turn", F.posexplode(markers.typed_markers(F.col("body"))).alias("pos", "m")
    ).select("conv_id", "turn", "pos", "m.marker", "m.kind", "m.quantity")


@query(
    "fn_canonical_illegible",
    r"""SELECT conv_id, turn, regexp_replace(body, '\[\.\.\.\s*~\s*(\d+)\s*chars?\]', '[... ~\1 chars]', 'g') AS spelled FROM marked""",
    {"marked": MARKED},
)
def _(t):
    return marked(t).select("conv_id", "turn", markers.canonical_illegible(F.col("body")).alias("spelled"))


@query(
    "fn_markers_to_markup",
    r"""SELECT conv_id, turn,
          regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            replace(replace(replace(replace(body, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'),
            '~~(.+?)~~', '<del>\1</del>', 'g'), '\{(.+?)\}', '<add>\1</add>', 'g'),
            '\[\.\.\.\s*~\s*(\d+)\s*chars?\]', '<gap reason="illegible" quantity="\1" unit="character"/>', 'g'),
            '\[\.\.\.\]', '<gap reason="illegible"/>', 'g'),
            '([^\s{}\[\]~]+)\[\?\]', '<unclear>\1</unclear>', 'g') AS markup FROM marked""",
    {"marked": MARKED},
)
def _(t):
    return marked(t).select("conv_id", "turn", markers.markers_to_markup(F.col("body")).alias("markup"))


@query(
    "fn_collapse_whitespace",
    r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS collapsed FROM documents",
)
def _(t):
    return t.documents.select("doc_id", text.collapse_whitespace(F.col("text")).alias("collapsed"))


_RAW_QUOTES = "«x» „y“ ‚z‘ – ‑ \u00ad ; ! "


@query(
    "fn_normalise_zbz",
    rf"""SELECT doc_id, nfc_normalize(trim(regexp_replace(regexp_replace(
            replace(translate('{_RAW_QUOTES}' || text, '«»„“”‹›`´‘’‐‑‒–—', repeat(chr(34), 5) || repeat(chr(39), 6) || '-----'), chr(173), ''),
            ' +([;:?!])', '\1', 'g'), '\s+', ' ', 'g'))) AS normalised FROM documents""",
)
def _(t):
    return t.documents.select(
        "doc_id", text.normalise_zbz(F.concat(F.lit(_RAW_QUOTES), F.col("text"))).alias("normalised")
    )


@query(
    "fn_comparison_text",
    r"""SELECT conv_id, turn,
           trim(regexp_replace(array_to_string([trim(l) FOR l IN string_split(regexp_replace(body, '[\t ]+', ' ', 'g'), chr(10))], chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS kept,
           trim(regexp_replace(body, '\s+', ' ', 'g')) AS joined
        FROM (SELECT conv_id, turn, replace(text, chr(10), '  ' || repeat(chr(10), 3) || ' ') AS body FROM conversations)""",
)
def _(t):
    body = F.replace(F.col("text"), F.lit("\n"), F.lit("  \n\n\n "))
    return t.conversations.select(
        "conv_id", "turn",
        text.comparison_text(body).alias("kept"),
        text.comparison_text(body, keep_line_breaks=False).alias("joined"),
    )


@query(
    "fn_display_text",
    r"""SELECT page_id,
           trim(regexp_replace(array_to_string([trim(l) FOR l IN string_split(body, chr(10))], chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS display
        FROM (SELECT page_id, regexp_replace(html, '<[^>]*>', repeat(chr(10), 2), 'g') AS body FROM pages)""",
)
def _(t):
    return t.pages.select(
        "page_id", text.display_text(F.regexp_replace("html", r"<[^>]*>", "\n\n")).alias("display")
    )


@query(
    "fn_xml_escape",
    """SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS escaped FROM pages""",
)
def _(t):
    return t.pages.select("page_id", text.xml_escape(F.col("html")).alias("escaped"))


@query(
    "fn_paragraphs_and_lines",
    r"""SELECT object_id, page, CAST(para_idx - 1 AS INT) AS para_idx, CAST(line_idx - 1 AS INT) AS line_idx, line
        FROM (SELECT object_id, page, para_idx, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_idx
              FROM (SELECT object_id, page, para_idx,
                           [trim(x) FOR x IN string_split(para, chr(10)) IF trim(x) <> ''] AS ls
                    FROM (SELECT object_id, page, unnest(ps) AS para, generate_subscripts(ps, 1) AS para_idx
                          FROM (SELECT object_id, page,
                                       regexp_split_to_array(regexp_replace(transcription, '^\s+|\s+$', '', 'g'), '\n{2,}') AS ps
                                FROM pages_v WHERE regexp_matches(transcription, '\S')))))""",
)
def _(t):
    body = F.col("transcription")
    return (
        t.pages_v.filter(text.has_text(body))
        .select("object_id", "page", F.posexplode(text.paragraphs(body)).alias("para_idx", "para"))
        .select("object_id", "page", "para_idx", F.posexplode(text.lines(F.col("para"))).alias("line_idx", "line"))
    )


@query(
    "fn_redact_secrets",
    r"""SELECT page_id, replace(regexp_replace(url || '&API_key=abc"def&page=3', '(?i)([?&](?:key|api[_-]?key|access[_-]?token)=)[^&\s"'']+', '\1[redacted]', 'g'), 'example', '[redacted]') AS redacted FROM pages""",
)
def _(t):
    return t.pages.select(
        "page_id",
        text.redact_secrets(F.concat("url", F.lit('&API_key=abc"def&page=3')), ["example"]).alias("redacted"),
    )


@query(
    "fn_code_fence_and_newline_repair",
    r"""SELECT conv_id, turn,
            replace(replace(replace(replace(replace(replace(body, chr(10), '\n'), '{\n', '{' || chr(10)), '\n}', chr(10) || '}'), '[\n', '[' || chr(10)), '\n]', chr(10) || ']'), ',\n', ',' || chr(10)) AS repaired
        FROM (SELECT conv_id, turn, '{' || chr(10) || '"t":"' || text || '",' || chr(10) || '"p":1' || chr(10) || '}' AS body FROM conversations)""",
)
def _(t):
    body = F.concat(F.lit('```json\n{\n"t":"'), F.col("text"), F.lit('",\n"p":1\n}\n```  '))
    return t.conversations.select(
        "conv_id", "turn", text.repair_raw_newlines(text.strip_code_fence(body)).alias("repaired")
    )


@query(
    "fn_lower_trim_and_line_policy",
    """SELECT doc_id, lower(trim('  ' || lang || source || ' ')) AS folded,
              NOT (source = 'src3' OR source = 'src4') AS keeps_breaks FROM documents""",
)
def _(t):
    edition = F.when(F.col("source") == "src3", "Normalized transcription").when(
        F.col("source") == "src4", "normalisiert").otherwise(F.col("source"))
    return t.documents.select(
        "doc_id",
        text.lower_trim(F.concat(F.lit("  "), "lang", "source", F.lit(" "))).alias("folded"),
        text.keeps_line_breaks(edition).alias("keeps_breaks"),
    )


@query(
    "fn_provenance_value",
    r"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN substr(sha256(text), 1, 12) ELSE '' END AS state_hash FROM documents""",
)
def _(t):
    digest = hashing.text_hash(F.col("text"))
    note = F.concat(
        F.lit("Provenance: provider=x; "),
        F.when(F.col("doc_id") % 3 == 0, "validation_state_hash=").otherwise("other_hash="), digest, F.lit(". End"),
    )
    return t.documents.select("doc_id", text.provenance_value(note, "validation_state_hash").alias("state_hash"))


@query(
    "fn_filename_safety",
    r"""SELECT page_id, NOT contains(name, '/') AS local,
             NOT (contains(name, '..') OR contains(name, ':') OR starts_with(name, '/')) AS safe_record
        FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url WHEN page_id % 4 = 1 THEN 'p' || CAST(page_id AS STRING) || '.png'
                     WHEN page_id % 4 = 2 THEN 'calls/../x.json' ELSE '/abs.json' END AS name FROM pages)""",
)
def _(t):
    name = (
        F.when(F.col("page_id") % 4 == 0, F.col("url"))
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".png")))
        .when(F.col("page_id") % 4 == 2, "calls/../x.json")
        .otherwise("/abs.json")
    )
    return t.pages.select(
        "page_id", text.is_local_filename(name).alias("local"), text.is_safe_record_path(name).alias("safe_record")
    )


@query(
    "fn_aware_timestamps",
    """SELECT seq, regexp_matches(event_time, '(Z|[+-][0-9]{2}:[0-9]{2})$') AS aware FROM review_v""",
)
def _(t):
    return t.review_v.select("seq", values.is_aware_timestamp(F.col("event_time")).alias("aware"))


@query(
    "fn_partial_dates",
    """SELECT object_id, date, CASE WHEN regexp_full_match(date, '[0-9]{4}(-[0-9]{2})?')
                OR (regexp_full_match(date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(date AS DATE) IS NOT NULL) THEN date ELSE '' END AS date_when
       FROM objects_v""",
)
def _(t):
    return t.objects_v.select("object_id", "date", values.date_when(F.col("date")).alias("date_when"))


@query(
    "fn_safe_rate_and_round",
    f"""SELECT conv_id, turn,
              CASE WHEN r = 0 AND h = 0 THEN 0.0 WHEN r = 0 THEN 1.0 ELSE CAST(length(text) AS DOUBLE) / r END AS rate,
              {round_one_sql("length(text) / 8")} AS rounded, {round_one_sql("length(text) / 20")} AS twentieths
       FROM (SELECT conv_id, turn, text, turn % 3 AS r, conv_id % 2 AS h FROM conversations)""",
)
def _(t):
    return t.conversations.select(
        "conv_id", "turn",
        values.safe_rate(F.length("text"), F.col("turn") % 3, F.col("conv_id") % 2).alias("rate"),
        values.round_one(F.length("text") / 8).alias("rounded"), values.round_one(F.length("text") / 20).alias("twentieths"),
    )


@query(
    "fn_text_and_file_hash",
    "SELECT doc_id, substr(sha256(text), 1, 12) AS short_hash, sha256(text) AS full_hash FROM documents",
)
def _(t):
    return t.documents.select(
        "doc_id",
        hashing.text_hash(F.col("text")).alias("short_hash"),
        F.sha2(F.col("text").cast("binary"), 256).alias("full_hash"),
    )


@query(
    "fn_canonical_struct_hash",
    """SELECT event_id, substr(sha256('{"event_type":"' || event_type || '","note":null,"user_id":' || CAST(user_id AS STRING) || '}'), 1, 12) AS struct_hash FROM events""",
)
def _(t):
    return t.events.select(
        "event_id",
        hashing.struct_hash(F.struct("event_type", F.lit(None).cast("string").alias("note"), "user_id")).alias("struct_hash"),
    )


@query(
    "fn_parse_json_and_typed_get",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, 'none' AS missing, TRUE AS is_object FROM events""",
)
def _(t):
    parsed = values.parse_json_or_null(F.col("props"))
    return t.events.select(
        "event_id",
        values.json_field(parsed, "$.k", "int").alias("k"),
        values.json_text(parsed, "$.k", "none").alias("missing"),
        (values.json_kind(parsed) == "OBJECT").alias("is_object"),
    )


@query(
    "fn_array_helpers",
    """SELECT conv_id, turn, list_contains(ws, 'la') AS has_word, ws[3] AS third,
              CAST(len(ws[2:4]) AS INT) AS sliced, len(ws) = len(ls) AS zipped
       FROM (SELECT conv_id, turn, string_split(text, ' ') AS ws, string_split(text, chr(10)) AS ls FROM conversations)""",
)
def _(t):
    words, rows = F.split("text", " ", -1), F.split("text", "\n", -1)
    return t.conversations.select(
        "conv_id", "turn",
        F.array_contains(words, "la").alias("has_word"),
        values.element_or_null(words, F.lit(3)).alias("third"),
        F.size(F.slice(words, 2, 3)).alias("sliced"),
        values.zip_checked(words, rows).isNotNull().alias("zipped"),
    )


@query(
    "fn_url_normalisation",
    """SELECT page_id, page, url FROM (
         SELECT page_id, 1 AS page, url AS url FROM pages
         UNION ALL SELECT page_id, 2, 'http://b.example/' || CAST(page_id AS STRING) FROM pages WHERE page_id % 3 <> 2
         UNION ALL SELECT page_id, 10, 'https://c.example/' FROM pages WHERE page_id % 3 = 0)""",
)
def _(t):
    second = F.concat(F.lit("http://b.example/"), F.col("page_id").cast("string"))
    as_map = F.to_json(
        F.create_map(F.lit("10"), F.lit("https://c.example/"), F.lit("2"), second, F.lit("1"), F.col("url"), F.lit("x"), F.lit("https://d/"))
    )
    as_list = F.to_json(F.array(F.col("url"), second, F.lit("ftp://no.example/")))
    single = F.to_json(F.array(F.col("url"), F.lit(None).cast("string")))
    raw = F.when(F.col("page_id") % 3 == 0, as_map).when(F.col("page_id") % 3 == 1, as_list).otherwise(single)
    return t.pages.select("page_id", F.inline(values.url_entries(F.parse_json(raw))))


@query(
    "fn_levenshtein_and_similarity",
    f"""SELECT fixture_id, CAST(d AS INT) AS distance,
              CASE WHEN n = 0 THEN 1.0 ELSE 1.0 - CAST(d AS DOUBLE) / n END AS similarity
       FROM (SELECT fixture_id, levenshtein({one_byte("reference")}, {one_byte("hypothesis")}) AS d,
                    greatest(length(reference), length(hypothesis)) AS n FROM pairs_v)""",
)
def _(t):
    from ..plans.evaluation import similarity

    reference, hypothesis = F.col("reference"), F.col("hypothesis")
    return t.pairs_v.select(
        "fixture_id",
        F.levenshtein(reference, hypothesis).alias("distance"),
        similarity(reference, hypothesis).alias("similarity"),
    )
