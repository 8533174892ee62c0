"""Contract audit over documents in JSON form, and over the page tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import contract
from ..plans import audit
from .registry import query

# One mutation per document, by doc_id: (text to replace, replacement, broken rules).
# The first entry leaves the document intact.
_REVIEW = '"review":{"status":"machine_unreviewed","history":[]}'
_EDIT = (
    '{{"id":"01234567-89ab-4cde-8f01-23456789abcd","timestamp":"2024-01-01T10:00:00Z","actor":"a","actor_kind":"human","note":"n",'
    '"before":{before},"after":{after}}}'
)

MUTATIONS: list[tuple[str, str, list[str]]] = [
    ("", "", []),
    ('"page":1,"transcription"', '"page":2,"transcription"', ["page.sequence", "origin.raw_hash"]),
    ('"page":1,"transcription"', '"page":"1","transcription"', ["page.number", "page.sequence", "origin.raw_hash"]),
    ('"page_type":""', '"page_type":"cover"', ["page.page_type", "page.recorded_type"]),
    ('"page_type":""', '"page_type":"blank"', ["page.blank", "page.recorded_type", "quality.stale"]),
    ('"foreign_paragraphs":[0]', '"foreign_paragraphs":[0,0]', ["page.foreign"]),
    ('"foreign_paragraphs":[0]', '"foreign_paragraphs":[999]', ["page.foreign_range"]),
    ('"foreign_paragraphs":[0]', '"foreign_paragraphs":5', ["page.foreign"]),
    ('"notes":"n"', '"notes":7', ["page.notes"]),
    ('"review":{"status":"machine_unreviewed","history":[]}', '"other":1', ["page.review"]),
    ('"status":"machine_unreviewed"', '"status":"done"', ["page.review_status"]),
    ('"status":"machine_unreviewed"', '"status":"accepted"', ["page.review_unproven"]),
    ('"history":[]', '"history":{}', ["page.review_history"]),
    ('"transcription_raw":', '"raw":', ["origin.raw_missing", "origin.raw_hash"]),
    ('"confidence":"high"', '"confidence":"sure"', ["file.confidence"]),
    ('"confidence_notes":""', '"confidence_notes":[]', ["file.confidence_notes"]),
    ('"timestamp":"2024-01-01T10:00:00+00:00"', '"timestamp":"2024-01-01T10:00:00"', ["_meta.timestamp_zone"]),
    ('"script":"transcribe"', '"script":""', ["_meta.script"]),
    ('"pipeline_step":3', '"pipeline_step":-1', ["_meta.step"]),
    ('"provider":"p"', '"provider":" "', ["_meta.step3_provider"]),
    ('"prompt_hash":"0123456789ab","prompt_layers"', '"prompt_hash":"xyz","prompt_layers"', ["_meta.step3_prompt_hash"]),
    ('"prompt_layers":["transcription.md",', '"prompt_layers":["other.md",', ["_meta.step3_layers"]),
    ('"prompt_profile":"letters"', '"prompt_profile":"notes"', ["_meta.step3_profile_layer"]),
    ('"prompt_profile":"letters"', '"prompt_profile":"a/b"', ["_meta.step3_profile_key"]),
    ('"chunk":1', '"chunk":0', ["_meta.step3_calls", "calls_chunks", "calls_coverage"]),
    ('"attempt":1', '"attempt":2', ["calls_coverage"]),
    ('"pages":[1]', '"pages":[1,2]', ["calls_coverage"]),
    ('"raw_transcription_hash":"', '"raw_transcription_hash":"0', ["_meta.step3_raw_transcription_hash", "origin.raw_hash"]),
    ('"source_images_hash":"', '"source_images_hash":"0', ["_meta.image_hash"]),
    ('"filename":"doc', '"filename":"../doc', ["_meta.image_states", "images.bound"]),
    ('"source_images":["doc', '"source_images":["x/doc', ["images.names", "images.bound"]),
    ('"source_images":["', '"source_images":["a.png","', ["images.count", "images.bound"]),
    ('"1":"https:', '"2":"https:', ["metadata.urls_keys"]),
    ('"1":"https:', '"1":"ftp:', ["metadata.urls_invalid"]),
    ('"1":"https:', '"2":"https://x/","1":"https:', ["metadata.urls_count"]),
    ('"title":"T"', '"title":["T"]', ["metadata.title"]),
    ('"metadata":{', '"metadata":[],"other":{', ["metadata.shape"]),
    ('"blank_pages":0', '"blank_pages":3', ["quality.stale"]),
    ('"total_chars":', '"total_chars":-', ["quality.total_chars"]),
    ('"needs_review":false', '"needs_review":"no"', ["quality.needs_review"]),
    ('"page_types":["content"]', '"page_types":["content","content"]', ["quality.page_type_count"]),
    ('"object_id":"doc', '"object_id":"odc', ["file.name"]),
    ('"object_id":"doc', '"object_id":".doc', ["file.name", "file.id_syntax"]),
    ('"_meta":{', '"meta":{', ["file.meta"]),
    ('"pages":[{', '"leaves":[{', ["file.pages"]),
    ('{"object_id"', '{object_id', ["file.shape"]),
    ('"history":[]', '"history":[{"status":"in_review","from_status":"machine_unreviewed","actor":"a","timestamp":"2024-01-01T10:00:00Z"}]', ["review_status_stale"]),
    (_REVIEW, _REVIEW + ',"edits":5', ["page.edits_shape"]),
    (_REVIEW, _REVIEW + ',"edits":[' + _EDIT.format(before="7", after='{"transcription":"x","notes":"n","more":"m"}') + "]", ["edit_chain_end", "edit_shape"]),
    (_REVIEW, _REVIEW + ',"edits":[' + _EDIT.format(before='{"transcription":"a","notes":7}', after='{"transcription":"x","notes":"n"}') + "]", ["edit_chain_end", "edit_shape"]),
    (_REVIEW, _REVIEW + ',"edits":[7]', ["edit_chain_end", "edit_id_or_time", "edit_no_actor", "edit_no_note", "edit_shape", "edit_unknown_actor_kind", "edit_without_change"]),
    ('"transcription_raw":"', '"transcription_raw":"Z', ["origin.raw_hash", "page.changed_unreviewed"]),
    ('"pipeline_step":3,"provider":"p","model":"m"', '"pipeline_step":4', ["_meta.step4_unexpected"]),
    ('"pipeline_step":3,"provider":"p"', '"pipeline_step":4', ["_meta.step4_calls", "_meta.step4_provider"]),
    ('"pipeline_step":3,"provider":"p","model":"m"', '"pipeline_step":4,"provider":"p"', ["_meta.step4_calls", "_meta.step4_model"]),
    ('"pipeline_step":3,"provider":"p","model":"m","prompt_template":"transcription.md"', '"pipeline_step":4,"provider":"p","model":"m"', ["_meta.step4_calls", "_meta.step4_prompt_template"]),
    ('"pipeline_step":3', '"pipeline_step":4', ["_meta.step4_calls"]),
]


def corpus(t) -> DataFrame:
    """Every row of ``documents`` as a one-page transcription document in JSON."""
    identifier = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    filename = F.concat(identifier, F.lit("_p1.png"))
    digest = F.sha2("text", 256)
    state = F.struct(F.lit(1).alias("page"), filename.alias("filename"), digest.alias("sha256"))
    short = F.lit("0123456789ab")
    meta = F.struct(
        F.lit("transcribe").alias("script"),
        F.lit("2024-01-01T10:00:00+00:00").alias("timestamp"),
        F.lit(3).alias("pipeline_step"),
        F.lit("p").alias("provider"),
        F.lit("m").alias("model"),
        F.lit("transcription.md").alias("prompt_template"),
        F.lit("letters").alias("prompt_profile"),
        short.alias("prompt_hash"),
        F.array(F.lit("transcription.md"), F.lit("profiles/letters.md")).alias("prompt_layers"),
        audit.digest_of(hashing.fields_hash(F.lit(1), F.col("text"))).alias("raw_transcription_hash"),
        short.alias("source_metadata_hash"),
        F.array(
            F.struct(
                F.lit(1).alias("chunk"), F.array(F.lit(1)).alias("pages"), F.lit(1).alias("attempt"), short.alias("prompt_hash")
            )
        ).alias("executed_prompts"),
        F.array(state).alias("source_images"),
        audit.digest_of(hashing.image_hash(F.lit(1), filename, digest)).alias("source_images_hash"),
    )
    page = F.struct(
        F.lit(1).alias("page"),
        F.col("text").alias("transcription"),
        F.col("text").alias("transcription_raw"),
        F.lit("n").alias("notes"),
        F.lit("").alias("page_type"),
        F.array(F.lit(0)).alias("foreign_paragraphs"),
        F.struct(F.lit("machine_unreviewed").alias("status"), F.array().cast("array<string>").alias("history")).alias("review"),
    )
    signals = F.struct(
        F.array(F.lit("content")).alias("page_types"),
        F.length("text").alias("total_chars"),
        F.length("text").cast("double").alias("chars_per_page"),
        *[F.lit(0).alias(f"{c}_pages") for c in ("blank", "undeclared_empty", "gate", "foreign")],
        F.lit(1).alias("content_pages"),
        F.lit(False).alias("needs_review"),
    )
    metadata = F.struct(
        F.lit("T").alias("title"),
        F.col("lang").alias("language"),
        F.create_map(F.lit("1"), F.lit("https://img.example.org/1.jpg")).alias("image_urls"),
    )
    value = F.to_json(
        F.struct(
            identifier.alias("object_id"),
            meta.alias("_meta"),
            F.array(filename).alias("source_images"),
            metadata.alias("metadata"),
            F.array(page).alias("pages"),
            F.lit("high").alias("confidence"),
            F.lit("").alias("confidence_notes"),
            signals.alias("quality_signals"),
        )
    )
    return t.documents.select("doc_id", identifier.alias("object_id"), value.alias("value"))


def mutated(t) -> DataFrame:
    """The corpus with one broken field per document, chosen by doc_id."""
    value, position = F.col("value"), F.col("doc_id") % len(MUTATIONS)
    broken = F.when(F.lit(False), value)
    for i, (find, put, _codes) in enumerate(MUTATIONS):
        if find:
            broken = broken.when(position == i, F.replace(value, F.lit(find), F.lit(put)))
    return corpus(t).select("doc_id", "object_id", broken.otherwise(value).alias("value"))


_EXPECTED = ", ".join(f"({i}, '{code}')" for i, (_f, _p, codes) in enumerate(MUTATIONS) for code in codes)


@query(
    "job09_contract_audit",
    f"""SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, code
        FROM documents JOIN (VALUES {_EXPECTED}) m(i, code) ON doc_id % {len(MUTATIONS)} = m.i""",
)
def _(t):
    return audit.audit(mutated(t)).select("object_id", "code")


@query(
    "src01_transcription_corpus",
    f"""SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, CAST(CASE k WHEN 1 THEN 2 WHEN 2 THEN NULL ELSE 1 END AS INT) AS page,
               text AS transcription, CASE k WHEN 8 THEN '' ELSE 'n' END AS notes
        FROM (SELECT *, doc_id % {len(MUTATIONS)} AS k FROM documents) WHERE k NOT IN (44, 45)""",
)
def _(t):
    _, pages = contract.parsed(mutated(t))
    return contract.typed_pages(pages).select("object_id", "page", "transcription", "notes")


def volumes(t) -> DataFrame:
    """JSON documents of ten neighbouring rows of ``documents`` a page each, with braces, brackets and the name of the list in their texts."""
    page = F.struct(
        (F.col("doc_id") % 10 + 1).cast("int").alias("page"),
        F.concat("text", F.lit(' }]{["pages":[ \\"} ')).alias("transcription"),
        F.array(F.struct(F.lit(1).alias("a"), F.array(F.struct(F.col("lang").alias("b"))).alias("c"))).alias("edits"),
    )
    grouped = t.documents.groupBy(F.floor(F.col("doc_id") / 10).alias("volume")).agg(F.array_sort(F.collect_list(page)).alias("pages"))
    meta = F.struct(F.array(F.struct(F.lit(1).alias("pages"))).alias("pages"))
    identifier = F.concat(F.lit("volume-"), F.col("volume").cast("string"))
    return grouped.select(
        identifier.alias("object_id"),
        F.to_json(F.struct(identifier.alias("object_id"), meta.alias("_meta"), "pages", F.lit("}").alias("confidence_notes"))).alias("value"),
    )


@query(
    "src01_pages_in_chunks",
    """SELECT 'volume-' || CAST(doc_id // 10 AS STRING) AS object_id, CAST(row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) - 1 AS INT) AS position,
              CAST(doc_id % 10 + 1 AS INT) AS page, text || ' }]{["pages":[ \\"} ' AS transcription FROM documents""",
)
def _(t):
    # every document by the way of large ones
    _, pages = contract.parsed(volumes(t), large=0)
    field = lambda name, kind: F.try_variant_get("raw", F.lit(f"$.{name}"), kind).alias(name)
    return pages.select("object_id", "position", field("page", "int"), field("transcription", "string"))


@query(
    "src04_page_count",
    f"""SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, CAST(1 AS INT) AS pages FROM documents
        UNION ALL SELECT 'volume-' || CAST(doc_id // 10 AS STRING), CAST(count(*) AS INT) FROM documents GROUP BY ALL""",
)
def _(t):
    from ..sources.transcriptions import count_pages

    return count_pages(mutated(t).select("object_id", "value").unionByName(volumes(t))).select("object_id", "pages")


# The pages table -------------------------------------------------------------------

PAGE_ROWS = """
    SELECT object_id, CAST(CASE WHEN page % 5 = 0 THEN 0 ELSE page END AS INT) AS page,
           CASE WHEN page % 7 = 6 THEN transcription || chr(11) ELSE transcription END AS transcription, notes,
           CASE WHEN role = 'user' AND page_type = 'foreign_text' THEN 'cover' ELSE page_type END AS page_type, foreign_index
    FROM pages_v"""


def page_rows(t):
    return t.pages_v.select(
        "object_id",
        F.when(F.col("page") % 5 == 0, 0).otherwise(F.col("page")).cast("int").alias("page"),
        F.when(F.col("page") % 7 == 6, F.concat("transcription", F.lit("\x0b"))).otherwise(F.col("transcription")).alias("transcription"),
        "notes",
        F.when((F.col("role") == "user") & (F.col("page_type") == "foreign_text"), "cover").otherwise(F.col("page_type")).alias("page_type"),
        F.when(F.col("foreign_index").isNotNull(), F.array("foreign_index")).otherwise(F.array().cast("array<int>")).alias("foreign_paragraphs"),
    )


@query(
    "gate05_to_gate07_page_table",
    r"""SELECT object_id, page, code FROM (
          SELECT object_id, page, unnest([
            CASE WHEN page < 1 THEN 'page_number' END,
            CASE WHEN contains(transcription, chr(11)) THEN 'page_illegal_text' END,
            CASE WHEN page_type = 'cover' THEN 'page_type' END,
            CASE WHEN page_type = 'blank' AND transcription <> '' THEN 'page_blank_text' END,
            CASE WHEN foreign_index >= CASE WHEN regexp_matches(transcription, '[^\s\x0B]')
                      THEN len(regexp_split_to_array(regexp_replace(transcription, '^[\s\x0B]+|[\s\x0B]+$', '', 'g'), '\n{2,}')) ELSE 0 END
                 THEN 'page_foreign_range' END]) AS code
          FROM page_rows) WHERE code IS NOT NULL""",
    {"page_rows": PAGE_ROWS},
)
def _(t):
    return contract.audit_pages(page_rows(t)).select("object_id", "page", "code")


@query(
    "gate04_page_numbers",
    """SELECT object_id, 'page_numbers' AS code FROM page_rows GROUP BY object_id
       HAVING NOT (min(page) = 1 AND max(page) = count(*) AND count(DISTINCT page) = count(*))""",
    {"page_rows": PAGE_ROWS},
)
def _(t):
    return contract.page_number_violations(page_rows(t)).select("object_id", "code")


SPELLINGS = """
    SELECT conv_id, turn, CASE WHEN conv_id % 6 = 0 AND turn % 2 = 1 THEN 'CONV-' || CAST(conv_id AS STRING)
                               WHEN conv_id % 10 = 1 THEN 'conv/' || CAST(conv_id AS STRING)
                               WHEN conv_id % 10 = 2 THEN 'Aux.' || CAST(conv_id AS STRING)
                               WHEN conv_id % 10 = 3 THEN 'conv-' || CAST(conv_id AS STRING) || '.'
                               ELSE 'conv-' || CAST(conv_id AS STRING) || CASE WHEN conv_id % 6 = 0 THEN '' ELSE '_' || CAST(turn AS STRING) END END AS object_id
    FROM conversations"""


def spellings(t):
    number = F.col("conv_id").cast("string")
    return t.conversations.select(
        "conv_id", "turn",
        F.when((F.col("conv_id") % 6 == 0) & (F.col("turn") % 2 == 1), F.concat(F.lit("CONV-"), number))
        .when(F.col("conv_id") % 10 == 1, F.concat(F.lit("conv/"), number))
        .when(F.col("conv_id") % 10 == 2, F.concat(F.lit("Aux."), number))
        .when(F.col("conv_id") % 10 == 3, F.concat(F.lit("conv-"), number, F.lit(".")))
        .otherwise(
            F.concat(F.lit("conv-"), number, F.when(F.col("conv_id") % 6 == 0, "").otherwise(F.concat(F.lit("_"), F.col("turn").cast("string"))))
        ).alias("object_id"),
    )


@query(
    "gate01_gate02_identifiers",
    r"""WITH_MARK SELECT object_id, 'object_id_invalid' AS code FROM spellings
        WHERE NOT (regexp_full_match(object_id, '[A-Za-z0-9][A-Za-z0-9._-]*') AND NOT ends_with(object_id, '.') AND lower(split_part(object_id, '.', 1)) <> 'aux')
        UNION ALL
        SELECT DISTINCT s.object_id, 'object_id_not_unique' FROM spellings s
        JOIN (SELECT lower(object_id) AS folded FROM spellings
              WHERE regexp_full_match(object_id, '[A-Za-z0-9][A-Za-z0-9._-]*') AND NOT ends_with(object_id, '.') AND lower(split_part(object_id, '.', 1)) <> 'aux'
              GROUP BY 1 HAVING count(*) > 1) d ON lower(s.object_id) = d.folded""".replace("WITH_MARK ", ""),
    {"spellings": SPELLINGS},
)
def _(t):
    return contract.identifier_violations(spellings(t)).select("object_id", "code")


@query(
    "win12_first_spelling",
    """SELECT lower(object_id) AS folded, arg_min(object_id, turn) AS object_id, count(*) AS spellings FROM spellings GROUP BY 1""",
    {"spellings": SPELLINGS},
)
def _(t):
    return contract.first_spelling(spellings(t), "turn")
