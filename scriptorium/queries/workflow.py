"""Ingestion, instructions, validated gate, freshness, review batches, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import hashing, text
from ..operators import calls, fingerprints, incremental, quality, selection
from ..operators.ordered import in_order
from ..plans import ingestion, inventory, prompts, review, validated
from .assessment import MEASURES, blocks
from .registry import query

# Model answers: every document is an object of one chunk -----------------------------


def model_calls(t):
    n = F.col("doc_id")
    page = F.struct(
        F.when(n % 9 == 7, 2).otherwise(1).alias("page"), F.col("text").alias("transcription"),
        F.when(n % 9 == 5, "cover").alias("page_type"), F.when(n % 9 == 6, "x").alias("transcription_raw"),
    )
    confidence = F.when(n % 9 == 1, " High ").when(n % 9 == 2, "low").when(n % 9 == 4, "sure")
    body = F.to_json(F.struct(F.array(page).alias("pages"), confidence.alias("confidence"), F.lit(" ok ").alias("confidence_notes")))
    raw_breaks = F.replace(body, F.lit("\\n"), F.lit("\n"))
    answer = (
        F.when(n % 9 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(n % 9 == 2, raw_breaks)
        .when(n % 9 == 3, F.concat(F.lit("{broken"), body))
        .otherwise(body)
    )
    return t.documents.select(
        F.concat(F.lit("doc-"), n.cast("string")).alias("object_id"), F.lit(0).alias("chunk"), F.lit(1).alias("attempt"),
        F.when(n % 9 != 8, answer).alias("answer"), F.when(n % 9 == 8, "timeout").alias("error"),
    )


def plan_of(t):
    return t.documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("object_id"), F.lit(0).alias("chunk"),
        F.lit(1).alias("start_page"), F.lit(1).alias("end_page"),
    )


@query(
    "job04_model_answer_pages",
    """SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, CAST(1 AS INT) AS page, text AS transcription, text AS transcription_raw, 'machine_unreviewed' AS review_status
       FROM documents WHERE doc_id % 9 < 3""",
)
def _(t):
    pages, _objects, _errors = ingestion.ingest(plan_of(t), model_calls(t))
    return pages.select("object_id", "page", "transcription", "transcription_raw", "review_status")


@query(
    "job04_gate23_answer_errors",
    """SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, CASE WHEN doc_id % 9 = 3 THEN 'parse' WHEN doc_id % 9 = 8 THEN 'api_call' ELSE 'contract' END AS stage,
              'chunk 1: ' || CASE doc_id % 9 WHEN 3 THEN 'JSON parse failed after retry' WHEN 4 THEN 'answer.confidence' WHEN 5 THEN 'page.page_type' WHEN 6 THEN 'page.reserved'
                WHEN 7 THEN 'page.sequence' ELSE 'timeout' END AS error
       FROM documents WHERE doc_id % 9 >= 3""",
)
def _(t):
    _pages, _objects, errors = ingestion.ingest(plan_of(t), model_calls(t))
    return errors.select("object_id", "stage", "error")


CHUNKS = """
    SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 AND turn = 1 THEN 'low' WHEN turn % 3 = 1 THEN 'High ' WHEN turn % 3 = 2 THEN 'medium' END AS confidence,
           CASE WHEN turn % 2 = 0 THEN ' Notiz ' || CAST(turn AS STRING) ELSE '  ' END AS notes FROM conversations"""


def chunk_documents(t):
    n = F.col("turn")
    doc = F.struct(
        F.when((F.col("conv_id") % 3 == 0) & (n == 1), "low").when(n % 3 == 1, "High ").when(n % 3 == 2, "medium").alias("confidence"),
        F.when(n % 2 == 0, F.concat(F.lit(" Notiz "), n.cast("string"))).otherwise("  ").alias("confidence_notes"),
    )
    return t.conversations.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("object_id"), n.cast("int").alias("chunk"),
        F.parse_json(F.to_json(doc)).alias("doc"),
    )


@query(
    "agg11_weakest_confidence",
    """SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id, count(*) AS chunks,
              coalesce(['low', 'medium', 'high'][min(list_position(['low', 'medium', 'high'], lower(trim(confidence))))], '') AS confidence FROM chunks GROUP BY conv_id""",
    {"chunks": CHUNKS},
)
def _(t):
    return ingestion.merge_chunks(chunk_documents(t))


@query(
    "agg11_merged_notes",
    """SELECT 'conv-' || CAST(conv_id AS STRING) AS object_id, CAST(0 AS BIGINT) AS part, string_agg(trim(notes), chr(10) ORDER BY turn) AS confidence_notes
       FROM chunks WHERE trim(notes) <> '' GROUP BY conv_id""",
    {"chunks": CHUNKS},
)
def _(t):
    return ingestion.merged_notes(chunk_documents(t)).drop("rows")


# Call logs -------------------------------------------------------------------------


def call_log(t):
    """Two pages per chunk; some chunks lost, repeated or with inconsistent retries."""
    size = t.pages_v.groupBy("object_id", F.floor((F.col("page") - 1) / 2).cast("int").alias("c")).agg(
        F.min("page").alias("low"), F.max("page").alias("high")
    ).withColumn("n", F.substring("object_id", 6, 20).cast("int"))
    first = size.filter("NOT (n % 10 = 3 AND c = 1)").select(
        "object_id", (F.col("c") + 1).alias("chunk"), F.lit(1).alias("attempt"), F.sequence("low", "high").alias("pages")
    )
    retry = size.filter("n % 4 = 1").select(
        "object_id", (F.col("c") + 1).alias("chunk"), F.when(F.col("n") % 8 == 5, 3).otherwise(2).alias("attempt"),
        F.sequence("low", "high").alias("pages"),
    )
    return first.unionByName(retry)


@query(
    "gate18_agg12_call_log",
    """SELECT object_id, code FROM (
         SELECT object_id, unnest([CASE WHEN n % 10 = 3 AND chunks > 2 THEN 'calls_chunks' END, CASE WHEN n % 10 = 3 AND chunks > 1 THEN 'calls_coverage' END]) AS code
         FROM (SELECT object_id, CAST(substr(object_id, 6) AS INT) AS n, (count(*) + 1) // 2 AS chunks FROM pages_v GROUP BY object_id)) WHERE code IS NOT NULL
       UNION ALL
       SELECT object_id, 'calls_retries' FROM (SELECT DISTINCT object_id, (page - 1) // 2 AS c, CAST(substr(object_id, 6) AS INT) AS n FROM pages_v)
       WHERE n % 8 = 5 AND NOT (n % 10 = 3 AND c = 1)""",
)
def _(t):
    counts = t.pages_v.groupBy("object_id").agg(F.count(F.lit(1)).cast("int").alias("page_count"))
    return calls.call_log_violations(call_log(t), counts).select("object_id", "code")


@query(
    "job08_verdict_ingestion",
    """SELECT object_id, page, CASE WHEN transcription = '' THEN CASE WHEN page_type = 'blank' THEN 'confident' ELSE 'unreviewed' END
              WHEN confidence IS NULL THEN 'unreviewed' WHEN confidence = 'perhaps' THEN 'uncertain' ELSE confidence END AS confidence,
              CASE WHEN transcription = '' THEN CASE WHEN page_type = 'blank' THEN 'Declared blank page, nothing to validate.' ELSE 'Empty page without a declared blank-page classification.' END
              WHEN confidence IS NULL THEN 'Judge not reached.' WHEN confidence = 'perhaps' THEN 'Response violated the validation contract.' ELSE 's' || object_id END AS summary,
              CASE WHEN transcription <> '' AND confidence <> 'perhaps' THEN 'spelling:a>b:linguistic' ELSE '' END AS issues FROM verdicts_v""",
)
def _(t):
    rows = t.verdicts_v
    issue = F.struct(
        F.lit("spelling").alias("type"), F.lit("a").alias("text"), F.lit("b").alias("suggestion"), F.lit("linguistic").alias("perspective")
    )
    answer = F.to_json(F.struct("confidence", F.concat(F.lit("s"), "object_id").alias("summary"), F.array(issue).alias("issues")))
    answers = rows.filter("confidence IS NOT NULL").select("object_id", "page", answer.alias("answer"))
    shown = F.transform("issues", lambda i: F.concat(i["type"], F.lit(":"), i["text"], F.lit(">"), i["suggestion"], F.lit(":"), i["perspective"]))
    return ingestion.ingest_verdicts(rows, answers).select("object_id", "page", "confidence", "summary", F.array_join(shown, ",").alias("issues"))


@query(
    "agg07_unreviewed_verdicts",
    """SELECT object_id, count(*) FILTER (coalesce(confidence, 'unreviewed') = 'unreviewed') AS unreviewed_pages FROM verdicts_v GROUP BY object_id""",
)
def _(t):
    return ingestion.unreviewed_counts(t.verdicts_v.withColumn("confidence", F.coalesce("confidence", F.lit("unreviewed"))))


@query(
    "gate_v4_join06_judge_coverage",
    """SELECT object_id, page, code FROM (SELECT object_id, page, unnest([
         CASE WHEN confidence IS NULL THEN 'judge_missing' END,
         CASE WHEN (transcription <> '') <> (n % 6 <> 1) THEN 'judge_calls' END,
         CASE WHEN confidence IS NOT NULL AND n % 6 <> 1 AND n % 8 = 3 THEN 'judge_hash' END]) AS code
       FROM (SELECT *, CAST(substr(object_id, 5) AS INT) AS n FROM verdicts_v)) WHERE code IS NOT NULL""",
)
def _(t):
    n = F.substring("object_id", 5, 20).cast("int")
    rows = t.verdicts_v
    verdicts = rows.filter("confidence IS NOT NULL").select("object_id", "page", F.lit("h1").alias("prompt_hash"))
    called = rows.filter(n % 6 != 1).select("object_id", "page", F.when(n % 8 == 3, "h2").otherwise("h1").alias("prompt_hash"))
    return calls.judge_coverage_violations(verdicts, called, rows)


@query(
    "gate_v2_join05_stale_page_stats",
    """SELECT object_id, page, CASE WHEN page % 4 = 0 THEN 'stats_missing' ELSE 'stats_word_count' END AS code
       FROM measures WHERE page % 4 = 0 OR page % 3 = 2""",
    {"measures": MEASURES},
)
def _(t):
    stats = quality.page_stats(t.pages_v).filter("page % 4 <> 0")
    recorded = stats.withColumn("word_count", F.col("word_count") + F.when(F.col("page") % 3 == 2, 1).otherwise(0))
    return validated.stale_page_stats(recorded, t.pages_v)


@query(
    "gate_v3_stale_totals",
    "SELECT object_id FROM totals WHERE total_characters % 5 = 2",
    blocks("totals"),
)
def _(t):
    recorded = quality.object_measures(t.pages_v).select(
        "object_id", (F.col("total_characters") + F.when(F.col("total_characters") % 5 == 2, 1).otherwise(0)).alias("total_characters")
    )
    return validated.stale_totals(recorded, t.pages_v)


@query(
    "gate17_stale_signals",
    "SELECT object_id FROM signals WHERE page_count % 3 = 1",
    blocks("signals"),
)
def _(t):
    recorded = quality.quality_signals(quality.object_measures(t.pages_v)).withColumn(
        "gate_pages", F.col("gate_pages") + F.when(F.col("page_count") % 3 == 1, 1).otherwise(0)
    )
    return validated.stale_signals(recorded, t.pages_v)


# Validated documents in JSON -----------------------------------------------------------

VALIDATED_MUTATIONS = [
    ("", "", []),
    ('"pipeline_step":4', '"pipeline_step":3', ["validated.step"]),
    ('"overall_status":"confident"', '"overall_status":"fine"', ["validated.result_hash", "validated.status"]),
    ('"confidence":"high"', '"confidence":"low"', ["validated.state_hash"]),
    ('"input_state_hash":"', '"input_state_hash":"0', ["validated.state_hash"]),
    ('"validation_result_hash":"', '"validation_result_hash":"0', ["validated.result_hash"]),
    ('"transcription_meta":', '"meta":', ["validated.origin", "validated.state_hash"]),
    ('"rules":[', '"rulez":[', ["validated.rules", "validated.result_hash"]),
    ('"line_count":', '"line_count":1', ["stats_line_count", "validated.result_hash"]),
    ('"total_characters":', '"total_characters":9', ["stats_total", "validated.result_hash"]),
]


def validated_files(t):
    n = F.col("doc_id")
    stats = F.struct(
        F.length("text").alias("char_count"), text.word_count(F.col("text")).alias("word_count"),
        (F.regexp_count("text", F.lit("\n")) + 1).alias("line_count"), F.lit(1).alias("page"),
    )
    findings = F.struct(
        F.array(F.struct(F.lit("double_spaces").alias("name"))).alias("rules"), F.array(stats).alias("per_page_stats"),
        F.length("text").alias("total_characters"),
    )

    def document(state, result):
        meta = F.struct(F.lit(4).alias("pipeline_step"), state.alias("input_state_hash"), result.alias("validation_result_hash"))
        return F.to_json(
            F.struct(
                F.concat(F.lit("doc-"), n.cast("string")).alias("object_id"), meta.alias("_meta"),
                F.struct(F.lit("t").alias("script")).alias("transcription_meta"),
                F.array(F.struct(F.lit(1).alias("page"), F.col("text").alias("transcription"))).alias("pages"),
                F.lit("high").alias("confidence"), findings.alias("validation"), F.lit("confident").alias("overall_status"),
            )
        )

    # the hashes cover everything but the block that records them
    unsealed = t.documents.withColumn("doc", F.parse_json(document(F.lit(""), F.lit(""))))
    sealed = unsealed.withColumn("s", validated.document_state_hash(F.col("doc"))).withColumn(
        "r", validated.document_result_hash(F.col("doc"))
    )
    value, position = F.col("value"), n % len(VALIDATED_MUTATIONS)
    broken = F.when(F.lit(False), value)
    for i, (find, put, _codes) in enumerate(VALIDATED_MUTATIONS):
        if find:
            broken = broken.when(position == i, F.replace(value, F.lit(find), F.lit(put)))
    return sealed.withColumn("value", document(F.col("s"), F.col("r"))).select(
        F.concat(F.lit("doc-"), n.cast("string")).alias("object_id"), broken.otherwise(value).alias("value")
    )


_VALIDATED = ", ".join(f"({i}, '{c}')" for i, (_f, _p, codes) in enumerate(VALIDATED_MUTATIONS) for c in codes)


@query(
    "gate_v1_src02_validated_gate",
    f"""SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, code FROM documents
        JOIN (VALUES {_VALIDATED}) m(i, code) ON doc_id % {len(VALIDATED_MUTATIONS)} = m.i""",
)
def _(t):
    from ..operators.contract import parse_documents

    return validated.validated_violations(parse_documents(validated_files(t))).select("object_id", "code")


# Instructions and chunk plan ------------------------------------------------------------


@query(
    "job05_instruction_assembly",
    """SELECT object_id, substr(sha256(body), 1, 12) AS prompt_hash, layers FROM (
         SELECT object_id, 'Base' || CASE WHEN object_type <> '' THEN chr(10) || chr(10) || '## Document-type profile' || chr(10) || chr(10) || 'Letters.' ELSE '' END
           || chr(10) || chr(10) || '## Document metadata' || chr(10) || chr(10) ||
           concat_ws(chr(10), CASE WHEN title <> '' THEN '- Title: ' || title END, CASE WHEN signature <> '' THEN '- Signature / Identifier: ' || signature END,
                     CASE WHEN date <> '' THEN '- Date: ' || date END, CASE WHEN language <> '' THEN '- Language: ' || language END,
                     CASE WHEN object_type <> '' THEN '- Object type: ' || object_type END,
                     CASE WHEN extent <> '' THEN '- Extent: ' || extent ELSE '- Extent: 3 page(s)' END)
           || CASE WHEN repository <> '' THEN chr(10) || chr(10) || '## Object-specific instructions' || chr(10) || chr(10) || 'Beware ' || object_id ELSE '' END AS body,
           concat_ws('|', 'transcription.md', CASE WHEN object_type <> '' THEN 'profiles/letter.md' END, 'inventory:metadata', CASE WHEN repository <> '' THEN 'objects/' || object_id || '.md' END) AS layers
         FROM objects_v)""",
)
def _(t):
    objects = t.objects_v.withColumn("pages", F.lit(3)).withColumn("prompt_profile", F.col("object_type"))
    profiles = t.objects_v.filter("object_type <> ''").select(F.col("object_type").alias("prompt_profile")).distinct().withColumn(
        "profile_text", F.lit(" Letters.\n")
    )
    overrides = t.objects_v.filter("repository <> ''").select("object_id", F.concat(F.lit("Beware "), "object_id").alias("override_text"))
    ready, _errors = prompts.assemble_instructions(objects, "Base\n", profiles, overrides)
    return ready.select("object_id", "prompt_hash", F.array_join("layers", "|").alias("layers"))


@query(
    "win07_chunk_assignment",
    """SELECT object_id, CAST((page - 1) // 3 AS INT) AS chunk, min(page) AS start_page, max(page) AS end_page, count(*) AS pages FROM images_v GROUP BY object_id, (page - 1) // 3""",
)
def _(t):
    return prompts.chunk_plan(t.images_v, 3).select("object_id", "chunk", "start_page", "end_page", "pages")


@query(
    "job06_chunk_cache_lookup",
    """SELECT object_id, chunk, CASE WHEN (n + chunk) % 3 = 0 THEN 'miss' WHEN (n + chunk) % 5 = 1 THEN 'contradictory' ELSE 'hit' END AS state
       FROM (SELECT DISTINCT object_id, CAST((page - 1) // 3 AS INT) AS chunk, CAST(substr(object_id, 6) AS INT) AS n FROM images_v)""",
)
def _(t):
    run = {"provider": "p", "model": "m", "temperature": "0"}
    plan = prompts.chunk_plan(t.images_v, 3).withColumn("prompt_hash", F.lit("0123456789ab"))
    plan = plan.withColumn("identity", prompts.chunk_identity(run))
    pick = F.substring("object_id", 6, 20).cast("int") + F.col("chunk")
    cache = plan.filter(pick % 3 != 0).select(
        "identity", F.sha2("identity", 256).alias("content_hash"),
        F.when(pick % 5 == 1, "x").otherwise(F.sha2("identity", 256)).alias("recorded_hash"),
    )
    return prompts.cache_lookup(plan, cache).select("object_id", "chunk", "state")


@query("job06_output_budget", "SELECT doc_id, (doc_id % 40 + 1) * 1500 <= n_chars * 10 AS fits FROM documents")
def _(t):
    return t.documents.select("doc_id", prompts.output_budget(F.col("doc_id") % 40 + 1, F.col("n_chars") * 10).alias("fits"))


# Freshness -------------------------------------------------------------------------------

FRESHNESS = """
    SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, sha256(text) AS state_hash, doc_id,
           CASE WHEN doc_id % 4 = 0 THEN 'new' WHEN doc_id % 4 = 1 OR doc_id % 10 = 7 THEN 'stale' ELSE 'current' END AS state FROM documents"""


def states(t):
    n = F.col("doc_id")
    current = t.documents.select(F.concat(F.lit("doc-"), n.cast("string")).alias("object_id"), F.sha2("text", 256).alias("state_hash"), "doc_id")
    previous = current.filter(n % 4 != 0).select(
        "object_id", F.when(n % 4 == 1, "old").otherwise(F.col("state_hash")).alias("state_hash"), (n % 10 != 7).alias("valid"), "doc_id"
    )
    return current, previous


@query("inc01_join12_freshness", "SELECT object_id, state_hash, doc_id, state FROM freshness", {"freshness": FRESHNESS})
def _(t):
    current, previous = states(t)
    return incremental.classify(current, previous)


@query(
    "inc04_dry_run",
    "SELECT object_id, CASE WHEN state = 'current' THEN 'CURRENT' WHEN state = 'new' THEN 'PENDING' ELSE 'BLOCKED' END AS report FROM freshness",
    {"freshness": FRESHNESS},
)
def _(t):
    return incremental.dry_run(incremental.classify(*states(t)))


@query(
    "inc02_forced_refusals",
    """SELECT object_id, CASE WHEN doc_id % 10 = 7 THEN 'stale' ELSE 'review_history' END AS stage FROM freshness WHERE doc_id % 4 <> 0 AND (doc_id % 10 = 7 OR doc_id % 6 = 2)""",
    {"freshness": FRESHNESS},
)
def _(t):
    current, previous = states(t)
    history = current.filter("doc_id % 6 = 2").select("object_id")
    return incremental.refuse_forced(current, history.unionByName(history), previous)


@query(
    "inc03_overwrite_guard",
    """SELECT object_id, CASE WHEN doc_id % 4 = 0 THEN 'write' WHEN doc_id % 4 <> 1 THEN 'skip' WHEN doc_id % 3 = 0 THEN 'write' ELSE 'refuse' END AS action FROM freshness""",
    {"freshness": FRESHNESS},
)
def _(t):
    current, previous = states(t)
    generated = current.select("object_id", F.col("state_hash").alias("sha256"))
    existing = previous.select(
        "object_id", F.col("state_hash").alias("sha256"), F.when(F.col("doc_id") % 3 == 0, F.col("state_hash")).alias("recorded")
    )
    return incremental.overwrite_guard(generated, existing).select("object_id", "action")


@query(
    "snk07_changed_rows",
    "SELECT object_id FROM freshness WHERE doc_id % 4 < 2",
    {"freshness": FRESHNESS},
)
def _(t):
    return incremental.changed_rows(*states(t), digest="state_hash").select("object_id")


@query(
    "snk08_set03_removed_keys",
    "SELECT object_id FROM freshness WHERE doc_id % 4 <> 0 AND doc_id % 5 = 3",
    {"freshness": FRESHNESS},
)
def _(t):
    current, previous = states(t)
    return incremental.removed_keys(current.filter("doc_id % 5 <> 3"), previous)


@query(
    "inc06_refresh_catalogue",
    """SELECT id, CASE WHEN conv_id % 10 = 4 THEN 'neu' ELSE title END AS title FROM (
         SELECT 'conv-' || CAST(conv_id AS STRING) AS id, 'alt' AS title, conv_id FROM conversations WHERE turn = 0)""",
)
def _(t):
    catalog = t.conversations.filter("turn = 0").select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("id"), F.lit("alt").alias("title"), "conv_id"
    )
    record = catalog.filter("conv_id % 10 = 4").select("id", F.lit("neu").alias("title"))
    unknown = record.limit(1).select(F.lit("none").alias("id"), "title")
    refreshed, _errors = incremental.refresh_one(catalog.drop("conv_id"), record.unionByName(unknown))
    return refreshed


@query(
    "fp02_raw_text_digest",
    """SELECT object_id, substr(sha256(CAST(count(*) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS STRING)
              || chr(31) || CAST(sum(CAST('0x' || substr(h, 31, 15) AS BIGINT)) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 46, 15) AS BIGINT)) AS STRING)), 1, 12) AS raw_hash
       FROM (SELECT object_id, sha256(CAST(page AS STRING) || chr(31) || transcription) AS h FROM pages_v) GROUP BY object_id""",
)
def _(t):
    return fingerprints.raw_digest(t.pages_v.withColumnRenamed("transcription", "transcription_raw"))


@query(
    "fp03_transcription_digest",
    """SELECT o.object_id, substr(sha256(o.object_id || chr(31) || o.title || chr(31) || o.confidence || chr(31) || p.pages_hash), 1, 12) AS state_hash FROM objects_v o JOIN (
         SELECT object_id, sha256(CAST(count(*) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS STRING)
              || chr(31) || CAST(sum(CAST('0x' || substr(h, 31, 15) AS BIGINT)) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 46, 15) AS BIGINT)) AS STRING)) AS pages_hash
         FROM (SELECT object_id, sha256(CAST(page AS STRING) || chr(31) || transcription || chr(31) || notes || chr(31) || page_type || chr(31) || coalesce(CAST(foreign_index AS STRING), '')) AS h FROM pages_v)
         GROUP BY object_id) p ON p.object_id = o.object_id""",
)
def _(t):
    pages = t.pages_v.withColumn("foreign_paragraphs", F.when(F.col("foreign_index").isNotNull(), F.array("foreign_index")))
    return fingerprints.transcription_digest(t.objects_v, pages, ["title", "confidence"])


@query(
    "fp04_validation_digest",
    """SELECT a.object_id, substr(sha256(a.overall_status || chr(31) || f.findings_hash), 1, 12) AS result_hash FROM assessed a JOIN (
         SELECT object_id, sha256(CAST(count(*) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS STRING)
              || chr(31) || CAST(sum(CAST('0x' || substr(h, 31, 15) AS BIGINT)) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 46, 15) AS BIGINT)) AS STRING)) AS findings_hash
         FROM (SELECT object_id, sha256(rule || chr(31) || CAST(count AS STRING) || chr(31) || severity) AS h FROM findings) GROUP BY object_id) f ON f.object_id = a.object_id""",
    blocks("assessed"),
)
def _(t):
    from ..plans.assessment import assess

    assessed = assess(t.pages_v, t.objects_v)
    return fingerprints.validation_digest(assessed, quality.rule_findings(assessed))


@query(
    "fp05_vocabulary_and_config_hash",
    """SELECT doc_id, substr(sha256('confident,likely,uncertain' || chr(31) || 'abbreviation,historical,marker,ocr_artifact,plausibility,punctuation,spelling,structural' || chr(31) || 'conventions,linguistic,orthographic,structural'), 1, 12) AS vocabulary_hash,
              substr(sha256('editor=A' || chr(31) || 'title=B'), 1, 12) AS config_hash FROM documents""",
)
def _(t):
    return t.documents.select(
        "doc_id", fingerprints.vocabulary_hash().alias("vocabulary_hash"),
        fingerprints.config_hash(t.spark, {"title": "B", "editor": "A"}).alias("config_hash"),
    )


# Review batches --------------------------------------------------------------------------

TRANSITION_REASON = """
    SELECT * REPLACE (coalesce(actor_kind, 'human') AS actor_kind), CASE WHEN trim(actor) = '' THEN 'no_actor' WHEN actor_kind = 'robot' THEN 'unknown_actor_kind'
         WHEN actor_kind = 'agent' AND requested_status IN ('human_verified', 'accepted') THEN 'agent_decision'
         WHEN current_status = requested_status THEN 'already_there'
         WHEN current_status || '>' || requested_status NOT IN ('machine_unreviewed>in_review', 'in_review>machine_unreviewed', 'in_review>human_verified', 'human_verified>in_review', 'human_verified>accepted', 'accepted>in_review') THEN 'not_allowed' END AS rejection
    FROM requests_v"""


@query(
    "job21_accepted_transitions",
    "SELECT object_id, page, current_status AS from_status, requested_status AS status, actor, actor_kind FROM judged WHERE rejection IS NULL",
    {"judged": TRANSITION_REASON},
)
def _(t):
    return review.apply_transitions(t.requests_v.drop("reason"))[0]


@query(
    "job21_rejected_transitions",
    "SELECT object_id, page, rejection AS reason FROM judged WHERE rejection IS NOT NULL",
    {"judged": TRANSITION_REASON},
)
def _(t):
    # the current status comes from the pages' own table
    state = t.requests_v.select("object_id", "page", "current_status")
    return review.apply_transitions(t.requests_v.drop("reason", "current_status"), state)[1].select("object_id", "page", "reason")


CORRECTION_REASON = """
    SELECT * REPLACE (coalesce(actor_kind, 'human') AS actor_kind), CASE WHEN trim(actor) = '' OR actor_kind = 'robot' THEN 'actor' WHEN reason = '' THEN 'no_reason'
         WHEN current_version IS NULL THEN 'unknown_page' WHEN version <> current_version THEN 'version_conflict'
         WHEN new_text = current_text AND new_notes = current_notes THEN 'no_change' WHEN has_foreign THEN 'foreign_paragraphs' END AS code
    FROM requests_v"""


_EDIT_DIGEST = "sha256(object_id || chr(31) || CAST(page AS STRING) || chr(31) || version || chr(31) || actor || chr(31) || reason || chr(31) || new_text || chr(31) || new_notes)"
_EDIT_ID = (
    "substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-8' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"
).format(h=_EDIT_DIGEST)
_STAMP = "'2024-05-0' || CAST(1 + page % 9 AS STRING) || 'T10:00:00+00:00'"


def stamped(t) -> DataFrame:
    page = (F.col("page") % 9 + 1).cast("string")
    return t.requests_v.withColumn("timestamp", F.concat(F.lit("2024-05-0"), page, F.lit("T10:00:00+00:00")))


@query(
    "job22_accepted_corrections",
    f"""SELECT object_id, page, {_EDIT_ID} AS edit_id, {_STAMP} AS event_time,
              actor, actor_kind, reason AS note, current_text AS before_text, new_text AS after_text, current_notes AS before_notes, new_notes AS after_notes,
              current_status <> 'in_review' AS reopened, 'in_review' AS review_status, TRUE AS needs_review FROM judged WHERE code IS NULL""",
    {"judged": CORRECTION_REASON},
)
def _(t):
    return review.apply_corrections(stamped(t))[0]


@query(
    "job22_rejected_corrections",
    "SELECT object_id, page, code FROM judged WHERE code IS NOT NULL",
    {"judged": CORRECTION_REASON},
)
def _(t):
    return review.apply_corrections(stamped(t))[1].select("object_id", "page", "code")


def rival_requests(t) -> DataFrame:
    """Each request three times against one version: as it is, earlier with another text, and earliest with a control character in its text."""
    base = stamped(t).withColumn("page_type", F.when(F.col("page") % 8 == 7, "blank").otherwise(""))
    earlier = base.withColumn("new_text", F.concat("new_text", F.lit(" früher"))).withColumn("timestamp", F.lit("2024-01-01T10:00:00+00:00"))
    broken = base.withColumn("new_text", F.concat("new_text", F.char(F.lit(11)))).withColumn("timestamp", F.lit("2023-01-01T10:00:00+00:00"))
    return base.unionByName(earlier).unionByName(broken)


RIVALS = """
    SELECT r.* REPLACE (r.new_text || CASE k WHEN 1 THEN ' früher' WHEN 2 THEN chr(11) ELSE '' END AS new_text, coalesce(actor_kind, 'human') AS actor_kind), k, r.new_text AS asked
    FROM requests_v r CROSS JOIN (VALUES (0), (1), (2)) x(k)"""
JUDGED_RIVALS = """
    SELECT *, CASE WHEN code IS NULL AND k = 0 THEN 'version_conflict' ELSE code END AS final FROM (
      SELECT *, CASE WHEN trim(actor) = '' OR actor_kind = 'robot' THEN 'actor' WHEN reason = '' THEN 'no_reason'
         WHEN current_version IS NULL THEN 'unknown_page' WHEN version <> current_version THEN 'version_conflict'
         WHEN new_text = current_text AND new_notes = current_notes THEN 'no_change' WHEN has_foreign THEN 'foreign_paragraphs'
         WHEN k = 2 OR page % 8 = 7 THEN 'contract' END AS code FROM rivals)"""


@query(
    "job22_rival_corrections",
    "SELECT object_id, page, new_text AS after_text, coalesce(final, 'accepted') AS code FROM judged_rivals",
    {"rivals": RIVALS, "judged_rivals": JUDGED_RIVALS},
)
def _(t):
    accepted, rejected = review.apply_corrections(rival_requests(t))
    return accepted.select("object_id", "page", "after_text", F.lit("accepted").alias("code")).unionByName(
        rejected.select("object_id", "page", F.col("new_text").alias("after_text"), "code")
    )


@query(
    "job22_corrected_objects",
    """SELECT object_id, count(*) AS page_count, CAST(sum(length(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS BIGINT) AS total_chars, TRUE AS needs_review,
              CAST(0 AS BIGINT) AS broken_rules
       FROM (SELECT r.object_id, coalesce(j.new_text, r.current_text) AS text, bool_or(j.page IS NOT NULL) OVER (PARTITION BY r.object_id) AS touched
             FROM requests_v r LEFT JOIN (SELECT * FROM judged_rivals WHERE final IS NULL) j ON j.object_id = r.object_id AND j.page = r.page)
       WHERE touched GROUP BY object_id""",
    {"rivals": RIVALS, "judged_rivals": JUDGED_RIVALS},
)
def _(t):
    from ..operators import reviews

    pages = t.requests_v.select(
        "object_id", "page", F.col("current_text").alias("transcription"), F.col("current_notes").alias("notes"),
        F.col("current_status").alias("review_status"), F.lit("").alias("page_type"), F.array().cast("array<int>").alias("foreign_paragraphs"),
    )
    accepted, _ = review.apply_corrections(rival_requests(t))
    broken = reviews.audit_edits(review.edit_events(accepted), review.corrected_pages(pages, accepted)).groupBy("object_id").count()
    signals = review.corrected_signals(pages, accepted).select("object_id", "page_count", "total_chars", "needs_review")
    return signals.join(broken, "object_id", "left").select(
        "object_id", "page_count", "total_chars", "needs_review", F.coalesce("count", F.lit(0)).cast("bigint").alias("broken_rules")
    )


@query(
    "str05_proposal_staleness",
    "SELECT object_id, page, version IS DISTINCT FROM current_version AS stale FROM requests_v",
)
def _(t):
    from ..streaming.corrections import proposal_staleness

    current = t.requests_v.select("object_id", "page", "current_version")
    return proposal_staleness(t.requests_v.select("object_id", "page", "version"), current).select("object_id", "page", "stale")


# Selection, sets, sorts --------------------------------------------------------------------


@query("prj01_select_one_object", "SELECT object_id, title FROM objects_v WHERE object_id = 'conv-7'")
def _(t):
    return selection.select_objects(t.objects_v, "conv-7").select("object_id", "title")


@query("prj01_srt04_first_objects", "SELECT object_id FROM objects_v ORDER BY object_id LIMIT 20")
def _(t):
    return selection.select_objects(t.objects_v, everything=True, sample=20).select("object_id")


@query("prj04_text_pages", r"SELECT object_id, page FROM pages_v WHERE regexp_matches(transcription, '\S')")
def _(t):
    return selection.text_pages(t.pages_v).select("object_id", "page")


@query(
    "prj02_exploded_pages",
    "SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, CAST(p AS INT) AS position, text AS transcription FROM documents, (VALUES (0), (1)) v(p)",
)
def _(t):
    page = F.struct(F.col("text").alias("transcription"))
    nested = t.documents.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("object_id"), F.array(page, page).alias("pages"))
    return selection.explode_pages(nested)


@query(
    "prj08_prj09_machine_layer",
    "SELECT object_id, page, transcription AS transcription_raw, 'machine_unreviewed' AS review_status, page_type, '' AS notes FROM pages_v",
)
def _(t):
    fresh = t.pages_v.select(
        "object_id", "page", "transcription", F.when(F.col("page_type") != "", F.col("page_type")).alias("page_type"),
        F.lit(None).cast("string").alias("notes"), F.lit(None).cast("array<int>").alias("foreign_paragraphs"),
    )
    done = selection.initialise_machine_layer(selection.without_null_fields(fresh))
    return done.select("object_id", "page", "transcription_raw", "review_status", "page_type", "notes")


@query(
    "prj05_prj07_transcribable_and_pages",
    """SELECT doc_id, source IN ('src1', 'src2') OR doc_id % 4 > 1 OR doc_id % 3 = 0 AS transcribable,
              coalesce(CASE WHEN doc_id % 5 = 0 THEN doc_id % 7 END, CASE WHEN doc_id % 4 > 0 THEN doc_id % 4 - 1 END, n_chars) AS pages FROM documents""",
)
def _(t):
    n = F.col("doc_id")
    rows = t.documents.select(
        "doc_id", F.when(F.col("source") == "src1", "pdf").when(F.col("source") == "src2", "image").otherwise("text").alias("source_type"),
        F.col("n_chars").alias("pages"), F.when(n % 5 == 0, n % 7).alias("declared_pages"), F.when(n % 4 > 0, n % 4 - 1).alias("materialized_pages"),
    )
    return rows.select(
        "doc_id", inventory.transcribable(n % 3 == 0).alias("transcribable"), inventory.effective_pages().alias("pages")
    )


@query(
    "srt02_casefolded_order",
    """SELECT id, row_number() OVER (ORDER BY lower(id), id) AS position
       FROM (SELECT CASE WHEN doc_id % 2 = 0 THEN 'DOC-' ELSE 'doc-' END || CAST(doc_id AS STRING) AS id FROM documents)""",
)
def _(t):
    rows = t.documents.select(
        F.concat(F.when(F.col("doc_id") % 2 == 0, "DOC-").otherwise("doc-"), F.col("doc_id").cast("string")).alias("id")
    )
    return in_order(rows.withColumn("folded", F.lower("id")), ["folded", "id"]).drop("folded")


@query(
    "set01_records_and_errors",
    """SELECT 'page-' || CAST(page_id AS STRING) AS fixture_id, 'relaxng' AS metric, 'invalid' AS status, CAST(0 AS DOUBLE) AS value, CAST(1 AS INT) AS n, NULL AS message FROM pages
       UNION ALL SELECT object_id, 'render', 'error', NULL, 0, error FROM manifest_v WHERE error IS NOT NULL""",
)
def _(t):
    from ..plans import evaluation, structure
    from .markup import html_fragments

    failed = t.manifest_v.filter("error IS NOT NULL").select(
        F.col("object_id").alias("fixture_id"), F.lit("render").alias("stage"), F.col("error").alias("message"), F.lit(None).cast("string").alias("profile")
    )
    records = evaluation.conformance_records(structure.conformance(html_fragments(t)))
    return evaluation.with_error_records(records, failed).select("fixture_id", "metric", "status", "value", "n", "message")


@query(
    "set02_documents_of_three_sources",
    """SELECT object_id, string_agg(s, ',' ORDER BY s) AS sources
       FROM (SELECT DISTINCT object_id, 'images' AS s FROM images_v UNION ALL SELECT DISTINCT object_id, 'manifest' FROM manifest_v WHERE error IS NOT NULL UNION ALL SELECT object_id, 'objects' FROM objects_v)
       GROUP BY object_id""",
)
def _(t):
    found = selection.documents_of_sources(images=t.images_v, manifest=t.manifest_v.filter("error IS NOT NULL"), objects=t.objects_v)
    return found.select("object_id", F.array_join("sources", ",").alias("sources"))


@query(
    "set04_set05_field_sets",
    """SELECT event_id, CASE WHEN k % 3 = 0 THEN 'extra' ELSE '' END AS unexpected, k % 3 <> 0 AND k % 4 <> 0 AS same, k % 4 <> 0 AS duplicate_free
       FROM (SELECT event_id, CAST(replace(replace(props, '{"k": ', ''), '}', '') AS INT) AS k FROM events)""",
)
def _(t):
    k = F.get_json_object("props", "$.k").cast("int")
    fields = F.array_compact(
        F.array(F.lit("transcription"), F.when(k % 3 == 0, "extra"), F.when(k % 4 != 0, "notes").otherwise("transcription"))
    )
    return t.events.select(
        "event_id",
        F.array_join(selection.unexpected_fields(fields, ["transcription", "notes"]), ",").alias("unexpected"),
        selection.same_fields(fields, ["notes", "transcription"]).alias("same"),
        selection.is_duplicate_free(fields).alias("duplicate_free"),
    )


@query(
    "agg22_set06_error_summary",
    """SELECT stage, count(*) AS errors, count(DISTINCT object_id) AS failed, (SELECT count(*) FROM objects_v) AS total
       FROM (SELECT 'render' AS stage, object_id FROM manifest_v WHERE error IS NOT NULL UNION ALL SELECT 'fetch', object_id FROM manifest_v WHERE NOT starts_with(url, 'http'))
       GROUP BY GROUPING SETS ((stage), ())""",
)
def _(t):
    from ..operators import violations

    render = t.manifest_v.filter("error IS NOT NULL").select("object_id", "error", F.lit("render").alias("stage"))
    fetch = t.manifest_v.filter("NOT startswith(url, 'http')").select("object_id", F.lit("address").alias("error"), F.lit("fetch").alias("stage"))
    return violations.run_summary(t.objects_v, violations.run_errors(render, fetch))


@query(
    "prj10_catalog_projection",
    """SELECT o.object_id AS id, o.title, o.date, o.language, o.signature, 'in_review' AS status, count(*) AS page_count, bool_or(i.url IS NOT NULL) AS has_images
       FROM objects_v o JOIN pages_v p ON p.object_id = o.object_id LEFT JOIN images_v i ON i.object_id = p.object_id AND i.page = p.page GROUP BY ALL""",
)
def _(t):
    from ..plans.catalog import catalog

    pages = t.pages_v.select("object_id", "page").join(t.images_v.select("object_id", "page", F.col("url").alias("image")), ["object_id", "page"], "left")
    return catalog(t.objects_v.withColumn("status", F.lit("in_review")), pages)


@query(
    "gate22_vocabularies",
    """SELECT object_id, code FROM (
         SELECT object_id, unnest([CASE WHEN n % 4 = 1 THEN 'file.confidence' END, CASE WHEN n % 6 = 2 THEN 'file.confidence_notes' END]) AS code
         FROM (SELECT object_id, CAST(substr(object_id, 6) AS INT) AS n FROM objects_v)) WHERE code IS NOT NULL""",
)
def _(t):
    from ..operators import contract

    number = F.substring("object_id", 6, 20).cast("int")
    confidence = F.when(number % 4 == 1, F.concat(F.lit("sure "), "confidence")).otherwise(F.col("confidence"))
    value = F.concat(
        F.lit('{"object_id":"'), "object_id", F.lit('","pages":[],"confidence":"'), confidence, F.lit('","confidence_notes":'),
        F.when(number % 6 == 2, "7").otherwise('"n"'), F.lit("}"),
    )
    documents, pages = contract.parsed(t.objects_v.select("object_id", value.alias("value")))
    return contract.audit_documents(documents, pages).filter("code LIKE 'file.confidence%'").select("object_id", "code")


@query(
    "win13_paragraph_index",
    r"""SELECT object_id, page, CAST(i - 1 AS INT) AS idx, sha256(p) AS para FROM (SELECT object_id, page, unnest(ps) AS p, generate_subscripts(ps, 1) AS i
        FROM (SELECT object_id, page, regexp_split_to_array(trim(transcription, ' ' || chr(10)), '\n{2,}') AS ps FROM pages_v))""",
)
def _(t):
    return t.pages_v.select("object_id", "page", F.posexplode(text.paragraphs(F.col("transcription"))).alias("idx", "p")).select(
        "object_id", "page", "idx", F.sha2("p", 256).alias("para")
    )


@query(
    "fn_h1_duplicate_texts",
    "SELECT substr(sha256(text), 1, 12) AS text_hash, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1",
)
def _(t):
    return t.documents.groupBy(hashing.text_hash(F.col("text")).alias("text_hash")).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
