"""Text quality: page measures, rules, signals, status."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..plans import assessment
from .registry import query

# Building blocks of the SQL checks --------------------------------------------------

MEASURES = r"""
    SELECT object_id, page,
           CAST(length(transcription) AS INT) AS char_count,
           CAST(length(regexp_replace(transcription, '^\s+|\s+$', '', 'g')) AS INT) AS stripped_chars,
           CAST(len(regexp_extract_all(transcription, '\S+')) AS INT) AS word_count,
           CAST(length(transcription) - length(replace(transcription, chr(10), '')) + CASE WHEN transcription <> '' THEN 1 ELSE 0 END AS INT) AS line_count,
           CASE WHEN page_type <> '' THEN page_type
                WHEN regexp_matches(transcription, '\S') THEN 'content' ELSE 'undeclared_empty' END AS derived_type,
           (page_type = 'gate_low_resolution' OR (NOT regexp_matches(transcription, '\S') AND page_type <> 'blank')) AS unverified,
           CAST(len(regexp_extract_all(transcription, '\[\?\]')) AS INT) AS uncertain_markers,
           CAST(len(regexp_extract_all(transcription, '  +')) AS INT) AS double_spaces,
           regexp_replace(transcription, '\[\?\]|\[\.\.\.(?:\s*~\s*\d+\s*chars?)?\]|~~(.*?)~~|\{(.*?)\}', '', 'g') AS stripped
    FROM pages_v"""



def round_one_sql(value: str) -> str:
    """One decimal of a non-negative double: nearest tenth of the binary value, half to even on exact ties."""
    x = f"CAST({value} AS DOUBLE)"
    n = f"floor({x} * 10)"
    side = f"({x} * 4 - ({n} * 2 + 1 - {x} * 16))"
    return f"(({n} + CASE WHEN {side} > 0 OR ({side} = 0 AND {n} % 2 = 1) THEN 1 ELSE 0 END) / CAST(10 AS DOUBLE))"


# Look-around-free form of the artefact rule: every dot and dash is doubled so
# that each symbol run keeps its own neighbour on both sides.
ARTIFACTS = r"""CAST(len([run FOR run IN
    regexp_extract_all(regexp_replace({text}, '([.—–-])', '\1\1', 'g'), '[.—–-]?[^\p{{L}}\p{{N}}_\s.—–-]+[.—–-]?')
    IF regexp_full_match(run, '(?:[.—–-][^\p{{L}}\p{{N}}_\s.—–-])?[^\p{{L}}\p{{N}}_\s.—–-]{{3,}}')
        OR regexp_full_match(run, '(?:[.—–-][^\p{{L}}\p{{N}}_\s.—–-])?[^\p{{L}}\p{{N}}_\s.—–-]{{3,}}[^\p{{L}}\p{{N}}_\s.—–)-]\)*[.—–-]')
]) AS INT)"""

JOINED = r"""
    SELECT object_id, len(regexp_extract_all(joined, '\[\.\.\.(?:\s*~\s*\d+\s*chars?)?\]')) AS illegible_markers
    FROM (SELECT object_id, string_agg(transcription, chr(10) || chr(10) ORDER BY page) AS joined FROM pages_v GROUP BY object_id)"""

TOTALS = f"""
    SELECT m.object_id, count(*) AS page_count,
           CAST(sum(stripped_chars) AS BIGINT) AS total_chars,
           CAST(sum(char_count) AS BIGINT) AS total_characters,
           count(*) FILTER (derived_type = 'blank') AS blank_pages,
           count(*) FILTER (derived_type = 'undeclared_empty') AS undeclared_empty_pages,
           count(*) FILTER (derived_type = 'gate_low_resolution') AS gate_pages,
           count(*) FILTER (derived_type = 'foreign_text') AS foreign_pages,
           count(*) FILTER (unverified) AS unverified_pages,
           CAST(sum(uncertain_markers) AS BIGINT) AS uncertain_markers,
           max(j.illegible_markers) AS illegible_markers,
           CAST(sum({ARTIFACTS.format(text="stripped")}) AS BIGINT) AS ocr_artifacts,
           CAST(sum(double_spaces) AS BIGINT) AS double_spaces
    FROM measures m JOIN joined j ON j.object_id = m.object_id GROUP BY m.object_id"""

SIGNALS = f"""
    SELECT *, {round_one_sql("total_chars / page_count")} AS chars_per_page,
           page_count - blank_pages - undeclared_empty_pages - gate_pages - foreign_pages AS content_pages,
           (undeclared_empty_pages > 0 OR blank_pages = page_count) AS needs_review
    FROM totals"""

FINDINGS = """
    SELECT object_id, 'uncertain_markers' AS rule, uncertain_markers AS count,
           CASE WHEN uncertain_markers > 10 THEN 'error' WHEN uncertain_markers > 3 THEN 'warning' ELSE 'info' END AS severity FROM totals
    UNION ALL SELECT object_id, 'illegible_markers', illegible_markers,
           CASE WHEN illegible_markers > 5 THEN 'error' WHEN illegible_markers > 1 THEN 'warning' ELSE 'info' END FROM totals
    UNION ALL SELECT object_id, 'ocr_artifacts', ocr_artifacts,
           CASE WHEN ocr_artifacts > 3 THEN 'error' WHEN ocr_artifacts > 0 THEN 'warning' ELSE 'info' END FROM totals
    UNION ALL SELECT object_id, 'double_spaces', double_spaces,
           CASE WHEN double_spaces > 10 THEN 'warning' ELSE 'info' END FROM totals"""

ASSESSED = """
    SELECT s.*, o.confidence, f.errors, f.warnings,
           CASE WHEN f.errors > 2 THEN 'problematic'
                WHEN f.warnings > 0 OR s.needs_review OR s.unverified_pages > 0 OR o.confidence = 'low' THEN 'needs_review'
                ELSE 'confident' END AS overall_status
    FROM signals s JOIN objects_v o ON o.object_id = s.object_id
    JOIN (SELECT object_id, CAST(count(*) FILTER (severity = 'error') AS INT) AS errors,
                 CAST(count(*) FILTER (severity = 'warning') AS INT) AS warnings
          FROM findings GROUP BY object_id) f ON f.object_id = s.object_id"""

BLOCKS = {
    "measures": MEASURES, "joined": JOINED, "totals": TOTALS,
    "signals": SIGNALS, "findings": FINDINGS, "assessed": ASSESSED,
}


def blocks(last: str) -> dict[str, str]:
    """The building blocks up to and including one of them."""
    names = list(BLOCKS)
    return {name: BLOCKS[name] for name in names[: names.index(last) + 1]}


# Queries -----------------------------------------------------------------------------


@query(
    "agg01_page_stats",
    "SELECT object_id, page, char_count, word_count, line_count FROM measures",
    {"measures": MEASURES},
)
def _(t):
    return quality.page_stats(t.pages_v)


@query(
    "agg02_quality_signals",
    """SELECT object_id, page_count, total_chars, chars_per_page, blank_pages, undeclared_empty_pages,
              gate_pages, foreign_pages, content_pages, needs_review FROM signals""",
    blocks("signals"),
)
def _(t):
    return quality.quality_signals(quality.object_measures(t.pages_v)).select(
        "object_id", "page_count", "total_chars", "chars_per_page", "blank_pages",
        "undeclared_empty_pages", "gate_pages", "foreign_pages", "content_pages", "needs_review",
    )


@query("agg02_derived_page_types", "SELECT object_id, page, derived_type FROM measures", {"measures": MEASURES})
def _(t):
    return t.pages_v.select(
        "object_id", "page",
        quality.derived_page_type(F.col("transcription"), F.col("page_type")).alias("derived_type"),
    )


@query("agg03_rule_findings", "SELECT object_id, rule, count, severity FROM findings", blocks("findings"))
def _(t):
    return quality.rule_findings(quality.object_measures(t.pages_v))


@query(
    "agg04_severity_histogram",
    "SELECT rule, severity, count(*) AS objects, CAST(sum(count) AS BIGINT) AS hits FROM findings GROUP BY rule, severity",
    blocks("findings"),
)
def _(t):
    return (
        quality.rule_findings(quality.object_measures(t.pages_v))
        .groupBy("rule", "severity")
        .agg(F.count(F.lit(1)).alias("objects"), F.sum("count").alias("hits"))
    )


@query(
    "agg05_overall_status",
    "SELECT object_id, errors, warnings, needs_review, unverified_pages, confidence, overall_status FROM assessed",
    blocks("assessed"),
)
def _(t):
    return assessment.assess(t.pages_v, t.objects_v).select(
        "object_id", "errors", "warnings", "needs_review", "unverified_pages", "confidence", "overall_status"
    )


@query(
    "agg06_unverified_pages",
    "SELECT object_id, count(*) FILTER (unverified) AS unverified_pages FROM measures GROUP BY object_id",
    {"measures": MEASURES},
)
def _(t):
    return t.pages_v.groupBy("object_id").agg(
        F.count_if(quality.is_unverified(F.col("transcription"), F.col("page_type"))).alias("unverified_pages")
    )


@query(
    "agg08_status_histogram",
    """SELECT d.overall_status, count(a.object_id) AS objects
       FROM (VALUES ('confident'), ('needs_review'), ('problematic')) d(overall_status)
       LEFT JOIN assessed a ON a.overall_status = d.overall_status GROUP BY d.overall_status""",
    blocks("assessed"),
)
def _(t):
    return assessment.status_overview(t.pages_v, t.objects_v)


@query("job07_text_quality_assessment", "SELECT * FROM assessed", blocks("assessed"))
def _(t):
    return assessment.assess(t.pages_v, t.objects_v)


@query(
    "job07_document_assessment",
    f"""SELECT object_id, hits,
               CASE WHEN hits > 3 THEN 'error' WHEN hits > 0 THEN 'warning' ELSE 'info' END AS severity
        FROM (SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id,
                     {ARTIFACTS.format(text="stripped")} AS hits
              FROM (SELECT doc_id, regexp_replace(text, '\\[\\?\\]|\\[\\.\\.\\.(?:\\s*~\\s*\\d+\\s*chars?)?\\]|~~(.*?)~~|\\{{(.*?)\\}}', '', 'g') AS stripped
                    FROM documents))""",
)
def _(t):
    rule = next(r for r in quality.RULES if r.name == "ocr_artifacts")
    hits = rule.count(F.col("text"))
    return t.documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("object_id"), hits.alias("hits")
    ).withColumn("severity", quality.severity(rule, F.col("hits")))


@query(
    "job07_agg05_with_verdicts",
    """SELECT a.object_id, v.unreviewed_pages, CASE WHEN v.unsure OR a.errors > 2 THEN 'problematic'
              WHEN v.likely OR v.unreviewed_pages > 0 OR a.warnings > 0 OR a.needs_review OR a.unverified_pages > 0 OR a.confidence = 'low' THEN 'needs_review'
              ELSE 'confident' END AS overall_status
       FROM assessed a LEFT JOIN (SELECT object_id, bool_or(k = 0) AS unsure, bool_or(k = 1) AS likely, count(*) FILTER (k = 2) AS unreviewed_pages
         FROM (SELECT object_id, (CAST(substr(object_id, 6) AS INT) * 3 + page) % 17 AS k FROM pages_v WHERE CAST(substr(object_id, 6) AS INT) % 5 <> 0) GROUP BY object_id) v ON v.object_id = a.object_id""",
    blocks("assessed"),
)
def _(t):
    number = F.substring("object_id", 6, 20).cast("int")
    k = (number * 3 + F.col("page")) % 17
    confidence = F.when(k == 0, "uncertain").when(k == 1, "likely").when(k == 2, "unreviewed").otherwise("confident")
    verdicts = t.pages_v.filter(number % 5 != 0).select("object_id", "page", confidence.alias("confidence"))
    return assessment.assess(t.pages_v, t.objects_v, verdicts).select("object_id", "unreviewed_pages", "overall_status")
