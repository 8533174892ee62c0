"""Review log and edit chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import hashing, values
from ..operators import ordered, reviews
from .registry import query

HISTORY = """
    SELECT *, coalesce(last_value(CASE WHEN status IN ('machine_unreviewed', 'in_review', 'human_verified', 'accepted') THEN status END IGNORE NULLS)
                OVER (PARTITION BY object_id, page ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'machine_unreviewed') AS previous_status,
           last_value(CASE WHEN event_time LIKE '%+00:00' THEN event_time END IGNORE NULLS)
                OVER (PARTITION BY object_id, page ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_time
    FROM review_v"""

ALLOWED = """(previous_status || '>' || status) IN ('machine_unreviewed>in_review', 'in_review>machine_unreviewed', 'in_review>human_verified',
        'human_verified>in_review', 'human_verified>accepted', 'accepted>in_review')"""

REVIEW_AUDIT = f"""
    SELECT object_id, page, seq, code FROM (
      SELECT object_id, page, seq, unnest([
        CASE WHEN status = 'archived' THEN 'review_unknown_status' END,
        CASE WHEN from_status <> previous_status THEN 'review_discontinuous' END,
        CASE WHEN NOT {ALLOWED} THEN 'review_not_allowed' END,
        CASE WHEN trim(actor) = '' THEN 'review_no_actor' END,
        CASE WHEN actor_kind = 'robot' THEN 'review_unknown_actor_kind' END,
        CASE WHEN actor_kind = 'agent' AND status IN ('human_verified', 'accepted') THEN 'review_agent_decision' END,
        CASE WHEN page_state_hash = 'abc' AND status IN ('human_verified', 'accepted') THEN 'review_no_state_hash' END,
        CASE WHEN event_time NOT LIKE '%+00:00' THEN 'review_no_aware_time' END,
        CASE WHEN event_time LIKE '%+00:00' AND event_time < previous_time THEN 'review_out_of_order' END]) AS code
      FROM history) WHERE code IS NOT NULL"""


@query(
    "win01_previous_status_continuity",
    "SELECT object_id, page, seq, previous_status, from_status = previous_status AS continues FROM history",
    {"history": HISTORY},
)
def _(t):
    return reviews.with_history(t.review_v).select(
        "object_id", "page", "seq", "previous_status",
        (F.col("from_status") == F.col("previous_status")).alias("continues"),
    )


@query(
    "win02_chronology",
    """SELECT object_id, page, seq FROM history WHERE event_time LIKE '%+00:00' AND event_time < previous_time""",
    {"history": HISTORY},
)
def _(t):
    return reviews.with_history(t.review_v).filter("instant < previous_instant").select("object_id", "page", "seq")


@query(
    "win03_latest_review",
    """SELECT object_id, page, status AS latest_status, n AS events FROM (
         SELECT object_id, page, status, row_number() OVER (PARTITION BY object_id, page ORDER BY seq DESC) AS rn,
                count(*) OVER (PARTITION BY object_id, page) AS n FROM review_v) WHERE rn = 1""",
)
def _(t):
    return reviews.latest_review(t.review_v).select("object_id", "page", "latest_status", "events")


@query("gate09_review_history", "SELECT * FROM audited", {"history": HISTORY, "audited": REVIEW_AUDIT})
def _(t):
    return reviews.audit_reviews(t.review_v).select("object_id", "page", "seq", "code")


# Declared page states: the last event's status, except on every third page of a user.
STATES = """
    SELECT object_id, page,
           CASE WHEN n % 4 = 0 THEN 'accepted' WHEN n % 9 = 1 THEN NULL ELSE status END AS review_status,
           CASE WHEN n % 2 = 0 THEN h ELSE 'other' END AS state_hash
    FROM (SELECT object_id, page, arg_max(status, seq) AS status, arg_max(page_state_hash, seq) AS h, count(*) AS n
          FROM review_v GROUP BY object_id, page)
    UNION ALL SELECT 'user-none-' || CAST(conv_id AS STRING), 1, CASE WHEN conv_id % 2 = 0 THEN 'in_review' ELSE 'machine_unreviewed' END, 'x'
    FROM conversations WHERE turn = 0"""


def states(t):
    n, status = F.col("n"), F.col("status")
    logged = (
        t.review_v.groupBy("object_id", "page")
        .agg(F.max_by("status", "seq").alias("status"), F.max_by("page_state_hash", "seq").alias("h"), F.count(F.lit(1)).alias("n"))
        .select(
            "object_id", "page",
            F.when(n % 4 == 0, "accepted").when(n % 9 == 1, None).otherwise(status).alias("review_status"),
            F.when(n % 2 == 0, F.col("h")).otherwise("other").alias("state_hash"),
        )
    )
    silent = t.conversations.filter("turn = 0").select(
        F.concat(F.lit("user-none-"), F.col("conv_id").cast("string")).alias("object_id"),
        F.lit(1).alias("page"),
        F.when(F.col("conv_id") % 2 == 0, "in_review").otherwise("machine_unreviewed").alias("review_status"),
        F.lit("x").alias("state_hash"),
    )
    return logged.unionByName(silent)


@query(
    "gate10_gate11_review_state",
    """SELECT object_id, page, code FROM (
         SELECT s.object_id, s.page, unnest([
           CASE WHEN review_status IS NULL THEN 'review_missing' END,
           CASE WHEN review_status = 'archived' THEN 'review_status_unknown' END,
           CASE WHEN review_status IN ('in_review', 'human_verified', 'accepted') AND l.object_id IS NULL THEN 'review_without_history' END,
           CASE WHEN l.object_id IS NOT NULL AND review_status IS DISTINCT FROM l.status THEN 'review_status_stale' END,
           CASE WHEN l.object_id IS NOT NULL AND review_status IN ('human_verified', 'accepted') AND l.h IS DISTINCT FROM s.state_hash THEN 'review_decision_stale' END]) AS code
         FROM states s LEFT JOIN (SELECT object_id, page, arg_max(status, seq) AS status, arg_max(page_state_hash, seq) AS h
                                  FROM review_v GROUP BY object_id, page) l
           ON l.object_id = s.object_id AND l.page = s.page) WHERE code IS NOT NULL""",
    {"states": STATES},
)
def _(t):
    return reviews.audit_review_state(states(t), t.review_v).select("object_id", "page", "code")


@query(
    "agg10_least_mature_status",
    """SELECT object_id, ['machine_unreviewed', 'in_review', 'human_verified', 'accepted'][min(coalesce(
           list_position(['machine_unreviewed', 'in_review', 'human_verified', 'accepted'], review_status), 1))] AS document_status
       FROM states GROUP BY object_id""",
    {"states": STATES},
)
def _(t):
    return reviews.least_mature_status(states(t))


@query(
    "agg21_all_pages_accepted",
    "SELECT object_id, bool_and(coalesce(review_status = 'accepted', FALSE)) AS all_accepted FROM states GROUP BY object_id",
    {"states": STATES},
)
def _(t):
    return reviews.all_accepted(states(t))


@query(
    "win11_actor_numbering",
    """SELECT object_id, actor, row_number() OVER (PARTITION BY object_id ORDER BY first_time, first_id) AS actor_number
       FROM (SELECT object_id, actor, min(event_time) AS first_time, arg_min(seq, (event_time, seq)) AS first_id
             FROM review_v GROUP BY object_id, actor)""",
)
def _(t):
    return reviews.number_actors(t.review_v, ["actor"], "event_time", "seq").select(
        "object_id", "actor", "actor_number"
    )


@query(
    "win08_attempt_numbering",
    """SELECT seq, row_number() OVER (PARTITION BY object_id, page ORDER BY seq) AS attempt FROM review_v""",
)
def _(t):
    return ordered.numbered(t.review_v, ["object_id", "page"], ["seq"], "attempt").select("seq", "attempt")


EDIT_HISTORY = """
    SELECT *, lag(after_text || chr(31) || after_notes) OVER (PARTITION BY object_id, page ORDER BY seq) AS previous_after,
           last_value(CASE WHEN length(event_time) > 19 THEN CAST(event_time AS TIMESTAMPTZ) END IGNORE NULLS)
             OVER (PARTITION BY object_id, page ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_time,
           row_number() OVER (PARTITION BY object_id, page, edit_id ORDER BY seq) AS nth_use
    FROM edits_v"""


@query(
    "win04_win05_win06_edit_chain",
    """SELECT object_id, page, seq, previous_after IS NULL OR previous_after = before_text || chr(31) || before_notes AS continues,
              coalesce(length(event_time) > 19 AND CAST(event_time AS TIMESTAMPTZ) < previous_time, FALSE) AS out_of_order
       FROM edit_history""",
    {"edit_history": EDIT_HISTORY},
)
def _(t):
    return reviews.with_edit_history(t.edits_v).select(
        "object_id", "page", "seq",
        (F.col("previous_after").isNull() | F.col("before").eqNullSafe(F.col("previous_after"))).alias("continues"),
        F.coalesce(F.col("instant") < F.col("previous_instant"), F.lit(False)).alias("out_of_order"),
    )


@query(
    "gate12_edit_chain",
    """SELECT object_id, page, seq, code FROM (
         SELECT h.object_id, h.page, seq, unnest([
           CASE WHEN edit_id = 'no-uuid' OR length(event_time) = 19 THEN 'edit_id_or_time' END,
           CASE WHEN length(event_time) > 19 AND CAST(event_time AS TIMESTAMPTZ) < previous_time THEN 'edit_out_of_order' END,
           CASE WHEN note = '' THEN 'edit_no_note' END,
           CASE WHEN previous_after <> before_text || chr(31) || before_notes THEN 'edit_discontinuous' END,
           CASE WHEN before_text = after_text AND before_notes = after_notes THEN 'edit_without_change' END,
           CASE WHEN nth_use > 1 THEN 'edit_duplicate_id' END,
           CASE WHEN seq = last_seq AND (after_text <> p.transcription OR after_notes <> p.notes) THEN 'edit_chain_end' END]) AS code
         FROM (SELECT *, max(seq) OVER (PARTITION BY object_id, page) AS last_seq FROM edit_history) h
         JOIN pages_v p ON p.object_id = h.object_id AND p.page = h.page) WHERE code IS NOT NULL""",
    {"edit_history": EDIT_HISTORY},
)
def _(t):
    return reviews.audit_edits(t.edits_v, t.pages_v).select("object_id", "page", "seq", "code")


@query("agg19_corrections_per_object", "SELECT object_id, count(*) AS corrections FROM edits_v GROUP BY object_id")
def _(t):
    return reviews.with_corrections(t.edits_v)


@query(
    "join18_allowed_transitions",
    """SELECT r.seq FROM review_v r JOIN (VALUES ('machine_unreviewed', 'in_review'), ('in_review', 'machine_unreviewed'),
         ('in_review', 'human_verified'), ('human_verified', 'in_review'), ('human_verified', 'accepted'), ('accepted', 'in_review')) d(a, b)
       ON r.from_status = d.a AND r.status = d.b""",
)
def _(t):
    # six fixed rows, so the broadcast never grows
    return t.review_v.join(
        F.broadcast(vocab.transition_table(t.spark)), ["from_status", "status"], "left_semi"
    ).select("seq")


@query(
    "join17_objects_with_history",
    """SELECT object_id FROM objects_v o WHERE EXISTS (SELECT 1 FROM edits_v e WHERE e.object_id = o.object_id)""",
)
def _(t):
    from ..operators import incremental

    previous = t.objects_v.select("object_id", F.lit(True).alias("valid"))
    return incremental.refuse_forced(t.objects_v.select("object_id"), t.edits_v, previous).select("object_id")


@query(
    "srt07_events_by_time",
    """SELECT object_id, page, seq, event_time, row_number() OVER (ORDER BY event_time, seq, object_id, page) AS position
       FROM review_v WHERE event_time LIKE '%+00:00'""",
)
def _(t):
    timed = t.review_v.withColumn("instant", values.aware_timestamp(F.col("event_time"))).filter("instant IS NOT NULL")
    return ordered.in_order(timed, ["instant", "seq", "object_id", "page"]).select("object_id", "page", "seq", "event_time", "position")


@query(
    "fp01_page_state_hash",
    """SELECT object_id, page, sha256(CAST(page AS STRING) || chr(31) || transcription || chr(31) || notes || chr(31) || page_type || chr(31)
              || coalesce(CAST(foreign_index AS STRING), '')) AS state_hash FROM pages_v""",
)
def _(t):
    foreign = F.when(F.col("foreign_index").isNotNull(), F.array("foreign_index"))
    return t.pages_v.select(
        "object_id", "page",
        hashing.page_state_hash(
            F.col("page"), F.col("transcription"), F.col("notes"), F.col("page_type"), foreign
        ).alias("state_hash"),
    )
