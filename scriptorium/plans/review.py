"""Batches of review transitions and corrections against the current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text, values
from ..operators import quality


def stated_kind() -> Column:
    """The actor's kind; a request that names none comes from a person."""
    return F.coalesce("actor_kind", F.lit("human"))


def transition_reason() -> Column:
    """Why a requested transition is refused, null when it is allowed."""
    status, kind = F.col("requested_status"), stated_kind()
    return (
        F.when(~F.coalesce(status.isin(vocab.REVIEW_STATUSES), F.lit(False)), "unknown_status")
        .when(text.is_blank(F.col("actor")), "no_actor")
        .when(~kind.isin(vocab.ACTOR_KINDS), "unknown_actor_kind")
        .when((kind == "agent") & status.isin(vocab.HUMAN_DECISIONS), "agent_decision")
        .when(F.col("current_status").isNull(), "unknown_page")
        .when(F.col("current_status") == status, "already_there")
        .when(~vocab.allowed_transition(F.col("current_status"), status), "not_allowed")
    )


def apply_transitions(requests: DataFrame, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted events, rejected requests); one request per page and batch.

    ``state`` carries (object_id, page, current_status); without it the
    requests already do. Order-dependent requests of one page go through the
    stream operator.
    """
    rows = requests if state is None else requests.join(state, ["object_id", "page"], "left")
    judged = rows.withColumn("reason", transition_reason())
    accepted = judged.filter("reason IS NULL").select(
        "object_id", "page", F.col("current_status").alias("from_status"), F.col("requested_status").alias("status"),
        text.strip(F.col("actor")).alias("actor"), stated_kind().alias("actor_kind"),
    )
    return accepted, judged.filter("reason IS NOT NULL")


def correction_reason(
    max_text: int = vocab.MAX_TEXT_CHARS, max_note: int = vocab.MAX_NOTE_CHARS, max_actor: int = vocab.MAX_ACTOR_CHARS
) -> Column:
    """Why a correction is refused, null when it is accepted; the limits are those of the contract.

    ``contract``: the corrected page or its edit would break a rule of the contract.
    """
    unchanged = F.col("new_text").eqNullSafe(F.col("current_text")) & F.col("new_notes").eqNullSafe(F.col("current_notes"))
    illegal = F.lit(False)
    for column in ("new_text", "new_notes", "actor", "reason"):
        illegal = illegal | text.has_illegal_xml(F.col(column))
    filled_blank = (F.col("page_type") == "blank") & (F.col("new_text") != "")
    return (
        F.when(text.is_blank(F.col("actor")) | ~stated_kind().isin(vocab.ACTOR_KINDS), "actor")
        .when(text.is_blank(F.col("reason")), "no_reason")
        .when((F.length("actor") > max_actor) | (F.length("reason") > max_note), "note_too_long")
        .when((F.length("new_text") > max_text) | (F.length("new_notes") > max_text), "text_too_long")
        .when(F.col("current_version").isNull(), "unknown_page")
        .when(~F.col("version").eqNullSafe(F.col("current_version")), "version_conflict")
        .when(unchanged, "no_change")
        .when(F.col("has_foreign"), "foreign_paragraphs")
        .when(F.col("new_text").isNull() | illegal | F.coalesce(filled_blank, F.lit(False)), "contract")
    )


def edit_id() -> Column:
    """A UUID (version 5 in form) made from page, version and content of a correction."""
    digest = F.sha2(F.concat_ws("\x1f", "object_id", "page", "version", "actor", "reason", "new_text", "new_notes"), 256)
    part = lambda start, n: F.substring(digest, start, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12))


def apply_corrections(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted corrections, rejected requests).

    A request names new text and new notes (``new_notes`` absent: the notes stay) and may carry ``timestamp`` (absent: now) and the page's
    ``page_type``. Of several requests against one version of a page the earliest is accepted (ties: smaller edit id) and the others are
    version conflicts; equal requests count once. An accepted correction reopens the page when it is not in review and carries texts
    and notes before and after, its time, and an edit id made from page, version and content.
    """
    have = set(requests.columns)
    if "new_notes" not in have:
        requests = requests.withColumn("current_notes", F.lit("")).withColumn("new_notes", F.lit(""))
    if "timestamp" not in have:
        requests = requests.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    if "page_type" not in have:
        requests = requests.withColumn("page_type", F.lit(""))
    judged = requests.withColumn("code", correction_reason()).withColumn("edit_id", edit_id())
    fit = judged.filter("code IS NULL").dropDuplicates(["object_id", "page", "version", "edit_id", "timestamp"])
    place = F.struct(F.coalesce(values.aware_timestamp(F.col("timestamp")), F.lit("9999-12-31").cast("timestamp")).alias("at"), "edit_id", "timestamp")
    first = fit.groupBy("object_id", "page", "version").agg(F.min(place).alias("first"))
    # a page has one current version, so this is one row per page
    chosen = fit.join(first, ["object_id", "page", "version"]).withColumn(
        "code", F.when((F.col("first.edit_id") != F.col("edit_id")) | (F.col("first.timestamp") != F.col("timestamp")), "version_conflict")
    )
    accepted = chosen.filter("code IS NULL").select(
        "object_id", "page", "edit_id", F.col("timestamp").alias("event_time"), text.strip(F.col("actor")).alias("actor"),
        stated_kind().alias("actor_kind"), F.col("reason").alias("note"),
        F.col("current_text").alias("before_text"), F.col("new_text").alias("after_text"),
        F.col("current_notes").alias("before_notes"), F.col("new_notes").alias("after_notes"),
        (F.col("current_status") != "in_review").alias("reopened"),
        F.lit("in_review").alias("review_status"), F.lit(True).alias("needs_review"),
    )
    late = chosen.filter("code IS NOT NULL").drop("first").select(*judged.columns)
    return accepted, judged.filter("code IS NOT NULL").unionByName(late)


def corrected_pages(pages: DataFrame, accepted: DataFrame) -> DataFrame:
    """``pages`` (object_id, page, transcription, notes, review_status and others) as the accepted corrections leave them."""
    new = accepted.select("object_id", "page", F.col("after_text").alias("_text"), F.col("after_notes").alias("_notes"), F.col("review_status").alias("_status"))
    joined = pages.join(new, ["object_id", "page"], "left")
    changed = F.col("_text").isNotNull()
    pick = lambda new, old: F.when(changed, F.col(new)).otherwise(F.col(old))
    return joined.withColumns(
        {"transcription": pick("_text", "transcription"), "notes": pick("_notes", "notes"), "review_status": pick("_status", "review_status")}
    ).drop("_text", "_notes", "_status")


def corrected_signals(pages: DataFrame, accepted: DataFrame) -> DataFrame:
    """Quality signals of the touched objects, computed anew from all their pages; they need review."""
    touched = accepted.select("object_id").distinct()
    after = corrected_pages(pages.join(touched, "object_id", "left_semi"), accepted)
    return quality.quality_signals(quality.object_measures(after, rules=[])).withColumn("needs_review", F.lit(True))


def edit_events(accepted: DataFrame, recorded: DataFrame | None = None) -> DataFrame:
    """Accepted corrections as edit events; ``seq`` goes on behind what is ``recorded`` (object_id, page, seq)."""
    events = accepted.select(
        "object_id", "page", "edit_id", "event_time", "actor", "actor_kind", "note", "before_text", "before_notes", "after_text", "after_notes"
    )
    if recorded is None:
        return events.withColumn("seq", F.lit(0).cast("bigint"))
    last = recorded.groupBy("object_id", "page").agg(F.max("seq").alias("_last"))
    return events.join(last, ["object_id", "page"], "left").withColumn("seq", F.coalesce(F.col("_last") + 1, F.lit(0)).cast("bigint")).drop("_last")
