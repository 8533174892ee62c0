"""Closed vocabularies and limits of the edition data contract.

Fixed values: the words, orders and thresholds below define the results and
are stated once, here.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Review maturity, least mature first.
REVIEW_STATUSES = ["machine_unreviewed", "in_review", "human_verified", "accepted"]
INITIAL_STATUS = "machine_unreviewed"
HUMAN_DECISIONS = ["human_verified", "accepted"]
# (from, to) pairs a review may take.
REVIEW_TRANSITIONS = [
    ("machine_unreviewed", "in_review"),
    ("in_review", "machine_unreviewed"),
    ("in_review", "human_verified"),
    ("human_verified", "in_review"),
    ("human_verified", "accepted"),
    ("accepted", "in_review"),
]
ACTOR_KINDS = ["human", "agent"]

PAGE_TYPES = ["", "blank", "foreign_text", "gate_low_resolution"]
CONFIDENCE_VALUES = ["", "low", "medium", "high"]
CONFIDENCE_ORDER = ["low", "medium", "high"]  # weakest first
OVERALL_STATUSES = ["confident", "needs_review", "problematic"]
METADATA_FIELDS = [
    "title", "signature", "date", "language", "object_type", "extent", "repository",
]

VERDICT_CONFIDENCE = ["confident", "likely", "uncertain"]
VERDICT_UNREVIEWED = "unreviewed"
ISSUE_TYPES = [
    "spelling", "punctuation", "abbreviation", "marker",
    "ocr_artifact", "historical", "structural", "plausibility",
]
ISSUE_PERSPECTIVES = ["orthographic", "linguistic", "conventions", "structural"]

OBJECT_ID_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
# Names no object may carry: device names (compared before the first dot) and
# names of per-directory files.
DEVICE_NAMES = (
    ["con", "prn", "aux", "nul"]
    + [f"com{n}" for n in range(1, 10)]
    + [f"lpt{n}" for n in range(1, 10)]
)
RESERVED_NAMES = ["errors", "catalog"]

# File extension -> source type.
SOURCE_TYPES = {
    ".pdf": "pdf",
    ".jpg": "image",
    ".jpeg": "image",
    ".png": "image",
    ".tif": "image",
    ".tiff": "image",
    ".txt": "text",
    ".xml": "xml",
    ".docx": "docx",
    ".json": "transcription",
}
IMAGE_SUFFIXES = ["png", "jpg", "jpeg", "tif", "tiff"]
IMAGE_SOURCE_TYPES = ["pdf", "image", "remote_images", "extracted_image"]

# Label -> metadata field of the instruction context, in order.
CONTEXT_FIELDS = [
    ("Title", "title"),
    ("Signature / Identifier", "signature"),
    ("Date", "date"),
    ("Language", "language"),
    ("Object type", "object_type"),
    ("Extent", "extent"),
]

DEFAULT_CHUNK_SIZE = 20
OUTPUT_TOKENS_PER_PAGE = 1500
SCOPE_BLOCK_MIN = 50
MAX_STORED_ERRORS = 20
MAX_SHOWN_ERRORS = 10
MAX_TEXT_CHARS = 200_000
MAX_NOTE_CHARS = 10_000
MAX_ACTOR_CHARS = 200

SAFE_URL_PATTERN = r"^https?://"


def ordinal(value: Column, ordered: list[str]) -> Column:
    """0-based position of a value in an ordered vocabulary, null when unknown."""
    lookup = F.create_map(*chain.from_iterable((F.lit(v), F.lit(i)) for i, v in enumerate(ordered)))
    return lookup[value]


def from_ordinal(position: Column, ordered: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in ordered]), position)


def allowed_transition(source: Column, target: Column) -> Column:
    """Whether (source, target) is one of the six review transitions."""
    pair = F.concat_ws(">", F.coalesce(source, F.lit("")), F.coalesce(target, F.lit("")))
    return pair.isin([f"{a}>{b}" for a, b in REVIEW_TRANSITIONS])


def transition_table(spark: SparkSession) -> DataFrame:
    """The six transitions as a dimension; its size is fixed, so it may be broadcast."""
    return spark.createDataFrame(REVIEW_TRANSITIONS, "from_status string, status string")


def status_dimension(spark: SparkSession) -> DataFrame:
    """The three overall statuses, for zero-filled histograms."""
    return spark.createDataFrame([(s,) for s in OVERALL_STATUSES], "overall_status string")
