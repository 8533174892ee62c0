"""Dates, rates, JSON access and map-or-list helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?"
    r"(Z|[+-]\d{2}(:?\d{2}(:\d{2})?)?)$"
)


def aware_timestamp(col: Column) -> Column:
    """Instant of an ISO text that carries a UTC offset, else null."""
    full = F.regexp_replace(col, ",", ".")
    for pattern, replacement in (
        (r"([T ]\d{2}:\d{2})(?=[Z+-])", "$1:00"),  # no seconds
        (r"([+-]\d{2})(\d{2})$", "$1:$2"),  # offset without colon
        (r"([+-]\d{2})$", "$1:00"),  # offset of hours only
    ):
        full = F.regexp_replace(full, pattern, replacement)
    return F.when(F.coalesce(col.rlike(_ISO), F.lit(False)), F.try_to_timestamp(full))


def is_aware_timestamp(col: Column) -> Column:
    return aware_timestamp(col).isNotNull()


def date_when(col: Column) -> Column:
    """``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD`` when it is a real date, else empty."""
    year = F.substring(col, 1, 4)
    month = F.substring(col, 6, 2)
    valid = (
        F.when(col.rlike(r"\A[0-9]{4}\z"), year != "0000")
        .when(
            col.rlike(r"\A[0-9]{4}-[0-9]{2}\z"),
            (year != "0000") & (month >= "01") & (month <= "12"),
        )
        .when(
            col.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"),
            (year != "0000") & col.try_cast("date").isNotNull(),
        )
        .otherwise(F.lit(False))
    )
    return F.when(valid, col).otherwise("")


def safe_rate(distance: Column, reference: Column, hypothesis: Column) -> Column:
    """distance/reference with 0/0 = 0 and x/0 = 1."""
    return (
        F.when((reference == 0) & (hypothesis == 0), F.lit(0.0))
        .when(reference == 0, F.lit(1.0))
        .otherwise(distance.cast("double") / reference.cast("double"))
    )


def round_one(col: Column) -> Column:
    """One decimal, to the nearest tenth of the binary value and half to even on exact ties.

    The side of a tie on which a double lies is ``4x - (k - 16x)`` with ``k`` twentieths: all three terms are exact near the tie,
    which decimal text forms of a double are not (0.15 lies below its tie, 0.25 on it).
    """
    value = col.cast("double")
    size = F.abs(value)
    tenths = F.floor(size * 10)
    side = size * 4 - (tenths * 2 + 1 - size * 16)
    up = (side > 0) | ((side == 0) & (tenths % 2 == 1))
    return F.signum(value) * (tenths + up.cast("int")) / F.lit(10.0)


def parse_json_or_null(col: Column) -> Column:
    """VARIANT of a JSON text, null when it is not JSON."""
    return F.try_parse_json(col)


def json_kind(value: Column) -> Column:
    """JSON type of a VARIANT: OBJECT, ARRAY, STRING, NUMBER, BOOLEAN, NULL; SQL null when absent."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "OBJECT")
        .when(kind.startswith("ARRAY"), "ARRAY")
        .when(kind == "STRING", "STRING")
        .when(kind == "BOOLEAN", "BOOLEAN")
        .when(kind == "VOID", "NULL")
        .when(kind == "BIGINT", "INTEGER")
        .otherwise(F.when(kind.isNotNull(), "NUMBER"))
    )


def json_field(value: Column, path: str, kind: str = "variant") -> Column:
    """Field of a VARIANT, null when absent or of another type."""
    return F.try_variant_get(value, path, kind)


def json_text(value: Column, path: str, default: str = "") -> Column:
    """A string field, or the default when it is absent or no string."""
    field = F.try_variant_get(value, path, "variant")
    return F.when(json_kind(field) == "STRING", F.try_variant_get(value, path, "string")).otherwise(default)


def url_entries(value: Column) -> Column:
    """Map-or-list of URLs (VARIANT) as array<struct<page int, url string>>.

    A map is keyed by page number texts, a list is in page order; entries that
    are no web address or no page number are dropped.
    """
    as_map = F.try_variant_get(value, "$", "map<string,string>")
    as_list = F.try_variant_get(value, "$", "array<string>")
    from_map = F.transform(
        F.filter(F.map_entries(as_map), lambda e: e["key"].rlike(r"^[0-9]+$")),
        lambda e: F.struct(e["key"].cast("int").alias("page"), e["value"].alias("url")),
    )
    from_list = F.transform(
        as_list, lambda u, i: F.struct((i + 1).cast("int").alias("page"), u.alias("url"))
    )
    kind = json_kind(value)
    entries = F.when(kind == "OBJECT", from_map).when(kind == "ARRAY", from_list)
    empty = F.array().cast("array<struct<page:int,url:string>>")
    return F.array_sort(
        F.coalesce(
            F.filter(entries, lambda e: e["url"].startswith("http") & e["page"].isNotNull()), empty
        )
    )


def zip_checked(left: Column, right: Column) -> Column:
    """Positional zip that is null when the lengths differ."""
    return F.when(F.size(left) == F.size(right), F.arrays_zip(left, right))


def element_or_null(values: Column, position: Column) -> Column:
    """1-based element, null outside the array."""
    return F.when((position >= 1) & (position <= F.size(values)), F.get(values, position - 1))
