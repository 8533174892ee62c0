"""Content fingerprints.

Row fingerprints are SHA-256 over a canonical text of the row. Fingerprints of
a whole object are mergeable: every child row contributes four 60-bit limbs of
its own SHA-256, the limbs are summed, and the sums are hashed once more. The
child hash contains its position, so order counts, yet the aggregate needs no
sorting, no list of children and combines on the map side. An object with a
third of all pages costs as much memory as one with a single page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\u001f"  # cannot occur in contract-valid text
NULL = "\u001e"


def text_hash(col: Column, length: int | None = 12) -> Column:
    digest = F.sha2(col, 256)
    return digest if length is None else F.substring(digest, 1, length)


def fields_hash(*cols: Column, length: int | None = None) -> Column:
    """SHA-256 over fields in a fixed order; null differs from empty."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL)) for c in cols]
    return text_hash(F.concat_ws(UNIT, *parts), length)


def struct_hash(value: Column, length: int | None = 12) -> Column:
    """Hash of a nested value through its JSON text; field order is the schema's."""
    return text_hash(F.to_json(value, {"ignoreNullFields": "false"}), length)


def page_state_hash(
    page: Column, transcription: Column, notes: Column, page_type: Column, foreign: Column
) -> Column:
    """Binds a human decision to everything of a page that reaches the markup."""
    return fields_hash(
        page,
        transcription,
        F.coalesce(notes, F.lit("")),
        F.coalesce(page_type, F.lit("")),
        F.array_join(F.coalesce(foreign, F.array().cast("array<int>")), ","),
    )


def set_digest(child_hash: Column, length: int | None = 12) -> Column:
    """Mergeable digest over the 64-hex hashes of all child rows (aggregate)."""
    limbs = [
        F.sum(F.conv(F.substring(child_hash, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)"))
        for i in range(4)
    ]
    sums = [F.coalesce(limb, F.lit(0)).cast("decimal(38,0)").cast("string") for limb in limbs]
    return text_hash(F.concat_ws(UNIT, F.count(child_hash).cast("string"), *sums), length)


def array_digest(child_hashes: Column, length: int | None = 12) -> Column:
    """The set digest of hashes that already sit in one array."""

    def limb(i: int) -> Column:
        zero = F.lit(0).cast("decimal(38,0)")
        return F.aggregate(
            child_hashes,
            zero,
            lambda total, h: (
                total + F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")
            ).cast("decimal(38,0)"),
        )

    sums = [limb(i).cast("string") for i in range(4)]
    return text_hash(F.concat_ws(UNIT, F.size(child_hashes).cast("string"), *sums), length)


def image_hash(page: Column, filename: Column, sha256: Column) -> Column:
    """Hash of one facsimile of an ordered image state."""
    return fields_hash(page, filename, sha256)
