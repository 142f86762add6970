"""Readable record keys and content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and the stand-in for NULL inside keys and hashes.
NULL_MARK = "<null>"
KEY_SEPARATOR = "|"
HASH_SEPARATOR = "||"

# Columns that checks and deduplication attach to rows on their way; no data.
ISSUES = "__issues"
HASH = "__row_hash"
CONTENT = "__row_hash_start"
COPIES = "__copies"
CONFLICT = "__conflict"
PLACE = "__place"
HELPERS = (ISSUES, HASH, CONTENT, COPIES, CONFLICT, PLACE)

# Lineage columns say where a row came from, not what it holds.
LINEAGE_COLUMNS = ("source_file_path", "run_id", "processed_at")


def _as_column(part: str | Column) -> Column:
    return F.col(part) if isinstance(part, str) else part


def record_key(parts: Sequence[str | Column]) -> Column:
    """Key parts joined by ``|``; NULL parts read ``<null>``; no parts give NULL."""
    if not parts:
        return F.lit(None).cast("string")
    return F.concat_ws(
        KEY_SEPARATOR,
        *[F.coalesce(_as_column(p).cast("string"), F.lit(NULL_MARK)) for p in parts],
    )


def content_columns(columns: Sequence[str]) -> list[str]:
    """Columns that hold data: all but lineage and the named helper columns."""
    return sorted(c for c in columns if c not in (*LINEAGE_COLUMNS, *HELPERS))


def row_hash(columns: Sequence[str], strict: bool = False) -> Column:
    """SHA-256 over the content columns in name order, as a hex string.

    The default joins the values by ``||``, so a value that itself holds the
    separator can collide. ``strict`` hashes the JSON of the row instead.
    """
    names = content_columns(columns)
    if strict:
        text = F.to_json(
            F.struct(*[F.col(c) for c in names]), {"ignoreNullFields": "false"}
        )
    else:
        text = F.concat_ws(
            HASH_SEPARATOR,
            *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in names],
        )
    return F.sha2(text, 256)
