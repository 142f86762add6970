"""Amounts written as text, safe casts, and measures derived from numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type names whose text form may carry $ , or %.
NUMERIC_TYPES = (
    "byte",
    "short",
    "int",
    "integer",
    "long",
    "bigint",
    "float",
    "double",
    "decimal",
)
INTEGER_TYPES = ("byte", "short", "int", "integer", "long", "bigint")
NUMERIC_DECORATION = "$,%"

# A failed cast of text builds an exception inside Spark, which costs more than ten
# times a pattern test. These tests turn away text that cannot be a number; all text
# that Spark accepts as one passes them.
_MAY_BE_INTEGER = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
_MAY_BE_NUMBER = r"(?i)[0-9]|nan|inf"


def _without(value: Column, characters: str) -> Column:
    for character in characters:
        value = F.replace(value, F.lit(character), F.lit(""))
    return value


def _compact(value: Column) -> Column:
    return F.regexp_replace(F.trim(value), r"\s+", "")


def amount_qualifier(value: Column) -> Column:
    """How an amount such as ``>=$239,200`` bounds the true value."""
    text = _compact(value)

    def starts(*marks: str) -> Column:
        found = text.startswith(marks[0])
        for mark in marks[1:]:
            found = found | text.startswith(mark)
        return found

    # The two-character marks are tested before their one-character prefixes.
    return (
        F.when(starts(">=", "≥"), "greater_than_or_equal")
        .when(starts("<=", "≤"), "less_than_or_equal")
        .when(starts(">"), "greater_than")
        .when(starts("<"), "less_than")
        .when(value.isNotNull(), "exact")
    )


def amount_text(value: Column) -> Column:
    """The digits of an amount, without its bound mark, ``$`` and ``,``."""
    unbounded = F.regexp_replace(_compact(value), r"^(?:[<>]=?|[≥≤])", "")
    return _without(unbounded, "$,")


def safe_cast(value: Column, type_name: str) -> Column:
    """``try_cast`` of the trimmed text; numeric targets ignore ``$ , %``."""
    text = F.trim(value.cast("string"))
    target = type_name.strip().lower()
    if not target.startswith(NUMERIC_TYPES):
        return text.try_cast(type_name)
    text = _without(text, NUMERIC_DECORATION)
    possible = _MAY_BE_INTEGER if target in INTEGER_TYPES else _MAY_BE_NUMBER
    return F.when(text.rlike(possible), text.try_cast(type_name))


def thousands_to_count(value: Column) -> Column:
    """Whole count from a figure in thousands; a NaN or overflow gives NULL."""
    return F.round(value * 1000, 0).try_cast("bigint")


def direction(change: Column) -> Column:
    return (
        F.when(change > 0, "growing")
        .when(change < 0, "declining")
        .when(change == 0, "no_change")
        .otherwise("unknown")
    )
