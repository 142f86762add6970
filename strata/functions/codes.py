"""Classification codes, flags and labels as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code formats shared with the published classification.
BASE_CODE_PATTERN = r"^\d{2}-\d{4}$"
DETAILED_CODE_PATTERN = r"^\d{2}-\d{4}\.\d{2}$"
ASCII_BASE_CODE_PATTERN = r"^[0-9]{2}-[0-9]{4}$"
MAJOR_GROUP_SUFFIX = "-0000"

# Spellings of a yes/no flag.
TRUE_WORDS = ("y", "yes", "true", "t", "1")
FALSE_WORDS = ("n", "no", "false", "f", "0")

# Preparation levels one to five.
PREPARATION_LABELS = {
    1: "little_or_no_preparation",
    2: "some_preparation",
    3: "medium_preparation",
    4: "high_preparation",
    5: "extensive_preparation",
}

# Rating scales.
SCALE_LABELS = {"IM": "importance", "LV": "level"}


# All characters that count as whitespace.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove leading and trailing whitespace of any kind, not only spaces."""
    return F.btrim(value, F.lit(WHITESPACE))


def base_code(value: Column) -> Column:
    """``##-####`` from the first six digits; NULL when there are fewer than six."""
    text = value.cast("string")
    digits = F.regexp_replace(text, "[^0-9]", "")
    # Values that start in the right form, nearly all of them, are only cut.
    return F.when(
        text.rlike("^[0-9]{2}-[0-9]{4}"), F.substring(text, 1, 7)
    ).when(
        F.length(digits) >= 6,
        F.concat(F.substring(digits, 1, 2), F.lit("-"), F.substring(digits, 3, 4)),
    )


def detailed_code(value: Column) -> Column:
    """The stripped value when it reads ``##-####.##`` exactly, else NULL."""
    text = strip(value.cast("string"))
    return F.when(text.rlike(r"^[0-9]{2}-[0-9]{4}\.[0-9]{2}$"), text)


def is_base_code(value: Column) -> Column:
    return value.rlike(ASCII_BASE_CODE_PATTERN)


def major_group_code(code: Column) -> Column:
    """Code of the two-digit group a base code belongs to."""
    return F.concat(F.substring(code, 1, 2), F.lit(MAJOR_GROUP_SUFFIX))


def yes_no(value: Column) -> Column:
    """Boolean from a yes/no spelling; an unknown spelling is NULL, not an error."""
    word = F.lower(strip(value.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(
        word.isin(*FALSE_WORDS), F.lit(False)
    )


def label(value: Column, labels: Mapping, default: Column) -> Column:
    """Constant lookup as one CASE expression, so no join is needed."""
    branches = iter(labels.items())
    key, text = next(branches)
    case = F.when(value == F.lit(key), F.lit(text))
    for key, text in branches:
        case = case.when(value == F.lit(key), F.lit(text))
    return case.otherwise(default)


def preparation_label(zone: Column) -> Column:
    return label(zone, PREPARATION_LABELS, F.lit("unknown"))


def scale_label(scale: Column) -> Column:
    return label(F.upper(scale), SCALE_LABELS, F.lower(scale))
