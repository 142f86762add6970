"""Header mapping, text cleaning and lineage, each as one projection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.codes import base_code, detailed_code
from strata.functions.headers import snake_case_all
from strata.functions.keys import LINEAGE_COLUMNS

# Spellings of a missing value, compared trimmed and in lower case.
NULL_TOKENS = ("", "—", "–", "-", "N/A", "n/a", "NA", "null", "NULL")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename all columns to snake_case; two headers with one name are an error."""
    return df.toDF(*snake_case_all(df.columns))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _map_strings(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(
        *[
            change(_quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else _quoted(f.name)
            for f in df.schema.fields
        ]
    )


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim the spaces around every string value."""
    return _map_strings(df, F.trim)


def nullify_placeholders(
    df: DataFrame, tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """Turn every spelling of "missing" in string columns into NULL."""
    words = sorted({t.strip().lower() for t in tokens})

    def known(value: Column) -> Column:
        return F.when(~F.lower(F.trim(value)).isin(words), value)

    return _map_strings(df, known)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Blank strings become NULL, then rows without any value are dropped."""
    filled = _map_strings(df, lambda c: F.when(c.rlike(r"(?U)\S"), c))
    return filled.filter(
        reduce(or_, [_quoted(c).isNotNull() for c in filled.columns])
    )


def with_lineage(
    df: DataFrame,
    source_path: str | None,
    run_id: str,
    processed_at: dt.datetime | None = None,
) -> DataFrame:
    """Add source path, run id and run time.

    ``source_path=None`` records the file each row was read from, for scans over
    many files. A given ``processed_at`` makes all tables of a run agree.
    """
    path = F.input_file_name() if source_path is None else F.lit(source_path)
    clock = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    return df.withColumns(
        {"source_file_path": path, "run_id": F.lit(run_id), "processed_at": clock}
    )


def base_frame(
    raw: DataFrame,
    source_path: str | None,
    run_id: str,
    processed_at: dt.datetime | None = None,
) -> DataFrame:
    """Cleaning shared by every source: headers, trim, placeholders, lineage."""
    return (
        raw.transform(normalize_headers)
        .transform(trim_strings)
        .transform(nullify_placeholders)
        .transform(with_lineage, source_path, run_id, processed_at)
    )


def find_column(
    columns: Sequence[str],
    candidates: Sequence[str],
    target: str,
    required: bool = True,
) -> str | None:
    """First candidate that the source has."""
    for candidate in candidates:
        if candidate in columns:
            return candidate
    if required:
        raise ValueError(
            f"No source column for {target!r}: expected one of {list(candidates)}, "
            f"available are {list(columns)}"
        )
    return None


@dataclass(frozen=True)
class Field:
    """An output column: where its text comes from and how it is derived."""

    name: str
    candidates: tuple[str, ...] = ()
    required: bool = False
    via: Callable[[Column], Column] | None = None

    def resolve(self, columns: Sequence[str]) -> Column | None:
        source = find_column(
            columns, self.candidates or (self.name,), self.name, self.required
        )
        if source is None:
            return None
        value = F.col(source)
        return (self.via(value) if self.via else value).alias(self.name)


def select_fields(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Project to stable names; absent optional fields are left out."""
    resolved = [f.resolve(df.columns) for f in fields]
    lineage = [c for c in LINEAGE_COLUMNS if c in df.columns]
    return df.select(*[c for c in resolved if c is not None], *lineage)


def select_mapped(
    df: DataFrame,
    required: Mapping[str, Sequence[str]],
    optional: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """``select_fields`` for plain renames given as target -> candidates."""
    return select_fields(
        df,
        [Field(t, tuple(c), required=True) for t, c in required.items()]
        + [Field(t, tuple(c)) for t, c in (optional or {}).items()],
    )


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep those of ``columns`` that exist, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


def add_codes(
    df: DataFrame,
    detailed_from: str | None = None,
    base_from: str | None = None,
) -> DataFrame:
    """Add the standard code columns; an absent source column is skipped."""
    added: dict[str, Column] = {}
    if detailed_from in df.columns:
        added["onet_soc_code"] = detailed_code(F.col(detailed_from))
        added["soc_code"] = base_code(F.col(detailed_from))
    if base_from in df.columns:
        added["soc_code"] = base_code(F.col(base_from))
    return df.withColumns(added) if added else df


def split_detailed_code(df: DataFrame) -> DataFrame:
    """Keep the raw detailed code beside its detailed and base forms."""
    find_column(df.columns, ("onet_soc_code",), "onet_soc_code_raw")
    raw = df.withColumnRenamed("onet_soc_code", "onet_soc_code_raw")
    return add_codes(raw, detailed_from="onet_soc_code_raw")


def keep_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in a required column that exists; NaN is a value."""
    present = [F.col(c).isNotNull() for c in required if c in df.columns]
    return df.filter(reduce(and_, present)) if present else df
