"""The nine checks to review after the dimensional views have been built."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from strata.operators.checks import (
    coverage,
    lookup_hits,
    match_counts,
    null_counts,
    repeated_keys,
)

# Business key per view; a repeated key is a fault.
UNIQUE_KEYS = {
    "dim_occupation": ("soc_code",),
    "fact_oews_measurement": ("series_id", "year", "period"),
    "bridge_occupation_education": (
        "onet_soc_code",
        "element_id",
        "scale_id",
        "category",
    ),
    "bridge_occupation_skill": (
        "onet_soc_code",
        "skill_family",
        "skill_id",
        "scale_id",
    ),
    "bridge_occupation_software": ("onet_soc_code", "software_name", "element_id"),
}

_BRIDGES = {
    "onet_occupations_with_education": "bridge_occupation_education",
    "onet_occupations_with_skills": "bridge_occupation_skill",
    "onet_occupations_with_software": "bridge_occupation_software",
    "onet_occupations_with_job_zone": "bridge_occupation_job_zone",
}


def validation(views: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Check results by name. Key checks hold no rows when all is well."""
    dimension = views["dim_occupation"]
    found = {
        f"{name}_key": repeated_keys(views[name], key)
        for name, key in UNIQUE_KEYS.items()
    }
    found["dim_occupation_nulls"] = null_counts(
        dimension,
        {"null_soc_codes": "soc_code", "null_occupation_titles": "occupation_title"},
    )
    found["fact_oews_measurement_lookups"] = lookup_hits(
        views["fact_oews_measurement"],
        {
            f"rows_with_{c}": c
            for c in ("occupation_name", "area_name", "industry_name", "datatype_name")
        },
        total="total_oews_rows",
    )
    found["fact_occupation_projection_matches"] = match_counts(
        views["fact_occupation_projection"],
        dimension,
        "soc_code",
        names=(
            "total_projection_rows",
            "matched_projection_rows",
            "unmatched_projection_rows",
        ),
    )
    found["bridge_coverage"] = coverage(
        dimension.select("soc_code", "occupation_title"),
        "soc_code",
        {n: (views[v], "soc_code", "onet_soc_code") for n, v in _BRIDGES.items()},
    ).orderBy("soc_code")
    return found
