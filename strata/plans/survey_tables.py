"""Specs of the labor-survey tables: wage series, projections and crosswalks.

The column names are fixed values: each field lists the header spellings its
source has used, in order of preference.
"""

from __future__ import annotations

from strata.functions.amounts import amount_qualifier, amount_text
from strata.functions.codes import (
    BASE_CODE_PATTERN,
    DETAILED_CODE_PATTERN,
    base_code,
    detailed_code,
)
from strata.functions.periods import PERIOD_PATTERN
from strata.operators.clean import Field
from strata.operators.quality import Matches
from strata.plans.spec import TableSpec

SYSTEM = "BLS"

OBSERVATION_KEY = ("series_id", "year", "period")

OBSERVATIONS = TableSpec(
    name="bls_oews_observations",
    source_system=SYSTEM,
    file_name="oews/oe_data_all_data.txt",
    fields=(
        Field("series_id", required=True),
        Field("year", required=True),
        Field("period", required=True),
        Field("value_raw", ("value",), required=True),
        Field("footnote_codes", ("footnote_codes", "footnote_code")),
        Field("value", required=True),
    ),
    casts={"year": "int", "value": "double"},
    rules=(Matches("period", PERIOD_PATTERN, OBSERVATION_KEY),),
    required=OBSERVATION_KEY,
    key=OBSERVATION_KEY,
)

SERIES = TableSpec(
    name="bls_oews_series",
    source_system=SYSTEM,
    file_name="oews/oe_series.txt",
    fields=(
        Field("series_id"),
        Field("seasonal"),
        Field("areatype_code"),
        Field("area_type_code"),
        Field("state_code"),
        Field("area_code"),
        Field("industry_code"),
        Field("occupation_code"),
        Field("soc_code", ("occupation_code",), via=base_code),
        Field("datatype_code"),
        Field("sector_code"),
        Field("series_title"),
        Field("footnote_codes"),
        Field("begin_year"),
        Field("begin_period"),
        Field("end_year"),
        Field("end_period"),
    ),
    casts={"begin_year": "int", "end_year": "int"},
    required=("series_id", "occupation_code", "datatype_code"),
    key=("series_id",),
)

OCCUPATIONS = TableSpec(
    name="bls_oews_occupations",
    source_system=SYSTEM,
    file_name="oews/oe_occupation.txt",
    fields=(
        Field("occupation_code"),
        Field("soc_code", ("occupation_code",), via=base_code),
        Field("occupation_name"),
        Field("occupation_description"),
        Field("display_level"),
        Field("selectable"),
        Field("sort_sequence"),
    ),
    casts={"display_level": "int", "sort_sequence": "int"},
    required=("occupation_code", "occupation_name"),
    key=("occupation_code",),
)


def _lookup(name: str, file_name: str, required, key, casts=None) -> TableSpec:
    return TableSpec(
        name=name,
        source_system=SYSTEM,
        file_name=f"oews/{file_name}",
        required=required,
        key=key,
        casts=casts or {},
    )


AREAS = _lookup(
    "bls_oews_areas",
    "oe_area.txt",
    ("area_code", "area_name"),
    ("area_type_code", "areatype_code", "area_code"),
)
INDUSTRIES = _lookup(
    "bls_oews_industries",
    "oe_industry.txt",
    ("industry_code", "industry_name"),
    ("industry_code",),
    {"display_level": "int", "sort_sequence": "int"},
)
DATATYPES = _lookup(
    "bls_oews_datatypes",
    "oe_datatype.txt",
    ("datatype_code", "datatype_name"),
    ("datatype_code",),
)
FOOTNOTES = _lookup(
    "bls_oews_footnotes",
    "oe_footnote.txt",
    ("footnote_code", "footnote_text"),
    ("footnote_code",),
)

_PROJECTION_CODE = (
    "2024_national_employment_matrix_code",
    "national_employment_matrix_code",
    "occupation_code",
    "soc_code",
)
_WAGE = (
    "median_annual_wage_dollars_2024_1",
    "median_annual_wage_dollars_2024",
    "median_annual_wage_2024",
)

PROJECTIONS = TableSpec(
    name="bls_employment_projections",
    source_system=SYSTEM,
    file_name=(
        "employment_projections/employment_projections_occupation_tables_2024_2034.txt"
    ),
    header_row=1,
    fields=(
        Field(
            "occupation_title",
            (
                "2024_national_employment_matrix_title",
                "national_employment_matrix_title",
                "occupation_title",
            ),
            required=True,
        ),
        Field("soc_code_raw", _PROJECTION_CODE, required=True),
        Field(
            "employment_base_year_thousands",
            ("employment_2024", "2024_employment"),
            required=True,
        ),
        Field(
            "employment_projected_year_thousands",
            ("employment_2034", "2034_employment"),
            required=True,
        ),
        Field(
            "employment_change_thousands",
            ("employment_change_numeric_2024_34", "numeric_change_2024_34"),
            required=True,
        ),
        Field(
            "employment_change_percent",
            ("employment_change_percent_2024_34", "percent_change_2024_34"),
            required=True,
        ),
        Field(
            "annual_openings_thousands",
            (
                "occupational_openings_2024_34_annual_average",
                "annual_average_occupational_openings_2024_34",
            ),
            required=True,
        ),
        Field("occupation_type"),
        Field(
            "employment_distribution_base_percent",
            ("employment_distribution_percent_2024",),
        ),
        Field(
            "employment_distribution_projected_percent",
            ("employment_distribution_percent_2034",),
        ),
        Field("percent_self_employed", ("percent_self_employed_2024",)),
        Field("median_annual_wage", _WAGE, via=amount_text),
        Field("typical_entry_education", ("typical_education_needed_for_entry",)),
        Field("related_work_experience", ("work_experience_in_a_related_occupation",)),
        Field(
            "on_the_job_training",
            (
                "typical_on_the_job_training_needed_to_attain_competency_in_the_occupation",
                "typical_on_the_job_training",
            ),
        ),
        Field("soc_code", _PROJECTION_CODE, required=True, via=base_code),
        Field("median_annual_wage_raw", _WAGE),
        Field("median_annual_wage_qualifier", _WAGE, via=amount_qualifier),
    ),
    casts={
        "employment_base_year_thousands": "double",
        "employment_projected_year_thousands": "double",
        "employment_change_thousands": "double",
        "employment_change_percent": "double",
        "annual_openings_thousands": "double",
        "employment_distribution_base_percent": "double",
        "employment_distribution_projected_percent": "double",
        "percent_self_employed": "double",
        "median_annual_wage": "double",
    },
    cast_key=("soc_code_raw",),
    rules=(Matches("soc_code_raw", BASE_CODE_PATTERN, ("soc_code_raw",)),),
    required=("soc_code", "occupation_title"),
    key=("soc_code", "occupation_type"),
)

_MATRIX_CODE = ("occupation_code", "national_employment_matrix_code", "soc_code")

MATRIX = TableSpec(
    name="bls_national_employment_matrix",
    source_system=SYSTEM,
    file_name="employment_projections/national_employment_matrix_2024_2034.txt",
    header_row=0,
    fields=(
        Field("soc_code_raw", _MATRIX_CODE, required=True),
        Field(
            "occupation_title",
            ("occupation_title", "national_employment_matrix_title"),
            required=True,
        ),
        Field("industry_code", required=True),
        Field("industry_title", required=True),
        Field(
            "employment_base_year_thousands",
            ("2024_employment", "employment_2024"),
            required=True,
        ),
        Field(
            "employment_projected_year_thousands",
            ("2034_employment", "employment_2034"),
            required=True,
        ),
        Field("occupation_type"),
        Field("industry_type"),
        Field("base_percent_of_industry", ("2024_percent_of_industry",)),
        Field("base_percent_of_occupation", ("2024_percent_of_occupation",)),
        Field("projected_percent_of_industry", ("2034_percent_of_industry",)),
        Field("projected_percent_of_occupation", ("2034_percent_of_occupation",)),
        Field(
            "employment_change_thousands",
            ("numeric_change_2024_34", "employment_change_numeric_2024_34"),
        ),
        Field(
            "employment_change_percent",
            ("percent_change_2024_34", "employment_change_percent_2024_34"),
        ),
        Field("soc_code", _MATRIX_CODE, required=True, via=base_code),
    ),
    casts={
        "employment_base_year_thousands": "double",
        "employment_projected_year_thousands": "double",
        "base_percent_of_industry": "double",
        "base_percent_of_occupation": "double",
        "projected_percent_of_industry": "double",
        "projected_percent_of_occupation": "double",
        "employment_change_thousands": "double",
        "employment_change_percent": "double",
    },
    cast_key=("soc_code_raw", "industry_code"),
    rules=(
        Matches("soc_code_raw", BASE_CODE_PATTERN, ("soc_code_raw", "industry_code")),
    ),
    required=("soc_code", "industry_code", "occupation_title", "industry_title"),
    key=("soc_code", "industry_code", "occupation_type", "industry_type"),
)

_CROSSWALK_DETAILED = ("onet_soc_code", "o_net_soc_code")
_CROSSWALK_BASE = ("nem_code", "national_employment_matrix_code", "soc_code")
_CROSSWALK_RAW_KEY = ("onet_soc_code_raw", "soc_code_raw")

CROSSWALK = TableSpec(
    name="bls_onet_soc_crosswalk",
    source_system=SYSTEM,
    file_name="crosswalks/onet_soc_to_nem_crosswalk.txt",
    header_row=4,
    fields=(
        Field("onet_soc_code_raw", _CROSSWALK_DETAILED, required=True),
        Field(
            "onet_title",
            ("onet_soc_title", "o_net_soc_title", "onet_title"),
            required=True,
        ),
        Field("soc_code_raw", _CROSSWALK_BASE, required=True),
        Field(
            "bls_title",
            ("nem_title", "national_employment_matrix_title", "bls_title"),
            required=True,
        ),
        Field("sort_order"),
        Field("ooh_profile_code"),
        Field("ooh_profile_title"),
        Field("ooh_occupation_group"),
        Field("ooh_occupation_group_brief"),
        Field("ooh_profile_website"),
        Field("onet_soc_code", _CROSSWALK_DETAILED, required=True, via=detailed_code),
        Field("soc_code", _CROSSWALK_BASE, required=True, via=base_code),
    ),
    casts={"sort_order": "int"},
    cast_key=_CROSSWALK_RAW_KEY,
    rules=(
        Matches("onet_soc_code_raw", DETAILED_CODE_PATTERN, _CROSSWALK_RAW_KEY),
        Matches("soc_code_raw", BASE_CODE_PATTERN, _CROSSWALK_RAW_KEY),
    ),
    required=("onet_soc_code", "soc_code", "onet_title", "bls_title"),
    key=("onet_soc_code", "soc_code"),
)

_COVERAGE_CODE = ("national_employment_matrix_code", "nem_code", "occupation_code")

COVERAGE = TableSpec(
    name="bls_nem_occupational_coverage",
    source_system=SYSTEM,
    file_name="crosswalks/nem_occupational_coverage.txt",
    header_row=3,
    fields=(
        Field("soc_code_raw", _COVERAGE_CODE, required=True),
        Field(
            "occupation_title",
            ("national_employment_matrix_title", "nem_title", "occupation_title"),
            required=True,
        ),
        Field("sort_order"),
        Field("occupation_type"),
        Field("occupation_level", ("level", "occupation_level")),
        Field("soc_code", _COVERAGE_CODE, required=True, via=base_code),
    ),
    casts={"sort_order": "int", "occupation_level": "int"},
    cast_key=("soc_code_raw",),
    rules=(Matches("soc_code_raw", BASE_CODE_PATTERN, ("soc_code_raw",)),),
    required=("soc_code", "occupation_title"),
    key=("soc_code", "occupation_type"),
)

SPECS = (
    OBSERVATIONS,
    SERIES,
    OCCUPATIONS,
    AREAS,
    INDUSTRIES,
    DATATYPES,
    FOOTNOTES,
    PROJECTIONS,
    MATRIX,
    CROSSWALK,
    COVERAGE,
)
