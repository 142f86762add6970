"""Specs of the occupation-content tables: ratings, tasks, software, job zones.

The column names are fixed values of the source files.
"""

from __future__ import annotations

from strata.functions.codes import (
    DETAILED_CODE_PATTERN,
    base_code,
    detailed_code,
    yes_no,
)
from strata.functions.periods import source_month
from strata.operators.clean import Field
from strata.operators.quality import InRange, Matches
from strata.plans.spec import TableSpec

SYSTEM = "O*NET"

_CODES = (
    Field("onet_soc_code_raw", ("onet_soc_code",), required=True),
    Field("onet_soc_code", required=True, via=detailed_code),
    Field("soc_code", ("onet_soc_code",), required=True, via=base_code),
)
_MONTH = (
    Field("source_date_raw", ("date",)),
    Field("data_month", ("date",), via=source_month),
)


def _spec(name, file_name, fields, required, key, casts=None, rules=()) -> TableSpec:
    """A table whose raw detailed code, when it has one, is checked for its format."""
    if any(f.name == "onet_soc_code_raw" for f in fields):
        rules = (*rules, Matches("onet_soc_code_raw", DETAILED_CODE_PATTERN, key))
    return TableSpec(
        name=name,
        source_system=SYSTEM,
        file_name=file_name,
        fields=fields,
        casts=casts or {},
        rules=rules,
        required=required,
        key=key,
    )


OCCUPATIONS = _spec(
    "onet_occupations",
    "Occupation Data.txt",
    (
        *_CODES,
        Field("occupation_title", ("title",), required=True),
        Field("description", required=True),
    ),
    required=("onet_soc_code", "soc_code", "occupation_title"),
    key=("onet_soc_code",),
)

EDUCATION_CATEGORIES = _spec(
    "onet_education_categories",
    "Education Categories.txt",
    (
        Field("element_id", required=True),
        Field("element_name", required=True),
        Field("scale_id", required=True),
        Field("category", required=True),
        Field("category_description", required=True),
    ),
    casts={"category": "int"},
    required=("element_id", "scale_id", "category", "category_description"),
    key=("element_id", "scale_id", "category"),
)

_RATING_NUMBERS = {
    "data_value": "double",
    "n": "int",
    "standard_error": "double",
    "lower_ci_bound": "double",
    "upper_ci_bound": "double",
}


def _rating(name: str, file_name: str) -> TableSpec:
    """One value per occupation, element and scale."""
    key = ("onet_soc_code", "element_id", "scale_id")
    return _spec(
        name,
        file_name,
        (
            *_CODES,
            Field("element_id"),
            Field("element_name"),
            Field("scale_id"),
            *[Field(c) for c in _RATING_NUMBERS],
            Field("recommend_suppress", via=yes_no),
            Field("not_relevant", via=yes_no),
            *_MONTH,
            Field("domain_source"),
        ),
        casts=_RATING_NUMBERS,
        required=("onet_soc_code", "soc_code", "element_id", "scale_id", "data_value"),
        key=key,
    )


def _category_rating(name: str, file_name: str) -> TableSpec:
    """One value per occupation, element, scale and category."""
    key = ("onet_soc_code", "element_id", "scale_id", "category")
    return _spec(
        name,
        file_name,
        (
            *_CODES,
            Field("element_id"),
            Field("element_name"),
            Field("scale_id"),
            Field("category"),
            *[Field(c) for c in _RATING_NUMBERS],
            Field("recommend_suppress", via=yes_no),
            *_MONTH,
            Field("domain_source"),
        ),
        casts={"category": "int", **_RATING_NUMBERS},
        required=(
            "onet_soc_code",
            "soc_code",
            "element_id",
            "scale_id",
            "category",
            "data_value",
        ),
        key=key,
    )


EDUCATION = _category_rating("onet_education", "Education.txt")
TRAINING_EXPERIENCE = _category_rating(
    "onet_training_experience", "Training and Experience.txt"
)
ESSENTIAL_SKILLS = _rating("onet_essential_skills", "Essential Skills.txt")
TRANSFERABLE_SKILLS = _rating("onet_transferable_skills", "Transferable Skills.txt")
KNOWLEDGE = _rating("onet_knowledge", "Knowledge.txt")
ABILITIES = _rating("onet_abilities", "Abilities.txt")
WORK_ACTIVITIES = _rating("onet_work_activities", "Work Activities.txt")

SOFTWARE_SKILLS = _spec(
    "onet_software_skills",
    "Software Skills.txt",
    (
        *_CODES,
        Field("software_name", ("workplace_example",), required=True),
        Field("element_id", required=True),
        Field("element_name", required=True),
        Field("hot_technology", required=True, via=yes_no),
        Field("in_demand", required=True, via=yes_no),
    ),
    required=("onet_soc_code", "soc_code", "software_name", "element_id"),
    key=("onet_soc_code", "software_name", "element_id"),
)

TASK_STATEMENTS = _spec(
    "onet_task_statements",
    "Task Statements.txt",
    (
        *_CODES,
        Field("task_id"),
        Field("task_statement", ("task",)),
        Field("task_type"),
        Field("incumbents_responding"),
        *_MONTH,
        Field("domain_source"),
    ),
    casts={"task_id": "long", "incumbents_responding": "int"},
    required=("onet_soc_code", "soc_code", "task_id", "task_statement"),
    key=("onet_soc_code", "task_id"),
)

JOB_ZONES = _spec(
    "onet_job_zones",
    "Job Zones.txt",
    (*_CODES, Field("job_zone"), *_MONTH, Field("domain_source")),
    casts={"job_zone": "int"},
    rules=(
        InRange(
            "job_zone",
            1,
            5,
            key="onet_soc_code",
            rule="invalid_job_zone",
            message="A job zone is a number from 1 to 5.",
        ),
    ),
    required=("onet_soc_code", "soc_code", "job_zone"),
    key=("onet_soc_code",),
)

_RELATED = ("related_onet_soc_code",)

RELATED_OCCUPATIONS = _spec(
    "onet_related_occupations",
    "Related Occupations.txt",
    (
        *_CODES,
        Field("related_onet_soc_code_raw", _RELATED, required=True),
        Field("relatedness_tier", required=True),
        Field("index", required=True),
        Field("related_onet_soc_code", _RELATED, required=True, via=detailed_code),
        Field("related_soc_code", _RELATED, required=True, via=base_code),
    ),
    casts={"index": "int"},
    rules=(
        Matches(
            "related_onet_soc_code_raw",
            DETAILED_CODE_PATTERN,
            ("onet_soc_code", "related_onet_soc_code_raw"),
        ),
    ),
    required=(
        "onet_soc_code",
        "soc_code",
        "related_onet_soc_code",
        "related_soc_code",
    ),
    key=("onet_soc_code", "related_onet_soc_code"),
)

SPECS = (
    OCCUPATIONS,
    EDUCATION_CATEGORIES,
    EDUCATION,
    TRAINING_EXPERIENCE,
    ESSENTIAL_SKILLS,
    TRANSFERABLE_SKILLS,
    SOFTWARE_SKILLS,
    KNOWLEDGE,
    ABILITIES,
    WORK_ACTIVITIES,
    TASK_STATEMENTS,
    JOB_ZONES,
    RELATED_OCCUPATIONS,
)
