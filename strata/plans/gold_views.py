"""The dimensional views as catalog views, resolved again at every read.

A view built from a frame is bound to the files that were there when it was built. These
are SQL text over table names, so a reader sees what the last run of the table job wrote.
The results equal those of ``strata.plans.gold``; the tests compare all seven. The output
columns are fixed values: the layout of the published views.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from strata.functions.codes import PREPARATION_LABELS, SCALE_LABELS
from strata.functions.keys import LINEAGE_COLUMNS

LINEAGE = ", ".join(LINEAGE_COLUMNS)
BASE_CODE = "rlike(soc_code, '^[0-9]{2}-[0-9]{4}$')"
PERIODS = ", ".join(
    [
        "('A01', 'annual', 1), ('M13', 'annual', 1)",
        "('S01', 'semiannual', 1), ('S02', 'semiannual', 7)",
        *[f"('M{m:02d}', 'monthly', {m})" for m in range(1, 13)],
    ]
)
LAST_STEP = 2**63 - 1


def _map(labels: dict) -> str:
    pairs = ", ".join(f"{k!r}, {v!r}" for k, v in labels.items())
    return f"map({pairs})"


def _dimension() -> str:
    sources = (
        ("bls_employment_projections", "occupation_title", "CAST(NULL AS STRING)"),
        ("bls_oews_occupations", "occupation_name", "CAST(NULL AS STRING)"),
        ("onet_occupations", "occupation_title", "onet_soc_code"),
    )
    stacked = " UNION ALL ".join(
        f"SELECT {place} AS place, soc_code, {title} AS title, {member} AS member "
        f"FROM {{silver}}{name}"
        for place, (name, title, member) in enumerate(sources)
    )
    titles = ", ".join(f"max(title) FILTER (WHERE place = {i})" for i in range(3))
    flags = ("has_employment_projection_data", "has_oews_data", "has_onet_data")
    held = ", ".join(f"bool_or(place = {i}) AS {f}" for i, f in enumerate(flags))
    return f"""
SELECT soc_code, occupation_title, major_group_code,
  max(if(soc_code = major_group_code, occupation_title, NULL))
    OVER (PARTITION BY major_group_code) AS major_group_title,
  onet_occupation_count, {", ".join(flags)}
FROM (
  SELECT soc_code, concat(left(soc_code, 2), '-0000') AS major_group_code,
    coalesce({titles}) AS occupation_title, {held},
    count(DISTINCT member) AS onet_occupation_count
  FROM ({stacked}) WHERE {BASE_CODE} GROUP BY soc_code)"""


def _measurement() -> str:
    def names(kind: str, table: str, more: str = "") -> str:
        return (
            f"(SELECT {kind}_code, max({kind}_name) AS {kind}_name{more} "
            f"FROM {{silver}}bls_oews_{table} GROUP BY {kind}_code)"
        )

    return f"""
WITH described AS (
  SELECT series_id, seasonal, series_title, area_code, area_name,
    area_lookup_record_count, industry_code, industry_name, occupation_code,
    nvl(s.soc_code, named_code) AS soc_code, occupation_name, datatype_code, datatype_name
  FROM {{silver}}bls_oews_series s
  LEFT JOIN {names('datatype', 'datatypes')} USING (datatype_code)
  LEFT JOIN {names('industry', 'industries')} USING (industry_code)
  LEFT JOIN {names('area', 'areas', ', count(*) AS area_lookup_record_count')}
    USING (area_code)
  LEFT JOIN {names('occupation', 'occupations', ', max(soc_code) AS named_code')}
    USING (occupation_code))
SELECT series_id, year, period, nvl(kind, 'other') AS period_type,
  if(year BETWEEN 1 AND 9999, make_date(year, first_month, 1), NULL) AS observation_date,
  seasonal, series_title, area_code, area_name, area_lookup_record_count, industry_code,
  industry_name, occupation_code, soc_code, occupation_name, datatype_code, datatype_name,
  value, value_raw, footnote_codes, {LINEAGE}
FROM {{silver}}bls_oews_observations
JOIN described USING (series_id)
LEFT JOIN (VALUES {PERIODS}) AS calendar(period, kind, first_month) USING (period)
WHERE value IS NOT NULL"""


def _projection(base_year: int = 2024, target_year: int = 2034) -> str:
    counts = {
        "employment_base_year": "employment_base_year_thousands",
        "employment_projected_year": "employment_projected_year_thousands",
        "employment_change": "employment_change_thousands",
        "annual_openings": "annual_openings_thousands",
    }
    whole = ", ".join(
        f"try_cast(round({c} * 1000, 0) AS BIGINT) AS {n}" for n, c in counts.items()
    )
    signs = _map({-1.0: "declining", 0.0: "no_change", 1.0: "growing"})
    # Literals like -1.0 are decimals; the sign is compared as one. NaN sorts last.
    sign = "CAST(nanvl(signum(employment_change_percent), 1) AS DECIMAL(2,1))"
    return f"""
SELECT soc_code, occupation_title, occupation_type,
  {base_year} AS projection_base_year, {target_year} AS projection_target_year,
  {", ".join(counts.values())}, {whole}, employment_change_percent,
  nvl(element_at({signs}, {sign}), 'unknown') AS growth_direction,
  employment_distribution_base_percent, employment_distribution_projected_percent,
  percent_self_employed, median_annual_wage, median_annual_wage_raw,
  median_annual_wage_qualifier, typical_entry_education, related_work_experience,
  on_the_job_training, {LINEAGE}
FROM {{silver}}bls_employment_projections WHERE {BASE_CODE}"""


def _ranked(rows: str, groups: Sequence[str], lead: str, ties: str, name: str) -> str:
    """Dense ranks by ``lead`` descending, a group split by steps of it.

    A group's step is one struct, in which NULLs are equal, so that the windows and the
    join need one shuffle and one sort of the rows. The last row of a step has its size,
    which takes no aggregate that holds the values.
    """
    group = ", ".join(groups)
    step = (
        f"if(isnan({lead}), {LAST_STEP}, "
        f"CAST(signum({lead}) * floor(log2(abs({lead}) + 1) * 256) AS BIGINT))"
    )
    within = f"(PARTITION BY part ORDER BY {lead} DESC, {ties})"
    inside = ", ".join(f"part.{c}" for c in groups)
    return f"""
stepped AS (
  SELECT * EXCEPT ({group}), struct({group}, {step} AS step) AS part FROM ({rows})),
sized AS (
  SELECT {inside}, part.step, size
  FROM (SELECT part, dense_rank() OVER within AS size, lead(1) OVER within AS more
        FROM stepped WINDOW within AS {within})
  WHERE more IS NULL),
placed AS (
  SELECT struct({group}, step) AS part,
    sum(size) OVER (PARTITION BY {group} ORDER BY step DESC) - size AS before
  FROM sized),
ranked AS (
  SELECT * EXCEPT (part, place, before), {inside}, CAST(before + place AS INT) AS {name}
  FROM (SELECT *, dense_rank() OVER {within} AS place FROM stepped) JOIN placed USING (part))"""


def _education() -> str:
    rows = (
        "SELECT *, data_value AS education_response_value "
        "FROM {silver}onet_education WHERE data_value IS NOT NULL"
    )
    ranked = _ranked(
        rows, ("onet_soc_code", "element_id", "scale_id"), "education_response_value",
        "category", "education_rank",
    )
    return f"""
WITH {ranked}
SELECT onet_soc_code, r.soc_code, occupation_title, element_id, r.element_name, scale_id,
  category, category_description AS education_category, education_response_value,
  education_rank, education_rank = 1 AS is_primary_education_category,
  {", ".join(f"r.{c}" for c in LINEAGE_COLUMNS)}
FROM ranked r
LEFT JOIN (SELECT element_id, scale_id, category, category_description
           FROM {{silver}}onet_education_categories) USING (element_id, scale_id, category)
LEFT JOIN (SELECT onet_soc_code, occupation_title FROM {{silver}}onet_occupations)
  USING (onet_soc_code)"""


def _skill() -> str:
    rows = " UNION ALL ".join(
        f"SELECT onet_soc_code, soc_code, '{family}' AS skill_family, "
        f"element_id AS skill_id, element_name AS skill_name, scale_id, "
        f"data_value AS skill_score, {LINEAGE} "
        f"FROM {{silver}}onet_{family}_skills WHERE data_value IS NOT NULL"
        for family in ("essential", "transferable")
    )
    ranked = _ranked(
        rows, ("onet_soc_code", "skill_family", "scale_id"), "skill_score", "skill_name",
        "skill_rank",
    )
    scale = f"nvl(element_at({_map(SCALE_LABELS)}, upper(scale_id)), lower(scale_id))"
    return f"""
WITH {ranked}
SELECT onet_soc_code, soc_code, occupation_title, skill_family, skill_id, skill_name,
  scale_id, {scale} AS scale_name, skill_score, skill_rank, {LINEAGE}
FROM ranked
LEFT JOIN (SELECT onet_soc_code, occupation_title FROM {{silver}}onet_occupations)
  USING (onet_soc_code)"""


def _software() -> str:
    detail = (
        "software_name, element_id, element_name, hot_technology, in_demand, " + LINEAGE
    )
    return f"""
SELECT onet_soc_code, soc_code, occupation_title, {detail}
FROM (SELECT DISTINCT onet_soc_code, soc_code, {detail}
      FROM {{silver}}onet_software_skills WHERE software_name IS NOT NULL)
LEFT JOIN (SELECT DISTINCT onet_soc_code, occupation_title
           FROM {{silver}}onet_occupations) USING (onet_soc_code)"""


def _job_zone() -> str:
    return f"""
SELECT onet_soc_code, soc_code, occupation_title, occupation_description, job_zone,
  nvl(element_at({_map(PREPARATION_LABELS)}, job_zone), 'unknown') AS job_zone_label,
  {LINEAGE}
FROM {{silver}}onet_job_zones
LEFT JOIN (SELECT onet_soc_code, occupation_title, description AS occupation_description
           FROM {{silver}}onet_occupations) USING (onet_soc_code)"""


#: View name: what it is, and its text with the place of the clean tables left open.
VIEW_TEXTS: dict[str, tuple[str, str]] = {
    "dim_occupation": ("One row for each occupation code of any source.", _dimension()),
    "fact_oews_measurement": ("Wage observations with their names.", _measurement()),
    "fact_occupation_projection": ("Projections as whole counts.", _projection()),
    "bridge_occupation_education": ("Education of occupations, ranked.", _education()),
    "bridge_occupation_skill": ("Skills of occupations, ranked.", _skill()),
    "bridge_occupation_software": ("Software used by occupations.", _software()),
    "bridge_occupation_job_zone": ("Preparation that occupations need.", _job_zone()),
}


def publish(
    spark: SparkSession,
    silver: str | None = None,
    gold: str | None = None,
    names: Sequence[str] = tuple(VIEW_TEXTS),
) -> None:
    """Create or replace the views of schema ``gold`` over the tables of ``silver``."""
    for name in names:
        comment, text = VIEW_TEXTS[name]
        view = f"{gold}.{name}" if gold else name
        place = f"{silver}." if silver else ""
        body = text.replace("{silver}", place)
        spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT '{comment}' AS {body}")
