"""Dimensional views over the clean tables: one dimension, two facts, four bridges.

Each function takes the clean tables by name and returns a lazy DataFrame. The output
columns of each are fixed values: the layout of the published views.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.amounts import direction, thousands_to_count
from strata.functions.codes import (
    is_base_code,
    major_group_code,
    preparation_label,
    scale_label,
)
from strata.functions.keys import LINEAGE_COLUMNS
from strata.functions.periods import observation_date, period_type
from strata.operators.lookups import left_lookup, unique_lookup
from strata.operators.ranking import dense_rank

Tables = Mapping[str, DataFrame]


def tagged_union(sources: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack frames by column name, each marked with its name."""
    marked = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, marked)


def code_dimension(
    sources: Mapping[str, DataFrame],
    flags: Mapping[str, str],
    counted: str,
    code: str = "soc_code",
    title: str = "occupation_title",
    count_name: str = "onet_occupation_count",
) -> DataFrame:
    """One row per base code from several sources.

    ``sources`` maps source name to a frame of (code, title, member) in order of
    preference for the title; ``flags`` maps presence flag to source name; the
    distinct members of source ``counted`` are counted. The sources are read and
    aggregated once. The major group is a code of the same dimension, so its title
    is taken from the rows that share the two-digit prefix: at most 10,000 codes,
    whatever the size of the sources.
    """
    stacked = tagged_union(sources, "__source").filter(is_base_code(F.col(code)))
    is_source = {name: F.col("__source") == name for name in sources}
    summary = stacked.groupBy(code).agg(
        F.coalesce(*[F.max(F.when(is_source[s], F.col(title))) for s in sources]).alias(
            title
        ),
        *[F.bool_or(is_source[s]).alias(flag) for flag, s in flags.items()],
        F.count_distinct(F.when(is_source[counted], F.col("member"))).alias(count_name),
    )
    group = major_group_code(F.col(code))
    group_title = F.max(F.when(F.col(code) == group, F.col(title)))
    return summary.select(
        code,
        title,
        group.alias("major_group_code"),
        group_title.over(Window.partitionBy(group)).alias("major_group_title"),
        count_name,
        *flags,
    )


def dim_occupation(tables: Tables) -> DataFrame:
    """One row per base code, from projections, survey and detailed occupations."""

    def source(name: str, title: str, member: Column | None = None) -> DataFrame:
        return tables[name].select(
            "soc_code",
            F.col(title).alias("occupation_title"),
            (F.lit(None).cast("string") if member is None else member).alias("member"),
        )

    return code_dimension(
        {
            "bls_employment_projections": source(
                "bls_employment_projections", "occupation_title"
            ),
            "bls_oews_occupations": source("bls_oews_occupations", "occupation_name"),
            "onet_occupations": source(
                "onet_occupations", "occupation_title", F.col("onet_soc_code")
            ),
        },
        {
            "has_employment_projection_data": "bls_employment_projections",
            "has_oews_data": "bls_oews_occupations",
            "has_onet_data": "onet_occupations",
        },
        counted="onet_occupations",
    )


def fact_oews_measurement(tables: Tables) -> DataFrame:
    """Observations with series metadata and the names of their codes."""
    observations = tables["bls_oews_observations"].filter(F.col("value").isNotNull())
    series = tables["bls_oews_series"].select(
        "series_id",
        "seasonal",
        "series_title",
        "area_code",
        "industry_code",
        "occupation_code",
        F.col("soc_code").alias("series_soc_code"),
        "datatype_code",
    )
    # The lookups enrich the series, which are far fewer than the observations.
    occupation = unique_lookup(
        tables["bls_oews_occupations"],
        "occupation_code",
        {"lookup_soc_code": "soc_code", "occupation_name": "occupation_name"},
    )
    area = unique_lookup(
        tables["bls_oews_areas"],
        "area_code",
        {
            "area_name": "area_name",
            "area_lookup_record_count": F.count(F.lit(1)),
        },
    )
    industry = unique_lookup(
        tables["bls_oews_industries"],
        "industry_code",
        {"industry_name": "industry_name"},
    )
    datatype = unique_lookup(
        tables["bls_oews_datatypes"],
        "datatype_code",
        {"datatype_name": "datatype_name"},
    )
    described = (
        series.join(occupation, "occupation_code", "left")
        .join(area, "area_code", "left")
        .join(industry, "industry_code", "left")
        .join(datatype, "datatype_code", "left")
    )
    period = F.col("period")
    return observations.join(described, "series_id").select(
        "series_id",
        "year",
        "period",
        period_type(period).alias("period_type"),
        observation_date(F.col("year"), period).alias("observation_date"),
        "seasonal",
        "series_title",
        "area_code",
        "area_name",
        "area_lookup_record_count",
        "industry_code",
        "industry_name",
        "occupation_code",
        F.coalesce("series_soc_code", "lookup_soc_code").alias("soc_code"),
        "occupation_name",
        "datatype_code",
        "datatype_name",
        "value",
        "value_raw",
        "footnote_codes",
        *LINEAGE_COLUMNS,
    )


def fact_occupation_projection(
    tables: Tables, base_year: int = 2024, target_year: int = 2034
) -> DataFrame:
    """Projections with whole counts and the direction of growth."""
    counts = {
        "employment_base_year": "employment_base_year_thousands",
        "employment_projected_year": "employment_projected_year_thousands",
        "employment_change": "employment_change_thousands",
        "annual_openings": "annual_openings_thousands",
    }
    return (
        tables["bls_employment_projections"]
        .filter(is_base_code(F.col("soc_code")))
        .select(
            "soc_code",
            "occupation_title",
            "occupation_type",
            F.lit(base_year).alias("projection_base_year"),
            F.lit(target_year).alias("projection_target_year"),
            *counts.values(),
            *[thousands_to_count(F.col(c)).alias(n) for n, c in counts.items()],
            "employment_change_percent",
            direction(F.col("employment_change_percent")).alias("growth_direction"),
            "employment_distribution_base_percent",
            "employment_distribution_projected_percent",
            "percent_self_employed",
            "median_annual_wage",
            "median_annual_wage_raw",
            "median_annual_wage_qualifier",
            "typical_entry_education",
            "related_work_experience",
            "on_the_job_training",
            *LINEAGE_COLUMNS,
        )
    )


def _with_title(df: DataFrame, tables: Tables, **more: str) -> DataFrame:
    return left_lookup(
        df,
        tables["onet_occupations"],
        {"onet_soc_code": "onet_soc_code"},
        {"occupation_title": "occupation_title", **more},
    )


def bridge_occupation_education(tables: Tables, ranked: bool = True) -> DataFrame:
    """Education categories of a detailed occupation, ranked by response value.

    Ranking runs a job; who needs no ranks can leave them and their flag out.
    """
    answered = tables["onet_education"].filter(F.col("data_value").isNotNull())
    rows = answered.select(
        "onet_soc_code",
        "soc_code",
        "element_id",
        "element_name",
        "scale_id",
        "category",
        F.col("data_value").alias("education_response_value"),
        *LINEAGE_COLUMNS,
    )
    ranks = []
    if ranked:
        # Ranked before the joins, so the rows carry no looked-up text.
        rows = dense_rank(
            rows,
            groups=["onet_soc_code", "element_id", "scale_id"],
            order=[("education_response_value", "desc"), ("category", "asc")],
            name="education_rank",
        )
        rank = F.col("education_rank")
        ranks = [rank, (rank == 1).alias("is_primary_education_category")]
    described = left_lookup(
        rows,
        tables["onet_education_categories"],
        {"element_id": "element_id", "scale_id": "scale_id", "category": "category"},
        {"education_category": "category_description"},
    )
    return _with_title(described, tables).select(
        "onet_soc_code",
        "soc_code",
        "occupation_title",
        "element_id",
        "element_name",
        "scale_id",
        "category",
        "education_category",
        "education_response_value",
        *ranks,
        *LINEAGE_COLUMNS,
    )


def bridge_occupation_skill(tables: Tables, ranked: bool = True) -> DataFrame:
    """Essential and transferable skills of a detailed occupation, ranked by score.

    Ranking runs a job; who needs no ranks can leave them out.
    """
    columns = [
        "onet_soc_code",
        "soc_code",
        F.col("element_id").alias("skill_id"),
        F.col("element_name").alias("skill_name"),
        "scale_id",
        F.col("data_value").alias("skill_score"),
        *LINEAGE_COLUMNS,
    ]
    skills = tagged_union(
        {
            family: tables[name]
            .filter(F.col("data_value").isNotNull())
            .select(*columns)
            for family, name in (
                ("essential", "onet_essential_skills"),
                ("transferable", "onet_transferable_skills"),
            )
        },
        "skill_family",
    )
    if ranked:
        skills = dense_rank(
            skills,
            groups=["onet_soc_code", "skill_family", "scale_id"],
            order=[("skill_score", "desc"), ("skill_name", "asc")],
            name="skill_rank",
        )
    return _with_title(skills, tables).select(
        "onet_soc_code",
        "soc_code",
        "occupation_title",
        "skill_family",
        "skill_id",
        "skill_name",
        "scale_id",
        scale_label(F.col("scale_id")).alias("scale_name"),
        "skill_score",
        *(["skill_rank"] if ranked else []),
        *LINEAGE_COLUMNS,
    )


def bridge_occupation_software(tables: Tables) -> DataFrame:
    """Distinct software items of a detailed occupation."""
    named = tables["onet_software_skills"].filter(F.col("software_name").isNotNull())
    detail = [
        "software_name",
        "element_id",
        "element_name",
        "hot_technology",
        "in_demand",
        *LINEAGE_COLUMNS,
    ]
    # Distinct items joined to distinct titles give distinct rows, and the shuffle
    # for the items carries no title text.
    items = named.select("onet_soc_code", "soc_code", *detail).distinct()
    titles = tables["onet_occupations"].select("onet_soc_code", "occupation_title")
    joined = _with_title(items, {"onet_occupations": titles.distinct()})
    return joined.select("onet_soc_code", "soc_code", "occupation_title", *detail)


def bridge_occupation_job_zone(tables: Tables) -> DataFrame:
    """Preparation level of a detailed occupation."""
    zones = tables["onet_job_zones"]
    return _with_title(zones, tables, occupation_description="description").select(
        "onet_soc_code",
        "soc_code",
        "occupation_title",
        "occupation_description",
        "job_zone",
        preparation_label(F.col("job_zone")).alias("job_zone_label"),
        *LINEAGE_COLUMNS,
    )


VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "dim_occupation": dim_occupation,
    "fact_oews_measurement": fact_oews_measurement,
    "fact_occupation_projection": fact_occupation_projection,
    "bridge_occupation_education": bridge_occupation_education,
    "bridge_occupation_skill": bridge_occupation_skill,
    "bridge_occupation_software": bridge_occupation_software,
    "bridge_occupation_job_zone": bridge_occupation_job_zone,
}


def build_views(tables: Tables) -> dict[str, DataFrame]:
    return {name: build(tables) for name, build in VIEWS.items()}


def clean_tables(
    spark: SparkSession, names: list[str], schema: str | None = None
) -> dict[str, DataFrame]:
    """Clean tables by name from the catalog."""
    return {n: spark.table(f"{schema}.{n}" if schema else n) for n in names}
