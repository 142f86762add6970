"""The metric layer over the projection fact: counters, rankings and facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from strata.operators.metrics import MetricView

# Only detailed rows count, or group totals would be added again.
DETAILED_ROWS = "occupation_type = 'Line item'"
FACETS = (
    "occupation_title",
    "occupation_type",
    "typical_entry_education",
    "growth_direction",
    "on_the_job_training",
)
DIMENSIONS = (
    *FACETS,
    "employment_change_percent",
    "median_annual_wage",
    "annual_openings",
)
MEASURES = {
    "total_base_employment": "sum(employment_base_year)",
    "total_projected_employment": "sum(employment_projected_year)",
    "total_annual_openings": "sum(annual_openings)",
    "avg_median_wage": "avg(median_annual_wage)",
}


def projection_metrics(fact: DataFrame) -> MetricView:
    return MetricView(
        source=fact,
        filter=DETAILED_ROWS,
        measures=MEASURES,
        dimensions={d: d for d in DIMENSIONS},
    )


def counters(view: MetricView, facets=None) -> DataFrame:
    """All totals in one pass."""
    return view.query(list(MEASURES), facets=facets)


def fastest_growing(view: MetricView, n: int = 15, facets=None) -> DataFrame:
    shown = ["employment_change_percent", "occupation_title"]
    return view.top_rows("employment_change_percent", shown, n, facets)


def most_openings(view: MetricView, n: int = 15, facets=None) -> DataFrame:
    return view.top_groups("total_annual_openings", ["occupation_title"], n, facets)


def highest_paying(view: MetricView, n: int = 15, facets=None) -> DataFrame:
    shown = ["median_annual_wage", "occupation_title"]
    return view.top_rows("median_annual_wage", shown, n, facets)


def wage_and_growth(view: MetricView, facets=None) -> DataFrame:
    return view.rows(["median_annual_wage", "employment_change_percent"], facets)


def details(view: MetricView, facets=None) -> DataFrame:
    def known_education(dimensions: dict[str, Column]) -> Column:
        return dimensions["typical_entry_education"].isNotNull()

    return view.rows(
        [
            "occupation_title",
            "typical_entry_education",
            "median_annual_wage",
            "employment_change_percent",
            "annual_openings",
            "on_the_job_training",
        ],
        facets,
        known_education,
    )


def facet_values(view: MetricView, chosen=None) -> DataFrame:
    return view.facet_counts(FACETS, chosen)
