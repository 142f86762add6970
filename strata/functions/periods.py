"""Source months and survey period codes as dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period codes of the observation files.
PERIOD_PATTERN = r"^(A01|M(0[1-9]|1[0-3])|S0[1-2])$"
ANNUAL_PERIODS = ("A01", "M13")
MONTH_PATTERN = r"^M(0[1-9]|1[0-2])$"
HALF_YEAR_PATTERN = r"^S0[1-2]$"


def source_month(value: Column) -> Column:
    """First day of an ``MM/yyyy`` month; an impossible month is NULL."""
    day = F.try_to_date(F.concat(F.lit("01/"), value), "dd/MM/yyyy")
    # Text in another form is turned away before the parser has to fail on it.
    return F.when(value.rlike("^(0[1-9]|1[0-2])/[0-9]{4}$"), day)


def period_type(period: Column) -> Column:
    return (
        F.when(period.isin(*ANNUAL_PERIODS), "annual")
        .when(period.rlike(MONTH_PATTERN), "monthly")
        .when(period.rlike(HALF_YEAR_PATTERN), "semiannual")
        .otherwise("other")
    )


def observation_date(year: Column, period: Column) -> Column:
    """First day of the period; NULL for other codes and impossible years."""
    month = (
        F.when(period.isin(*ANNUAL_PERIODS) | (period == "S01"), F.lit(1))
        .when(period == "S02", F.lit(7))
        .when(
            period.rlike(MONTH_PATTERN), F.substring(period, 2, 2).try_cast("int")
        )
    )
    return F.when(
        month.isNotNull() & year.between(1, 9999), F.make_date(year, month, F.lit(1))
    )
