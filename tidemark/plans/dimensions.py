"""Time and demographic dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import recode, title_case
from tidemark.operators.numbering import number_rows
from tidemark.operators.star import RECENT_YEARS
from tidemark.params import Params
from tidemark.workspace import Workspace

TRIPLE = ("sex", "residence", "wealth_quintile")

# Labels of the known demographic codes.
SEX_LABELS = {"male": "Male", "female": "Female", "both": "Both Sexes"}
RESIDENCE_LABELS = {"urban": "Urban", "rural": "Rural", "total": "All Areas"}
WEALTH_LABELS = {
    "q1": "Poorest (Q1)",
    "q2": "Second Quintile (Q2)",
    "q3": "Middle Quintile (Q3)",
    "q4": "Fourth Quintile (Q4)",
    "q5": "Richest (Q5)",
    "total": "All Wealth Groups",
}


def distinct_years(staged: DataFrame) -> DataFrame:
    return staged.select("year").filter(F.col("year").isNotNull()).distinct()


def distinct_triples(staged: DataFrame) -> DataFrame:
    return staged.select(*TRIPLE).dropna().distinct()


def _bucket(year: Column, width: int) -> Column:
    return (year - F.pmod(year, F.lit(width))).cast("long")


def dim_time(staged: DataFrame, params: Params) -> DataFrame:
    year, now = F.col("year"), params.current_year
    decade, half = _bucket(year, 10), _bucket(year, 5)
    # An upper limit on "recent" is absent on purpose: later years count too.
    return distinct_years(staged).select(
        "year",
        decade.alias("decade_start"),
        (decade + 9).alias("decade_end"),
        F.concat(decade.cast("string"), F.lit("s")).alias("decade_label"),
        half.alias("five_year_period_start"),
        (half + 4).alias("five_year_period_end"),
        (now - year).alias("years_ago"),
        F.when(year == now, "Current year")
        .when(year == now - 1, "Last year")
        .when(year >= now - RECENT_YEARS, "Recent (5 years)")
        .when(year >= now - 10, "Medium term (10 years)")
        .otherwise("Historical (>10 years)")
        .alias("time_category"),
        (year == now).alias("is_current_year"),
        (year >= now - RECENT_YEARS).alias("is_recent_5y"),
        (year >= now - 10).alias("is_recent_10y"),
        F.lit(params.run_ts).alias("updated_at"),
    )


def dim_demographics(
    staged: DataFrame, params: Params, workspace: Workspace
) -> DataFrame:
    sex, residence, wealth = (F.col(c) for c in TRIPLE)
    total_sex, total_residence = sex == "both", residence == "total"
    total_wealth = wealth == "total"
    numbered = number_rows(
        distinct_triples(staged), TRIPLE, "demographic_key", workspace
    )
    return numbered.select(
        "demographic_key",
        *TRIPLE,
        recode(sex, SEX_LABELS, title_case(sex)).alias("sex_label"),
        recode(residence, RESIDENCE_LABELS, title_case(residence)).alias(
            "residence_label"
        ),
        recode(wealth, WEALTH_LABELS, title_case(wealth)).alias(
            "wealth_quintile_label"
        ),
        total_sex.alias("is_total_sex"),
        total_residence.alias("is_total_residence"),
        total_wealth.alias("is_total_wealth"),
        (total_sex & total_residence & total_wealth).alias("is_total_population"),
        wealth.isin("q1", "q2").alias("is_low_wealth"),
        (residence == "rural").alias("is_rural"),
        F.lit(params.run_ts).alias("updated_at"),
    )
