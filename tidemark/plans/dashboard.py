"""The sixteen dashboard queries.

Each takes the warehouse and returns a sorted DataFrame. Sorts end in a unique
key, so limits always pick the same rows; NULL placement is spelled out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import PERCENT
from tidemark.functions.text import recode
from tidemark.operators import star
from tidemark.operators.exact import average, mean, merged, total
from tidemark.operators.newest import newest_partitions
from tidemark.params import Params
from tidemark.plans.dimensions import (
    RESIDENCE_LABELS,
    SEX_LABELS,
    TRIPLE,
    WEALTH_LABELS,
)


@dataclass(frozen=True)
class Warehouse:
    fact: DataFrame
    dim_time: DataFrame
    dim_demographics: DataFrame
    kpi: DataFrame
    params: Params

    def star(self) -> DataFrame:
        return star.star(self.fact, self.dim_time, self.dim_demographics)


BOTH = SEX_LABELS["both"]
URBAN_RURAL = (RESIDENCE_LABELS["urban"], RESIDENCE_LABELS["rural"])
MALE_FEMALE = (SEX_LABELS["male"], SEX_LABELS["female"])
# Categories of the wealth gradient.
GRADIENT = ("Stunting", "Underweight")
# Categories of the pivot, in column order.
PIVOTED = ("Stunting", "Wasting", "Underweight", "Anaemia")


def _is(column: str, value) -> Column:
    return F.col(column) == value


def _up(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _down(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def stunting_trend(w: Warehouse) -> DataFrame:
    """Stunting of the whole population by year, with its bounds."""
    return (
        w.star()
        .filter(
            _is("indicator_category", "Stunting")
            & F.col("is_total_population")
            & _is("severity_level", "Overall")
        )
        .orderBy(*_up("year", "fact_key"))
        .select(
            "year",
            F.col("indicator_value").alias("stunting_percentage"),
            F.col("value_lower_ci").alias("lower_bound"),
            F.col("value_upper_ci").alias("upper_bound"),
        )
    )


def mortality_by_sex(w: Warehouse) -> DataFrame:
    return (
        w.star()
        .filter(
            _is("indicator_category", "Mortality")
            & F.col("is_total_residence")
            & F.col("is_total_wealth")
        )
        .orderBy(*_up("year", "sex_label", "fact_key"))
        .select("year", "sex_label", F.col("indicator_value").alias("mortality_rate"))
    )


def category_trend(w: Warehouse) -> DataFrame:
    """Average of each category per year for the whole population."""
    return (
        w.star()
        .filter(
            F.col("is_total_population")
            & _is("severity_level", "Overall")
            & (F.col("year") >= w.params.recent_min_year)
        )
        .groupBy("year", "indicator_category")
        .agg(average(F.col("indicator_value")).alias("avg_value"))
        .orderBy(*_up("year", "indicator_category"))
    )


def _recent_average(w: Warehouse, label: str, condition: Column) -> DataFrame:
    return (
        w.star()
        .filter(star.is_recent() & condition)
        .groupBy("indicator_category", label)
        .agg(average(F.col("indicator_value")).alias("avg_value"))
    )


def urban_rural(w: Warehouse) -> DataFrame:
    return _recent_average(
        w,
        "residence_label",
        F.col("residence_label").isin(*URBAN_RURAL)
        & _is("sex_label", BOTH)
        & F.col("is_total_wealth")
        & _is("severity_level", "Overall"),
    ).orderBy(*_up("indicator_category", "residence_label"))


def wealth_gradient(w: Warehouse) -> DataFrame:
    """Averages from the poorest to the richest; unknown quintiles come last."""
    label = F.col("wealth_quintile_label")
    ranks = {WEALTH_LABELS[f"q{n}"]: str(n) for n in range(1, 6)}
    rank = recode(label, ranks, F.lit(None).cast("string"))
    return _recent_average(
        w,
        "wealth_quintile_label",
        (label != WEALTH_LABELS["total"])
        & _is("sex_label", BOTH)
        & F.col("is_total_residence")
        & F.col("indicator_category").isin(*GRADIENT),
    ).orderBy(
        *_up("indicator_category"),
        rank.asc_nulls_last(),
        *_up("wealth_quintile_label"),
    )


def sex_gap(w: Warehouse) -> DataFrame:
    return _recent_average(
        w,
        "sex_label",
        F.col("sex_label").isin(*MALE_FEMALE)
        & F.col("is_total_residence")
        & F.col("is_total_wealth"),
    ).orderBy(*_up("indicator_category", "sex_label"))


def stunting_kpi(w: Warehouse) -> DataFrame:
    """The latest stunting measurement of the whole population.

    Facts are partitioned by year, and only the newest years up to the first one with
    such a measurement are read.
    """
    measured = w.star().filter(
        _is("indicator_category", "Stunting")
        & F.col("is_total_population")
        & _is("severity_level", "Overall")
    )
    # Four-digit years: at most 10,000 of them.
    years = [r["year"] for r in w.dim_time.select("year").collect()]
    return (
        newest_partitions(measured, "time_key", years, 1)
        .orderBy(_down("year"), *_up("fact_key"))
        .limit(1)
        .select(
            F.col("indicator_value").alias("current_stunting_rate"),
            F.col("percentage_change").alias("yoy_change"),
            "trend_direction",
            F.col("year").alias("measurement_year"),
        )
    )


def mortality_kpi(w: Warehouse) -> DataFrame:
    """One row even when nothing matches: a NULL average and a count of zero."""
    return (
        w.star()
        .filter(
            _is("indicator_category", "Mortality")
            & F.col("is_total_population")
            & star.is_recent()
        )
        .agg(
            average(F.col("indicator_value"), 1).alias("avg_mortality_rate"),
            F.count(F.lit(1)).alias("data_points"),
            F.min("year").alias("from_year"),
            F.max("year").alias("to_year"),
        )
    )


def largest_gap(w: Warehouse) -> DataFrame:
    return (
        w.kpi.filter(F.col("urban_rural_gap").isNotNull() & _is("sex_label", BOTH))
        .orderBy(
            F.abs("urban_rural_gap").desc_nulls_first(),
            *_up("indicator_category", "residence_label", "wealth_quintile_label"),
        )
        .limit(1)
        .select(
            "indicator_category",
            F.col("urban_rural_gap").alias("gap_percentage"),
            "urban_value",
            "rural_value",
            "disparity_level",
        )
    )


def trend_scorecard(w: Warehouse) -> DataFrame:
    """Per category, how many series improve, worsen or stay."""
    return (
        star.with_demographics(w.fact, w.dim_demographics)
        .filter(F.col("is_total_population") & F.col("percentage_change").isNotNull())
        .groupBy("indicator_category")
        .agg(
            F.count_if(_is("trend_direction", "Decreasing")).alias(
                "improving_indicators"
            ),
            F.count_if(_is("trend_direction", "Increasing")).alias(
                "worsening_indicators"
            ),
            F.count_if(_is("trend_direction", "Stable")).alias("stable_indicators"),
            average(F.col("percentage_change"), 2, PERCENT).alias("avg_change_pct"),
        )
        .orderBy(*_up("indicator_category"))
    )


def quality_summary(w: Warehouse) -> DataFrame:
    return (
        w.fact.groupBy("indicator_category")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.sum(F.when(F.col("is_missing_value"), 1).otherwise(0)).alias(
                "missing_values"
            ),
            average(F.col("data_quality_score"), 1).alias("avg_quality_score"),
            F.count_if("is_significant_change").alias("significant_changes"),
        )
        .orderBy(*_up("indicator_category"))
    )


def yoy_detail(w: Warehouse) -> DataFrame:
    return (
        w.star()
        .filter(
            F.col("residence_label").isin(*URBAN_RURAL)
            & _is("sex_label", BOTH)
            & F.col("is_total_wealth")
            & F.col("percentage_change").isNotNull()
        )
        .orderBy(
            _down("year"), *_up("indicator_category", "residence_label", "fact_key")
        )
        .select(
            "year",
            "indicator_category",
            "residence_label",
            F.col("indicator_value").alias("current_value"),
            "previous_year_value",
            "absolute_change",
            "percentage_change",
            "is_significant_change",
        )
    )


def top_improvements(w: Warehouse) -> DataFrame:
    """The five steepest recent decreases."""
    return (
        w.star()
        .filter(
            (F.col("percentage_change") < 0)
            & _is("sex_label", BOTH)
            & star.is_recent()
        )
        .orderBy(*_up("percentage_change", "fact_key"))
        .limit(5)
        .select(
            "indicator_name",
            "year",
            "residence_label",
            "indicator_value",
            "percentage_change",
            "absolute_change",
        )
    )


def severe_cases(w: Warehouse) -> DataFrame:
    return (
        w.star()
        .filter(
            _is("severity_level", "Severe")
            & _is("sex_label", BOTH)
            & F.col("is_total_wealth")
        )
        .orderBy(_down("year"), *_up("indicator_name", "fact_key"))
        .select(
            "year",
            "indicator_name",
            F.col("indicator_value").alias("severe_percentage"),
            "residence_label",
        )
    )


def indicator_pivot(w: Warehouse) -> DataFrame:
    """Highest value per category, side by side, where the first two exist.

    Facts of the four categories are reduced to one row per cell before the
    dimensions are joined.
    """
    cells = (
        w.fact.filter(
            _is("severity_level", "Overall") & F.col("indicator_category").isin(*PIVOTED)
        )
        .groupBy("time_key", "demographic_key", "indicator_category")
        .agg(F.max("indicator_value").alias("highest"))
    )
    return (
        star.star(cells, w.dim_time, w.dim_demographics)
        .groupBy("year", "demographic_key")
        .pivot("indicator_category", list(PIVOTED))
        .agg(F.max("highest"))
        .withColumnsRenamed({c: c.lower() for c in PIVOTED})
        .dropna(subset=["stunting", "wasting"])
        .orderBy(_down("year"), *_up("demographic_key"))
    )


def coverage(w: Warehouse) -> DataFrame:
    """How much each year covers.

    Facts are summed up per (year, category, demographic) first, so the
    distinct counts and the joins work on that small table.
    """
    cells = w.fact.groupBy("time_key", "indicator_category", "demographic_key").agg(
        F.count(F.lit(1)).alias("rows_n"),
        total(F.col("data_quality_score")).alias("score_total"),
    )
    return (
        star.star(cells, w.dim_time, w.dim_demographics)
        .groupBy("year")
        .agg(
            F.count_distinct("indicator_category").alias("indicators_count"),
            # Codes are joined without a separator, so different triples that
            # read the same count once.
            F.count_distinct(F.concat_ws("", *TRIPLE)).alias(
                "demographic_combinations"
            ),
            F.sum("rows_n").alias("total_measurements"),
            mean(merged("score_total"), 1).alias("avg_quality"),
        )
        .orderBy(_down("year"))
    )


# Key of each query -> function.
QUERIES = {
    "bi_stunting_trend": stunting_trend,
    "bi_mortality_by_sex": mortality_by_sex,
    "bi_category_trend": category_trend,
    "bi_urban_rural": urban_rural,
    "bi_wealth_gradient": wealth_gradient,
    "bi_sex_gap": sex_gap,
    "bi_stunting_kpi": stunting_kpi,
    "bi_mortality_kpi": mortality_kpi,
    "bi_largest_gap": largest_gap,
    "bi_trend_scorecard": trend_scorecard,
    "bi_quality_summary": quality_summary,
    "bi_yoy_detail": yoy_detail,
    "bi_top_improvements": top_improvements,
    "bi_severe": severe_cases,
    "bi_indicator_pivot": indicator_pivot,
    "bi_coverage": coverage,
}
