"""Pre-aggregated KPIs over recent years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import PERCENT, disparity_band
from tidemark.operators.exact import mean, merged, total
from tidemark.operators.star import is_recent
from tidemark.params import Params
from tidemark.plans.dimensions import RESIDENCE_LABELS, WEALTH_LABELS

SUBGROUP = (
    "indicator_category",
    "sex_label",
    "residence_label",
    "wealth_quintile_label",
)
GAP = ("indicator_category", "year", "sex_label")
URBAN, RURAL = RESIDENCE_LABELS["urban"], RESIDENCE_LABELS["rural"]


def recent_cells(
    fact: DataFrame, dim_time: DataFrame, dim_demographics: DataFrame
) -> DataFrame:
    """Mergeable aggregates per subgroup and recent year.

    Both the subgroup aggregates and the equity gap derive from these cells, so
    the fact table is read once. Facts are summed up by their keys before the
    dimensions are joined, which keeps the joins as small as the result.
    """
    value, pct = F.col("indicator_value"), F.col("percentage_change")
    recent = dim_time.filter(is_recent()).select("year")
    sums = (
        fact.join(F.broadcast(recent), fact["time_key"] == recent["year"])
        .groupBy("indicator_category", "year", "demographic_key")
        .agg(
            total(value).alias("value_total"),
            F.min(value).alias("value_min"),
            F.max(value).alias("value_max"),
            total(pct, PERCENT).alias("pct_total"),
            F.count(F.lit(1)).alias("rows_n"),
        )
    )
    labels = dim_demographics.select(
        "demographic_key", *SUBGROUP[1:], "is_low_wealth", "is_rural"
    )
    return sums.join(labels, "demographic_key")


def subgroup_aggregates(cells: DataFrame) -> DataFrame:
    low, high = F.min("value_min"), F.max("value_max")
    return cells.groupBy(*SUBGROUP).agg(
        mean(merged("value_total"), 2).alias("avg_indicator_value"),
        F.round(low, 2).alias("min_indicator_value"),
        F.round(high, 2).alias("max_indicator_value"),
        F.round(high - low, 2).alias("value_range"),
        mean(merged("pct_total"), 4, PERCENT).alias("avg_percentage_change"),
        F.sum("rows_n").alias("measurement_count"),
        F.max("year").alias("most_recent_year"),
        F.bool_or("is_low_wealth").alias("includes_low_wealth"),
        F.bool_or("is_rural").alias("includes_rural"),
    )


def equity_gap(cells: DataFrame) -> DataFrame:
    """Highest urban minus highest rural value where both exist."""
    sides = (
        cells.filter(F.col("wealth_quintile_label") == WEALTH_LABELS["total"])
        .groupBy(*GAP)
        .pivot("residence_label", [URBAN, RURAL])
        .agg(F.max("value_max"))
        .withColumnsRenamed({URBAN: "urban_value", RURAL: "rural_value"})
    )
    return sides.dropna(subset=["urban_value", "rural_value"]).withColumn(
        "urban_rural_gap", F.col("urban_value") - F.col("rural_value")
    )


def kpi_summary(cells: DataFrame, params: Params) -> DataFrame:
    gaps = equity_gap(cells).withColumnRenamed("year", "most_recent_year")
    return (
        subgroup_aggregates(cells)
        .join(gaps, ["indicator_category", "sex_label", "most_recent_year"], "left")
        .select(
            *SUBGROUP,
            "avg_indicator_value",
            "min_indicator_value",
            "max_indicator_value",
            "value_range",
            "avg_percentage_change",
            "measurement_count",
            "most_recent_year",
            "includes_low_wealth",
            "includes_rural",
            "urban_value",
            "rural_value",
            "urban_rural_gap",
            disparity_band(F.col("urban_rural_gap")).alias("disparity_level"),
            F.lit(params.run_ts).alias("updated_at"),
        )
    )
