"""Change against the previous measurement of the same series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.operators.previous import with_previous
from tidemark.params import Params
from tidemark.workspace import Workspace

SERIES = ("indicator_name", "sex", "residence", "wealth_quintile")


def add_changes(
    classified: DataFrame,
    params: Params,
    workspace: Workspace,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """Every classified row that has a value, plus its change columns.

    The previous measurement need not be of the previous calendar year, and two
    measurements of one year follow each other in id order.
    """
    rows = with_previous(
        classified.filter(F.col("indicator_value").isNotNull()),
        series,
        ("year",),
        "indicator_id",
        {"previous_year_value": "indicator_value", "previous_year": "year"},
        workspace,
        params.hot_rows,
        params.chunk_rows,
    )
    value, previous = F.col("indicator_value"), F.col("previous_year_value")
    return rows.withColumns(
        {
            "absolute_change": value - previous,
            "percentage_change": rules.percentage_change(value, previous),
            "years_gap": F.col("year") - F.col("previous_year"),
            "trend_direction": rules.trend(value, previous),
            "is_significant_change": rules.is_significant(value, previous),
        }
    )


def yoy_changes(
    classified: DataFrame, params: Params, workspace: Workspace
) -> DataFrame:
    return add_changes(classified, params, workspace).select(
        "indicator_id",
        "indicator_name",
        "indicator_category",
        "severity_level",
        "year",
        "previous_year",
        "years_gap",
        "sex",
        "residence",
        "wealth_quintile",
        F.col("indicator_value").alias("current_value"),
        "previous_year_value",
        "absolute_change",
        "percentage_change",
        "trend_direction",
        "is_significant_change",
        "data_quality_score",
        "updated_at",
    )


def by_size_of_change(yoy: DataFrame) -> DataFrame:
    """Newest year first, then category, then the largest change."""
    return yoy.orderBy(
        F.col("year").desc_nulls_first(),
        F.col("indicator_category").asc_nulls_last(),
        F.abs("percentage_change").desc_nulls_last(),
        F.col("indicator_id").asc(),
    )
