"""The fact table: one row per in-scope observation that has a value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.numbering import number_rows
from tidemark.params import Params
from tidemark.plans.dimensions import TRIPLE
from tidemark.plans.yoy import add_changes
from tidemark.workspace import Workspace

# Columns of the fact table, in order.
FACT_COLUMNS = (
    "fact_key",
    "time_key",
    "demographic_key",
    "indicator_id",
    "indicator_name",
    "indicator_code",
    "indicator_category",
    "severity_level",
    "indicator_value",
    "value_lower_ci",
    "value_upper_ci",
    "ci_width",
    "previous_year_value",
    "absolute_change",
    "percentage_change",
    "trend_direction",
    "is_significant_change",
    "is_missing_value",
    "has_data_quality_issue",
    "data_quality_score",
    "updated_at",
)


def build_fact(
    classified: DataFrame,
    dim_time: DataFrame,
    dim_demographics: DataFrame,
    params: Params,
    workspace: Workspace,
) -> DataFrame:
    """Number the valued rows by year, name and demographic, then id.

    Numbers come first: their order is known before the previous measurement
    is, and range bounds are then sampled from a plain scan. The demographic dimension is built from the same staging table, so it knows
    every triple, and its keys rank triples by sex, residence and wealth. One
    integer thus stands in for three texts in both shuffles. Change columns come
    from the same pass, so no join by id is needed.
    """
    keyed = classified.join(
        dim_demographics.select("demographic_key", *TRIPLE), list(TRIPLE), "left"
    ).drop(*TRIPLE, "updated_at")
    numbered = number_rows(
        keyed.filter(F.col("indicator_value").isNotNull()),
        ["year", "indicator_name", "demographic_key", "indicator_id"],
        "fact_key",
        workspace,
    )
    changed = add_changes(
        numbered, params, workspace, ("indicator_name", "demographic_key")
    )
    timed = changed.join(
        # at most 10,000 four-digit years
        F.broadcast(dim_time.select(F.col("year").alias("time_key"))),
        changed["year"] == F.col("time_key"),
        "left",
    )
    return timed.withColumn("updated_at", F.lit(params.run_ts)).select(*FACT_COLUMNS)
