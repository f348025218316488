"""In-scope observations with category, severity and quality score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.workspace import Workspace


def classify(staged: DataFrame) -> DataFrame:
    name = F.col("indicator_name")
    scoped = (
        staged.filter(rules.in_scope(name))
        .withColumn("indicator_category", rules.category(name))
        .filter(F.col("indicator_category") != rules.OTHER)
    )
    return _scored(scoped.withColumn("severity_level", rules.severity(name)))


def name_dictionary(staged: DataFrame) -> DataFrame:
    """Each name in scope once, with its category and severity."""
    names = staged.select("indicator_name").distinct()
    name = F.col("indicator_name")
    return (
        names.filter(rules.in_scope(name))
        .withColumns(
            {"indicator_category": rules.category(name), "severity_level": rules.severity(name)}
        )
        .filter(F.col("indicator_category") != rules.OTHER)
    )


def classify_by_dictionary(staged: DataFrame, workspace: Workspace) -> DataFrame:
    """``classify`` with the keyword tests run once per distinct name.

    The dictionary is stored, so its size tells Spark whether to broadcast it; a large
    one is joined by shuffle. Worth it where names repeat a lot and rules are many.
    """
    names = workspace.store(name_dictionary(staged), "names").withColumnRenamed(
        "indicator_name", "__name"
    )
    return _scored(staged.join(names, staged["indicator_name"] == names["__name"]))


def _scored(scoped: DataFrame) -> DataFrame:
    measured = scoped.select(
        "indicator_id",
        "indicator_name",
        "indicator_code",
        "year",
        "indicator_category",
        "severity_level",
        "sex",
        "residence",
        "wealth_quintile",
        F.col("value").alias("indicator_value"),
        "value_lower_ci",
        "value_upper_ci",
        (F.col("value_upper_ci") - F.col("value_lower_ci")).alias("ci_width"),
        "is_missing_value",
        "has_data_quality_issue",
        "updated_at",
    )
    return measured.withColumn(
        "data_quality_score",
        rules.quality_score(
            F.col("is_missing_value"),
            F.col("has_data_quality_issue"),
            F.col("ci_width"),
        ),
    )
