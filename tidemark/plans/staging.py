"""Raw extract rows to typed, cleaned observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse, text
from tidemark.operators.numbering import number_rows, number_wanted
from tidemark.params import Params
from tidemark.workspace import Workspace

TAG_ROW = "#indicator+code"  # fixed value: marks a second header row


def drop_tag_rows(raw: DataFrame) -> DataFrame:
    """Also drops rows without a code, as SQL's <> does."""
    return raw.filter(F.col("indicator_code") != TAG_ROW)


def number_raw(
    raw: DataFrame, params: Params, workspace: Workspace, wanted_only: bool = False
) -> DataFrame:
    """Number data rows by raw indicator, location and period.

    With ``wanted_only`` the numbers are those of the whole table, but only the
    rows staging keeps come out, and only groups that have any are sorted.
    """
    rows, groups = drop_tag_rows(raw), ["indicator", "location", "period"]
    if wanted_only:
        return number_wanted(
            rows, groups, params.tie_keys, "indicator_id", workspace, wanted(params)
        )
    return number_rows(rows, [*groups, *params.tie_keys], "indicator_id", workspace)


def wanted(params: Params):
    return (
        (text.clean(F.col("location_code")) == params.focus_location)
        & parse.parse_year(F.col("period")).isNotNull()
        & F.col("indicator").isNotNull()
    )


def clean_observations(numbered: DataFrame, params: Params) -> DataFrame:
    """Parse every field of numbered raw rows."""
    parsed = numbered.select(
        "indicator_id",
        text.clean(F.col("indicator")).alias("indicator_name"),
        text.clean(F.col("indicator_code")).alias("indicator_code"),
        text.clean(F.col("location")).alias("location"),
        text.clean(F.col("location_code")).alias("location_code"),
        text.clean(F.col("period")).alias("period"),
        parse.parse_year(F.col("period")).alias("year"),
        text.default_dimension(F.col("sex"), "both").alias("sex"),
        text.default_dimension(F.col("residence"), "total").alias("residence"),
        text.default_dimension(F.col("wealth_quintile"), "total").alias(
            "wealth_quintile"
        ),
        parse.parse_value(F.col("value_numeric"), F.col("value")).alias("parsed"),
        parse.lower_bound(F.col("value_ci")).alias("value_lower_ci"),
        parse.upper_bound(F.col("value_ci")).alias("value_upper_ci"),
        F.col("value").alias("display"),
        "value_numeric",
    )
    flagged = parsed.withColumns(
        {
            "is_missing_value": parse.is_missing(F.col("parsed"), F.col("display")),
            "has_data_quality_issue": parse.used_fallback(
                F.col("parsed"), F.col("value_numeric")
            ),
            "updated_at": F.lit(params.run_ts),
        }
    )
    return flagged.drop("display", "value_numeric").withColumnRenamed("parsed", "value")


def stage(raw: DataFrame, params: Params, workspace: Workspace) -> DataFrame:
    """Observations of the focus location that have a year and a name."""
    if params.ids_after_filter:
        numbered = number_raw(raw.filter(wanted(params)), params, workspace)
    else:
        numbered = number_raw(raw, params, workspace, wanted_only=True)
    return clean_observations(numbered, params)


def malformed_numbers(raw: DataFrame) -> DataFrame:
    """Data rows with text made of digits and dots that is no storable number.

    Their value is NULL (or the fallback's, or rounded) in staging, and so are
    the bounds of their interval; this is where they can be found.
    """
    broken = (
        parse.unstorable_number(F.col("value_numeric"))
        | parse.unstorable_number(F.col("value"))
        | parse.unstorable_bound(F.col("value_ci"))
    )
    return drop_tag_rows(raw).filter(F.coalesce(broken, F.lit(False)))
