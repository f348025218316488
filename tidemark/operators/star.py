"""Star join of the fact table and its dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECENT_YEARS = 5


def is_recent() -> Column:
    """The condition behind the time dimension's ``is_recent_5y``.

    Spark prunes the fact's year partitions at run time for a comparison, not
    for a bare flag.
    """
    return F.col("years_ago") <= RECENT_YEARS


def with_time(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Inner join on the year.

    Years have four digits, so the dimension cannot exceed 10,000 rows and is
    broadcast; a filter on it prunes the fact's year partitions at run time.
    """
    return fact.join(
        F.broadcast(dim_time.drop("updated_at")), fact["time_key"] == dim_time["year"]
    )


def with_demographics(fact: DataFrame, dim_demographics: DataFrame) -> DataFrame:
    """Inner join on the key.

    Demographic codes are free text, so nothing bounds this dimension: Spark
    broadcasts it only while its stored size is under the threshold.
    """
    return fact.join(dim_demographics.drop("updated_at"), "demographic_key")


def star(
    fact: DataFrame, dim_time: DataFrame, dim_demographics: DataFrame
) -> DataFrame:
    return with_demographics(with_time(fact, dim_time), dim_demographics)
