"""Declarative data checks.

A check gives one row: check, table, column, status, failing_rows, total_rows.
The ``*_failures`` functions give the offending rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import CATEGORIES
from tidemark.operators.keysets import missing_keys, repeated_keys
from tidemark.workspace import Workspace


def _report(
    df: DataFrame, check, table: str, column, failing: Column, total: Column
) -> DataFrame:
    column = F.lit(column) if isinstance(column, str) else column
    check = F.lit(check) if isinstance(check, str) else check
    return df.select(
        check.alias("check"),
        F.lit(table).alias("table"),
        column.alias("column"),
        F.when(failing == 0, "pass").otherwise("fail").alias("status"),
        failing.cast("long").alias("failing_rows"),
        total.cast("long").alias("total_rows"),
    )


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """One row per column, all columns counted in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(
            *[
                F.struct(F.lit(c).alias("name"), F.count_if(F.col(c).isNull()).alias("bad"))
                for c in columns
            ]
        ).alias("found"),
    ).select("n", F.inline("found"))
    return _report(counted, "not_null", table, F.col("name"), F.col("bad"), F.col("n"))


def _per_value(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Repeated values with their number of rows; NULLs may repeat."""
    repeated = (F.col("n") > 1) & F.col("v").isNotNull()
    return _per_value(df, column).filter(repeated).withColumnRenamed("v", column)


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Counts the values that repeat."""
    repeated = (F.col("n") > 1) & F.col("v").isNotNull()
    counted = _per_value(df, column).agg(
        F.count_if(repeated).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    )
    return _report(counted, "unique", table, column, F.col("bad"), F.col("n"))


def check_unique_number(
    df: DataFrame, table: str, column: str, workspace: Workspace
) -> DataFrame:
    """``check_unique`` of a whole number that fills a good part of its range.

    Keys travel as bitmaps; rows do only where a key repeats. Numbers given out in
    order stay in order in their files, so this costs a bit a row.
    """
    sets, repeated = repeated_keys(df, column, workspace)
    counted = sets.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
    if repeated is None:
        counted = counted.withColumn("bad", F.lit(0))
    else:
        bad = workspace.store(repeated.agg(F.count(F.lit(1)).alias("bad")), "repeated")
        counted = counted.join(F.broadcast(bad))  # one row each
    return _report(counted, "unique", table, column, F.col("bad"), F.col("n"))


def accepted_values_failures(
    df: DataFrame, column: str, accepted: Sequence[str]
) -> DataFrame:
    """Rows with another value; NULL passes."""
    return df.filter(~F.col(column).isin(*accepted))


def check_accepted_values(
    df: DataFrame, table: str, column: str, accepted: Sequence[str]
) -> DataFrame:
    counted = df.agg(
        F.count_if(~F.col(column).isin(*accepted)).alias("bad"),
        F.count(F.lit(1)).alias("n"),
    )
    return _report(counted, "accepted_values", table, column, F.col("bad"), F.col("n"))


def relationships_failures(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows whose non-NULL key has no parent."""
    known = parent.select(F.col(parent_column).alias("known"))
    return child.filter(F.col(column).isNotNull()).join(
        known, child[column] == known["known"], "left_anti"
    )


def check_relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows are counted per key before the join, so a hot key is one row
    of it. NULL keys pass."""
    keys = _per_value(child, column)
    known = parent.select(F.col(parent_column).alias("known")).distinct()
    orphan = F.col("v").isNotNull() & F.col("known").isNull()
    counted = keys.join(known, keys["v"] == known["known"], "left").agg(
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("bad"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
    )
    return _report(counted, "relationships", table, column, F.col("bad"), F.col("n"))


def check_relationships_number(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    workspace: Workspace,
) -> DataFrame:
    """``check_relationships`` of whole numbers that fill a good part of their range.

    Both tables' keys travel as bitmaps, and rows do only where one is missing: the
    parent may be of any size.
    """
    sets, orphans = missing_keys(child, column, parent, parent_column, workspace)
    counted = sets.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
    if orphans is None:
        counted = counted.withColumn("bad", F.lit(0))
    else:
        bad = workspace.store(orphans.agg(F.count(F.lit(1)).alias("bad")), "orphans")
        counted = counted.join(F.broadcast(bad))  # one row each
    return _report(counted, "relationships", table, column, F.col("bad"), F.col("n"))


def range_failures(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(~F.col(column).between(low, high))


def check_range(df: DataFrame, table: str, column: str, low, high) -> DataFrame:
    """Rows outside [low, high]; NULL passes. Not part of the suite."""
    counted = df.agg(
        F.count_if(~F.col(column).between(low, high)).alias("bad"),
        F.count(F.lit(1)).alias("n"),
    )
    return _report(counted, "range", table, column, F.col("bad"), F.col("n"))


# The suite: what each warehouse table promises.
NOT_NULL = {
    "stg_observations": ("indicator_id", "year"),
    "int_classified": ("indicator_category", "data_quality_score"),
    "fact_observations": ("fact_key", "time_key"),
    "dim_time": ("year",),
    "dim_demographics": ("demographic_key",),
    "mart_kpi_summary": ("indicator_category",),
}
UNIQUE = {
    "stg_observations": "indicator_id",
    "fact_observations": "fact_key",
    "dim_time": "year",
    "dim_demographics": "demographic_key",
}
# Keys given out without gaps, and stored in order.
NUMBERED = {"fact_observations"}
ACCEPTED = {"int_classified": ("indicator_category", CATEGORIES)}
FOREIGN_KEYS = (
    ("fact_observations", "time_key", "dim_time", "year"),
    ("fact_observations", "demographic_key", "dim_demographics", "demographic_key"),
)


def _column_checks(tables: Mapping[str, DataFrame], table: str) -> DataFrame:
    """The not-null and accepted-values checks of a table, counted in one pass."""
    rules = [("not_null", c, F.col(c).isNull()) for c in NOT_NULL.get(table, ())]
    if table in ACCEPTED:
        column, values = ACCEPTED[table]
        rules.append(("accepted_values", column, ~F.col(column).isin(*values)))
    counted = tables[table].agg(
        F.count(F.lit(1)).alias("n"),
        F.array(
            *[
                F.struct(
                    F.lit(check).alias("check"),
                    F.lit(column).alias("name"),
                    F.count_if(failing).alias("bad"),
                )
                for check, column, failing in rules
            ]
        ).alias("found"),
    ).select("n", F.inline("found"))
    return _report(counted, F.col("check"), table, F.col("name"), F.col("bad"), F.col("n"))


def _key_counts(
    tables: Mapping[str, DataFrame], table: str, workspace: Workspace
) -> DataFrame:
    """Rows per combination of a table's foreign keys, with the NULLs of its
    other checked columns: small, stored, and all that those checks need."""
    keys = [column for t, column, _, _ in FOREIGN_KEYS if t == table]
    others = [c for c in NOT_NULL.get(table, ()) if c not in keys]
    counted = tables[table].groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in others],
    )
    return workspace.store(counted, f"{table}-keys")


def _checks_by_key(
    tables: Mapping[str, DataFrame], table: str, workspace: Workspace
) -> list[DataFrame]:
    counts = _key_counts(tables, table, workspace)
    total = F.coalesce(F.sum("rows"), F.lit(0))
    reports = []
    for column in NOT_NULL.get(table, ()):
        foreign = any((table, column) == key[:2] for key in FOREIGN_KEYS)
        nulls = F.when(F.col(column).isNull(), F.col("rows")) if foreign else F.col(column)
        found = counts.agg(F.coalesce(F.sum(nulls), F.lit(0)).alias("bad"), total.alias("n"))
        reports.append(_report(found, "not_null", table, column, F.col("bad"), F.col("n")))
    for child, column, parent, parent_column in FOREIGN_KEYS:
        if child == table:
            known = tables[parent].select(F.col(parent_column).alias("known")).distinct()
            joined = counts.join(known, counts[column] == known["known"], "left")
            orphan = F.col(column).isNotNull() & F.col("known").isNull()
            found = joined.agg(
                F.coalesce(F.sum(F.when(orphan, F.col("rows"))), F.lit(0)).alias("bad"),
                total.alias("n"),
            )
            reports.append(_report(found, "relationships", table, column, F.col("bad"), F.col("n")))
    return reports


def run_suite(tables: Mapping[str, DataFrame], workspace: Workspace) -> DataFrame:
    """All sixteen checks, one row each; no table is read more than twice.

    Uniqueness takes a pass of its own, in which rows of the fact stay where they are
    unless a key repeats. A table with foreign keys is counted by
    them once, and the other checks work on those counts.
    """
    children = {table for table, *_ in FOREIGN_KEYS}
    reports = [_column_checks(tables, t) for t in NOT_NULL if t not in children]
    for table in sorted(children):
        reports += _checks_by_key(tables, table, workspace)
    for t, column in UNIQUE.items():
        if t in NUMBERED:
            reports.append(check_unique_number(tables[t], t, column, workspace))
        else:
            reports.append(check_unique(tables[t], t, column))
    return reduce(DataFrame.unionByName, reports)


def failing_rows(
    tables: Mapping[str, DataFrame], check: str, table: str, column: str
) -> DataFrame:
    """What a check of the suite found: rows, or repeated values with their count."""
    df = tables[table]
    if check == "not_null":
        return not_null_failures(df, column)
    if check == "unique":
        return unique_failures(df, column)
    if check == "accepted_values":
        return accepted_values_failures(df, column, ACCEPTED[table][1])
    parent, key = next(k[2:] for k in FOREIGN_KEYS if k[:2] == (table, column))
    return relationships_failures(df, column, tables[parent], key)


class EmptyExtract(ValueError):
    """The raw table holds no rows."""


def completeness(raw: DataFrame) -> DataFrame:
    """Rows, and rows with an indicator and with a value.

    Without both columns only rows are counted; the other counts are NULL.
    """
    skip = not {"indicator", "value"} <= set(raw.columns)

    def filled(column: str) -> Column:
        return F.lit(None).cast("long") if skip else F.count(column)

    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        filled("indicator").alias("non_null_indicators"),
        filled("value").alias("non_null_values"),
    )


def validate_raw(raw: DataFrame) -> DataFrame:
    """Raise on an empty raw table, then report its completeness."""
    if raw.isEmpty():
        raise EmptyExtract("the raw table is empty")
    return completeness(raw)
