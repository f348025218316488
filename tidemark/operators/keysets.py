"""Sets of whole-number keys as bitmaps: exact, mergeable, one bit a key.

Numbers are cut into buckets of 32,768, and a bucket's keys are one bitmap of 4 KB.
Tasks make bitmaps of what they read and merge them, so keys that are stored in order
travel as bits and not as rows. Keys should fill a good part of their range, as numbers
given out by this library do; of scattered ones every key would have a bitmap of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import Workspace

#: A range this many times the number of keys still takes fewer bytes as bitmaps.
SPARSE = 32


def _bucket(key: Column) -> Column:
    return F.bitmap_bucket_number(key.cast("long"))


def is_dense(df: DataFrame, column: str) -> bool:
    """Whether a column's values take few enough bits; one row reaches the driver."""
    key = F.col(column).cast("decimal(20,0)")
    found = df.agg(
        F.count(key).alias("n"), (F.max(key) - F.min(key) + 1).alias("range")
    ).first()
    return found["n"] > 0 and found["range"] <= SPARSE * found["n"]


def key_sets(df: DataFrame, column: str) -> DataFrame:
    """Per bucket its rows, its keys as a bitmap and their number; NULLs are a bucket
    of their own without keys."""
    key = F.col(column).cast("long")
    return (
        df.select(_bucket(key).alias("bucket"), F.bitmap_bit_position(key).alias("bit"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("rows"), F.bitmap_construct_agg("bit").alias("bits"))
        .withColumn("keys", F.when(F.col("bucket").isNull(), 0).otherwise(F.bitmap_count("bits")))
    )


def in_buckets(df: DataFrame, column: str, buckets: DataFrame) -> DataFrame:
    """Rows whose key lies in one of the (stored) buckets."""
    wanted = buckets.select(F.col("bucket").alias("__bucket"))
    return df.join(wanted, _bucket(F.col(column)) == F.col("__bucket"), "left_semi")


def repeated_keys(
    df: DataFrame, column: str, workspace: Workspace
) -> tuple[DataFrame, DataFrame | None]:
    """Rows per bucket, and the repeated keys (v, n), if there are any.

    Only rows of buckets with more rows than keys are grouped by key.
    """
    sets = workspace.store(key_sets(df, column).drop("bits"), "keys")
    surplus = sets.filter(F.col("bucket").isNotNull() & (F.col("rows") > F.col("keys")))
    if surplus.isEmpty():
        return sets, None
    found = (
        in_buckets(df, column, workspace.store(surplus, "surplus"))
        .groupBy(F.col(column).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    return sets, found


def missing_keys(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, workspace: Workspace
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the child per bucket, and its rows without a parent, if there are any.

    The two sets are compared bucket by bucket; only rows of buckets in which the
    child has a key more are joined with the parent's keys there.
    """
    sides = (
        key_sets(child, column)
        .select("bucket", "bits", "rows", F.lit(0).cast("long").alias("known"))
        .unionByName(
            key_sets(parent, parent_column)
            .filter("bucket IS NOT NULL")
            .select("bucket", "bits", F.lit(0).cast("long").alias("rows"), F.col("keys").alias("known"))
        )
    )
    both = sides.groupBy("bucket").agg(
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"),
    )
    sets = workspace.store(both, "keys")
    more = sets.filter(F.col("bucket").isNotNull() & (F.col("all") > F.col("known")))
    if more.isEmpty():
        return sets, None
    more = workspace.store(more, "missing")
    known = in_buckets(parent, parent_column, more).select(F.col(parent_column).alias("known"))
    rows = in_buckets(child, column, more)
    return sets, rows.join(known, rows[column] == known["known"], "left_anti")
