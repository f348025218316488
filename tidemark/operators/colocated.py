"""Tables stored in buckets of a key, so that joins on it move no rows.

Rows are dealt to files by the key's hash once, when they are written. Two tables with
as many buckets of keys of one type are then joined file by file, however often.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import Workspace


def write_colocated(
    df: DataFrame, name: str, key: str, buckets: int, workspace: Workspace
) -> DataFrame:
    """Store ``df`` in ``buckets`` files by hash of ``key``, each sorted by it.

    Choose as many buckets as make a file fit a task; tables to be joined need the same
    number. The table's name is known to this session only; its files are the
    workspace's.
    """
    spark, table = df.sparkSession, f"tidemark_{name}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", workspace.path(name))
        .saveAsTable(table)
    )
    return spark.table(table)


def join_colocated(
    left: DataFrame, right: DataFrame, key: str, also: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on ``key``, which is unique on the right, with ``also`` equal as well.

    Spark moves rows again if a join has more keys than the tables' buckets. So the
    others are compared behind the join: where they differ, the right's columns are
    NULL (``left``) or the row goes (``inner``). A NULL equals nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"no co-located join of kind {how}")
    values = [c for c in right.columns if c != key and c not in also]
    renamed = right.select(
        F.col(key).alias("__key"),
        *[F.col(c).alias(f"__{c}") for c in also],
        *[F.col(c).alias(f"__{c}") for c in values],
    )
    joined = left.join(renamed, left[key] == renamed["__key"], how)
    equal: Column = F.col("__key").isNotNull()
    for c in also:
        equal = equal & (left[c] == F.col(f"__{c}"))
    if how == "inner":
        joined = joined.filter(equal)
    found = [F.when(equal, F.col(f"__{c}")).alias(c) for c in values]
    return joined.select(*[left[c] for c in left.columns], *found)
