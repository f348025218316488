"""The first rows by descending partition, without a scan of all partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_partitions(
    rows: DataFrame, partition: str, values: Sequence[int], k: int
) -> DataFrame:
    """``rows`` of the newest partitions that hold ``k`` of them together, or of all.

    ``partition`` is the column that ``rows``' files are partitioned by, and ``values``
    are those to be looked at, in any order. One partition is read first, then twice as
    many each time, and only until ``k`` rows are known. Whatever is ordered by
    ``partition`` descending has its first k rows in the result.
    """
    values, found, taken, step = sorted(set(values), reverse=True), 0, 0, 1
    while found < k and taken < len(values):
        batch = values[taken : taken + step]
        # Rows beyond the k-th needn't be counted.
        found += rows.filter(F.col(partition).isin(batch)).limit(k - found).count()
        taken, step = taken + len(batch), 2 * step
    return rows.filter(F.col(partition).isin(values[:taken]))
