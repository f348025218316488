"""Global row numbers without a single-partition window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.workspace import Workspace

# monotonically_increasing_id keeps the partition above bit 33, the row below.
_ROW_BITS = 33
_SLOT, _PART, _BEFORE, _KEEP = "__slot", "__part", "__before", "__keep"


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    id_col: str,
    workspace: Workspace,
    keep: Column | None = None,
) -> DataFrame:
    """Number all rows 1..n in ``order`` (ascending, NULLs last).

    Equals ``row_number() over (order by ...)`` when ``order`` is total. Rows
    are range-partitioned on the whole order, so a hot leading value is spread
    over many tasks, sorted inside each partition and stored once; the number
    is the position in the partition plus the sizes of the partitions before.

    With ``keep``, every row is counted but only kept rows are returned; the
    others travel as bare sort keys and are stored as NULLs.
    """
    ranking = [F.col(c).asc_nulls_last() for c in order]
    columns = df.columns
    if keep is None:
        shaped, payload = df, [F.col(c) for c in columns]
    else:
        shaped = df.withColumn(_KEEP, F.coalesce(keep, F.lit(False))).select(
            _KEEP,
            *[c if c in order else F.when(F.col(_KEEP), F.col(c)).alias(c) for c in columns],
        )
        payload = [F.when(F.col(_KEEP), F.col(c)).alias(c) for c in columns]
        payload.append(F.col(_KEEP))
    placed = (
        shaped.repartitionByRange(*ranking)
        .sortWithinPartitions(*ranking)
        .select(F.monotonically_increasing_id().alias(_SLOT), *payload)
    )
    # Range bounds are sampled, so the placement is stored before it is used
    # twice (for the sizes and for the rows).
    stored = workspace.store(placed, id_col)
    part = F.shiftright(_SLOT, _ROW_BITS)
    # One row per range partition: the window and the broadcast stay that small.
    sizes = stored.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_BEFORE)
    )
    rows = stored if keep is None else stored.filter(_KEEP)
    position = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        rows.withColumn(_PART, part)
        .join(F.broadcast(offsets), _PART)
        .select((F.col(_BEFORE) + position + 1).alias(id_col), *columns)
    )


def running_totals(
    df: DataFrame, order: Sequence[str], sums: Mapping[str, Column], workspace: Workspace
) -> DataFrame:
    """Add, per new name, the sum of a column over all rows before in ``order``.

    Rows are placed as in ``number_rows``; a window covers one range partition,
    and only the sums per partition meet in one task.
    """
    ranking = [F.col(c).asc_nulls_last() for c in order]
    placed = (
        df.withColumns(dict(sums))
        .repartitionByRange(*ranking)
        .sortWithinPartitions(*ranking)
        .select(F.monotonically_increasing_id().alias(_SLOT), *df.columns, *sums)
    )
    stored = workspace.store(placed, "totals").withColumn(_PART, F.shiftright(_SLOT, _ROW_BITS))
    names = {new: f"__{new}" for new in sums}
    parts = stored.groupBy(_PART).agg(*[F.sum(new).alias(names[new]) for new in sums])
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        _PART, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names.values()]
    )
    inside = Window.partitionBy(_PART).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    within = {new: F.coalesce(F.sum(new).over(inside), F.lit(0)) for new in sums}
    return (
        stored.withColumns(within)
        .join(F.broadcast(offsets), _PART)
        .select(*df.columns, *[(F.col(n) + F.col(new)).alias(new) for new, n in names.items()])
    )


def number_wanted(
    df: DataFrame,
    groups: Sequence[str],
    ties: Sequence[str],
    id_col: str,
    workspace: Workspace,
    keep: Column,
) -> DataFrame:
    """The kept rows with the numbers ``number_rows`` over ``groups`` and ``ties`` gives.

    Only groups that hold a kept row are put in order. The others count as a
    whole: rows are summed up per group (NULL is a key of its own), a running
    total over the groups says how many rows lie before each, and rows of the
    wanted groups are numbered among themselves and moved up by the difference.
    """
    counted = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("__rows"), F.bool_or(F.coalesce(keep, F.lit(False))).alias(_KEEP)
    )
    others = F.when(~F.col(_KEEP), F.col("__rows")).otherwise(0)
    skipped = running_totals(counted, groups, {"__shift": others}, workspace)
    # Stored, its size tells Spark how to join it.
    needed = workspace.store(
        skipped.filter(_KEEP).select(*[F.col(g).alias(f"__g_{g}") for g in groups], "__shift"),
        "needed",
    )
    same = [df[g].eqNullSafe(needed[f"__g_{g}"]) for g in groups]
    rows = df.join(needed, same).select(*[df[c] for c in df.columns], "__shift")
    numbered = number_rows(rows, [*groups, *ties], id_col, workspace, keep=keep)
    return numbered.select(
        (F.col(id_col) + F.col("__shift")).alias(id_col), *[F.col(c) for c in df.columns]
    )
