"""Previous row of a group, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.workspace import Workspace

_CHUNK, _ROW, _PREV, _CARRY = "__chunk", "__row", "__prev", "__carry"
_HOT, _LAST = "__hot", "__last"


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    id_col: str,
    values: Mapping[str, str],
    workspace: Workspace,
    hot_rows: int,
    chunk_rows: int,
) -> DataFrame:
    """Add, per new name, the value the preceding row of the group holds.

    Groups are ``keys``; rows are ordered by ``order`` then ``id_col``, which
    must be a unique integer. Keys and order must not be NULL.

    Group sizes are counted first (pre-aggregated in the map tasks). Groups up
    to ``hot_rows`` are one window partition each; larger ones are cut into
    chunks of consecutive ids, which share ``id_col div chunk_rows`` and so have
    at most that many rows.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    # At most rows/hot_rows groups are hot. Stored, their size decides how Spark
    # joins them; a join it does not broadcast is split by AQE where skewed.
    hot = workspace.store(sizes.filter(F.col("__n") > hot_rows).select(*keys), "hot")
    if hot.isEmpty():
        return _one_window(df, keys, order, id_col, values)
    marked = df.join(hot.withColumn(_HOT, F.lit(True)), list(keys), "left")
    return _chunked(marked, df.columns, keys, order, id_col, values, workspace, chunk_rows)


def _one_window(df, keys, order, id_col, values):
    w = Window.partitionBy(*keys).orderBy(*order, id_col)
    return df.select(
        "*", *[F.lag(src).over(w).alias(new) for new, src in values.items()]
    )


def _chunked(
    marked: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    id_col: str,
    values: Mapping[str, str],
    workspace: Workspace,
    chunk_rows: int,
) -> DataFrame:
    """One window over all rows, and the last row of each chunk carried to the next.

    Rows of other groups have no chunk; their partition is the group. The
    windowed rows are stored: the tails are filtered from them, so hot rows are
    scanned and sorted once, and carried over one row per chunk.
    """
    chunk = F.when(F.col(_HOT), F.call_function("div", F.col(id_col), F.lit(chunk_rows)))
    cut = {f"__cut_{c}": F.when(F.col(_HOT), F.col(c)) for c in order}
    row = F.struct(*[F.col(s).alias(n) for n, s in values.items()])
    rows = marked.withColumns({_CHUNK: chunk, _ROW: row, **cut})
    inside = Window.partitionBy(*keys, *cut, _CHUNK).orderBy(*order, id_col)
    within = rows.withColumns(
        {
            _PREV: F.lag(_ROW).over(inside),
            _LAST: F.col(_CHUNK).isNotNull() & F.lead(F.lit(1)).over(inside).isNull(),
        }
    )
    within = workspace.store(within.select(*columns, _CHUNK, _ROW, _PREV, _LAST), "chunks")
    place = [*keys, *order, _CHUNK]
    across = Window.partitionBy(*keys).orderBy(*order, _CHUNK)
    tails = within.filter(_LAST).select(*place, F.lag(_ROW).over(across).alias(_CARRY))
    carried = workspace.store(tails.filter(F.col(_CARRY).isNotNull()), "carried")
    found = F.coalesce(_PREV, _CARRY)
    return within.join(carried, place, "left").select(
        *columns, *[found[n].alias(n) for n in values]
    )
