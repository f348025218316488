"""Merkle manifest of a table by incremental witnesses.

Rows are leaves, ordered inside groups; the roots of the groups are the leaves of one
more tree. Nodes are hashed in runs of two; the last run of a level may hold one node,
which is hashed alone.

Leaves are appended one after another, block by block. Subtrees of equal height that
lie next to each other are joined as soon as both are there: that completes a sibling
for every leaf below, whose witness grows by one. A block is aligned and holds
``2**BITS`` leaves at most, so a task needs memory for one block. The blocks' roots are
leaves of the same procedure, until one block is left in a group; a leaf's path is its
own witness followed by those of the blocks above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import quoted
from tidemark.operators.numbering import number_rows
from tidemark.workspace import Workspace

#: A block has 2**BITS leaves.
BITS = 12

#: A step of a path: L or R, the side the sibling is on, and its digest; empty where
#: a node is hashed alone.
LEFT, RIGHT = "L", "R"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts' texts behind each other, as hex text."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


class Witnesses:
    """Leaves appended in order, with the siblings each of them has so far."""

    def __init__(self, n: int):
        self.digests: list[str] = []
        # Per leaf and height: 0 for none, else a node and the side it is on.
        self.steps = np.zeros((n, max(n - 1, 0).bit_length()), np.int32)
        self.open: list[tuple[int, int, int, int]] = []  # height, node, leaves from, to

    def _node(self, value: str) -> int:
        self.digests.append(value)
        return len(self.digests) - 1

    def append(self, leaf: str, at: int) -> None:
        self._add(0, self._node(leaf), at, at + 1)

    def _add(self, height: int, node: int, start: int, end: int) -> None:
        """Put a subtree behind the open ones, joining those it completes."""
        while self.open and self.open[-1][0] == height:
            _, left, first, _ = self.open.pop()
            self.steps[first:start, height] = 2 * node + 2
            self.steps[start:end, height] = 2 * left + 1
            node = self._node(_hash(self.digests[left] + self.digests[node]))
            height, start = height + 1, first
        self.open.append((height, node, start, end))

    def close(self, height: int | None = None) -> str:
        """The root once no leaf follows; with ``height``, that of a block so high."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            at, node, start, end = self.open.pop()
            self._add(at + 1, self._node(_hash(self.digests[node])), start, end)
        return self.digests[self.open[0][1]]

    def paths(self, height: int) -> pa.ListArray:
        """The witnesses of all leaves up to ``height``, level by level."""
        steps = np.zeros((len(self.steps), height), np.int32)
        high = min(height, self.steps.shape[1])
        steps[:, :high] = self.steps[:, :high]
        names = [""]
        for d in self.digests:
            names += [LEFT + d, RIGHT + d]
        values = pa.array(names, pa.string()).take(pa.array(steps.ravel()))
        offsets = np.arange(len(steps) + 1, dtype=np.int32) * height
        return pa.ListArray.from_arrays(pa.array(offsets), values)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def witnesses(leaves: Iterable[str], blocks_high: int | None = None) -> tuple[str, pa.ListArray]:
    """Root and witnesses of one block of leaves; ``blocks_high`` raises it to that
    height, as a block that isn't the only one of its group must be."""
    leaves = list(leaves)
    tree = Witnesses(len(leaves))
    for k, leaf in enumerate(leaves):
        tree.append(leaf, k)
    root = tree.close(blocks_high)
    height = tree.steps.shape[1] if blocks_high is None else blocks_high
    return root, tree.paths(height)


def _block_function(bits: int):
    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("at")
        whole = table["count"][0].as_py() > (1 << bits)
        root, paths = witnesses(table["node"].to_pylist(), bits if whole else None)
        n = table.num_rows
        return pa.table(
            {
                "grp": table["grp"],
                "at": table["at"],
                "count": table["count"],
                "steps": paths,
                "block_root": pa.array([root], pa.string()).take(pa.array([0] * n, pa.int32())),
                **{c: table[c] for c in table.column_names if c.startswith("_")},
            }
        )

    return build


def _append(nodes: DataFrame, bits: int, workspace: Workspace) -> DataFrame:
    """Witnesses of the nodes (grp, at, count, node and columns named ``_...``) inside
    their blocks, and the blocks' roots."""
    carried = [f for f in nodes.schema.fields if f.name.startswith("_")]
    schema = "grp long, at long, count long, steps array<string>, block_root string" + "".join(
        f", {f.name} {f.dataType.simpleString()}" for f in carried
    )
    block = F.shiftright("at", bits).alias("block")
    return workspace.store(
        nodes.groupBy("grp", block).applyInArrow(_block_function(bits), schema), "witnesses"
    )


def _forest(nodes: DataFrame, bits: int, workspace: Workspace):
    """Levels of blocks over the nodes, and per group its root and the level it ends at.

    Level 0 is about the nodes, level k + 1 about the roots of level k's blocks in
    groups of more than one block. Only the largest count reaches the driver.
    """
    levels, roots = [], []
    most = 1 << bits
    while True:
        level = _append(nodes, bits, workspace)
        levels.append(level)
        heads = level.filter(F.col("at") % most == 0)
        ended = F.col("count") <= most
        roots.append(
            heads.filter(ended).select(
                "grp", F.col("block_root").alias("root"), F.lit(len(levels) - 1).alias("level")
            )
        )
        largest = level.agg(F.max("count")).first()[0]
        if largest is None or largest <= most:
            break
        nodes = heads.filter(~ended).select(
            "grp",
            F.shiftright("at", bits).alias("at"),
            F.ceil(F.col("count") / most).alias("count"),
            F.col("block_root").alias("node"),
        )
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return levels, found


def _above(levels: Sequence[DataFrame], roots: DataFrame, bits: int, workspace: Workspace):
    """Per block of level 0 (grp, block) the steps above it: those of the blocks over it,
    then ``upper`` of its group. ``roots`` has grp, level and upper."""
    upper = None
    for k in reversed(range(len(levels))):
        own = roots.filter(F.col("level") == k).select(
            "grp", F.lit(0).cast("long").alias("block"), "upper"
        )
        if upper is not None:
            up = upper.select(
                F.col("grp").alias("g"), F.col("block").alias("b"), F.col("upper").alias("u")
            )
            level = levels[k + 1]
            inside = level.join(
                up, (level["grp"] == up["g"]) & (F.shiftright(level["at"], bits) == up["b"])
            )
            own = own.unionByName(
                inside.select(
                    "grp", F.col("at").alias("block"), F.concat("steps", "u").alias("upper")
                )
            )
        # Stored, its size tells Spark how to join it.
        upper = workspace.store(own, "above")
    return upper


def manifest(
    rows: DataFrame,
    workspace: Workspace,
    leaf: Column,
    order: Sequence[str],
    group: str,
    carry: Mapping[str, Column] | None = None,
    bits: int = BITS,
) -> DataFrame:
    """The leaves of a manifest: the columns of ``order`` and ``group``, those of
    ``carry``, and ``leaf``, ``subroot``, ``root`` and ``path``.

    ``leaf`` is a digest as hex text. Leaves of a group ascend by ``order``, nulls
    first, equal ones by leaf; groups ascend by ``group``, a null first, texts by their
    bytes. Rows that agree in all of these are equal, and their places don't matter.
    ``path`` leads from the leaf to the root: per level ``L`` or ``R`` and the sibling's
    digest, or an empty text where a node has none. Without rows there are no leaves.

    Rows are placed by ranges of (group, order), so a large group spreads over tasks.
    Texts don't travel: only digests and the columns named here do.
    """
    named = {f"_k{k}": quoted(c) for k, c in enumerate(order)}
    extra = {f"_c{k}": v for k, v in enumerate((carry or {}).values())}
    present = {f"_p{k}": quoted(c).isNotNull() for k, c in enumerate(order)}
    leaves = rows.select(
        quoted(group).isNotNull().alias("_p"),
        quoted(group).alias("_g"),
        *[c.alias(k) for k, c in {**present, **named, **extra}.items()],
        leaf.alias("_leaf"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    keys = [x for k in range(len(order)) for x in (f"_p{k}", f"_k{k}")]
    numbered = number_rows(leaves, ["_p", "_g", *keys, "_leaf", "_tie"], "n", workspace)
    spans = numbered.groupBy("_p", "_g").agg(
        F.min("n").alias("first"), F.count(F.lit(1)).alias("count")
    )
    groups = workspace.store(number_rows(spans, ["_p", "_g"], "grp", workspace), "groups")
    sized = groups.select(F.col("_g").alias("g"), "grp", "first", "count")
    nodes = numbered.join(sized, F.col("_g").eqNullSafe(F.col("g"))).select(
        "grp",
        (F.col("n") - F.col("first")).alias("at"),
        "count",
        F.col("_leaf").alias("node"),
        "_g", "_leaf", *named, *extra,
    )
    levels, roots = _forest(nodes, bits, workspace)
    roots = workspace.store(roots, "roots")
    n_groups = groups.count()
    tops, top = _forest(
        roots.select(
            F.lit(0).cast("long").alias("grp"),
            (F.col("grp") - 1).alias("at"),
            F.lit(n_groups).cast("long").alias("count"),
            F.col("root").alias("node"),
            F.col("grp").alias("_grp"),
            F.col("level").alias("_level"),
            F.col("root").alias("_root"),
        ),
        bits,
        workspace,
    )
    root = top.first()
    none = F.array().cast("array<string>")
    over = _above(tops, top.withColumn("upper", none), bits, workspace)
    over = over.select("block", F.col("upper").alias("u"))
    uppers = tops[0].join(over, F.shiftright(tops[0]["at"], bits) == over["block"])
    uppers = workspace.store(
        uppers.select(
            F.col("_grp").alias("grp"),
            F.col("_level").alias("level"),
            F.concat("steps", "u").alias("upper"),
            F.col("_root").alias("subroot"),
        ),
        "uppers",
    )
    above = _above(levels, uppers, bits, workspace)
    subroots = uppers.select(F.col("grp").alias("sub"), "subroot")
    above = above.join(subroots, above["grp"] == subroots["sub"]).select(
        F.col("grp").alias("g"), F.col("block").alias("b"), "upper", "subroot"
    )
    found = levels[0].join(
        above, (F.col("grp") == F.col("g")) & (F.shiftright("at", bits) == F.col("b"))
    )
    return found.select(
        *[F.col(k).alias(c) for k, c in zip(named, order, strict=True)],
        *([] if group in order else [F.col("_g").alias(group)]),
        *[F.col(k).alias(c) for k, c in zip(extra, carry or {}, strict=True)],
        F.col("_leaf").alias("leaf"),
        "subroot",
        F.lit(root["root"] if root else None).cast("string").alias("root"),
        F.concat("steps", "upper").alias("path"),
    )


def proof(path: Column) -> Column:
    """SHA-256 of a path's siblings behind each other, without the sides."""
    there = F.filter(path, lambda step: step != "")
    siblings = F.transform(there, lambda step: F.substring(step, 2, 64))
    return F.sha2(F.array_join(siblings, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def up(node, step):
        sibling = F.substring(step, 2, 64)
        left, right = step.startswith(LEFT), step.startswith(RIGHT)
        return F.sha2(
            F.when(left, F.concat(sibling, node))
            .when(right, F.concat(node, sibling))
            .otherwise(node),
            256,
        )

    return F.aggregate(path, leaf, up)
