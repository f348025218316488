"""Manifests against trees built level by level."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.workspace import Workspace


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([hashed(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        side = merkle.LEFT if other < at else merkle.RIGHT
        out.append(side + level[other] if other < len(level) else "")
        at //= 2
    return out


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def expected(rows):
    """(lang, id, leaf) -> (subroot, root, path), as a sorted list."""
    groups = {}
    for key, lang, text in rows:
        leaf = hashed(field(text))
        groups.setdefault(lang, []).append(((key is not None, key or 0, leaf), key, leaf))
    trees = {g: tree([leaf for *_, leaf in sorted(v, key=lambda x: x[0])]) for g, v in groups.items()}
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, (_, key, leaf) in enumerate(sorted(groups[g], key=lambda x: x[0])):
            steps = path(trees[g], at) + path(top, k)
            out.append((g, key, leaf, trees[g][-1][0], top[-1][0], steps))
    return sorted(out, key=repr)


def found(spark, rows, bits):
    df = spark.createDataFrame(rows, "id long, lang string, text string").repartition(3)
    clashing = {c: F.lit(c) for c in ("n", "grp", "_g", "root", "odd.name", "_leaf")}
    with Workspace(spark) as w:
        out = merkle.manifest(
            df.withColumns(clashing), w, merkle.digest(merkle.field(F.col("text"))),
            ["id"], "lang", {"more": F.length("text")}, bits=bits,
        )
        out = out.withColumns(
            {
                "folded": merkle.folded(F.col("leaf"), F.col("path")),
                "proof": merkle.proof(F.col("path")),
            }
        ).collect()
    for r in out:
        assert r.folded == r.root
        assert r.proof == hashed(*[step[1:] for step in r.path])
    return sorted([(r.lang, r.id, r.leaf, r.subroot, r.root, r.path) for r in out], key=repr)


@pytest.mark.parametrize("bits", [1, 3, 12])
@pytest.mark.parametrize("sizes", [[1], [1, 5, 17], [2, 3, 4, 8, 9, 31, 1, 1, 1]])
def test_every_block_size_gives_the_same_tree(spark, bits, sizes):
    rows = [
        (3 * i if i else None, f"ü{g}" if g else None, f"text {g} {i}")
        for g, n in enumerate(sizes)
        for i in range(n)
    ]
    random.Random(1).shuffle(rows)
    assert found(spark, rows, bits) == expected(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (None, None, None), (None, "", ""),
            (None, None, "long " * 200_000), (2, "a", None)]
    for bits in (1, 12):
        assert found(spark, rows, bits) == expected(rows)


def test_empty_table(spark):
    assert found(spark, [], 12) == []


def test_a_changed_leaf_leads_elsewhere(spark):
    df = spark.createDataFrame([(k, "a", str(k)) for k in range(9)], "id long, lang string, text string")
    with Workspace(spark) as w:
        out = merkle.manifest(df, w, merkle.digest(F.col("text")), ["id"], "lang", bits=2)
        other = merkle.folded(merkle.digest(F.lit("other")), F.col("path"))
        assert out.filter(other == F.col("root")).count() == 0


def test_witnesses_grow_as_siblings_complete():
    tree = merkle.Witnesses(4)
    for k, seen in enumerate([0, 1, 1, 2]):
        tree.append(hashed(str(k)), k)
        assert (tree.steps[0] > 0).sum() == seen
    assert len(tree.open) == 1
