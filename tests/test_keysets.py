"""Bitmaps of keys against grouping and joining rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keysets, quality
from tidemark.workspace import Workspace


@pytest.fixture
def workspace(spark):
    with Workspace(spark) as w:
        yield w


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long").repartition(3)


def result(df):
    return tuple(df.first())


CASES = {
    "none": [],
    "nulls": [None, None],
    "once": list(range(1, 70_000)),
    "edges": [0, -1, 1, 32767, 32768, 32769, -32768, -32767, 65536, 2**31],
    "twice": [5, 5, 40_000, 40_000, 40_000, None, 7, 0, 0, -3, -3],
}


@pytest.mark.parametrize("name", CASES)
def test_unique(spark, workspace, name):
    df = keys(spark, CASES[name])
    fast = result(quality.check_unique_number(df, "t", "k", workspace))
    assert fast == result(quality.check_unique(df, "t", "k"))


@pytest.mark.parametrize("child", CASES)
@pytest.mark.parametrize("parent", ["none", "edges", "twice"])
def test_relationships(spark, workspace, child, parent):
    df, known = keys(spark, CASES[child]), keys(spark, CASES[parent]).toDF("p")
    fast = result(quality.check_relationships_number(df, "t", "k", known, "p", workspace))
    assert fast == result(quality.check_relationships(df, "t", "k", known, "p"))


def test_random_keys(spark, workspace):
    rng = random.Random(3)
    for _ in range(3):
        child = [rng.choice([None, rng.randint(-50, 100_000)]) for _ in range(3000)]
        parent = [rng.randint(-50, 100_000) for _ in range(50_000)]
        df, known = keys(spark, child), keys(spark, parent).toDF("p")
        assert result(quality.check_unique_number(df, "t", "k", workspace)) == result(
            quality.check_unique(df, "t", "k")
        )
        fast = quality.check_relationships_number(df, "t", "k", known, "p", workspace)
        assert result(fast) == result(quality.check_relationships(df, "t", "k", known, "p"))


def test_rows_of_sound_keys_are_not_shuffled(spark, workspace):
    """A million keys in order travel as some thirty bitmaps."""
    df = spark.range(1, 1_000_001, numPartitions=4).withColumnRenamed("id", "k")
    sets = keysets.key_sets(df, "k")
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    before = plan[plan.index("Exchange") :]
    assert "partial_bitmap_construct_agg" in before  # rows are folded below it
    assert sets.count() == 31
    found, repeated = keysets.repeated_keys(df, "k", workspace)
    assert repeated is None
    assert found.agg(F.sum("keys")).first()[0] == 1_000_000


def test_dense(spark):
    assert keysets.is_dense(keys(spark, [1, 2, 90]), "k")
    assert not keysets.is_dense(keys(spark, [1, 10**9]), "k")
    assert not keysets.is_dense(keys(spark, []), "k")
    assert not keysets.is_dense(keys(spark, [-(2**63), 2**63 - 1]), "k")
