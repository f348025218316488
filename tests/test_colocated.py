"""Joins of bucketed tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.colocated import join_colocated, write_colocated
from tidemark.workspace import Workspace
from workload import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_rows_move(spark, no_broadcast):
    s = registry.session(spark, "/root/testdata/sf0.001")
    valued, changes, keys = registry.colocated_changes(s)
    joined = join_colocated(valued, changes, "indicator_id", keys)
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    by_all = valued.join(changes, ["indicator_id", *keys], "left")
    assert "Exchange" in plan(by_all)
    columns = sorted(joined.columns)
    found, expected = (sorted(map(tuple, d.select(columns).collect()), key=repr) for d in (joined, by_all))
    assert found == expected and len(found) > 100


@pytest.mark.parametrize("how", ["left", "inner"])
def test_other_keys_count_too(spark, how):
    left = spark.createDataFrame(
        [(1, "a", 1), (2, "b", 2), (3, None, 3), (4, "d", 4), (None, "e", 5), (4, "x", 6)],
        "id long, k string, v int",
    )
    right = spark.createDataFrame(
        [(1, "a", 10), (2, "z", 20), (3, None, 30), (4, "d", None), (None, "e", 50)],
        "id long, k string, w int",
    )
    with Workspace(spark) as w:
        stored = [write_colocated(d, n, "id", 3, w) for d, n in ((left, "l"), (right, "r"))]
        found = join_colocated(*stored, "id", ["k"], how)
        expected = left.join(right, ["id", "k"], how)
        assert found.columns == ["id", "k", "v", "w"]
        assert sorted(found.collect(), key=repr) == sorted(
            expected.select("id", "k", "v", "w").collect(), key=repr
        )
    with pytest.raises(ValueError, match="outer"):
        join_colocated(left, right, "id", [], "outer")


def test_dictionary_is_as_long_as_its_names(spark):
    from tidemark.plans.classified import classify, classify_by_dictionary, name_dictionary

    staged = registry.session(spark, "/root/testdata/sf0.001").tables["stg_observations"]
    names = name_dictionary(staged)
    assert names.count() < staged.select("indicator_name").distinct().count()
    assert names.groupBy("indicator_name").count().filter("count > 1").isEmpty()
    with Workspace(spark) as w:
        found = classify_by_dictionary(staged, w)
        assert found.columns == classify(staged).columns
        assert found.exceptAll(classify(staged)).isEmpty()
        assert found.agg(F.count("*")).first() == classify(staged).agg(F.count("*")).first()
