import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.numbering import number_rows, number_wanted, running_totals
from tidemark.workspace import Workspace

ORDER = ["a", "b", "k"]


def expected(df):
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])
    return {r.k: r.n for r in df.withColumn("n", F.row_number().over(w)).collect()}


def numbered(df, workspace, **options):
    out = number_rows(df, ORDER, "n", workspace, **options)
    return {r.k: r.n for r in out.collect()}


@pytest.fixture
def workspace(spark):
    with Workspace(spark) as w:
        yield w


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows share one leading key, a tenth have a NULL there."""
    rng = random.Random(7)
    rows = []
    for k in range(4000):
        a = "hot" if k % 2 else rng.choice(["a", "z", None, "m"])
        rows.append((k, a, rng.choice([None, "x", "y"]), f"payload {k}"))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k long, a string, b string, text string")


def test_equals_global_row_number(hot, workspace):
    assert numbered(hot, workspace) == expected(hot)


def test_does_not_depend_on_partitioning(spark, hot, workspace):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(numbered(hot.repartition(int(n)), workspace))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_kept_rows_carry_the_numbers_of_the_whole_table(hot, workspace):
    keep = F.col("b") == "x"
    out = number_rows(hot, ORDER, "n", workspace, keep=keep)
    assert out.columns == ["n", *hot.columns]
    whole = expected(hot)
    rows = out.collect()
    assert {r.k for r in rows} == {r.k for r in hot.filter(keep).collect()}
    assert all(whole[r.k] == r.n and r.text == f"payload {r.k}" for r in rows)


def test_hot_key_is_spread(spark, hot):
    """The placement splits the hot leading key over several partitions."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with Workspace(spark) as w:
            number_rows(hot, ORDER, "n", w)
            stored = spark.read.parquet(f"{w.root}/n-*")
            sizes = [
                r["count"]
                for r in stored.groupBy(F.shiftright("__slot", 33)).count().collect()
            ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) > 4
    assert max(sizes) < 0.3 * sum(sizes)


def test_empty_table(spark, hot, workspace):
    assert numbered(hot.filter("false"), workspace) == {}


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "", "a", "B", "é"]), st.sampled_from([None, "0", "1"])
        ),
        min_size=1,
        max_size=40,
    )
)
def test_is_a_permutation(spark, pairs):
    rows = [(k, a, b) for k, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "k long, a string, b string")
    with Workspace(spark) as w:
        out = numbered(df, w)
    assert sorted(out.values()) == list(range(1, len(rows) + 1))
    assert out == expected(df)


def test_running_totals(hot, workspace):
    groups = hot.groupBy("a", "b").count()
    out = running_totals(groups, ["a", "b"], {"before": F.col("count")}, workspace)
    w = Window.orderBy(F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last())
    exact = F.sum("count").over(w.rowsBetween(Window.unboundedPreceding, -1))
    exact = groups.withColumn("before", F.coalesce(exact, F.lit(0)))
    assert sorted(map(repr, out.collect())) == sorted(map(repr, exact.collect()))


@pytest.mark.parametrize("wanted", ["b = 'x' AND k % 3 = 0", "a IS NULL", "false", "true", "null"])
def test_numbers_of_wanted_groups(hot, workspace, wanted):
    """One hot group, NULL keys, groups with no wanted row, and NULL conditions."""
    out = number_wanted(hot, ["a", "b"], ["k"], "n", workspace, F.expr(wanted).cast("boolean"))
    assert out.columns == ["n", *hot.columns]
    whole, rows = expected(hot), out.collect()
    assert {r.k for r in rows} == {r.k for r in hot.filter(F.expr(wanted).cast("boolean")).collect()}
    assert all(whole[r.k] == r.n and r.text == f"payload {r.k}" for r in rows)


def test_only_wanted_groups_are_sorted(spark, hot):
    with Workspace(spark) as w:
        number_wanted(hot, ["a", "b"], ["k"], "n", w, F.expr("a = 'm' AND b = 'x'"))
        placed = spark.read.parquet(f"{w.root}/n-*").count()
    assert placed == hot.filter("a = 'm' AND b = 'x'").count()
