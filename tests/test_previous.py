import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.previous import with_previous
from tidemark.workspace import Workspace

KEYS, ORDER = ["g"], ["year"]
VALUES = {"prev": "v", "prev_year": "year"}


def brute_force(rows):
    """{id: (previous value, previous year)} by walking each sorted group."""
    out, last = {}, {}
    for g, year, i, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out[i] = last.get(g, (None, None))
        last[g] = (v, year)
    return out


def collected(df):
    return {r.i: (r.prev, r.prev_year) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(1, 3001):
        g = "hot" if i % 3 else f"g{rng.randrange(40)}"
        out.append((g, 2000 + rng.randrange(6), i, rng.randrange(100)))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "g string, year int, i long, v int")


@pytest.mark.parametrize("chunk_rows", [1, 7, 100, 10_000])
def test_chunks_equal_brute_force(spark, df, rows, chunk_rows):
    with Workspace(spark) as w:
        out = with_previous(df, KEYS, ORDER, "i", VALUES, w, 0, chunk_rows)
        assert out.columns == [*df.columns, *VALUES]
        assert collected(out) == brute_force(rows)


@pytest.mark.parametrize("hot_rows", [0, 50, 1000, 1_000_000])
def test_hot_and_cold_groups_together(spark, df, rows, hot_rows):
    with Workspace(spark) as w:
        out = with_previous(df, KEYS, ORDER, "i", VALUES, w, hot_rows, 64)
        assert out.count() == len(rows)
        assert collected(out) == brute_force(rows)


def test_chunks_stay_small(df):
    """No window partition of the hot group exceeds the chunk size."""
    sizes = df.groupBy("g", "year", F.floor(F.col("i") / 64)).count()
    assert sizes.agg(F.max("count")).head()[0] <= 64


def test_null_values_are_carried(spark):
    rows = [("a", 2000, 1, None), ("a", 2001, 2, 5), ("a", 2001, 3, None), ("a", 2002, 9, 1)]
    df = spark.createDataFrame(rows, "g string, year int, i long, v int")
    with Workspace(spark) as w:
        out = with_previous(df, KEYS, ORDER, "i", VALUES, w, 0, 1)
        assert collected(out) == brute_force(rows)
