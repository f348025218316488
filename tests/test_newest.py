"""Newest partitions first."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.newest import newest_partitions


@pytest.fixture
def stored(spark, tmp_path):
    rows = [(y, k, (y * k) % 7) for y in range(1990, 2010) for k in range(5)]
    path = str(tmp_path / "facts")
    df = spark.createDataFrame(rows, "year int, k int, v int")
    df.write.partitionBy("year").parquet(path)
    return spark.read.parquet(path)


def years_read(df, column="year"):
    """The years of the scan's partition filter."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    df.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")
    scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    (filters,) = {f for f in scans if f"{column}#" in f}
    listed = re.search(rf"{column}#\d+L? (?:= (\d+)|IN \(([\d, ]+)\))", filters)
    assert listed, filters
    return {int(y) for y in (listed[1] or listed[2]).split(",")}


def test_one_year_is_enough(stored):
    out = newest_partitions(stored.filter("k = 3"), "year", range(1990, 2010), 1)
    assert years_read(out) == {2009}
    assert [r.year for r in out.collect()] == [2009]


@pytest.mark.parametrize("k", [1, 3, 8, 10**6])
@pytest.mark.parametrize("condition", ["v = 3", "year < 1993 AND k = 1", "v > 100", "true"])
def test_the_first_rows_are_there(stored, k, condition):
    order = [F.desc("year"), F.asc("k")]
    rows = stored.filter(condition)
    years = [r.year for r in stored.select("year").distinct().collect()]
    out = newest_partitions(rows, "year", years, k)
    assert out.orderBy(*order).limit(k).collect() == rows.orderBy(*order).limit(k).collect()


def test_no_partitions(stored):
    assert newest_partitions(stored, "year", [], 3).count() == 0


def test_latest_measurement_reads_the_newest_years_only(spark):
    from tidemark.plans import dashboard
    from workload import registry

    w = registry.session(spark, "/root/testdata/sf0.001").warehouse
    all_years = {r.year for r in w.dim_time.select("year").collect()}
    out = dashboard.stunting_kpi(w)
    latest, read = out.first().measurement_year, years_read(out, "time_key")
    assert latest in read and len(read) < len(all_years)
    newer = sum(y > latest for y in all_years)
    assert len(read) <= 2 * newer + 1
