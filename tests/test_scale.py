"""What grows with the input is spread over tasks, built once, and only when needed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import job
from tidemark.sources import infer
from tidemark.workspace import Workspace, is_written
from workload import registry
from workload.derived import PARAMS, derived_raw

ORDERS = 4000


@pytest.fixture(scope="module")
def one_row_group(spark, tmp_path_factory):
    """The four tables, each in one file of one row group."""
    folder = str(tmp_path_factory.mktemp("tables"))
    key = F.col("id")
    made = {
        "orders": spark.range(1, ORDERS + 1).select(
            key.alias("o_orderkey"),
            (key % 50).alias("o_custkey"),
            F.date_add(F.lit(dt.date(1995, 1, 1)), (key % 2500).cast("int")).alias("o_orderdate"),
            F.when(key % 2 == 0, "F").otherwise("O").alias("o_orderstatus"),
            F.lit("1-URGENT").alias("o_orderpriority"),
            (key * 12.34).alias("o_totalprice"),
        ),
        "customer": spark.range(50).select(
            key.alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"),
            (key % 5).alias("c_nationkey"),
        ),
        "nation": spark.range(5).select(
            key.alias("n_nationkey"), (key % 2).alias("n_regionkey")
        ),
        "region": spark.createDataFrame([(0, "AFRICA"), (1, "EUROPE")], "r_regionkey long, r_name string"),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_rows_of_one_row_group_go_to_many_tasks(spark, one_row_group):
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least, "1k")
    try:
        raw = derived_raw(spark, one_row_group)
        sizes = raw.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(least)
    assert sum(r["count"] for r in sizes) == ORDERS
    assert len(sizes) > 2
    assert max(r["count"] for r in sizes) < ORDERS / 2


def test_tables_are_built_when_asked_for(spark, one_row_group):
    with Workspace(spark) as workspace:
        folder = workspace.path("warehouse")
        raw = workspace.store(derived_raw(spark, one_row_group), "raw")
        tables = job.tables_on_demand(raw, PARAMS, workspace, folder)
        assert tables["int_classified"].count() > 0
        assert is_written(spark, f"{folder}/stg_observations")
        assert not is_written(spark, f"{folder}/fact_observations")
        assert tables["fact_observations"].count() > 0
        assert not is_written(spark, f"{folder}/mart_kpi_summary")
        assert set(job.STORED) < set(dict(tables))
        assert is_written(spark, f"{folder}/mart_kpi_summary")


def test_queries_share_tables(spark, one_row_group):
    queries = registry.queries()
    scored = queries["quality_score"](spark, one_row_group)
    assert scored.count() > 0
    tables = registry.session(spark, one_row_group).tables
    assert tables["stg_observations"] is tables["stg_observations"]
    root = tables["stg_observations"].inputFiles()[0].split("/stg_observations")[0]
    assert not is_written(spark, f"{root}/fact_observations")
    assert queries["disparity_band"](spark, one_row_group).columns[-1] == "disparity_level"
    assert is_written(spark, f"{root}/fact_observations")


def test_a_number_is_parsed_and_printed_once(spark):
    df = spark.createDataFrame(
        [("\t1.50 ", "1"), ("-0e3", "2"), (" +INF", "3"), ("1.25e-7", " 4\n"), ("2e3", None)],
        "x string, __x0 string",
    )
    read = infer.as_read(df, {"x": infer.NUMBER, "__x0": infer.WHOLE})
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as double)") == 1
    assert read.columns == ["x", "__x0"]
    assert [tuple(r) for r in read.collect()] == [
        ("1.5", "1"), ("-0", "2"), ("Infinity", "3"), ("1.25e-07", "4"), ("2000", None),
    ]
