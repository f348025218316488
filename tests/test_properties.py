"""Properties of whole builds over the derived input."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.plans import job, yoy
from tidemark.workspace import Workspace
from workload.derived import PARAMS, derived_raw

SF_DIR = "/root/testdata/sf0.01"


def build(spark, partitions, **options):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        workspace = Workspace(spark)
        raw = derived_raw(spark, SF_DIR).repartition(partitions)
        raw = workspace.store(raw, "raw")
        params = job.Params(**{**PARAMS.__dict__, **options})
        tables = job.build_tables(raw, params, workspace, workspace.path("tables"))
        return workspace, tables
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def tables(spark):
    workspace, out = build(spark, 8)
    yield out
    workspace.clear()


def test_counts_of_the_derived_input(tables):
    """Counts that both engines agreed on when the input was designed."""
    classified = tables["int_classified"]
    expected = {
        "raw_observations": 15_000,
        "stg_observations": 8_830,
        "dim_time": 7,
        "dim_demographics": 54,
        "int_classified": 6_643,
        "fact_observations": 6_547,
    }
    assert {t: tables[t].count() for t in expected} == expected
    scores = classified.groupBy("data_quality_score").count().collect()
    assert dict(map(tuple, scores)) == {0: 419, 50: 522, 70: 1123, 80: 2300, 100: 2279}
    bounds = classified.agg(F.count("value_lower_ci"), F.count("value_upper_ci")).head()
    assert tuple(bounds) == (5_356, 5_649)


def test_previous_year_counts(spark, tables):
    with Workspace(spark) as workspace:
        changes = yoy.yoy_changes(tables["int_classified"], PARAMS, workspace)
        assert changes.filter("previous_year IS NOT NULL").count() == 5_636
        assert changes.filter("years_gap = 0").count() == 3_133


def test_some_series_are_hot_for_the_chunking_test(tables):
    valued = tables["int_classified"].filter("indicator_value IS NOT NULL")
    sizes = valued.groupBy(*yoy.SERIES).count()
    assert sizes.filter("count > 8").count() > 10
    assert sizes.filter("count <= 8").count() > 10


def test_fact_holds_exactly_the_classified_rows_with_a_value(tables):
    ids = tables["int_classified"].filter("indicator_value IS NOT NULL")
    fact = tables["fact_observations"]
    assert fact.count() == ids.count()
    assert ids.join(fact, "indicator_id", "left_anti").isEmpty()
    keys = fact.agg(F.min("fact_key"), F.max("fact_key"), F.count_distinct("fact_key")).head()
    assert tuple(keys) == (1, fact.count(), fact.count())


def test_classification_is_total(tables):
    names = tables["stg_observations"].select(rules.category(F.col("indicator_name")).alias("c"))
    found = {r.c for r in names.distinct().collect()}
    assert found <= {*rules.CATEGORIES, rules.OTHER}


@pytest.mark.parametrize(
    "partitions, options", [(3, {}), (5, {"hot_rows": 8, "chunk_rows": 64})]
)
def test_tables_do_not_depend_on_partitioning_or_chunking(spark, tables, partitions, options):
    workspace, other = build(spark, partitions, **options)
    for name in ("stg_observations", "dim_demographics", "fact_observations", "mart_kpi_summary"):
        a, b = tables[name], other[name].select(*tables[name].columns)
        assert a.count() == b.count()
        assert a.exceptAll(b).isEmpty(), name
    workspace.clear()
