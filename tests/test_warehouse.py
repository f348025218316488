"""Models and dashboard queries on hand-written rows."""

import dataclasses
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.hand import PARAMS, frame, row
from tidemark.operators import quality
from tidemark.plans import dashboard, job, staging, yoy
from tidemark.workspace import Workspace

D = Decimal


@pytest.fixture
def workspace(spark):
    with Workspace(spark) as w:
        yield w


def build(spark, workspace, rows):
    raw = workspace.store(frame(spark, rows), "raw")
    return job.build_tables(raw, PARAMS, workspace, workspace.path("tables"))


def test_staging_filters_and_numbering(spark, workspace):
    rows = [
        row("b", "2014", "1"),
        row("a", "2014", "1", location_code="UGA"),
        row("a", "2014", "2", location_code=" KEN "),
        row("a", "2013", "3", indicator_code="#indicator+code"),
        row("a", "2013", "3", indicator_code=None),
        row(None, "2014", "4"),
        row("c", "later", "5"),
        row("", "2014", "6"),
        row("d", "2014", "7", location_code=None),
        row("d", "2014", "8", indicator_code=" #indicator+code"),
    ]
    staged = staging.stage(frame(spark, rows), PARAMS, workspace)
    got = [(r.indicator_id, r.indicator_name, r.location_code) for r in staged.collect()]
    # ids count every data row: '', a (UGA), a (KEN), b, c, d, d and the NULL name last
    assert sorted(got) == [(1, "", "KEN"), (3, "a", "KEN"), (4, "b", "KEN"), (7, "d", "KEN")]


def test_ids_after_the_filter_have_no_gaps(spark, workspace):
    rows = [
        row("b", "2014", "1"),
        row("a", "2014", "1", location_code="UGA"),
        row("a", "2014", "2", location_code=" KEN "),
        row("aa", "later", "5"),
    ]
    params = dataclasses.replace(PARAMS, ids_after_filter=True)
    staged = staging.stage(frame(spark, rows), params, workspace)
    got = [(r.indicator_id, r.indicator_name) for r in staged.collect()]
    assert sorted(got) == [(1, "a"), (2, "b")]


def test_changes_follow_year_then_id(spark, workspace):
    rows = [
        row("Stunting", "2016", "8"),
        row("Stunting", "2014", "10"),
        row("Stunting", "2014-2018", "0"),
        row("Stunting", "2019", "5"),
        row("Stunting", "2018", None),
        row("Stunting", "2015", "7", sex="male"),
    ]
    tables = build(spark, workspace, rows)
    changes = yoy.yoy_changes(tables["int_classified"], PARAMS, workspace)
    got = [
        (r.sex, r.year, r.previous_year, r.years_gap, r.percentage_change, r.trend_direction)
        for r in changes.orderBy("sex", "year", "indicator_id").collect()
    ]
    assert got == [
        ("both", 2014, None, None, None, "No baseline"),
        ("both", 2014, 2014, 0, D("-100.00"), "Decreasing"),
        ("both", 2016, 2014, 2, None, "Increasing"),
        ("both", 2019, 2016, 3, D("-37.50"), "Decreasing"),
        ("male", 2015, None, None, None, "No baseline"),
    ]


def test_order_by_size_of_change(spark):
    rows = [
        (1, 2019, "A", D(1)),
        (2, 2019, "A", None),
        (3, 2019, "A", D(-9)),
        (4, 2020, "B", D(2)),
        (5, None, "A", D(0)),
    ]
    schema = (
        "indicator_id long, year int, indicator_category string,"
        " percentage_change decimal(9,2)"
    )
    df = spark.createDataFrame(rows, schema)
    assert [r.indicator_id for r in yoy.by_size_of_change(df).collect()] == [5, 4, 3, 1, 2]


def test_time_dimension(spark, workspace):
    years = ["2020", "2019", "2015", "2010", "2009", "2023", "1998-2001"]
    tables = build(spark, workspace, [row("hospital beds", y, "1") for y in years])
    got = {r.year: r for r in tables["dim_time"].collect()}
    assert {y: r.time_category for y, r in got.items()} == {
        2020: "Current year",
        2019: "Last year",
        2015: "Recent (5 years)",
        2023: "Recent (5 years)",
        2010: "Medium term (10 years)",
        2009: "Historical (>10 years)",
        1998: "Historical (>10 years)",
    }
    assert got[2023].years_ago == -3 and got[2023].is_recent_5y
    assert not got[2010].is_recent_5y and got[2010].is_recent_10y
    assert (got[1998].decade_start, got[1998].decade_end) == (1990, 1999)
    assert got[1998].decade_label == "1990s"
    assert (got[1998].five_year_period_start, got[1998].five_year_period_end) == (1995, 1999)


def test_demographic_labels_may_collide(spark, workspace):
    rows = [
        row("x", "2014", "1"),
        row("x", "2014", "1", sex="Both Sexes", residence="semi-urban", wealth="Q1 (poorest)"),
        row("x", "2014", "1", sex="", residence="Rural", wealth="Q2"),
    ]
    tables = build(spark, workspace, rows)
    got = [tuple(r)[:-1] for r in tables["dim_demographics"].orderBy("demographic_key").collect()]
    assert got == [
        (1, "", "rural", "q2", "", "Rural", "Second Quintile (Q2)",
         False, False, False, False, True, True),
        (2, "both", "total", "total", "Both Sexes", "All Areas", "All Wealth Groups",
         True, True, True, True, False, False),
        (3, "both sexes", "semi-urban", "q1 (poorest)", "Both Sexes", "Semi-Urban",
         "Q1 (Poorest)", False, False, False, False, False, False),
    ]


@pytest.fixture(scope="module")
def warehouse(spark):
    rows = [
        row("Stunting", "2018", "20", residence="urban"),
        row("Stunting", "2018", "26.5", residence="rural"),
        row("Stunting", "2019", "30", residence="rural"),
        row("Severe stunting", "2018", "22", residence="urban"),
        row("Stunting", "2012", "99", residence="urban"),
        row("Stunting", "2017", "35"),
        row("Stunting", "2019", "33"),
        row("Wasting", "2019", "4.25"),
        row("Wasting", "2016", "5"),
        row("Mortality under five", "2012", "50"),
        *[row("Underweight", "2019", str(n), wealth=q) for n, q in
          enumerate(["Q5", "Q1", "other", "Q3", "zz"], 10)],
    ]
    workspace = Workspace(spark)
    yield job.as_warehouse(build(spark, workspace, rows), PARAMS)
    workspace.clear()


def test_gap_is_attached_to_its_year_only(warehouse):
    got = {
        r.residence_label: (r.most_recent_year, r.urban_rural_gap, r.disparity_level)
        for r in warehouse.kpi.filter("indicator_category = 'Stunting'").collect()
    }
    # highest urban value of 2018 is the severe one: 22 against 26.5
    assert got == {
        "Urban": (2018, D("-4.500000"), "Small disparity"),
        "Rural": (2019, None, "No data"),
        "All Areas": (2019, None, "No data"),
    }


def test_kpi_rounding_and_counts(warehouse):
    r = warehouse.kpi.filter("indicator_category = 'Wasting'").head()
    assert (r.avg_indicator_value, r.value_range, r.measurement_count) == (D("4.63"), D("0.75"), 2)
    assert r.avg_percentage_change == D("-15")


def test_sort_orders(warehouse):
    gradient = dashboard.wealth_gradient(warehouse).collect()
    assert [r.wealth_quintile_label for r in gradient] == [
        "Poorest (Q1)", "Middle Quintile (Q3)", "Richest (Q5)", "Other", "Zz",
    ]
    trend = dashboard.category_trend(warehouse).collect()
    assert [(r.year, r.indicator_category) for r in trend] == [
        (2016, "Wasting"), (2017, "Stunting"), (2019, "Stunting"), (2019, "Wasting"),
    ]
    coverage = [r.year for r in dashboard.coverage(warehouse).collect()]
    assert coverage == sorted(coverage, reverse=True)


def test_limits(warehouse):
    latest = dashboard.stunting_kpi(warehouse).collect()
    assert [(r.measurement_year, r.trend_direction) for r in latest] == [(2019, "Decreasing")]
    best = dashboard.top_improvements(warehouse).collect()
    assert [r.percentage_change for r in best] == [D("-79.80"), D("-15.00"), D("-5.71")]
    gap = dashboard.largest_gap(warehouse).collect()
    assert [(r.gap_percentage, r.disparity_level) for r in gap] == [(D("-4.5"), "Small disparity")]


def test_global_average_over_nothing_is_one_row(warehouse):
    rows = dashboard.mortality_kpi(warehouse).collect()
    assert [tuple(r) for r in rows] == [(None, 0, None, None)]


def test_pivot_needs_the_first_two(warehouse):
    rows = dashboard.indicator_pivot(warehouse).collect()
    assert [(r.year, r.stunting, r.wasting, r.anaemia) for r in rows] == [
        (2019, D("33"), D("4.25"), None)
    ]


def test_triples_that_read_the_same_count_once(spark, workspace):
    rows = [
        row("Stunting", "2019", "1", sex="ab", residence="c"),
        row("Stunting", "2019", "1", sex="a", residence="bc"),
    ]
    w = job.as_warehouse(build(spark, workspace, rows), PARAMS)
    got = dashboard.coverage(w).head()
    assert (got.demographic_combinations, got.total_measurements) == (1, 2)


def test_blank_display_value_scores_zero_but_stays_in_the_fact(spark, workspace):
    tables = build(spark, workspace, [row("Stunting", "2019", "7", value="  ")])
    fact = tables["fact_observations"].collect()
    assert [(r.indicator_value, r.is_missing_value, r.data_quality_score) for r in fact] == [
        (D("7"), True, 0)
    ]


def test_malformed_numbers_go_to_the_quarantine(spark, workspace):
    rows = [
        row("Stunting", "2019", "1.2.3", value="4"),
        row("Stunting", "2019", None, value="9" * 21),
        row("Stunting", "2019", "x", value="4"),
        row("Stunting", "2019", ".", value="4", indicator_code=None),
        row("Stunting", "2019", "5", value_ci="[1.2.3-4]"),
        row("Stunting", "2019", "5", value_ci="[5-" + "9" * 21 + "]"),
    ]
    tables = build(spark, workspace, rows)
    assert sorted(r.k for r in tables["quarantine"].collect()) == [0, 1, 4, 5]


def test_no_facts_at_all(spark, workspace):
    tables = build(spark, workspace, [row("hospital beds", "2019", "7")])
    assert tables["fact_observations"].count() == 0
    w = job.as_warehouse(tables, PARAMS)
    assert all(q(w).count() == (k == "bi_mortality_kpi") for k, q in dashboard.QUERIES.items())


def test_recent_years_prune_fact_partitions(warehouse):
    """The dashboard's recency condition reaches the scan of the fact table."""
    df = dashboard.urban_rural(warehouse)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_scores_and_categories(warehouse):
    scores = {r[0] for r in warehouse.fact.select("data_quality_score").distinct().collect()}
    assert scores <= {0, 50, 70, 80, 100}
    known = quality.ACCEPTED["int_classified"][1]
    assert warehouse.fact.filter(~F.col("indicator_category").isin(*known)).count() == 0
