import pytest
from pyspark.sql import functions as F

from tests.hand import PARAMS, frame, row
from tidemark.operators import quality
from tidemark.plans import job
from tidemark.workspace import Workspace


def outcome(df):
    return [(r.status, r.failing_rows, r.total_rows) for r in df.collect()]


@pytest.fixture
def rows(spark):
    data = [(1, "a"), (1, "b"), (2, None), (None, "a"), (None, "c")]
    return spark.createDataFrame(data, "k int, v string")


def test_not_null(rows):
    out = quality.check_not_null(rows, "t", ["k", "v"])
    assert {r.column: (r.status, r.failing_rows, r.total_rows) for r in out.collect()} == {
        "k": ("fail", 2, 5),
        "v": ("fail", 1, 5),
    }
    assert quality.not_null_failures(rows, "k").count() == 2


def test_unique_ignores_null(rows):
    assert outcome(quality.check_unique(rows, "t", "k")) == [("fail", 1, 5)]
    assert [tuple(r) for r in quality.unique_failures(rows, "k").collect()] == [(1, 2)]
    assert outcome(quality.check_unique(rows.filter("v = 'b'"), "t", "k")) == [("pass", 0, 1)]


def test_accepted_values_let_null_pass(rows):
    assert outcome(quality.check_accepted_values(rows, "t", "v", ["a", "b"])) == [("fail", 1, 5)]
    bad = quality.accepted_values_failures(rows, "v", ["a", "b"])
    assert [r.v for r in bad.collect()] == ["c"]


def test_relationships_let_null_pass(spark, rows):
    parent = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert outcome(quality.check_relationships(rows, "t", "k", parent, "id")) == [("fail", 1, 5)]
    assert [r.k for r in quality.relationships_failures(rows, "k", parent, "id").collect()] == [2]
    empty = parent.filter("false")
    assert outcome(quality.check_relationships(rows, "t", "k", empty, "id")) == [("fail", 3, 5)]


def test_range(rows):
    assert outcome(quality.check_range(rows, "t", "k", 2, 9)) == [("fail", 2, 5)]
    assert quality.range_failures(rows, "k", 2, 9).count() == 2


def test_checks_of_empty_tables_pass(rows):
    none = rows.filter("false")
    assert outcome(quality.check_not_null(none, "t", ["k"])) == [("pass", 0, 0)]
    assert outcome(quality.check_unique(none, "t", "k")) == [("pass", 0, 0)]
    assert outcome(quality.check_relationships(none, "t", "k", none, "k")) == [("pass", 0, 0)]


@pytest.fixture(scope="module")
def tables(spark):
    workspace = Workspace(spark)
    raw = workspace.store(
        frame(
            spark,
            [row("Stunting", "2018", "1"), row("Wasting", "2019", "2", sex="male")],
        ),
        "raw",
    )
    yield job.build_tables(raw, PARAMS, workspace, workspace.path("tables"))
    workspace.clear()


def failing(tables):
    with Workspace(tables["dim_time"].sparkSession) as workspace:
        report = quality.run_suite(tables, workspace).collect()
    assert len(report) == 16
    return sorted((r.check, r.table, r.column) for r in report if r.status == "fail")


def test_suite_passes_on_our_own_tables(tables):
    assert failing(tables) == []


@pytest.mark.parametrize(
    "table, change, expected",
    [
        ("fact_observations", {"fact_key": "1L"}, ("unique", "fact_key")),
        ("stg_observations", {"year": "cast(null as int)"}, ("not_null", "year")),
        ("int_classified", {"indicator_category": "'Obesity'"},
         ("accepted_values", "indicator_category")),
        ("int_classified", {"indicator_category": "cast(null as string)"},
         ("not_null", "indicator_category")),
        ("fact_observations", {"time_key": "1900"}, ("relationships", "time_key")),
        ("fact_observations", {"demographic_key": "99L"}, ("relationships", "demographic_key")),
        ("dim_time", {"year": "if(year = 2018, 2019, year)"}, ("unique", "year")),
        ("fact_observations", {"demographic_key": "cast(null as bigint)"}, None),
    ],
)
def test_suite_finds_seeded_faults(tables, table, change, expected):
    broken = tables[table].withColumns({c: F.expr(e) for c, e in change.items()})
    changed = {**tables, table: broken}
    found = failing(changed)
    for check, of, column in found:
        assert quality.failing_rows(changed, check, of, column).count() > 0
    if expected is None:
        assert found == []
    else:
        assert (expected[0], table, expected[1]) in found


def test_validation(spark, rows):
    raw = frame(spark, [row("a", "2014", None), row(None, "2014", "1")])
    assert tuple(quality.validate_raw(raw).head()) == (2, 1, 1)
    with pytest.raises(quality.EmptyExtract):
        quality.validate_raw(raw.filter("false"))
    assert tuple(quality.validate_raw(rows).head()) == (rows.count(), None, None)
