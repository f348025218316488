import csv
import dataclasses
import os

import pytest

from tests.hand import PARAMS, row
from tidemark import schemas
from tidemark.operators import quality
from tidemark.plans import dashboard, job
from tidemark.workspace import Workspace, shared_root

FILE_PARAMS = dataclasses.replace(
    PARAMS, tie_keys=("source_file", "source_block", "source_row")
)
HEADER = [n.upper().replace("_", " ") for n in schemas.RAW.names]


def write(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(HEADER)
        out.writerows([r[n] for n in schemas.RAW.names] for r in rows)
    return str(path)


ROWS = [
    row("Stunting, all", "2018", "20", residence="urban"),
    row("Stunting, all", "2018", "26.5", residence="rural"),
    row("Stunting, all", "2019", "NA", residence="rural"),
    row("Wasting", "2019", "4.25", value_ci="4.25 [3-5]"),
    row("Wasting", "2019", "4.5"),
    row("", "2019", "4.25", indicator_code="#indicator+code"),
]


def test_run_publishes(spark, tmp_path):
    path, out = write(tmp_path / "in.csv", ROWS), str(tmp_path / "out")
    before = os.listdir(shared_root(spark))
    run = job.run_job(spark, path, out, FILE_PARAMS)
    assert tuple(run.metrics.head()) == (6, 6, 0, 13)
    assert run.checks.count() == 16
    assert run.preview.count() == 3
    # ties of (indicator, location, period) are numbered in file order
    fact = run.tables["fact_observations"].orderBy("fact_key").collect()
    assert [(r.fact_key, r.indicator_name, float(r.indicator_value)) for r in fact] == [
        (1, "Stunting, all", 26.5),
        (2, "Stunting, all", 20.0),
        (3, "Wasting", 4.25),
        (4, "Wasting", 4.5),
    ]
    again = job.as_warehouse(job.open_latest(spark, out), FILE_PARAMS)
    assert dashboard.urban_rural(again).count() == 2
    # the run's intermediate tables are gone from the shared folder
    assert os.listdir(shared_root(spark)) == before


def test_last_run_wins_and_failed_runs_stay_hidden(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    first = write(tmp_path / "one.csv", ROWS)
    job.run_job(spark, first, out, FILE_PARAMS)
    later = dataclasses.replace(FILE_PARAMS, run_ts=PARAMS.run_ts.replace(year=2021))
    job.run_job(spark, write(tmp_path / "two.csv", ROWS[:1]), out, later)
    assert job.open_latest(spark, out)["fact_observations"].count() == 1

    latest = dataclasses.replace(FILE_PARAMS, run_ts=PARAMS.run_ts.replace(year=2022))
    monkeypatch.setitem(quality.ACCEPTED, "int_classified", ("indicator_category", ("Wasting",)))
    with pytest.raises(job.ChecksFailed, match="accepted_values") as failure:
        job.run_job(spark, first, out, latest)
    assert failure.value.report.filter("status = 'fail'").count() == 1
    (failed,) = failure.value.failures.values()
    assert {r.indicator_category for r in failed.collect()} == {"Stunting"}
    assert job.open_latest(spark, out)["fact_observations"].count() == 1


def test_empty_extract_is_refused(spark, tmp_path):
    path = write(tmp_path / "in.csv", [])
    with pytest.raises(quality.EmptyExtract):
        job.run_job(spark, path, str(tmp_path / "out"), FILE_PARAMS)


def test_missing_file_and_missing_columns(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        job.run_job(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"), FILE_PARAMS)
    path = tmp_path / "in.csv"
    path.write_text("Disease,Value\na,1\n")
    with pytest.raises(ValueError, match="indicator_code"):
        job.run_job(
            spark, str(path), str(tmp_path / "out"), FILE_PARAMS,
            rename={"disease": "indicator"},
        )


def test_lenient_run_keeps_rejected_lines(spark, tmp_path):
    path = write(tmp_path / "in.csv", ROWS)
    with open(path, "a") as f:
        f.write(",".join(["x"] * (len(HEADER) + 1)) + "\n")
    out = str(tmp_path / "out")
    run = job.run_job(spark, path, out, FILE_PARAMS, strict=False)
    assert run.tables["rejected"].count() == 1
    assert tuple(run.metrics.head()) == (7, 6, 1, 13)
    latest = job.open_latest(spark, out)
    assert latest["rejected"].count() == 1
    assert latest["checks"].count() == 16


def test_typed_seed_enters_the_warehouse(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(
        "Indicator,Indicator Code,Location,Location Code,Sex,Residence,Wealth Quintile,"
        "YEAR (DISPLAY),Numeric,Low,High\n"
        "Wasting,C1,Kenya,KEN,,urban,,2018,4.25,3,5\n"
        "Wasting,C1,Kenya,KEN,,rural,,2019,x,3,\n"
        "Wasting,C1,Kenya,KEN,,rural,,2019,6,1,9,SURPLUS\n"
    )
    run = job.run_job(
        spark, str(path), str(tmp_path / "out"), FILE_PARAMS, strict=False, seed=True
    )
    assert tuple(run.metrics.head()) == (3, 2, 1, 13)
    fact = run.tables["fact_observations"].collect()
    assert [(float(r.indicator_value), float(r.ci_width), r.time_key) for r in fact] == [
        (4.25, 2.0, 2018)
    ]


def test_views(spark, tmp_path):
    run = job.run_job(
        spark, write(tmp_path / "in.csv", ROWS), str(tmp_path / "out"), FILE_PARAMS
    )
    with Workspace(spark) as workspace:
        job.register_views(run.tables, FILE_PARAMS, workspace)
        for view in (*job.VIEWS, "int_yoy_changes"):
            assert spark.sql(f"SELECT * FROM {view}").count() > 0


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Cluster())
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
