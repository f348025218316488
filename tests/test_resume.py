"""Failed runs that go on where they stopped."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.test_job import FILE_PARAMS, ROWS, write
from tidemark.plans import job, runs


class Killed(RuntimeError):
    pass


def killed(*args, **kwargs):
    raise Killed


def files(folder):
    return {
        os.path.join(base, f): os.stat(os.path.join(base, f)).st_mtime_ns
        for base, _, names in os.walk(folder)
        for f in names
    }


def rows(run):
    hidden = ("updated_at", "ingestion_timestamp")
    return {
        name: sorted(map(repr, df.drop(*hidden).collect())) for name, df in run.tables.items()
    }


def test_a_killed_run_is_taken_up_behind_its_last_table(spark, tmp_path, monkeypatch):
    path, out = write(tmp_path / "in.csv", ROWS), str(tmp_path / "out")
    with monkeypatch.context() as m:
        m.setattr(job, "build_fact", killed)
        with pytest.raises(Killed):
            job.run_job(spark, path, out, FILE_PARAMS)
    (run_id,) = os.listdir(f"{out}/runs")
    done = files(f"{out}/runs/{run_id}")
    assert any("stg_observations" in f for f in done)
    assert not os.path.exists(f"{out}/published")
    with monkeypatch.context() as m:
        m.setattr(job, "stage", killed)
        m.setattr(job, "read_extract", killed)
        run = job.run_job(spark, path, out, FILE_PARAMS, resume=True)
    assert os.listdir(f"{out}/runs") == [run_id]
    now = files(f"{out}/runs/{run_id}")
    assert all(now[f] == t for f, t in done.items())
    clean = job.run_job(spark, path, str(tmp_path / "clean"), FILE_PARAMS)
    assert rows(run) == rows(clean)
    assert run.metrics.collect() == clean.metrics.collect()
    assert rows(run)["fact_observations"]


def test_the_batch_time_of_the_first_attempt_holds(spark, tmp_path, monkeypatch):
    path, out = write(tmp_path / "in.csv", ROWS), str(tmp_path / "out")
    early = job.replace(FILE_PARAMS, run_ts=dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc))
    late = job.replace(FILE_PARAMS, run_ts=dt.datetime(2025, 1, 2, tzinfo=dt.timezone.utc))
    with monkeypatch.context() as m:
        m.setattr(job, "kpi_summary", killed)
        with pytest.raises(Killed):
            job.run_job(spark, path, out, early, strict=False)
    run = job.run_job(spark, path, out, late, strict=False, resume=True)
    for name in ("fact_observations", "mart_kpi_summary", "dim_time"):
        times = run.tables[name].select(F.unix_timestamp("updated_at")).distinct().collect()
        assert [r[0] for r in times] == [int(early.run_ts.timestamp())]
    assert run.tables["rejected"].count() == 0


def test_a_half_written_table_is_built_again(spark, tmp_path, monkeypatch):
    path, out = write(tmp_path / "in.csv", ROWS), str(tmp_path / "out")
    with monkeypatch.context() as m:
        m.setattr(job, "kpi_summary", killed)
        with pytest.raises(Killed):
            job.run_job(spark, path, out, FILE_PARAMS)
    (run_id,) = os.listdir(f"{out}/runs")
    os.remove(f"{out}/runs/{run_id}/dim_time/_SUCCESS")
    run = job.run_job(spark, path, out, FILE_PARAMS, resume=True)
    assert os.path.exists(f"{out}/runs/{run_id}/dim_time/_SUCCESS")
    assert run.tables["dim_time"].count() == 2


def test_other_input_or_parameters_begin_anew(spark, tmp_path, monkeypatch):
    path, out = write(tmp_path / "in.csv", ROWS), str(tmp_path / "out")
    name = runs.fingerprint(spark, path, FILE_PARAMS, {"strict": True})
    assert name == runs.fingerprint(
        spark, path, job.replace(FILE_PARAMS, run_ts=dt.datetime(2020, 1, 1)), {"strict": True}
    )
    other = job.replace(FILE_PARAMS, current_year=1999)
    assert name != runs.fingerprint(spark, path, other, {"strict": True})
    assert name != runs.fingerprint(spark, path, FILE_PARAMS, {"strict": False})
    write(tmp_path / "in.csv", ROWS[1:])
    assert name != runs.fingerprint(spark, path, FILE_PARAMS, {"strict": True})
    # a published run is over
    first = job.run_job(spark, path, out, FILE_PARAMS, resume=True)
    job.run_job(spark, path, out, FILE_PARAMS, resume=True)
    assert len(os.listdir(f"{out}/runs")) == 2
    assert first.tables["fact_observations"].count() > 0


def test_inferred_numbers_count(spark, tmp_path):
    changed = [{**r, "value_numeric": "2e1", "value": "2e1"} for r in ROWS]
    path = write(tmp_path / "in.csv", changed)
    plain = job.run_job(spark, path, str(tmp_path / "plain"), FILE_PARAMS)
    read = job.run_job(spark, path, str(tmp_path / "read"), FILE_PARAMS, infer=True)
    assert plain.tables["fact_observations"].isEmpty()
    values = read.tables["fact_observations"].select("indicator_value").distinct().collect()
    assert [float(r[0]) for r in values] == [20.0]
