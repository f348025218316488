"""The batch job: extract to published warehouse.

Every run writes its tables to a folder of its own; the run becomes visible in
one step, when its row is appended to the ``published`` table. Readers keep the
previous run until then, and a failed run publishes nothing; it can be resumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import failing_rows, run_suite, validate_raw
from tidemark.params import Params
from tidemark.plans.classified import classify
from tidemark.plans.dashboard import Warehouse
from tidemark.plans.dimensions import dim_demographics, dim_time
from tidemark.plans.fact import build_fact
from tidemark.plans.kpi import kpi_summary, recent_cells
from tidemark.plans.runs import Tables, fingerprint, note, unfinished
from tidemark.plans.staging import malformed_numbers, stage
from tidemark.plans.yoy import yoy_changes
from tidemark.schemas import conform_raw
from tidemark.sources.extract import LONG, Extract, raw_from_seed, read_extract, read_typed
from tidemark.workspace import Workspace, write_table

PUBLISHED = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("columns_loaded", T.IntegerType()),
    ]
)

STORED = (
    "raw_observations",
    "stg_observations",
    "dim_time",
    "dim_demographics",
    "fact_observations",
    "mart_kpi_summary",
)
# Further tables of a run: its checks, and the lines a lenient read set aside.
REPORTS = ("checks", "rejected")

# Relation names dashboards use -> our tables.
VIEWS = {
    "stg_health_indicators": "stg_observations",
    "int_child_health_indicators": "int_classified",
    "fact_child_health": "fact_observations",
    "dim_time": "dim_time",
    "dim_demographics": "dim_demographics",
    "mart_kpi_summary": "mart_kpi_summary",
}


class ChecksFailed(RuntimeError):
    """At least one data check failed; ``report`` holds all of them, ``failures``
    the offending rows (or repeated values) of each that failed, as stored."""

    def __init__(self, report: DataFrame, failures: Mapping[str, DataFrame]):
        super().__init__(f"failed checks: {', '.join(failures)}")
        self.report = report
        self.failures = failures


@dataclass(frozen=True)
class Run:
    tables: Mapping[str, DataFrame]
    warehouse: Warehouse
    checks: DataFrame
    metrics: DataFrame
    preview: DataFrame


def load_raw(
    extract: Extract,
    path: str,
    shape: Callable[[DataFrame], DataFrame] = conform_raw,
) -> tuple[DataFrame, DataFrame]:
    """Write the raw table; return it and its one-row metrics.

    Lines read and rejected are observed while the table is written, rows
    loaded are counted in what was written. Columns are the source's and the
    two of the audit.
    """
    seen = Observation()
    lines = extract.lines.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col(LONG)).alias("rejected")
    )
    raw = write_table(shape(replace(extract, lines=lines).rows), path)
    metrics = raw.agg(
        F.lit(seen.get["read"]).cast("long").alias("rows_read"),
        F.count(F.lit(1)).alias("rows_loaded"),
        F.lit(seen.get["rejected"]).cast("long").alias("rows_rejected"),
        F.lit(len(extract.names) + 2).alias("columns_loaded"),
    )
    return raw, metrics


class OnDemand(Mapping[str, DataFrame]):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders, self._built = dict(builders), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def tables_on_demand(
    raw: DataFrame, params: Params, workspace: Workspace, folder: str
) -> OnDemand:
    """Staging, dimensions, fact and KPI tables, written when first asked for; each
    feeds the next.

    Tables that the folder has already are read and not built again.

    Dimensions are stored before they are joined: their size on disk
    tells Spark whether a broadcast is safe.
    """

    table = Tables(raw.sparkSession, folder).table

    def by_year_and_key() -> DataFrame:
        # The write sorts by year anyway; by key as well, equal names stay together.
        dimensions = tables["dim_time"], tables["dim_demographics"]
        fact = build_fact(tables["int_classified"], *dimensions, params, workspace)
        return fact.sortWithinPartitions("time_key", "fact_key")

    def kpis() -> DataFrame:
        star = [tables[n] for n in ("fact_observations", "dim_time", "dim_demographics")]
        return kpi_summary(workspace.store(recent_cells(*star), "cells"), params)

    def staged() -> DataFrame:
        return tables["stg_observations"]

    models = {
        "stg_observations": lambda: stage(raw, params, workspace),
        "dim_time": lambda: dim_time(staged(), params),
        "dim_demographics": lambda: dim_demographics(staged(), params, workspace),
        "fact_observations": by_year_and_key,
        "mart_kpi_summary": kpis,
    }
    partitions = {"fact_observations": ("time_key",)}

    def stored(name: str) -> Callable[[], DataFrame]:
        return lambda: table(name, models[name], partitions.get(name, ()))

    tables = OnDemand(
        {
            "raw_observations": lambda: raw,
            **{name: stored(name) for name in models},
            "int_classified": lambda: classify(staged()),
            "quarantine": lambda: malformed_numbers(raw),
        }
    )
    return tables


def build_tables(
    raw: DataFrame, params: Params, workspace: Workspace, folder: str
) -> dict[str, DataFrame]:
    """All tables of a run, written; see ``tables_on_demand``."""
    return dict(tables_on_demand(raw, params, workspace, folder))


def with_derived(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Add the tables that are a filter and a projection of a stored one."""
    return {
        **tables,
        "int_classified": classify(tables["stg_observations"]),
        "quarantine": malformed_numbers(tables["raw_observations"]),
    }


def as_warehouse(tables: Mapping[str, DataFrame], params: Params) -> Warehouse:
    return Warehouse(
        fact=tables["fact_observations"],
        dim_time=tables["dim_time"],
        dim_demographics=tables["dim_demographics"],
        kpi=tables["mart_kpi_summary"],
        params=params,
    )


def register_views(
    tables: Mapping[str, DataFrame], params: Params, workspace: Workspace
) -> None:
    """Make the tables available to ``spark.sql`` under the dashboards' names.

    The view of changes may read the workspace; keep that until it is dropped.
    """
    for view, name in VIEWS.items():
        tables[name].createOrReplaceTempView(view)
    changes = yoy_changes(tables["int_classified"], params, workspace)
    changes.createOrReplaceTempView("int_yoy_changes")


def run_job(
    spark: SparkSession,
    csv_path: str,
    out: str,
    params: Params | None = None,
    *,
    rename: Mapping[str, str] | None = None,
    strict: bool = True,
    multi_line: bool = False,
    seed: bool = False,
    infer: bool = False,
    resume: bool = False,
) -> Run:
    """Ingest, validate, build, check and publish one extract.

    ``seed`` reads a typed seed instead (year, number and bounds in columns of
    their own). ``infer`` reads columns of numbers alone as numbers, so that ``1e3``
    counts as 1000. Tables that fail a check stay in the run's folder, with the
    rows that failed, but are not published.

    ``resume`` goes on with the last run over the same files and parameters that was
    not published: its batch time holds and its finished tables stay as they are. Two
    runs at a time must not resume the same one.
    """
    params, out = params or Params(), out.rstrip("/")
    if infer and seed:
        raise ValueError("a typed seed has its types")
    options = {"strict": strict, "multi_line": multi_line}
    shaped = {**options, "seed": seed, "infer": infer, "rename": sorted((rename or {}).items())}
    name = fingerprint(spark, csv_path, params, shaped)
    begun = unfinished(spark, out, name) if resume else None
    if begun is None:
        run_id = f"{params.run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        note(spark, out, name, run_id, params.run_ts)
    else:
        run_id, run_ts = begun
        params = replace(params, run_ts=run_ts)
    folder = f"{out}/runs/{run_id}"
    stored = Tables(spark, folder)

    def shape(rows: DataFrame) -> DataFrame:
        return conform_raw(raw_from_seed(rows, params.run_ts) if seed else rows, rename)

    def ingest(workspace: Workspace) -> tuple[DataFrame, DataFrame]:
        """Write the raw table, the rejected lines, and last the metrics of both."""
        reading = {**options, "workspace": workspace}
        if seed:
            extract = read_typed(spark, csv_path, **reading)
        else:
            extract = read_extract(spark, csv_path, params.run_ts, **reading)
        if infer or not strict:
            extract = extract.stored(workspace)
        if infer:
            extract = extract.inferred()
        raw, metrics = load_raw(extract, stored.path("raw_observations"), shape)
        if not strict:
            write_table(extract.rejected, stored.path("rejected"))
        return raw, write_table(metrics, stored.path("metrics"))

    with Workspace(spark) as workspace:
        if stored.has("metrics"):
            raw, metrics = stored.read("raw_observations"), stored.read("metrics")
        else:
            raw, metrics = ingest(workspace)
        validate_raw(raw)
        tables = build_tables(raw, params, workspace, folder)
        if not strict:
            tables["rejected"] = stored.read("rejected")
        checks = write_table(run_suite(tables, workspace), stored.path("checks"))
        tables["checks"] = checks
        failed = checks.filter("status = 'fail'").collect()
        failures = {
            f"{r.check} {r.table}.{r.column}": write_table(
                failing_rows(tables, r.check, r.table, r.column),
                f"{folder}/failures/{r.check}-{r.table}-{r.column}",
            )
            for r in failed  # at most one row per check of the suite
        }
    if failures:
        raise ChecksFailed(checks, failures)
    line = metrics.select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("published_at"),
        "*",
    )
    line.write.mode("append").parquet(f"{out}/published")
    return Run(
        tables=tables,
        warehouse=as_warehouse(tables, params),
        checks=checks,
        metrics=metrics,
        preview=raw.limit(3),
    )


def open_latest(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the run published last."""
    out = out.rstrip("/")
    last = (
        spark.read.schema(PUBLISHED)
        .parquet(f"{out}/published")
        .orderBy(F.desc("published_at"), F.desc("run_id"))
        .head()
    )
    if last is None:
        raise ValueError(f"nothing published in {out}")
    folder = f"{out}/runs/{last['run_id']}"
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in STORED}
    for name in REPORTS:
        try:
            tables[name] = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as e:  # a strict run rejects nothing
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return with_derived(tables)
