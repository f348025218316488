"""Time the warehouse build and every registered query; print one JSON line.

``value`` is the headline: building all tables from the raw input plus the
sixteen dashboard queries. Query times are medians over repeated runs, each
computing the full result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tidemark.plans import dashboard, job
from tidemark.workspace import Workspace
from workload import registry
from workload.derived import PARAMS, derived_raw

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def build(spark: SparkSession) -> None:
    with Workspace(spark) as workspace:
        raw = workspace.store(derived_raw(spark, SF_DIR), "raw")
        job.build_tables(raw, PARAMS, workspace, workspace.path("warehouse"))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = seconds(lambda: dict(registry.session(spark, SF_DIR).tables))
    times = {
        "build_warehouse": statistics.median(
            seconds(lambda: build(spark)) for _ in range(RUNS)
        )
    }
    failed = {}
    for key, query in registry.queries().items():

        def run(query=query):
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

        try:
            times[key] = statistics.median(seconds(run) for _ in range(RUNS))
        except Exception as e:  # the other queries still get their times
            failed[key] = str(e).splitlines()[0][:300]
    headline = times["build_warehouse"] + sum(
        times.get(k, 0) for k in dashboard.QUERIES
    )
    result = {
        "metric": "warehouse build plus sixteen dashboard queries",
        "value": round(headline, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cold_build": round(cold, 3),
        "cpus": int(CPUS),
        "shuffle_partitions": int(CPUS),
        "runs": RUNS,
    }
    if failed:
        result["failed"] = failed
    spark.stop()
    print(json.dumps(result))
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
