"""Runs that were begun, so that a failed one goes on where it stopped.

Every run notes a fingerprint of its input files and parameters before it starts. A run
with the fingerprint of one that was not published takes over its folder, its batch time
and all tables written to the end; it builds the others.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.params import Params
from tidemark.workspace import is_written, write_table

STARTED = T.StructType(
    [
        T.StructField("fingerprint", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("started_at", T.TimestampType()),
    ]
)


def fingerprint(
    spark: SparkSession, path: str, params: Params, options: Mapping[str, object]
) -> str:
    """A name for what a run reads and how: files by place, size and time, and all
    parameters but the batch time. File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .load(path)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")).alias("of"),
        )
        .first()
    )
    given = {k: v for k, v in asdict(params).items() if k != "run_ts"}
    told = [list(map(str, files)), sorted(map(str, given.items())), sorted(map(str, options.items()))]
    return hashlib.sha256(json.dumps(told).encode()).hexdigest()


def unfinished(spark: SparkSession, out: str, name: str) -> tuple[str, dt.datetime] | None:
    """Run id and batch time of the last run with a fingerprint, unless published."""
    try:
        begun = spark.read.schema(STARTED).parquet(f"{out}/started")
        last = (
            begun.filter(F.col("fingerprint") == name)
            .orderBy(F.desc("started_at"), F.desc("run_id"))
            .head()
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if last is None:
        return None
    try:
        published = spark.read.parquet(f"{out}/published")
        if not published.filter(F.col("run_id") == last["run_id"]).isEmpty():
            return None
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    return last["run_id"], last["run_ts"]


def note(spark: SparkSession, out: str, name: str, run_id: str, run_ts: dt.datetime) -> None:
    row = spark.range(1).select(
        F.lit(name).alias("fingerprint"),
        F.lit(run_id).alias("run_id"),
        F.lit(run_ts).alias("run_ts"),
        F.current_timestamp().alias("started_at"),
    )
    row.write.mode("append").parquet(f"{out}/started")


@dataclass(frozen=True)
class Tables:
    """Tables of one run's folder, each built only if it isn't there yet."""

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def has(self, name: str) -> bool:
        return is_written(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def table(
        self, name: str, build: Callable[[], DataFrame], by: tuple[str, ...] = ()
    ) -> DataFrame:
        if self.has(name):
            return self.read(name)
        return write_table(build(), self.path(name), by)
