"""Intermediate tables in the folder the whole cluster shares.

Stored tables cut lineage: a lost executor costs a re-read of files, never a
recomputation that could number rows differently from what was already used.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for local sessions."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return _local_root()


@functools.cache
def _local_root() -> str:
    """One temporary folder for this process, deleted when it ends."""
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


#: Workspaces made inside each ``cleared`` block that is open, innermost last.
_made: list[list[Workspace]] = []


@contextlib.contextmanager
def cleared() -> Iterator[None]:
    """Delete the workspaces made inside the block when it ends.

    What is to be kept must be stored in one made outside by then.
    """
    _made.append([])
    try:
        yield
    finally:
        for workspace in _made.pop():
            workspace.clear()


class Workspace:
    """A fresh subfolder of the shared folder holding this run's tables."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        if _made:
            _made[-1].append(self)
        self.spark = spark
        base = (root or shared_root(spark)).rstrip("/")
        self.root = f"{base}/tidemark-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def store(
        self, df: DataFrame, name: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write ``df`` as parquet and return a DataFrame that scans it."""
        return write_table(df, self.path(name), partition_by)

    def clear(self) -> None:
        """Delete the subfolder; DataFrames that read from it stop working."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.clear()


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to the end."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
