"""Column names of an extract, taken from its header line."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def normalize_header(name: str) -> str:
    """Strip, lower-case, blanks to underscores, drop everything else."""
    name = name.strip().lower().replace(" ", "_")
    return re.sub(r"[^a-z0-9_]", "", name)


def distinct_headers(names: Sequence[str]) -> list[str]:
    """Suffix repeats ``.1``, ``.2`` ...; name blank headers by position."""
    taken: set[str] = set()
    out = []
    for i, name in enumerate(names):
        name = name or f"Unnamed: {i}"
        unique, n = name, 0
        while unique in taken or (n and unique in names):
            n += 1
            unique = f"{name}.{n}"
        taken.add(unique)
        out.append(unique)
    return out


def normalized_names(names: Sequence[str]) -> list[str]:
    out = [normalize_header(n) for n in distinct_headers(names)]
    clashes = sorted({n for n in out if out.count(n) > 1})
    if clashes:
        raise ValueError(f"headers are equal once normalized: {', '.join(clashes)}")
    return out


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*normalized_names(df.columns))


def read_header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """The fields of the extract's first line that isn't blank.

    Spark renames repeated headers its own way, hence the look at the line.
    """
    first = _fields(spark, path, multi_line).head()
    if first is None:
        raise ValueError(f"no header line in {path}")
    names = [name or "" for name in first]
    return [names[0].removeprefix("\ufeff"), *names[1:]]


def _fields(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    reader = spark.read.option("header", False).option("escape", '"')
    try:
        return reader.option("multiLine", multi_line).csv(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise ValueError(f"no header line in {path}") from e
        raise


def check_headers(spark: SparkSession, path: str) -> None:
    """Raise if two files of the extract begin with different lines.

    Reads the extract once; lines are numbered in file order, so the first one
    of each file is that with the least number of its first block.
    """
    first = (
        spark.read.text(path)
        .filter("trim(value) <> ''")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
            "value",
        )
        .filter("block = 0")
        .groupBy("file")
        .agg(F.min_by("value", "row").alias("header"))
    )
    if len(first.select("header").distinct().limit(2).collect()) > 1:
        raise ValueError(f"files in {path} have different headers")
