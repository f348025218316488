"""Inferred types against a data-frame reader."""

import datetime as dt
import io

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.sources import extract, infer

RUN_TS = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
# Doubles as a database prints them.
PRINTED = {
    -0.0: "-0", 1.0: "1", 1000.0: "1000", 0.1: "0.1", -12.5: "-12.5",
    1e7: "10000000", 123456789.125: "123456789.125", 1e14: "100000000000000",
    999999999999999.9: "999999999999999.9", 1e15: "1e+15", -1.5e20: "-1.5e+20",
    1e100: "1e+100", 0.0001: "0.0001", 0.00012345678901234567: "0.00012345678901234567",
    0.00001: "1e-05", 1.25e-7: "1.25e-07", float("inf"): "Infinity", float("-inf"): "-Infinity",
}


def test_doubles_as_text(spark):
    df = spark.createDataFrame([(x,) for x in PRINTED], "x double")
    found = df.select("x", infer.shortest(F.col("x")).alias("t")).collect()
    assert [r.t for r in found] == list(PRINTED.values())


COLUMNS = {
    "whole": ["1", "+2", " 3", "-4 "],
    "zeros": ["007", "0", "00", "1"],
    "holes": ["1", "", "NA", "4"],
    "real": ["1e3", "1.0", ".5", "5."],
    "ends": ["inf", "-Infinity", "1", "+INF"],
    "text": ["1", "2", "x", "4"],
    "range": ["2010", "2010-2015", "2011", "2012"],
    "truth": ["True", "FALSE", "true", "false"],
    "truth_hole": ["True", "", "true", "false"],
    "truth_number": ["True", "1", "0", "1"],
    "nothing": ["", "NA", "null", ""],
    "commas": ["1;000", "1", "2", "3"],
    "hex": ["0x10", "1", "2", "3"],
    "two_dots": ["1.2.3", "1", "2", "3"],
    "java": ["1d", "2f", "3", "4"],
    "limits": ["9223372036854775807", "-9223372036854775808", "0", "1"],
    "too_large": ["-9223372036854775809", "0", "1", "2"],
}


@pytest.fixture
def path(tmp_path):
    rows = zip(*COLUMNS.values(), strict=True)
    text = "\n".join([",".join(COLUMNS), *[",".join(r) for r in rows]]) + "\n"
    (tmp_path / "x.csv").write_text(text)
    return tmp_path / "x.csv"


def test_kinds_are_those_of_the_reader(spark, path):
    read = extract.read_extract(spark, str(path), RUN_TS)
    kinds = infer.column_kinds(read.rows, read.names)
    frame = pd.read_csv(io.StringIO(path.read_text()), low_memory=False)
    names = {"int64": infer.WHOLE, "float64": infer.NUMBER, "bool": infer.TRUTH}
    expected = {c: names.get(str(t), infer.TEXT) for c, t in frame.dtypes.items()}
    expected["truth_hole"] = infer.TRUTH  # objects there, all of them truths
    assert kinds == expected


def test_values_are_those_of_the_reader(spark, path):
    read = extract.read_extract(spark, str(path), RUN_TS)
    rows = read.inferred().rows.orderBy(*extract.ORDER).collect()
    frame = pd.read_csv(io.StringIO(path.read_text()), low_memory=False)
    for name in COLUMNS:
        found = [r[name] for r in rows]
        values = [None if pd.isna(v) else v for v in frame[name]]
        if frame[name].dtype == float:
            assert [None if v is None else float(v) for v in found] == values
        else:
            printed = [str(v).lower() if isinstance(v, (bool, np.bool_)) else str(v) for v in values]
            assert [str(v) for v in found] == printed


def test_numbers_written_otherwise_count(spark, path):
    read = extract.read_extract(spark, str(path), RUN_TS)
    found = {r.real for r in read.inferred().rows.collect()}
    assert found == {"1000", "1", "0.5", "5"}


def test_one_pass_and_no_columns(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("a`b"))
    assert infer.column_kinds(df, ["a`b"]) == {"a`b": infer.WHOLE}
    assert infer.column_kinds(df.limit(0), ["a`b"]) == {"a`b": infer.NUMBER}
    assert infer.column_kinds(df, []) == {}
    assert infer.as_read(df, {"a`b": infer.WHOLE}).columns == ["a`b"]
