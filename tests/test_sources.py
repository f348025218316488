import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import extract, headers

RUN_TS = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


def read(spark, tmp_path, text, **options):
    path = tmp_path / "extract.csv"
    path.write_text(text, encoding="utf-8")
    return extract.read_extract(spark, str(path), RUN_TS, **options)


def in_file_order(df):
    return df.orderBy("source_file", "source_block", "source_row").collect()


def test_header_names():
    names = [" Indicator Code ", "VALUE (CI)", "Value-Numeric!", "Value", "Value", ""]
    assert headers.normalized_names(names) == [
        "indicator_code",
        "value_ci",
        "valuenumeric",
        "value",
        "value1",
        "unnamed_5",
    ]


def test_repeated_headers_avoid_taken_suffixes():
    assert headers.distinct_headers(["v", "v", "v.1", "v"]) == ["v", "v.2", "v.1", "v.3"]


def test_clashing_headers_are_refused():
    with pytest.raises(ValueError, match="value"):
        headers.normalized_names(["Value", "value "])


def test_quotes_tokens_and_blank_lines(spark, tmp_path):
    text = (
        'Name,"Value, shown",Note\n'
        '"a, b","say ""hi""", padded \n'
        "\n"
        "NA,null,nan\n"
        'N/A,"",none\n'
        "#indicator+code,n/a,None\n"
    )
    out = read(spark, tmp_path, text).rows
    rows = [(r.name, r.value_shown, r.note) for r in in_file_order(out)]
    assert rows == [
        ("a, b", 'say "hi"', " padded "),
        (None, None, None),
        (None, None, "none"),
        ("#indicator+code", None, None),
    ]
    assert out.select("ingestion_timestamp").distinct().count() == 1
    assert out.head().source_file == "extract.csv"


def test_short_lines_are_filled(spark, tmp_path):
    rows = in_file_order(read(spark, tmp_path, "a,b,c\n1,2,3\n4\n").rows)
    assert [(r.a, r.b, r.c) for r in rows] == [("1", "2", "3"), ("4", None, None)]


def test_long_lines_fail_or_are_set_aside(spark, tmp_path):
    text = "a,b\n1,2\n3,4,5\n6,7,8,9\n"
    with pytest.raises(PySparkException, match="more fields"):
        read(spark, tmp_path, text).rows.collect()
    lenient = read(spark, tmp_path, text, strict=False)
    assert [(r.a, r.b) for r in lenient.rows.collect()] == [("1", "2")]
    assert sorted(r.a for r in lenient.rejected.collect()) == ["3", "6"]


def test_empty_extra_fields_are_extra_too(spark, tmp_path):
    text = (
        "a,b\n"
        "1,2,\n"
        "3,4,,\n"
        "5,6,,7\n"
        '"8,8","9,9",\n'
        '"10,10","11,11"\n'
        '"12,""12,"",","""13,"""\n'
        '"",",,,"\n'
        '14,"15,\t,",,16\n'
    )
    lenient = read(spark, tmp_path, text, strict=False)
    kept = [(r.a, r.b) for r in in_file_order(lenient.rows)]
    assert kept == [("10,10", "11,11"), ('12,"12,",', '"13,"'), (None, ",,,")]
    assert [r.a for r in in_file_order(lenient.rejected)] == ["1", "3", "5", "8,8", "14"]


def test_strict_count_also_fails(spark, tmp_path):
    with pytest.raises(PySparkException, match="more fields"):
        read(spark, tmp_path, "a,b\n1,2,3\n").rows.count()


def test_line_breaks_inside_quotes(spark, tmp_path):
    text = 'a,b\n"one\ntwo",2\n3,4\n'
    rows = in_file_order(read(spark, tmp_path, text, multi_line=True).rows)
    assert [(r.a, r.b) for r in rows] == [("one\ntwo", "2"), ("3", "4")]


def test_file_order_survives_splitting(spark, tmp_path):
    lines = [f"{i},{'x' * 40}" for i in range(5000)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = read(spark, tmp_path, "\n".join(["n,pad", *lines]) + "\n").rows
        assert out.rdd.getNumPartitions() > 4
        assert [int(r.n) for r in in_file_order(out)] == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_byte_order_mark(spark, tmp_path):
    rows = read(spark, tmp_path, "﻿name,v\nx,1\n").rows
    assert [(r.name, r.v) for r in rows.collect()] == [("x", "1")]


def test_typed_columns(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("YEAR (DISPLAY),Numeric,Low,High,Note\n2014,1.5,x,,NA\n")
    df = extract.read_typed(spark, str(path)).rows.drop(*extract.ORDER)
    assert dict(df.dtypes)["Low"] == "decimal(32,12)"
    assert df.columns == ["YEAR (DISPLAY)", "Numeric", "Low", "High", "Note"]
    assert tuple(df.head()) == ("2014", Decimal("1.500000000000"), None, None, None)


def test_typed_rows_share_header_names_and_surplus_detection(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("Value,Numeric,Value\nx,1.5,y\nx,2,y,SURPLUS\n")
    with pytest.raises(PySparkException, match="more fields"):
        extract.read_typed(spark, str(path)).rows.collect()
    lenient = extract.read_typed(spark, str(path), strict=False)
    rows = lenient.rows.drop(*extract.ORDER)
    assert rows.columns == ["Value", "Numeric", "Value.1"]
    assert [tuple(r) for r in rows.collect()] == [("x", Decimal("1.5"), "y")]
    assert [r.line for r in lenient.rejected.collect()] == ["x,2,y,SURPLUS"]


def test_seed_rows_under_the_raw_contract(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(
        "Indicator Code,YEAR (DISPLAY),Numeric,Low,High\nC1,2014,1.5,1,2\nC2,2015,x,,2\n"
    )
    rows = extract.raw_from_seed(extract.read_typed(spark, str(path)).rows, RUN_TS)
    found = [
        (r.indicator_code, r.period, r.value_numeric, r.value, r.value_ci)
        for r in in_file_order(rows)
    ]
    one, two = "1.000000000000", "2.000000000000"
    assert found == [
        ("C1", "2014", "1.500000000000", "1.500000000000", f"[{one}-{two}]"),
        ("C2", "2015", None, None, None),
    ]


@pytest.mark.parametrize("second", ["value,name", "name", "name,value,more", "name,other"])
@pytest.mark.parametrize("header", ["name,value", "name,name", "name,"])
def test_files_with_another_header_fail(spark, tmp_path, header, second):
    folder = tmp_path / "extract"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{header}\na,1\nb,2\n")
    (folder / "b.csv").write_text(f"{second}\n3,c\n")
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        extract.read_extract(spark, str(folder), RUN_TS, strict=False).rows.collect()
    (folder / "b.csv").write_text(f"{header}\nc,3\n")
    rows = extract.read_extract(spark, str(folder), RUN_TS).rows
    assert sorted(r[0] for r in rows.collect()) == ["a", "b", "c"]


def test_line_break_in_a_quoted_header(spark, tmp_path):
    text = 'name,"Value\n(shown)"\nx,1\n'
    rows = read(spark, tmp_path, text, multi_line=True).rows
    assert rows.columns[:2] == ["name", "valueshown"]
    assert [tuple(r)[:2] for r in rows.collect()] == [("x", "1")]


def test_audit_columns_hold_one_batch_time(spark):
    df = extract.audit_columns(spark.range(3), RUN_TS, "a.csv")
    row = df.agg(
        F.count_distinct("ingestion_timestamp").alias("times"),
        F.first("source_file").alias("name"),
    ).head()
    assert (row.times, row["name"]) == (1, "a.csv")


def test_contract(spark):
    df = spark.createDataFrame(
        [tuple(["x"] * 10 + [3.5, 1])],
        ["Disease", *schemas.RAW.names[1:10], "value_ci", "extra"],
    )
    out = schemas.conform_raw(df, {"Disease": "indicator"})
    assert out.columns == [*schemas.RAW.names, "extra"]
    assert dict(out.dtypes)["value_ci"] == "string"
    assert "bracket" in out.schema["value_ci"].metadata["comment"]
    with pytest.raises(ValueError, match="indicator"):
        schemas.conform_raw(df)
