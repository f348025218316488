from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import parse, text


def evaluate(spark, values, expr):
    """Apply ``expr`` to a column of texts, keeping their order."""
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, x string")
    return [r.v for r in df.select("i", expr(F.col("x")).alias("v")).orderBy("i").collect()]


def dec(x):
    return None if x is None else Decimal(x)


def test_year(spark):
    cases = {
        "2014": 2014,
        "2014-2018": 2014,
        " 2014": None,
        "2014 ": None,
        "2014-18": None,
        "2014\n": None,
        "n/a": None,
        "": None,
        None: None,
        "0999": 999,
    }
    assert evaluate(spark, cases, parse.parse_year) == list(cases.values())


def test_number(spark):
    cases = {
        "12.5": "12.5",
        " 12.5 ": "12.5",
        "5.": "5",
        ".5": "0.5",
        "0": "0",
        "007": "7",
        "-3": None,
        "+3": None,
        "1e3": None,
        "1,000": None,
        "<0.1": None,
        "1.2.3": None,
        ".": None,
        "": None,
        "  ": None,
        None: None,
        "12\n": None,
        "\t12": None,
        "1.23456789": "1.23456789",
        "1.1234567890126": "1.123456789013",
        "99999999999999999999": "99999999999999999999",
        "100000000000000000000": None,
    }
    expected = [dec(v) for v in cases.values()]
    assert evaluate(spark, cases, parse.parse_number) == expected


def test_looks_numeric_is_never_null(spark):
    cases = {"1.2.3": True, ".": True, " 7 ": True, "": False, None: False, "a": False}
    assert evaluate(spark, cases, parse.looks_numeric) == list(cases.values())


@pytest.mark.parametrize(
    "interval, low, high",
    [
        ("[10-14]", "10", "14"),
        ("[ 10.5 - 14 ]", "10.5", "14"),
        ("12 [10-14]", None, "14"),
        ("[-3-5]", None, "3"),
        ("10-14", None, None),
        ("[10]", "10", None),
        ("[a-b]", None, None),
        ("[10-14-18]", "10", "14"),
        ("[]", None, None),
        ("]10-14[", None, None),
        ("[1.2.3-4]", None, "4"),
        (None, None, None),
    ],
)
def test_bounds(spark, interval, low, high):
    assert evaluate(spark, [interval], parse.lower_bound) == [dec(low)]
    assert evaluate(spark, [interval], parse.upper_bound) == [dec(high)]


def test_value_falls_back_to_the_display_value(spark):
    rows = [
        (0, "12.5", "9"),
        (1, None, "9"),
        (2, "No data", "9"),
        (3, "1.2.3", "9"),
        (4, None, "No data"),
        (5, "7", ""),
    ]
    df = spark.createDataFrame(rows, "i int, n string, d string").withColumn(
        "v", parse.parse_value(F.col("n"), F.col("d"))
    )
    out = df.select(
        "v",
        parse.is_missing(F.col("v"), F.col("d")).alias("missing"),
        parse.used_fallback(F.col("v"), F.col("n")).alias("issue"),
    ).collect()
    assert [r.v for r in out] == [dec(x) for x in ("12.5", "9", "9", "9", None, "7")]
    # a blank display value counts as missing although a number is there
    assert [r.missing for r in out] == [False, False, False, False, True, True]
    # only a NULL numeric column counts as an issue, not an unusable text
    assert [r.issue for r in out] == [False, True, False, False, False, False]


def test_clean_strips_spaces_only(spark):
    assert evaluate(spark, ["  a b ", "\ta"], text.clean) == ["a b", "\ta"]


def test_default_dimension(spark):
    cases = {"Male": "male", " BOTH ": "both", "": "", "  ": "", None: "both"}
    out = evaluate(spark, cases, lambda c: text.default_dimension(c, "both"))
    assert out == list(cases.values())


def test_title_case(spark):
    cases = {
        "q1 (poorest)": "Q1 (Poorest)",
        "semi-urban": "Semi-Urban",
        "both sexes": "Both Sexes",
        "ABC dEF": "Abc Def",
        "o'neil/smith_x": "O'Neil/Smith_X",
        "école élémentaire": "École Élémentaire",
        "2nd quintile": "2nd Quintile",
        "": "",
        None: None,
    }
    assert evaluate(spark, cases, text.title_case) == list(cases.values())


def test_recode(spark):
    labels = {"a": "Alpha", "b": "Beta"}
    out = evaluate(
        spark, ["a", "b", "c", None], lambda c: text.recode(c, labels, F.upper(c))
    )
    assert out == ["Alpha", "Beta", "C", None]


def test_unstorable_numbers(spark):
    cases = {
        "1.2.3": True,
        ".": True,
        "100000000000000000000": True,
        "1.1234567890126": True,
        "1.12345678901200": False,
        "12.5": False,
        "No data": False,
        None: False,
    }
    assert evaluate(spark, cases, parse.unstorable_number) == list(cases.values())


def test_unstorable_bounds(spark):
    cases = {
        "[1.2.3-4]": True,
        "[5-99999999999999999999999]": True,
        "[5-1.0000000000001]": True,
        "[5-7.5]": False,
        "12 [10-14]": False,
        "5-99999999999999999999999": False,
        None: False,
    }
    assert evaluate(spark, cases, parse.unstorable_bound) == list(cases.values())
