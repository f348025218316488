from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import rules
from tests.test_parse import evaluate


def test_category_first_match_wins(spark):
    cases = {
        "Stunting and wasting": "Stunting",
        "WASTING, underweight": "Wasting",
        "Underweight": "Underweight",
        "Anaemia in children": "Anaemia",
        "Anaemia in women": "Other",
        "Mortality under five": "Mortality",
        "Mortality, adults": "Other",
        "Vaccine coverage": "Immunization",
        "Immunization": "Immunization",
        "hospital beds": "Other",
        "": "Other",
    }
    assert evaluate(spark, cases, rules.category) == list(cases.values())


def test_severe_comes_before_moderate(spark):
    cases = {
        "moderate and severe": "Severe",
        "Moderate": "Moderate",
        "stunting": "Overall",
    }
    assert evaluate(spark, cases, rules.severity) == list(cases.values())


def test_scope(spark):
    cases = {
        "Child health": True,
        "Under-5 rate": True,
        "under 5 rate": True,
        "Mortality under": True,
        "Mortality": False,
        "Vaccine coverage": False,
        "Anaemia in women": True,
        None: None,
    }
    assert evaluate(spark, cases, rules.in_scope) == list(cases.values())


@pytest.mark.parametrize(
    "missing, issue, width, score",
    [
        (True, True, 1, 0),
        (False, True, None, 50),
        (False, False, None, 70),
        (False, False, 20.5, 80),
        (False, False, 20, 100),
        (False, False, -5, 100),
    ],
)
def test_quality_score(spark, missing, issue, width, score):
    row = [(missing, issue, width if width is None else float(width))]
    df = spark.createDataFrame(row, "m boolean, i boolean, w double")
    out = df.select(rules.quality_score(F.col("m"), F.col("i"), F.col("w")).alias("s"))
    assert out.head().s == score


@pytest.mark.parametrize(
    "value, previous, pct, trend, significant",
    [
        ("11", "10", "10.00", "Increasing", True),
        ("9", "10", "-10.00", "Decreasing", True),
        ("10", "10", "0.00", "Stable", False),
        ("5", "0", None, "Increasing", False),
        ("5", None, None, "No baseline", False),
        # rounds to 10.00 but is below ten: the unrounded change decides
        ("10.99996", "10", "10.00", "Increasing", False),
        ("1", "3", "-66.67", "Decreasing", True),
        ("8.01", "8", "0.13", "Increasing", False),
        ("-8.01", "8", "-200.13", "Decreasing", True),
        ("1.0000002", "1.0000001", "0.00", "Increasing", False),
        # seventh decimal of the quotient decides: 0.00500000000001 percent
        ("1.000050000000", "1", "0.01", "Increasing", False),
        ("1.000049999999", "1", "0.00", "Increasing", False),
        ("99999999999999999999", "3", "3333333333333333333200.00", "Increasing", True),
        ("12345678901234.5", "12345678901233.5", "0.00", "Increasing", False),
        ("99999999999999999999", "0.000000000001", None, "Increasing", True),
    ],
)
def test_change(spark, value, previous, pct, trend, significant):
    row = [(Decimal(value), None if previous is None else Decimal(previous))]
    df = spark.createDataFrame(row, "v decimal(32,12), p decimal(32,12)")
    v, p = F.col("v"), F.col("p")
    change = rules.percentage_change(v, p)
    out = df.select(
        change.alias("pct"),
        rules.trend(v, p).alias("trend"),
        rules.is_significant(v, p).alias("significant"),
    ).head()
    assert out.pct == (None if pct is None else Decimal(pct))
    assert (out.trend, out.significant) == (trend, significant)


def test_disparity_band(spark):
    cases = {
        "10": "Large disparity",
        "-10": "Large disparity",
        "9.99": "Moderate disparity",
        "5": "Moderate disparity",
        "-1": "Small disparity",
        "0.5": "Minimal disparity",
        "0": "Minimal disparity",
        None: "No data",
    }
    out = evaluate(
        spark, cases, lambda c: rules.disparity_band(c.cast("decimal(32,12)"))
    )
    assert out == list(cases.values())
