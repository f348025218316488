"""Keyword classification, scoring, trends and bands."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import VALUE

PERCENT = T.DecimalType(34, 2)

# Each rule is (label, alternatives); an alternative is the set of
# words that must all occur in the lower-cased name. The first rule wins.
CATEGORY_RULES = (
    ("Stunting", (("stunting",),)),
    ("Wasting", (("wasting",),)),
    ("Underweight", (("underweight",),)),
    ("Anaemia", (("anaemia", "child"),)),
    ("Mortality", (("mortality", "under"),)),
    ("Immunization", (("immunization",), ("vaccine",))),
)
SEVERITY_RULES = (
    ("Severe", (("severe",),)),
    ("Moderate", (("moderate",),)),
)
SCOPE = (
    ("child",),
    ("stunting",),
    ("wasting",),
    ("underweight",),
    ("under-5",),
    ("under 5",),
    ("anaemia",),
    ("mortality", "under"),
)
OTHER = "Other"
CATEGORIES = tuple(label for label, _ in CATEGORY_RULES)


def _mentions(lowered: Column, alternatives) -> Column:
    return reduce(
        or_,
        (
            reduce(and_, (lowered.contains(w) for w in words))
            for words in alternatives
        ),
    )


def _first_match(name: Column, rules, otherwise: str) -> Column:
    lowered = F.lower(name)
    out = F.lit(otherwise)
    for label, alternatives in reversed(rules):
        out = F.when(_mentions(lowered, alternatives), label).otherwise(out)
    return out


def category(name: Column) -> Column:
    return _first_match(name, CATEGORY_RULES, OTHER)


def severity(name: Column) -> Column:
    return _first_match(name, SEVERITY_RULES, "Overall")


def in_scope(name: Column) -> Column:
    return _mentions(F.lower(name), SCOPE)


def quality_score(missing: Column, issue: Column, ci_width: Column) -> Column:
    # Scores and the width above which an interval counts as wide.
    return (
        F.when(missing, 0)
        .when(issue, 50)
        .when(ci_width.isNull(), 70)
        .when(ci_width > 20, 80)
        .otherwise(100)
    )


def percentage_change(value: Column, previous: Column) -> Column:
    """In hundredths of a percent, rounded half up once; NULL without a baseline
    or with a baseline of zero.

    Both are VALUE decimals. The quotient is an integer division, as Spark's own
    keeps six decimals only at this width; that serves beyond 10**14 percent.
    """
    size, base = F.abs(value - previous).cast(VALUE), F.abs(previous)
    twice = (size * F.lit(20000).cast("decimal(5,0)")).cast("decimal(37,12)") + base
    whole = F.call_function("div", twice, base * F.lit(2).cast("decimal(1,0)"))
    exact = (whole.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(PERCENT)
    far = F.try_multiply(F.try_divide(size, base), F.lit(100).cast("decimal(3,0)"))
    near = size.cast("double") < base.cast("double") * 1e12
    pct = F.when(near, exact).otherwise(F.round(far, 2).try_cast(PERCENT))
    falls = (value < previous) != (previous < 0)
    return F.when(previous != 0, F.when(falls, -pct).otherwise(pct))


def trend(value: Column, previous: Column) -> Column:
    return (
        F.when(previous.isNull(), "No baseline")
        .when(value > previous, "Increasing")
        .when(value < previous, "Decreasing")
        .otherwise("Stable")
    )


def is_significant(value: Column, previous: Column) -> Column:
    """A change by a tenth of the baseline or more."""
    tenfold = F.abs(value - previous) * F.lit(10).cast("decimal(2,0)")
    return F.coalesce((previous != 0) & (tenfold >= F.abs(previous)), F.lit(False))


def disparity_band(gap: Column) -> Column:
    size = F.abs(gap)
    return (
        F.when(size >= 10, "Large disparity")
        .when(size >= 5, "Moderate disparity")
        .when(size >= 1, "Small disparity")
        .when(gap.isNotNull(), "Minimal disparity")
        .otherwise("No data")
    )
