"""Averages against exact fractions."""

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rules import PERCENT
from tidemark.operators.exact import average, mean, merged, total
from tidemark.schemas import VALUE


@pytest.fixture(autouse=True)
def exact_decimals():
    with localcontext() as context:
        context.prec = 200
        yield


def expected(values, digits):
    values = [v for v in values if v is not None]
    if not values:
        return None
    return (sum(values) / len(values)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def column(spark, values, dtype):
    rows = [(k % 3, v) for k, v in enumerate(values)]
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("x", dtype)])
    return spark.createDataFrame(rows, schema)


def drawn(rng, dtype):
    limit = 10**dtype.precision - 1
    out = []
    for _ in range(rng.randint(0, 8)):
        size = 10 ** rng.randint(0, dtype.precision) - 1
        unit = rng.choice([rng.randint(-size, size), limit, -limit, 0, 1, -1, 5, -5])
        out.append(None if rng.random() < 0.1 else Decimal(unit).scaleb(-dtype.scale))
    return out


@pytest.mark.parametrize("dtype, wanted", [(VALUE, (1, 2, 4, 16)), (PERCENT, (1, 2, 4))])
def test_rounded_once_whatever_the_total(spark, dtype, wanted):
    rng = random.Random(7)
    groups = [drawn(rng, dtype) for _ in range(300)]
    schema = T.StructType([T.StructField("g", T.LongType()), T.StructField("x", dtype)])
    df = spark.createDataFrame([(g, v) for g, vs in enumerate(groups) for v in vs], schema)
    out = df.groupBy("g").agg(*[average(F.col("x"), d, dtype).alias(f"d{d}") for d in wanted])
    found = {r["g"]: r for r in out.collect()}
    assert len(found) == sum(bool(vs) for vs in groups)
    for g, row in found.items():
        for d in wanted:
            assert row[f"d{d}"] == expected(groups[g], d), (groups[g], d)


def test_totals_of_parts_merge(spark):
    values = [Decimal("-99999999999999999999.999999999999")] * 7 + [
        None, Decimal("0.000000000001"), Decimal("12345678901234567890.5"),
    ]
    parts = column(spark, values, VALUE).groupBy("part").agg(total(F.col("x")).alias("t"))
    assert parts.agg(mean(merged("t"), 16).alias("a")).first()["a"] == expected(values, 16)


def test_total_of_more_than_38_digits(spark):
    # 10**32 rows' worth of the largest value: limbs as an earlier step would leave them.
    n = 10**17
    high, low = divmod(10**31 - 1, 10**18)
    limbs = spark.range(1).select(
        F.struct(
            F.lit(str(high * n)).cast("decimal(38,0)").alias("high"),
            F.lit(str(low * n)).cast("decimal(38,0)").alias("low"),
            F.lit(n).cast("long").alias("n"),
        ).alias("t")
    )
    found = limbs.select(mean(F.col("t"), 16).alias("a")).first()["a"]
    assert found == Decimal(10**31 - 1).scaleb(-12)


def test_ten_to_the_19_in_many_rows(spark):
    df = spark.range(1_000_000).select(F.lit("9999999999999999999.25").alias("x"))
    assert df.agg(average(F.col("x"), 2).alias("a")).first()["a"] == Decimal(
        "9999999999999999999.25"
    )


def test_no_values_have_no_average(spark):
    df = column(spark, [None, None], VALUE)
    assert df.agg(average(F.col("x"), 2).alias("a")).first()["a"] is None
    assert df.limit(0).agg(average(F.col("x"), 2).alias("a")).first()["a"] is None
    assert df.limit(0).groupBy("part").agg(average(F.col("x"), 2)).collect() == []


def test_integers_and_too_many_digits(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert df.agg(average(F.col("x"), 1).alias("a")).first()["a"] == Decimal("1.5")
    try:
        average(F.col("x"), 16, PERCENT)
    except ValueError as e:
        assert "16 decimals" in str(e)
    else:
        raise AssertionError
