"""Raw indicator rows derived from orders, one per order.

Every case the parsers must handle occurs: see FIXTURES.md section 2.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.params import Params

PARAMS = Params(
    current_year=2001,
    focus_location="KEN",
    recent_min_year=1998,
    tie_keys=("src_key",),
    run_ts=dt.datetime(2001, 12, 31, tzinfo=dt.timezone.utc),
)

# Indicator names by key modulo eight.
NAMES = (
    "stunting in children",
    "wasting in children",
    "underweight in children",
    "anaemia in children",
    "under-five mortality rate",
    "measles immunization, child",
    "overweight in children",
    "hospital beds",
)


# What stands before or behind numbers that try the limits.
MANY_DIGITS = "1234567890123"
MANY_DECIMALS = "0000012345"
TINY = "0.000000"
TOO_LONG = "9" * 30


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(expr: str) -> Column:
    return F.expr(expr).cast("bigint")


def _text(hundredths: Column) -> Column:
    whole = F.floor(hundredths / 100).cast("bigint").cast("string")
    rest = F.pmod(hundredths, F.lit(100)).cast("string")
    return F.concat(whole, F.lit("."), F.lpad(rest, 2, "0"))


def derived_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c_custkey"),
        F.year("o_orderdate").alias("y"),
        "o_orderstatus",
        "o_orderpriority",
        _whole("cast(round(o_totalprice * 100) as bigint) div 5000").alias("h"),
    )
    customer = read(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.col("c_nationkey").alias("nk")
    )
    nation = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nk"), F.col("n_regionkey").alias("r_regionkey")
    )
    region = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # A file is read by as many tasks as it has row groups, maybe by one. Dealt out, all
    # that follows runs on every core, and the stored rows come in as many files.
    orders = orders.repartition(*orders.columns)
    joined = (
        orders.join(customer, "c_custkey").join(nation, "nk").join(region, "r_regionkey")
    )

    k, y, h = F.col("k"), F.col("y"), F.col("h")
    year = y.cast("string")
    prefix = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Severe ")
        .when(F.col("o_orderpriority") == "2-HIGH", "Moderate ")
        .otherwise("")
    )
    name = F.element_at(F.array(*map(F.lit, NAMES)), (k % 8 + 1).cast("int"))
    interval = F.concat(
        F.lit("["),
        _text(F.floor(h * 8 / 10).cast("bigint")),
        F.lit("-"),
        _text(F.floor(h * 12 / 10).cast("bigint")),
        F.lit("]"),
    )
    # Columns of their own are computed once, however often they are used below.
    joined = joined.withColumns({"number": _text(h), "interval": interval})
    number, interval = F.col("number"), F.col("interval")
    quintile = F.col("nk") % 7
    segment, status = F.col("c_mktsegment"), F.col("o_orderstatus")
    return joined.select(
        F.concat(prefix, name).alias("indicator"),
        F.when(k % 89 == 0, "#indicator+code")
        .otherwise(F.concat(F.lit("IND"), (k % 8).cast("string")))
        .alias("indicator_code"),
        F.col("r_name").alias("location"),
        F.when(F.col("r_name").isin("AFRICA", "ASIA"), "KEN")
        .when(F.col("r_name") == "EUROPE", " KEN ")
        .otherwise("XXX")
        .alias("location_code"),
        F.when(k % 97 == 0, "n/a")
        .when(k % 10 == 0, F.concat(year, F.lit("-"), (y + 1).cast("string")))
        .otherwise(year)
        .alias("period"),
        F.when(status == "F", "Female").when(status == "O", "Male").alias("sex"),
        F.when(segment == "AUTOMOBILE", "Urban")
        .when(segment == "BUILDING", "Rural")
        .alias("residence"),
        F.when(
            quintile.between(1, 5), F.concat(F.lit("Q"), quintile.cast("string"))
        ).alias("wealth_quintile"),
        F.when(k % 11 == 0, None)
        .when(k % 13 == 0, "No data")
        .when(k % 37 == 0, F.concat(F.lit(MANY_DIGITS), number))
        .when(k % 41 == 0, F.concat(number, F.lit(MANY_DECIMALS)))
        .when(k % 43 == 0, F.concat(F.lit(TINY), (k % 10).cast("string")))
        .when(k % 211 == 0, TOO_LONG)
        .otherwise(number)
        .alias("value_numeric"),
        F.when(k % 17 == 0, "")
        .when(k % 143 == 0, "1.2.3")
        .otherwise(number)
        .alias("value"),
        F.when(k % 7 == 0, None)
        .when(k % 223 == 0, "[1.2.3-4]")
        .when(k % 227 == 0, f"[5-{TOO_LONG}]")
        .when(k % 229 == 0, f"[0.5-7.5{MANY_DECIMALS}0001]")
        .when(k % 19 == 0, F.concat(number, F.lit(" "), interval))
        .otherwise(interval)
        .alias("value_ci"),
        k.alias("src_key"),
    )
