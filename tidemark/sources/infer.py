"""Types of text columns as a data-frame reader infers them from whole files.

A column of numbers alone is read as numbers and leaves as their shortest text, so
``1e3`` and ``1.0`` become ``1000`` and ``1``; one other text keeps the column as it is.
Kinds form a lattice (nothing, whole numbers, numbers, truths, texts): the kind of a
column joins those of its values, so all columns are folded in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE, NUMBER, TRUTH, TEXT = "whole", "number", "truth", "text"

# Texts read as truths, and what numbers look like.
TRUTHS = ("True", "TRUE", "true", "False", "FALSE", "false")
_INTEGER = r"\A\s*[+-]?[0-9]+\s*\z"
_FLOAT = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
_INFINITE = r"(?i)\A\s*[+-]?inf(inity)?\s*\z"


def _long(c: Column) -> Column:
    """A whole number of 64 bits; NULL beyond. The cast takes off blanks around it."""
    return c.try_cast("long")


def _facts(c: Column) -> Column:
    integer = c.rlike(_INTEGER)
    return F.struct(
        F.count(c).alias("n"),
        F.count_if(c.isNull()).alias("nulls"),
        F.count_if(integer).alias("integers"),
        F.count_if(integer & _long(c).isNull()).alias("too_large"),
        F.count_if(integer | c.rlike(_FLOAT) | c.rlike(_INFINITE)).alias("numbers"),
        F.count_if(c.isin(*TRUTHS)).alias("truths"),
    )


def column_kinds(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The kind of each column over all rows; NULLs are missing values.

    Whole numbers with a missing value among them are numbers, as a column of 64-bit
    integers can't hold it. Whole numbers alone that don't all fit 64 bits are texts. A
    column without values is one of numbers. One row reaches the driver.
    """
    if not columns:
        return {}
    named = {f"c{k}": F.col(f"`{c.replace('`', '``')}`") for k, c in enumerate(columns)}
    facts = df.agg(*[_facts(c).alias(k) for k, c in named.items()]).first()

    def kind(f) -> str:
        if f["numbers"] == f["n"]:
            if f["integers"] < f["n"] or not f["n"]:
                return NUMBER
            if f["too_large"]:
                return TEXT
            return NUMBER if f["nulls"] else WHOLE
        return TRUTH if f["truths"] == f["n"] else TEXT

    return {c: kind(facts[k]) for k, c in zip(named, columns, strict=True)}


def _bare(c: Column) -> Column:
    """A decimal text without zeros at its end."""
    return F.rtrim(F.rtrim(c, F.lit("0")), F.lit("."))


def shortest(x: Column) -> Column:
    """A double as the shortest text that reads back as it: plain from 1e-4 up to 1e15,
    else with a signed exponent of two digits at least."""
    return _shortest(x, x.cast("string"))


def _shortest(x: Column, text: Column) -> Column:
    """``shortest`` of a double and of its text, which both are used often."""
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0\z", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.abs(power).cast("string")
    signed = F.concat(
        mantissa,
        F.when(power < 0, "e-").otherwise("e+"),
        F.lpad(digits, F.greatest(F.length(digits), F.lit(2)), F.lit("0")),
    )
    # Enough decimals for seventeen digits behind four zeros.
    spelt_out = text.try_cast("decimal(38,22)").cast("string")
    size = F.abs(x)
    return (
        F.when(F.isnan(x), "NaN")
        .when(size == float("inf"), F.when(x > 0, "Infinity").otherwise("-Infinity"))
        .when(x == 0, F.when(text.startswith("-"), "-0").otherwise("0"))
        .when(
            (size >= 1e-4) & (size < 1e15),
            _bare(F.when(text.contains("E"), spelt_out).otherwise(text)),
        )
        .otherwise(signed)
    )


def as_read(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns of ``kinds`` as the reader would hand them on as text.

    Every double, and its text, is a column first: that way it is computed once, while
    an expression would compute it wherever it stands.
    """

    def named(name: str) -> Column:
        return F.col(f"`{name.replace('`', '``')}`")

    def free(stem: str) -> str:
        while stem.lower() in taken:
            stem += "_"
        return stem

    taken = {c.lower() for c in df.columns}
    numbers = [c for c in df.columns if kinds.get(c) == NUMBER]
    doubles = {c: free(f"__x{k}") for k, c in enumerate(numbers)}
    texts = {c: free(f"__t{k}") for k, c in enumerate(numbers)}
    # Blanks around a number, and infinity in all its spellings, are the cast's business.
    df, columns = df.withColumns({x: named(c).try_cast("double") for c, x in doubles.items()}), df.columns
    df = df.withColumns({t: F.col(doubles[c]).cast("string") for c, t in texts.items()})

    def rendered(name: str) -> Column:
        c, kind = named(name), kinds.get(name)
        if kind == WHOLE:
            return _long(c).cast("string")
        if kind == NUMBER:
            return _shortest(F.col(doubles[name]), F.col(texts[name]))
        return F.lower(c) if kind == TRUTH else c

    return df.select(*[rendered(c).alias(c) for c in columns])
