"""Averages of decimals without a limit on their total.

Spark keeps 38 digits, so the sum of a column of 34-digit decimals overflows after
some rows. A value is cut here into two limbs of at most 18 and 20 digits, which are
summed apart (partially, then finally, like any sum) and divided by hand at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import VALUE

#: Digits of the low limb; a remainder times this many tens still fits 38 digits.
_LIMB = 18
_WHOLE = "decimal(38,0)"
#: A limb before its sum: Spark adds ten digits to it, for 10**18 rows and more.
_PART = "decimal(28,0)"


def _ten(power: int) -> Column:
    return F.lit("1" + "0" * power).cast(f"decimal({power + 1},0)")


def _let(f: Callable[..., Column], **values: Column) -> Column:
    """``f`` of some values, each computed once however often ``f`` names it."""
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.transform(F.array(row), lambda r: f(*[r[k] for k in values]))[0]


def _rest(a: Column, b: Column) -> Column:
    """The remainder of whole decimals; a >= 0, b > 0."""
    return (a % b).cast(_WHOLE)


def _quotient(a: Column, b: Column) -> Column:
    """The quotient without its remainder, which has at most 32 digits."""
    return ((a - _rest(a, b)).cast(_WHOLE) / b).cast(_WHOLE)


def _digits(units: Column, n: int) -> tuple[Column, Column]:
    """The digits of a whole number without its last n, and the last n."""
    text = F.lpad(units.cast("string"), 40, "0")
    return F.substring(text, 1, 40 - n), F.substring(text, 41 - n, n)


def total(c: Column, dtype: T.DecimalType = VALUE) -> Column:
    """Sum and count of ``c``, cast to ``dtype`` first, as a struct (high, low, n).

    The sum is high * 10**18 + low, in units of the last decimal of ``dtype``; low
    isn't negative. Over no values both limbs are NULL and n is 0.
    """
    c = c.cast(dtype)
    units = (c * _ten(dtype.scale)).cast(_WHOLE)
    low = F.pmod(units, _ten(_LIMB)).cast(_WHOLE)
    high = ((units - low).cast(_WHOLE) / _ten(_LIMB)).cast(_PART)
    return F.struct(
        F.sum(high).alias("high"), F.sum(low.cast(_PART)).alias("low"), F.count(c).alias("n")
    )


def merged(name: str) -> Column:
    """The total of a column of totals."""
    return F.struct(*[F.sum(f"{name}.{part}").alias(part) for part in ("high", "low", "n")])


def mean(of: Column, digits: int, dtype: T.DecimalType = VALUE) -> Column:
    """A total divided by its count, rounded half away from zero to ``digits``
    decimals in one step; NULL over no values.

    An average is no larger than the largest value, so it has the integer digits of
    ``dtype`` at most: they and ``digits`` must not exceed 38 together, and ``digits``
    may exceed the decimals of ``dtype`` by 18.
    """
    extra = digits - dtype.scale
    size = dtype.precision - dtype.scale + digits + (extra < 0)  # 9.9 rounds to 10
    if size > 38 or extra > _LIMB:
        raise ValueError(f"an average of {dtype.simpleString()} can't have {digits} decimals")
    limb = _ten(_LIMB)

    def sized(high, low, n):
        # Below zero, high is negative and low counts upwards from it.
        below = high < 0
        up = (F.when(low > 0, -1).otherwise(0) - high).cast(_WHOLE)
        down = F.when(low > 0, limb - low).otherwise(low).cast(_WHOLE)
        return _let(
            divided,
            below=below,
            high=F.when(below, up).otherwise(high),
            low=F.when(below, down).otherwise(low),
            n=n,
        )

    def divided(below, high, low, n):
        rest = (_rest(high, n) * limb).cast(_WHOLE) + low
        return _let(joined, below=below, first=_quotient(high, n), rest=rest.cast(_WHOLE), n=n)

    def joined(below, first, rest, n):
        units = (first * limb).cast(_WHOLE) + _quotient(rest, n)
        return _let(rounded, below=below, units=units.cast(_WHOLE), rest=_rest(rest, n), n=n)

    def rounded(below, units, rest, n):
        if extra < 0:
            half = F.lit("5" + "0" * (-extra - 1)).cast(f"decimal({-extra},0)")
            units = _digits((units + half).cast(_WHOLE), -extra)[0].cast(_WHOLE)
        else:
            twice = (rest * _ten(extra)).cast(_WHOLE) * 2 + n
            units = (units * _ten(extra)).cast(_WHOLE) + _quotient(twice.cast(_WHOLE), n * 2)
        return _let(written, below=below, units=units.cast(_WHOLE))

    def written(below, units):
        # As text: the type of a division would lose digits, and Spark's minus keeps 34.
        text = F.concat(F.when(below, "-").otherwise(""), _digits(units, digits)[0])
        if digits:
            text = F.concat(text, F.lit("."), _digits(units, digits)[1])
        return text.cast(T.DecimalType(size, digits))

    return F.when(
        of["n"] > 0,
        _let(
            sized,
            high=(of["high"] + _quotient(of["low"], limb)).cast(_WHOLE),
            low=_rest(of["low"], limb),
            n=of["n"].cast("decimal(19,0)"),
        ),
    )


def average(c: Column, digits: int = 16, dtype: T.DecimalType = VALUE) -> Column:
    """AVG of ``c`` rounded once, also for integers."""
    return mean(total(c, dtype), digits, dtype)
