"""Defensive parsing of published text into years, numbers and bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import blank_to_null
from tidemark.schemas import VALUE

# Java's $ also matches before a trailing newline, hence \A and \z. A number is
# digits and dots, spaces around it aside; group 1 is the number.
YEAR_OR_RANGE = r"\A[0-9]{4}(-[0-9]{4})?\z"
NUMBER = r"\A *([0-9.]+) *\z"
LOWER_BOUND = r"\A *([0-9.]+) *(?:-|\z)"
# A thirteenth or later decimal that is not zero.
TOO_FINE = r"\.[0-9]{12}[0-9]*[1-9]"
UPPER_BOUND = r"\A[^-]*- *([0-9.]+) *(?:-|\z)"


def parse_year(period: Column) -> Column:
    """Year of ``2014`` or first year of ``2014-2018``; otherwise NULL.

    The text is not stripped first, so a padded period has no year.
    """
    return F.when(
        period.rlike(YEAR_OR_RANGE), F.substring(period, 1, 4).cast("int")
    )


def looks_numeric(c: Column) -> Column:
    return F.coalesce(c.rlike(NUMBER), F.lit(False))


def _text(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def _captured(c: Column, pattern: str) -> Column:
    return _text(c, pattern).try_cast(VALUE)


def _unstorable(text: Column) -> Column:
    """Digits and dots that are no number, don't fit, or have too many decimals."""
    lossy = text.rlike(TOO_FINE)
    return text.isNotNull() & (text.try_cast(VALUE).isNull() | lossy)


def unstorable_number(c: Column) -> Column:
    return _unstorable(_text(c.cast("string"), NUMBER))


def unstorable_bound(interval: Column) -> Column:
    """Either bound of an interval cannot be stored."""
    bare = _inside_brackets(interval)
    return _unstorable(_text(bare, LOWER_BOUND)) | _unstorable(_text(bare, UPPER_BOUND))


def parse_number(c: Column) -> Column:
    """Digits and dots only; text such as ``1.2.3`` looks numeric but is no
    number and gives NULL."""
    return _captured(c.cast("string"), NUMBER)


def parse_value(value_numeric: Column, display: Column) -> Column:
    return F.coalesce(parse_number(value_numeric), parse_number(display))


def _inside_brackets(interval: Column) -> Column:
    bare = F.replace(F.replace(interval, F.lit("[")), F.lit("]"))
    return F.when(interval.like("%[%]%"), bare)


def lower_bound(interval: Column) -> Column:
    """Number before the first dash of ``[10-14]``.

    A value in front of the bracket stays glued to it, and the two together are
    no number: ``12 [10-14]`` has only an upper bound.
    """
    return _captured(_inside_brackets(interval), LOWER_BOUND)


def upper_bound(interval: Column) -> Column:
    """Number between the first dash and the next, or the end."""
    return _captured(_inside_brackets(interval), UPPER_BOUND)


def is_missing(value: Column, display: Column) -> Column:
    """No value, or a blank display value even if the numeric one parsed."""
    return value.isNull() | blank_to_null(display).isNull()


def used_fallback(value: Column, value_numeric: Column) -> Column:
    """A value exists although the numeric column is NULL."""
    return value_numeric.isNull() & value.isNotNull()
