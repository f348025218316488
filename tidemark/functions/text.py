"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(c: Column) -> Column:
    """Cast to text and strip spaces (tabs stay)."""
    return F.trim(c.cast("string"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(clean(c), F.lit(""))


def default_dimension(c: Column, default: str) -> Column:
    """Lower-cased, stripped dimension code; only NULL takes the default."""
    return F.trim(F.lower(F.coalesce(c.cast("string"), F.lit(default))))


def title_case(c: Column) -> Column:
    """Capitalise after every non-alphanumeric character.

    Spark's initcap starts a new word after whitespace only.
    """
    pieces = F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    cased = F.transform(
        pieces,
        lambda w: F.concat(
            F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))
        ),
    )
    return F.array_join(cased, "")


def recode(c: Column, labels: Mapping[str, str], otherwise: Column) -> Column:
    """Replace known codes by their labels."""
    out = otherwise
    for code, label in reversed(labels.items()):
        out = F.when(c == code, F.lit(label)).otherwise(out)
    return out
