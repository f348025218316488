"""Column names that do not get in each other's way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with as many underscores behind as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def quoted(name: str, table: str = "") -> Column:
    """A column by its exact name, dots and backticks included."""
    name = "`" + name.replace("`", "``") + "`"
    return F.col(f"{table}.{name}" if table else name)


def own(df: DataFrame, table: str = "") -> list[Column]:
    """All columns of ``df`` by their exact names."""
    return [quoted(c, table) for c in df.columns]
