"""Declared table contracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Values and bounds: up to twenty integer digits and twelve decimals, so that
# differences and the products that compare them stay exact in 38 digits. Text
# that does not fit, or loses decimals to rounding, is listed in the quarantine.
VALUE = T.DecimalType(32, 12)


def _text(name: str, comment: str) -> T.StructField:
    return T.StructField(name, T.StringType(), True, {"comment": comment})


# The column contract of an indicator extract.
RAW = T.StructType(
    [
        _text("indicator", "name of the indicator"),
        _text("indicator_code", "publisher's code of the indicator"),
        _text("location", "country name"),
        _text("location_code", "country code"),
        _text("period", "measurement year, or a range of two years"),
        _text("sex", "male, female or both"),
        _text("residence", "urban, rural or total"),
        _text("wealth_quintile", "q1 to q5 or total"),
        _text("value_numeric", "value as a plain number"),
        _text("value", "value as displayed"),
        _text("value_ci", "confidence interval in square brackets"),
    ]
)

# Types an alternative typed extract overrides.
SEED_TYPES = {
    "YEAR (DISPLAY)": T.StringType(),
    "Numeric": VALUE,
    "Low": VALUE,
    "High": VALUE,
}


def conform_raw(df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Apply the caller's renames and cast the contract columns to text.

    Columns outside the contract (keys, audit columns) pass through.
    """
    df = df.withColumnsRenamed(dict(rename or {}))
    missing = [c for c in RAW.names if c not in df.columns]
    if missing:
        raise ValueError(f"extract lacks columns: {', '.join(missing)}")
    extra = [F.col(c) for c in df.columns if c not in RAW.names]
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in RAW
        ],
        *extra,
    )
