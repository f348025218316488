"""A small raw table written by hand."""

from __future__ import annotations

import datetime as dt

from tidemark import Params, schemas

PARAMS = Params(
    current_year=2020,
    focus_location="KEN",
    recent_min_year=2014,
    tie_keys=("k",),
    run_ts=dt.datetime(2020, 6, 1, tzinfo=dt.timezone.utc),
)


def row(name, period, number, *, sex=None, residence=None, wealth=None, **other):
    """One raw row of the focus location; other columns by keyword."""
    base = {
        "indicator": name,
        "indicator_code": "C1",
        "location": "Kenya",
        "location_code": "KEN",
        "period": period,
        "sex": sex,
        "residence": residence,
        "wealth_quintile": wealth,
        "value_numeric": number,
        "value": number,
        "value_ci": None,
    }
    return {**base, **other}


def frame(spark, rows):
    schema = ", ".join(f"{n} string" for n in schemas.RAW.names) + ", k long"
    data = [tuple(r[n] for n in schemas.RAW.names) + (k,) for k, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)
