"""Run parameters shared by the plans."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class Params:
    """Everything a run can vary.

    ``tie_keys`` are raw columns that make (indicator, location, period) a
    total order, so generated ids do not depend on how Spark laid out the data.
    ``run_ts`` is one literal per run; every ``updated_at`` carries it.
    """

    current_year: int = 2024
    focus_location: str = "KEN"
    recent_min_year: int = 2014
    tie_keys: tuple[str, ...] = ("source_file", "source_block", "source_row")
    # True numbers only the rows staging keeps, so the rest is never sorted; ids
    # then have no gaps and differ from those of the whole table.
    ids_after_filter: bool = False
    run_ts: dt.datetime = field(default_factory=_now)
    # A LAG group above hot_rows is cut into chunks of at most chunk_rows rows.
    hot_rows: int = 1_000_000
    chunk_rows: int = 1_000_000
