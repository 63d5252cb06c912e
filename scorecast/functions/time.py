"""Time arithmetic on epoch seconds.

Timestamps in the data are ``timestamp_ntz``; converting with NTZ
arithmetic keeps every result independent of the session time zone.
Bins are integer arithmetic on seconds, never calendar intervals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS = {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400, "weeks": 604800}
DAY = 86400
WEEK = 604800


def _epoch_ntz() -> Column:
    # from a string: a Python datetime literal would be a zoned timestamp and
    # the cast to NTZ would shift it by the session time zone
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    """``timestamp_ntz`` -> whole epoch seconds (bigint)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", _epoch_ntz(), c)


def seconds_to_ts(secs) -> Column:
    """Epoch seconds -> ``timestamp_ntz`` (the UTC wall clock)."""
    c = F.col(secs) if isinstance(secs, str) else secs
    return F.timestamp_add("SECOND", c, _epoch_ntz())


def step_seconds(step_value: int, step_unit: str) -> int:
    if step_unit not in SECONDS:
        raise ValueError(f"unknown step unit {step_unit!r}; use one of {sorted(SECONDS)}")
    return int(step_value) * SECONDS[step_unit]


def bin_index(secs, origin, step: int) -> Column:
    """0-based left-closed bin of ``secs`` on a grid starting at ``origin``."""
    c = F.col(secs) if isinstance(secs, str) else secs
    o = F.col(origin) if isinstance(origin, str) else F.lit(origin)
    return F.floor((c - o) / F.lit(step)).cast("long")


def align_up(secs, step: int) -> Column:
    """Move a time strictly up to the next multiple of ``step`` (epoch grid)."""
    c = F.col(secs) if isinstance(secs, str) else secs
    return ((F.floor(c / F.lit(step)) + 1) * F.lit(step)).cast("long")


def nearest_label_index(secs, origin, step: int) -> Column:
    """Index j of the nearest right-edge label ``origin + j*step``; ties go up."""
    c = F.col(secs) if isinstance(secs, str) else secs
    o = F.col(origin) if isinstance(origin, str) else F.lit(origin)
    return F.floor((F.lit(2) * (c - o) + F.lit(step)) / F.lit(2 * step)).cast("long")
