"""Fixed time windows as plain arithmetic.

A window start is an ordinary column here, so joins on it are equi-joins and
aggregations on it need no extra operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirwatch.fixed_values import OFF_HOURS_END, OFF_HOURS_START

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def window_seconds(window: str) -> int:
    """Length in seconds of text such as ``5 minutes``."""
    count, unit = window.split()
    unit = unit.rstrip("s")
    if unit not in _UNITS or int(count) <= 0:
        raise ValueError(f"unsupported window: {window}")
    return int(count) * _UNITS[unit]


def window_start(ts: Column, window: str = "5 minutes") -> Column:
    """Start of the window that holds ``ts``; windows are aligned to UTC."""
    width = F.lit(window_seconds(window) * 1_000_000).cast("bigint")
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, width))


def off_hours(start: Column, tz: str = "UTC") -> Column:
    """Whether a window starts at night in the given zone."""
    hour = F.hour(start if tz == "UTC" else F.from_utc_timestamp(start, tz))
    return (hour < OFF_HOURS_END) | (hour >= OFF_HOURS_START)
