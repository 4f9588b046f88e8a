"""The time axis: bounds, periods, days and bins on a 64-bit index."""

from __future__ import annotations

import re
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import NS_PER_DAY, NS_PER_TICK, NS_PER_US

# Length of each period unit in nanoseconds.
UNIT_NS = {
    "h": 3_600_000_000_000,
    "m": 60_000_000_000,
    "s": 1_000_000_000,
    "ms": 1_000_000,
    "microsecond": NS_PER_US,
    "tick": NS_PER_TICK,
}

# The spellings accepted for each period unit.
UNIT_SPELLINGS = {
    "h": ["h", "hr", "hour", "hours"],
    "m": ["m", "min", "minute", "minutes"],
    "s": ["s", "sec", "second", "seconds"],
    "ms": ["ms", "milli", "millis", "millisecond", "milliseconds"],
    "microsecond": ["micro", "micros", "microsecond", "microseconds"],
    "tick": ["tick"],
}

_UNIT_OF = {spelling: unit for unit, names in UNIT_SPELLINGS.items() for spelling in names}
_PERIOD = re.compile(r"(\d*)\s*([a-z]+)")


def normalize_period(period: str) -> tuple[int, str]:
    """``'15minutes'`` -> ``(15, 'm')``; a bare unit counts once."""
    match = _PERIOD.fullmatch(str(period).strip().lower())
    if match is None or match.group(2) not in _UNIT_OF:
        raise ValueError(
            f"period {period!r} is not an integer followed by one of: " + ", ".join(UNIT_NS)
        )
    count = int(match.group(1) or 1)
    if count < 1:
        raise ValueError(f"period {period!r} has no length")
    return count, _UNIT_OF[match.group(2)]


def period_ns(period: str) -> int:
    """Length of a period in nanoseconds."""
    count, unit = normalize_period(period)
    return count * UNIT_NS[unit]


def parse_bound(bound) -> int:
    """Nanoseconds of a range bound.

    Integers are taken as they are. Text that starts with the year is read in
    ISO order, other text day first. Times are UTC unless they name a zone.
    """
    if isinstance(bound, (bool, np.bool_)):
        raise ValueError("a bound is an integer, a string or a datetime")
    if isinstance(bound, (int, np.integer)):
        return int(bound)
    if isinstance(bound, str):
        year_first = re.match(r"\s*\d{4}", bound) is not None
        stamp = pd.to_datetime(bound, dayfirst=not year_first, utc=True)
    elif isinstance(bound, (date, np.datetime64)):
        stamp = pd.to_datetime(bound, utc=True)
    else:
        stamp = pd.to_datetime(bound, unit="ns", utc=True)
    if stamp is pd.NaT:
        raise ValueError(f"{bound!r} is not a point in time")
    return int(stamp.value)


def long_lit(value: int) -> Column:
    return F.lit(value).cast("bigint")


def floor_div(i: Column, width: int) -> Column:
    """Integer division rounding down; stays in 64-bit integers throughout."""
    below = (i % long_lit(width) < 0).cast("int").cast("bigint")
    return F.call_function("div", i, long_lit(width)) - below


def day_of(index: str | Column) -> Column:
    """UTC day number of an index; days before 1970 count downwards."""
    i = F.col(index) if isinstance(index, str) else index
    return floor_div(i, NS_PER_DAY).cast("int")


def bin_start(index: str | Column, width_ns: int) -> Column:
    """Left edge of the epoch-aligned bin that holds an index."""
    i = F.col(index) if isinstance(index, str) else index
    return i - F.pmod(i, long_lit(width_ns))


def to_index(ts: str | Column) -> Column:
    """Nanoseconds of a timestamp column. The session time zone must be UTC."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(t.cast("timestamp")) * NS_PER_US


def to_timestamp(index: str | Column) -> Column:
    """UTC timestamp of an index, to the microsecond; for display only."""
    i = F.col(index) if isinstance(index, str) else index
    return F.timestamp_micros(floor_div(i, NS_PER_US))


def in_range(index: str | Column, start: int | None, end: int | None) -> Column:
    """``start <= index < end``; a missing bound leaves that side open."""
    i = F.col(index) if isinstance(index, str) else index
    cond = F.lit(True)
    if start is not None:
        cond = cond & (i >= long_lit(start))
    if end is not None:
        cond = cond & (i < long_lit(end))
    return cond


def day_in_range(day: str, start: int | None, end: int | None) -> Column:
    """The same range on the ``day`` partition column, so that whole days are
    skipped before a file is opened. Spark cannot derive this from ``index``."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(day) >= start // NS_PER_DAY)
    if end is not None:
        cond = cond & (F.col(day) <= (end - 1) // NS_PER_DAY)
    return cond


def parse_range(start, end) -> tuple[int | None, int | None]:
    """Bounds in nanoseconds, checked; only ``None`` means open."""
    lo = None if start is None else parse_bound(start)
    hi = None if end is None else parse_bound(end)
    if lo is not None and hi is not None and lo >= hi:
        raise ValueError("start must be before end")
    return lo, hi
