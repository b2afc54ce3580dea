"""Time functions; every one takes its clock as a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000.0
MICROS_PER_DAY = 86_400_000_000


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def instant(as_of: dt.datetime | Column) -> Column:
    """A clock value as a column."""
    return as_of if isinstance(as_of, Column) else F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def hours_since(ts: Column | str, as_of: dt.datetime | Column) -> Column:
    """Hours from ``ts`` to ``as_of``, at least 1."""
    micros = F.timestamp_diff("MICROSECOND", _col(ts), instant(as_of))
    return F.greatest(F.lit(1.0), micros / F.lit(MICROS_PER_HOUR))


def recent_days(ts: Column | str, as_of: dt.datetime | Column, n: int = 60) -> Column:
    """At most ``n`` whole days old, so anything younger than ``n + 1`` days; null is false."""
    micros = F.timestamp_diff("MICROSECOND", _col(ts), instant(as_of))
    return F.coalesce(micros < F.lit((n + 1) * MICROS_PER_DAY), F.lit(False))


def iso_z(ts: Column | str) -> Column:
    """ISO time text with a trailing Z."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def week_label(ts: Column | str) -> Column:
    """``year-Week-nn`` with weeks from Monday; days before the first Monday are in week 00."""
    ts = _col(ts)
    week = F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7)
    return F.concat(F.date_format(ts, "yyyy"), F.lit("-Week-"), F.lpad(week.cast("string"), 2, "0"))


def event_time(ts: Column | str) -> Column:
    """Time text to a time; bad text gives null."""
    return F.try_to_timestamp(_col(ts).cast("string"))
