"""Time buckets, time ranges and time text.

There are two ways to bucket: by a prefix of the ISO text in ``timestamp``, and by flooring the
event time. The two columns come from separate clock reads, so both ways are kept apart.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Prefix lengths of ISO-8601 text.
DAY, HOUR, MINUTE = 10, 13, 16

_PERIOD = re.compile(r"^P(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$")
_UNITS = ("weeks", "days", "hours", "minutes", "seconds")
# Calendar periods; their buckets have no fixed length.
_CALENDAR = {"P1M": "MONTH", "P3M": "QUARTER", "P1Y": "YEAR"}
# The epoch was a Thursday; weeks start on Monday.
_MONDAY = 4 * 86400 * 1_000_000


def time_prefix(column: str | Column, length: int = MINUTE) -> Column:
    return F.substring(F.col(column) if isinstance(column, str) else column, 1, length)


def period_to_interval(period: str) -> str:
    """``'PT30M'`` -> ``'30 minutes'``; text that is no ISO period passes through."""
    found = _PERIOD.match(period)
    if not found:
        return period
    parts = [f"{n} {unit}" for n, unit in zip(found.groups(), _UNITS) if n]
    if not parts:
        raise ValueError(f"empty period: {period!r}")
    return " ".join(parts)


def period_interval(period: str) -> Column:
    return F.expr(f"INTERVAL '{period_to_interval(period)}'")


def time_floor(column: str | Column, period: str = "PT1H") -> Column:
    """Start of the period-long bucket in UTC, counted from the epoch; weeks start on Monday.

    P1M, P3M and P1Y are calendar months, quarters and years. Any other text is an error now, not when rows are read.
    """
    column = F.col(column) if isinstance(column, str) else column
    if period in _CALENDAR:
        return F.date_trunc(_CALENDAR[period], column)
    length = period_micros(period)
    since = slot_offset(period)
    micros = F.unix_micros(column)
    return F.timestamp_micros(micros - F.pmod(micros - F.lit(since), F.lit(length)))


def slot_offset(period: str) -> int:
    """Microseconds from the epoch to where buckets are counted from."""
    return _MONDAY if re.fullmatch(r"P\d+W", period) else 0


def period_micros(period: str) -> int:
    scale = {"week": 7 * 86400, "day": 86400, "hour": 3600, "minute": 60, "second": 1}
    words = period_to_interval(period).split()
    if len(words) % 2 or any(not n.isdigit() or unit.rstrip("s") not in scale for n, unit in zip(words[::2], words[1::2])):
        raise ValueError(f"no fixed period: {period!r}")
    length = sum(int(n) * scale[unit.rstrip("s")] for n, unit in zip(words[::2], words[1::2])) * 1_000_000
    if not length:
        raise ValueError(f"empty period: {period!r}")
    return length


def event_timestamp(column: str = "event_time") -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(F.col(column))


def iso_text(column: Column) -> Column:
    """ISO-8601 text with six decimals and a UTC offset."""
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def as_timestamp(value) -> Column:
    """A Column stays; text or a datetime becomes a timestamp literal; None is the current time."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def last_period(column: str | Column, period: str, as_of=None) -> Column:
    """``[as_of - period, as_of)``: the start belongs to the range, the end does not."""
    column = F.col(column) if isinstance(column, str) else column
    end = as_timestamp(as_of)
    return (column >= end - period_interval(period)) & (column < end)


def within(df: DataFrame, since=None, until=None) -> DataFrame:
    """Rows with ``event_ts`` in ``[since, until)``; None leaves an end open.

    A table stored by day has ``event_date``, too, and then the range also prunes its folders.
    """
    by_day = "event_date" in df.columns
    if since is not None:
        start = as_timestamp(since)
        df = df.filter(F.col("event_ts") >= start)
        df = df.filter(F.col("event_date") >= F.to_date(start)) if by_day else df
    if until is not None:
        end = as_timestamp(until)
        df = df.filter(F.col("event_ts") < end)
        df = df.filter(F.col("event_date") <= F.to_date(end)) if by_day else df
    return df
