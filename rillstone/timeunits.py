"""Durations and event-time columns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def as_micros(duration: str | int | timedelta) -> int:
    """Microseconds in ``'10 seconds'``, ``'1 hour 30 minutes'``, a timedelta or a plain number."""
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    if isinstance(duration, int):
        return duration
    parts = duration.split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    return sum(
        int(amount) * _UNIT_MICROS[unit.lower().rstrip("s")]
        for amount, unit in zip(parts[::2], parts[1::2])
    )


def interval_text(duration: str | int | timedelta) -> str:
    """The form ``F.window`` and ``withWatermark`` accept."""
    return duration if isinstance(duration, str) else f"{as_micros(duration)} microseconds"


def interval(duration: str | int | timedelta) -> Column:
    return F.expr(f"INTERVAL '{as_micros(duration)}' MICROSECOND")


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp column (both timestamp types; session zone UTC)."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def from_millis(ms: str | Column) -> Column:
    """Event time from an epoch-millisecond field."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def as_ntz(ts: str | Column) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")
