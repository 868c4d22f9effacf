from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def duration_micros(duration: str | int | float | None) -> int:
    """Microseconds of "10 minutes", "1 hour 30 minutes" or a plain number of seconds; none and "0" give 0."""
    if duration is None:
        return 0
    if isinstance(duration, (int, float)):
        return int(duration * 1_000_000)
    text = duration.strip().lower()
    if re.fullmatch(r"\d+", text):
        return int(text) * 1_000_000
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?\b", text)
    if not parts or re.sub(r"\d+\s*[a-z]+", "", text).strip():
        raise ValueError(f"not a duration: {duration!r}")
    try:
        return sum(int(n) * _UNITS[unit] for n, unit in parts)
    except KeyError as unit:
        raise ValueError(f"unknown unit in {duration!r}: {unit}") from None


def from_epoch_ms(ms: Column, epoch_offset_ms: int = 0) -> Column:
    """Timestamp of an epoch-millisecond value; the offset moves simulated time away from 1970."""
    return F.timestamp_millis(ms + epoch_offset_ms if epoch_offset_ms else ms)


def to_epoch_ms(seconds: Column) -> Column:
    return (seconds * 1000).cast("long")
