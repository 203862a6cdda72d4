"""Raw change-log time values to Spark types, by the unit the source column is captured in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def to_time(raw: Column, unit: str) -> Column:
    """``ms``/``us`` since the epoch to a timestamp, ``days`` since the epoch to a date."""
    if unit == "ms":
        return F.timestamp_millis(raw)
    if unit == "us":
        return F.timestamp_micros(raw)
    if unit == "days":
        return F.date_from_unix_date(raw)
    raise ValueError(f"unknown time unit {unit!r}")


def days_between(start: Column, end: Column, unit: str = "us") -> Column:
    """Length in days of two raw stamps of the same unit; NULL if either is missing."""
    per_day = {"us": MICROS_PER_DAY, "ms": MICROS_PER_DAY // 1000, "days": 1}[unit]
    return (end - start).cast("double") / F.lit(float(per_day))
