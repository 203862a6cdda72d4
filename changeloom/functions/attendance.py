"""Working time, lateness, overtime and shift of one attendance row. Times are epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000
ZONE_OFFSET_MS = 25_200_000  # +7 h
LATE_AFTER_MS = 32_400_000  # 09:00:00.000, itself still on time
NOON_MS = 43_200_000
EVENING_MS = 64_800_000
FULL_DAY_HOURS = 8.0


def worked_hours(check_in: Column, check_out: Column) -> Column:
    """Hours between the two stamps; NULL if either is missing."""
    return (check_out - check_in).cast("double") / F.lit(float(MS_PER_HOUR))


def time_of_day(stamp: Column, zone_offset_ms: int = ZONE_OFFSET_MS) -> Column:
    """Milliseconds since midnight after adding ``zone_offset_ms`` (0 for stamps that are already local)."""
    return (stamp + F.lit(zone_offset_ms).cast("bigint")) % F.lit(MS_PER_DAY).cast("bigint")


def presence_status(check_in: Column, check_out: Column, status: Column) -> Column:
    """The recorded status, or the reason why it cannot be trusted."""
    return (
        F.when(check_in.isNull() & check_out.isNull(), "MISSING_DATA")
        .when(check_in.isNull(), "NOT_CHECKED_IN")
        .when(check_out.isNull(), "NOT_CHECKED_OUT")
        .otherwise(status)
    )


def is_late(check_in: Column, zone_offset_ms: int = ZONE_OFFSET_MS, after_ms: int = LATE_AFTER_MS) -> Column:
    """Strictly after the limit; FALSE without a check-in."""
    return F.coalesce(time_of_day(check_in, zone_offset_ms) > F.lit(after_ms), F.lit(False))


def overtime_hours(hours: Column, full_day: float = FULL_DAY_HOURS) -> Column:
    """Hours beyond a full day; 0.0 for short or incomplete days."""
    return F.when(hours > F.lit(full_day), hours - F.lit(full_day)).otherwise(F.lit(0.0))


def shift_label(check_in: Column, zone_offset_ms: int = ZONE_OFFSET_MS) -> Column:
    clock = time_of_day(check_in, zone_offset_ms)
    return (
        F.when(check_in.isNull(), "UNKNOWN")
        .when(clock < NOON_MS, "MORNING")
        .when(clock < EVENING_MS, "AFTERNOON")
        .otherwise("EVENING")
    )
