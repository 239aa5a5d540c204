"""Day and minute arithmetic on epoch milliseconds. None of it depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "GMT"
DAY_MS = 86_400_000
# Timestamps end here, about year 294,000, less two days for time zones; times and years beyond give null.
LAST_MS = 9_223_372_036_854_775 - 2 * DAY_MS
FIRST_YEAR, LAST_YEAR = 1, 294_246


def zone_or_default(zone: Column) -> Column:
    return F.coalesce(zone, F.lit(DEFAULT_ZONE))


def out_of_range(epoch_ms: Column) -> Column:
    """Whether a time has no calendar day here."""
    return ~epoch_ms.between(-LAST_MS, LAST_MS)


def day_epoch(epoch_ms: Column, zone: Column) -> Column:
    """Start of the local day that holds a time, as epoch milliseconds."""
    name = zone_or_default(zone)
    sound = F.when(epoch_ms.between(-LAST_MS, LAST_MS), epoch_ms)
    wall = F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(sound), name))
    midnight = wall - F.pmod(wall, F.lit(DAY_MS))
    return F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(midnight), name))


def minute_epoch(year: Column, dayofyear: Column, hour: Column, minute: Column) -> Column:
    """Start of the calendar minute that four integer columns name, as epoch milliseconds."""
    sound = F.when(year.between(FIRST_YEAR, LAST_YEAR), year)
    days = F.unix_date(F.make_date(sound, F.lit(1), F.lit(1))).cast("long") + dayofyear - 1
    return days * DAY_MS + hour.cast("long") * 3_600_000 + minute.cast("long") * 60_000
