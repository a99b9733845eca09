"""Calendar and clock expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clock_hour(hhmm: Column) -> Column:
    """Hour of an HHMM integer; anything outside 0-23 (such as 2400) is hour 0."""
    hour = F.floor(hhmm.cast("int") / 100).cast("int")
    return F.when(hour.between(0, 23), hour).when(hour.isNotNull(), 0)


def day_part(hour: Column) -> Column:
    """Quarter of the day the hour falls in."""
    return (
        F.when(hour < 6, "night")
        .when(hour < 12, "morning")
        .when(hour < 18, "afternoon")
        .otherwise("evening")
    )


def hour_ts(day: Column, hour: Column) -> Column:
    """Timestamp at the top of ``hour`` on ``day``, in the session zone (UTC)."""
    zero = F.lit(0)
    return F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), hour, zero, zero)


def hour_key(day: Column, hour: Column) -> Column:
    """yyyymmddHH as a long: the key hourly tables are joined on."""
    return (
        F.year(day) * 1000000 + F.month(day) * 10000 + F.dayofmonth(day) * 100 + hour
    ).cast("bigint")


def hour_key_of(ts: Column) -> Column:
    return hour_key(ts, F.hour(ts))


def hour_key_utc(day: Column, hour: Column, zone: Column) -> Column:
    """Hour key after shifting a local departure hour to UTC by its zone name."""
    return hour_key_of(F.to_utc_timestamp(hour_ts(day, hour), zone))


def epoch_day(day: Column) -> Column:
    return F.unix_date(day).cast("bigint")


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def event_time(epoch_seconds: Column) -> Column:
    """Epoch seconds to timestamp, without passing through a zone-bound string."""
    return F.timestamp_seconds(epoch_seconds)


def stale_seconds(as_of: Column, now: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), now - as_of)
