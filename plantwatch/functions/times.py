"""Time expressions. Times are zone-free UTC (``timestamp_ntz``) throughout the package."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLANT_ZONE = "Etc/GMT-8"
TWELVE_HOUR = "yyyy-MM-dd hh:mm:ss a"
NTZ = "timestamp_ntz"
EPOCH = "1970-01-01 00:00:00"


def parse_time(text: Column, *patterns: str) -> Column:
    """ISO text first, then each pattern; null when none fits."""
    tries = [text.try_cast(NTZ)]
    tries += [F.try_to_timestamp(text, F.lit(p)).cast(NTZ) for p in patterns]
    return F.coalesce(*tries)


def from_epoch_nanos(text: Column) -> Column:
    """Epoch nanoseconds in text; digits below a microsecond are dropped."""
    return from_epoch_micros((text.try_cast("decimal(38,0)") / 1000).try_cast("bigint"))


def from_epoch_millis(value: Column) -> Column:
    return from_epoch_micros(value.try_cast("bigint") * 1000)


def from_epoch_micros(value: Column) -> Column:
    return _epoch() + F.make_dt_interval(secs=value / F.lit(1_000_000).cast("decimal(18,0)"))


def epoch_seconds(time: Column) -> Column:
    return F.timestamp_diff("SECOND", _epoch(), time)


def epoch_micros(time: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), time)


def to_plant_zone(time: Column, zone: str = PLANT_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), time)


def twelve_hour_text(time: Column) -> Column:
    return F.date_format(time, TWELVE_HOUR)


def whole_seconds(time: Column) -> Column:
    return F.date_trunc("SECOND", time).cast(NTZ)


def iso_text(time: Column, suffix: str = "") -> Column:
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(suffix))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def now_utc() -> Column:
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def span(text: str) -> Column:
    """Interval such as ``5 minutes``; a bare number is seconds."""
    return F.expr(f"INTERVAL '{text}' SECOND" if text.strip().lstrip("-").isdigit() else f"INTERVAL {text}")


def at(text: str) -> Column:
    return F.lit(text).cast(NTZ)


def _epoch() -> Column:
    return F.lit(EPOCH).cast(NTZ)
