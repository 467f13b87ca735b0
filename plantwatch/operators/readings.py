"""Time-series queries over long readings (one row per measurement, tags, field and time)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantwatch.functions.times import NTZ, span
from plantwatch.operators.ordered import first_rows, top_rows
from plantwatch.schema import FIELD, MEASUREMENT, NUMBER, TIME


def in_range(readings: DataFrame, start: str | Column | None = None, stop: str | Column | None = None) -> DataFrame:
    """start <= time < stop; an absent bound is open. Stored tables also prune on ``date``."""
    for bound, compare in ((start, "__ge__"), (stop, "__lt__")):
        if bound is None:
            continue
        limit = F.lit(bound).cast(NTZ) if isinstance(bound, str) else bound
        readings = readings.where(getattr(F.col(TIME), compare)(limit))
        if "date" in readings.columns:
            day = limit.cast("date")
            readings = readings.where(F.col("date") >= day if compare == "__ge__" else F.col("date") <= day)
    return readings


def since(readings: DataFrame, length: str, now: Column) -> DataFrame:
    """Readings of the last ``length`` up to and including ``now``."""
    readings = in_range(readings, start=now - span(length))
    return readings.where(F.col(TIME) <= now)


def latest_time(readings: DataFrame) -> Column:
    """Newest time as a scalar subquery, for relative ranges over stored data."""
    return readings.agg(F.max(TIME)).scalar()


def select_readings(
    readings: DataFrame,
    measurement: str | None = None,
    field: str | None = None,
    field_like: str | None = None,
    fields: list[str] | None = None,
    tags: dict[str, str] | None = None,
) -> DataFrame:
    """Rows by measurement, field name (equal, pattern or list) and tag values."""
    if measurement is not None:
        readings = readings.where(F.col(MEASUREMENT) == measurement)
    if field is not None:
        readings = readings.where(F.col(FIELD) == field)
    if field_like is not None:
        readings = readings.where(F.col(FIELD).rlike(field_like))
    if fields is not None:
        readings = readings.where(F.col(FIELD).isin(*fields))
    for tag, value in (tags or {}).items():
        readings = readings.where(F.col(tag) == value)
    return readings


def measurements(readings: DataFrame) -> DataFrame:
    return readings.select(MEASUREMENT).distinct()


def last(readings: DataFrame, series: list[str], tie: str | None = None, value: str = NUMBER) -> DataFrame:
    """Latest row of every series; no series columns gives the latest overall."""
    return _latest(readings, series, tie, value)


def last_known(readings: DataFrame, series: list[str], tie: str | None = None, value: str = NUMBER) -> DataFrame:
    """Latest non-null value of every series."""
    return _latest(readings.where(F.col(value).isNotNull()), series, tie, value)


def _latest(readings: DataFrame, series: list[str], tie: str | None, value: str) -> DataFrame:
    grouped = readings.groupBy(*series)
    if tie is None:  # times are unique in a series: two fixed-width maxima, a hash aggregate
        return grouped.agg(F.max(TIME).alias(TIME), F.max_by(value, TIME).alias(value))
    newest = F.max(F.struct(TIME, tie, value)).alias("_newest")
    return grouped.agg(newest).select(*series, f"_newest.{TIME}", f"_newest.{value}")


def mean(readings: DataFrame, by: list[str] | None = None, value: str = NUMBER) -> DataFrame:
    return readings.groupBy(*(by or [])).agg(F.avg(value).alias("mean_value"))


def count(readings: DataFrame, by: list[str] | None = None) -> DataFrame:
    return readings.groupBy(*(by or [])).agg(F.count("*").alias("n"))


def first_per_series(readings: DataFrame, series: list[str], n: int, tie: str) -> DataFrame:
    return first_rows(readings, series, [F.asc(TIME), F.asc(tie)], n)


def tail_per_series(readings: DataFrame, series: list[str], n: int, tie: str) -> DataFrame:
    return first_rows(readings, series, [F.desc(TIME), F.desc(tie)], n)


def top(readings: DataFrame, n: int, value: str, tie: str) -> DataFrame:
    return top_rows(readings, [F.desc(value), F.asc(tie)], n)


def windowed(readings: DataFrame, every: str, by: list[str] | None = None, slide: str | None = None) -> DataFrame:
    """Row count and value sum per time window; empty windows give no row.

    Sliding windows are added up from panes as long as the greatest common divisor of both
    lengths, so each pane is inside a window or outside it and a row is counted once however
    many windows hold it. Rows without a time are in no window.
    """
    by = by or []
    pane = every if slide is None else f"{math.gcd(*(pd.Timedelta(t) // pd.Timedelta('1us') for t in (every, slide)))} microseconds"
    totals = (
        readings.groupBy(F.window(TIME, pane).alias("pane"), *by)
        .agg(F.count("*").alias("n"), F.sum(NUMBER).alias("total"))
        .select(F.col("pane.start").alias("window_start"), F.col("pane.end").alias("window_end"), *by, "n", "total")
    )
    if slide is None:
        return totals
    return (
        totals.groupBy(F.window("window_start", every, slide).alias("pane"), *by)
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .select(F.col("pane.start").alias("window_start"), F.col("pane.end").alias("window_end"), *by, "n", "total")
    )


def daily_statistics(readings: DataFrame, by: list[str]) -> DataFrame:
    return readings.groupBy(F.to_date(TIME).alias("day"), *by).agg(
        F.count(NUMBER).alias("n"),
        F.avg(NUMBER).alias("mean_value"),
        F.stddev_pop(NUMBER).alias("std_value"),
        F.min(NUMBER).alias("min_value"),
        F.max(NUMBER).alias("max_value"),
    )


def top_series_latest(readings: DataFrame, by: str, tie: str) -> DataFrame:
    """Latest reading of the series with most rows (ties by name)."""
    leader = top_rows(count(readings, [by]), [F.desc("n"), F.asc(by)], 1).select(by).scalar()
    leading = readings.where(F.col(by) == leader)
    return last(leading, [by], tie).select(
        F.col(TIME), F.col(by).alias("sensor"), F.col(NUMBER).alias("reading")
    )


def latest_write(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one written last. Replayed rows collapse before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    ordering = order + [c for c in rest if c not in order]
    newest = F.max(F.struct(*ordering)).alias("_newest")
    return rows.groupBy(*key).agg(newest).select(*key, *[F.col(f"_newest.{c}").alias(c) for c in rest])
