"""Wide rows to points and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwatch.functions.numbers import to_number
from plantwatch.schema import FIELD, MEASUREMENT, NUMBER, POINT_MEASUREMENT, TEXT, TIME


def to_points(
    rows: DataFrame,
    time: str,
    tags: list[str],
    fields: list[str],
    keep: list[str] | None = None,
    measurement: str = POINT_MEASUREMENT,
) -> DataFrame:
    """One point per non-null field of a wide row.

    Tags are text. Numbers and booleans become doubles; anything else stays text.
    """
    types = dict(rows.dtypes)
    typed = rows.select(
        F.col(time).alias(TIME),
        *[F.col(t).cast("string").alias(t) for t in tags],
        *(keep or []),
        *[_as_text(f, types[f]) for f in fields],
    )
    points = typed.unpivot([TIME, *tags, *(keep or [])], fields, FIELD, "_text").where(F.col("_text").isNotNull())
    number = to_number(F.col("_text"))
    return points.select(
        F.lit(measurement).alias(MEASUREMENT),
        TIME,
        *tags,
        *(keep or []),
        FIELD,
        number.alias(NUMBER),
        F.when(number.isNull(), F.col("_text")).alias(TEXT),
    )


def to_numeric_points(rows: DataFrame, time: str, tags: list[str], fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """As ``to_points`` for rows whose fields are all numeric: values never pass through text."""
    typed = rows.select(
        F.col(time).alias(TIME),
        *[F.col(t).cast("string").alias(t) for t in tags],
        *(keep or []),
        *[F.col(f).cast("double").alias(f) for f in fields],
    )
    return typed.unpivot([TIME, *tags, *(keep or [])], fields, FIELD, NUMBER).where(F.col(NUMBER).isNotNull())


def _as_text(name: str, kind: str):
    column = F.col(name)
    return (column.cast("int") if kind == "boolean" else column).cast("string").alias(name)


def to_rows(points: DataFrame, by: list[str], fields: list[str], tie: str | None = None, value: str = NUMBER) -> DataFrame:
    """One row per key with a column per declared field; of duplicate points the last written stays."""
    chosen = F.max_by(value, tie) if tie else F.max(value)
    return points.groupBy(*by).pivot(FIELD, fields).agg(chosen)


def aligned(rows: DataFrame, features: list[str], defaults: dict[str, float] | float = 0.0) -> list:
    """Select list that gives exactly the declared features, in order, never null."""
    def default(name):
        return float(defaults[name] if isinstance(defaults, dict) else defaults)

    return [
        (F.coalesce(F.col(f"`{f}`").try_cast("double"), F.lit(default(f))) if f in rows.columns else F.lit(default(f))).alias(f)
        for f in features
    ]
