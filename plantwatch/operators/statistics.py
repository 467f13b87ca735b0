"""Baselines, z-scores, anomaly labels and the gate on anomaly rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantwatch.functions.labels import severity
from plantwatch.functions.numbers import finite, zscore
from plantwatch.operators.joins import lookup_by
from plantwatch.operators.ordered import top_rows
from plantwatch.schema import FIELD, NUMBER


def baseline(readings: DataFrame, by: str = FIELD, value: str = NUMBER) -> DataFrame:
    """Mean and population standard deviation per field."""
    clean = finite(F.col(value))
    return readings.groupBy(by).agg(F.avg(clean).alias("mean"), F.stddev_pop(clean).alias("std"))


def scored(
    readings: DataFrame,
    base: DataFrame | None = None,
    fields: list[str] | None = None,
    value: str = NUMBER,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Readings with the mean, std and z-score of their field; every reading is kept.

    The lookup spreads hot fields over several tasks. ``fields`` names the fields that a caller
    expects; readings of other fields, and those without a field, are scored like all others.
    """
    base = baseline(readings, value=value) if base is None else base
    joined = lookup_by(readings, base, FIELD, spread_by=spread_by)
    return joined.withColumn("z", zscore(F.col(value), F.col("mean"), F.col("std")))


def with_severity(scores: DataFrame) -> DataFrame:
    return scores.withColumn("severity", severity(F.col("z")))


def anomaly_flag(value: Column, z: Column, threshold: float) -> Column:
    """1 where |z| exceeds the threshold; null for a missing value; 0 for a constant series."""
    return F.when(finite(value).isNotNull(), F.coalesce(F.abs(z) > threshold, F.lit(False)).cast("int"))


def feature_labels(readings: DataFrame, fields: list[str], threshold: float = 3.0) -> DataFrame:
    scores = scored(readings, fields=fields)
    return scores.withColumn("y", anomaly_flag(F.col(NUMBER), F.col("z"), threshold))


def anomaly_rates(labels: DataFrame) -> DataFrame:
    return labels.groupBy(FIELD).agg(
        F.avg("y").alias("anomaly_rate"), F.count("y").alias("n"), F.sum("y").alias("anomalies")
    )


def wide_anomaly_rates(rows: DataFrame, columns: list[str], threshold: float = 3.0) -> DataFrame:
    """Anomaly rates of the columns of wide rows: two passes over the rows, which are never unpivoted."""
    s = F.col("_statistics")
    flags = {
        c: anomaly_flag(F.col(c), zscore(F.col(c), s[c]["mean"], s[c]["std"]), threshold) for c in columns
    }
    rated = [
        F.struct(
            F.lit(c).alias(FIELD),
            F.avg(y).alias("anomaly_rate"),
            F.count(y).alias("n"),
            F.sum(y).alias("anomalies"),
        )
        for c, y in flags.items()
    ]
    counted = rows.select(*columns).withColumn("_statistics", column_statistics(rows, columns)).agg(F.array(*rated).alias("rates"))
    return counted.select(F.inline("rates"))


def column_statistics(rows: DataFrame, columns: list[str]) -> Column:
    """Mean and population std of many columns as one scalar subquery."""
    measured = [
        F.struct(F.avg(finite(F.col(c))).alias("mean"), F.stddev_pop(finite(F.col(c))).alias("std")).alias(c) for c in columns
    ]
    return rows.agg(F.struct(*measured).alias("s")).scalar()


def gated(rates: DataFrame, low: float = 0.01, high: float = 0.5) -> DataFrame:
    """Fields whose anomaly rate lies strictly between the bounds."""
    return rates.where((F.col("anomaly_rate") > low) & (F.col("anomaly_rate") < high))


def most_anomalous(rates: DataFrame, n: int = 5) -> DataFrame:
    return top_rows(rates, [F.desc("anomaly_rate"), F.asc(FIELD)], n)


def wide_statistics(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population variance of many columns in one pass, one row per column."""
    measured = [
        F.struct(F.lit(c).alias("feature"), F.avg(finite(F.col(c))).alias("mean"), F.var_pop(finite(F.col(c))).alias("variance"))
        for c in columns
    ]
    return rows.agg(F.array(*measured).alias("features")).select(F.inline("features"))


def standardised(rows: DataFrame, columns: list[str], training: DataFrame | None = None) -> DataFrame:
    """Columns scaled by the training rows' mean and population std; a constant column is only centred."""
    s = F.col("_training")
    scaled = {
        c: (F.coalesce(finite(F.col(c)), s[c]["mean"]) - s[c]["mean"])
        / F.coalesce(F.nullif(s[c]["std"], F.lit(0.0)), F.lit(1.0))
        for c in columns
    }
    return rows.withColumn("_training", column_statistics(training if training is not None else rows, columns)).withColumns(scaled).drop("_training")
