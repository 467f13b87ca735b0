"""Attack classes from the shape of anomalies in a time window, and the four-layer verdict."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwatch.functions.times import seconds_between
from plantwatch.operators.joins import only_fields
from plantwatch.schema import TIME


@dataclass(frozen=True)
class Scope:
    """Counts that separate the classes; a window is classified by the first rule that fits."""

    every: str = "1 minute"
    many_sensors: int = 5
    many_stages: int = 3
    family_stages: int = 2
    group_sensors: int = 3
    many_actuators: int = 3
    probe_gap_seconds: float = 10.0


def window_evidence(readings: DataFrame, by: list[str], scope: Scope) -> DataFrame:
    """What each window shows.

    Input columns: time, field, kind, stage, is_actuator, value_num, severity,
    state_invalid. Rows first shrink to one per (window, field), which bounds all
    that follows by the number of fields.
    """
    anomalous = F.col("severity") != "NORMAL"
    actuator = F.col("is_actuator")
    per_field = readings.groupBy(F.window(TIME, scope.every).alias("pane"), *by, "field", "kind", "stage", "is_actuator").agg(
        F.count("*").alias("seen"),
        F.min("value_num").alias("low"),
        F.max("value_num").alias("high"),
        F.count_if(anomalous).alias("anomalies"),
        F.count_if(anomalous & (F.col("severity") != "MODERATE")).alias("strong"),
        F.min(F.when(anomalous, F.col(TIME))).alias("first_anomaly"),
        F.count_if(F.col("state_invalid")).alias("invalid"),
        F.min("state_code").alias("low_state"),
        F.max("state_code").alias("high_state"),
    )
    hit = ~actuator & (F.col("anomalies") > 0)
    window_keys = ["pane", *by]
    per_family = per_field.groupBy(*window_keys, "kind").agg(
        F.collect_set(F.when(hit, F.col("stage"))).alias("hit_stages"),
        F.collect_list(F.when(hit, F.struct("stage", "field", "first_anomaly"))).alias("hits"),
        F.count_if(~actuator).alias("sensors"),
        F.count_if(~actuator & (F.col("low") == F.col("high")) & (F.col("seen") >= 2)).alias("frozen"),
        F.sum(F.when(~actuator, F.col("strong")).otherwise(0)).alias("strong"),
        F.count_if(actuator & (F.col("low_state") != F.col("high_state"))).alias("moving"),
        F.count_if(actuator & (F.col("invalid") > 0)).alias("invalid"),
        F.sum("anomalies").alias("anomalies"),
    )
    return per_family.groupBy(*window_keys).agg(
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.max(F.size("hit_stages")).alias("family_stages"),
        F.sum("sensors").alias("sensors"),
        F.sum("frozen").alias("frozen"),
        F.sum("strong").alias("strong"),
        F.sum("moving").alias("moving_actuators"),
        F.sum("invalid").alias("invalid_actuators"),
        F.sum("anomalies").alias("anomalies"),
    )


def classified(evidence: DataFrame, by: list[str], scope: Scope) -> DataFrame:
    stages = F.array_distinct(F.transform("hits", lambda h: h["stage"]))
    largest = F.array_max(
        F.transform(stages, lambda s: F.size(F.filter("hits", lambda h: h["stage"] == s)))
    )
    times = F.array_sort(F.transform("hits", lambda h: h["first_anomaly"]))
    gaps_small = F.forall(
        F.sequence(F.lit(1), F.greatest(F.size("hits") - 1, F.lit(1))),
        lambda i: F.coalesce(
            seconds_between(F.get(F.col("times"), i - 1), F.get(F.col("times"), i)) <= scope.probe_gap_seconds, F.lit(True)
        ),
    )
    n = F.size("hits")
    verdict = (
        F.when((F.col("sensors") > 0) & (F.col("frozen") == F.col("sensors")), "DOS")
        .when((n >= scope.many_sensors) & (F.col("strong") == 0) & F.col("gaps_small"), "RECON")
        .when((n >= scope.many_sensors) & (F.size("stages") >= scope.many_stages), "MSMP")
        .when(F.col("family_stages") >= scope.family_stages, "MSCP")
        .when(F.col("largest") >= scope.group_sensors, "SSMP")
        .when(F.col("moving_actuators") >= scope.many_actuators, "CMRI")
        .when(F.col("invalid_actuators").between(1, 2), "NMRI")
        .when(n.between(1, 2) & (F.size("stages") == 1), "SSCP")
        .when((F.col("anomalies") > 0) | (F.col("invalid_actuators") > 0), "UNKNOWN_ATTACK")
        .otherwise("NORMAL")
    )
    return (
        evidence.withColumn("stages", stages)
        .withColumn("largest", F.coalesce(largest, F.lit(0)))
        .withColumn("times", times)
        .withColumn("gaps_small", gaps_small)
        .select(
            F.col("pane.start").alias("window_start"),
            F.col("pane.end").alias("window_end"),
            *by,
            n.alias("sensors_hit"),
            F.size("stages").alias("stages_hit"),
            F.col("moving_actuators"),
            F.col("invalid_actuators"),
            verdict.alias("attack_class"),
        )
    )


def attack_classes(readings: DataFrame, by: list[str] | None = None, scope: Scope | None = None) -> DataFrame:
    scope = scope or Scope()
    return classified(window_evidence(readings, by or [], scope), by or [], scope)


def correlated(readings: DataFrame, every: str, at_least: int, fields: list[str] | None = None) -> DataFrame:
    """Windows in which several fields, or several of the named ones, are anomalous at once.

    Readings without a field count as one field, which the text of field names leaves out.
    """
    flagged = readings.where(F.col("severity") != "NORMAL")
    if fields is not None:
        flagged = only_fields(flagged, fields)
    per_field = flagged.groupBy(F.window(TIME, every).alias("pane"), "field").agg(F.count("*").alias("n"))
    return (
        per_field.groupBy("pane")
        .agg(F.sort_array(F.collect_list("field")).alias("fields"), F.count("*").cast("int").alias("n_fields"), F.sum("n").alias("anomalies"))
        .where(F.col("n_fields") >= at_least)
        .select(
            F.col("pane.start").alias("window_start"), F.col("pane.end").alias("window_end"),
            F.array_join("fields", ",").alias("fields"), "n_fields", "anomalies",
        )
    )


def fired_layers(layers: dict[str, tuple]) -> "F.Column":
    """Array of (severity rank, layer) of the layers that fire on a row."""
    from plantwatch.functions.labels import severity_rank

    fired = F.array(
        *[F.when(fires, F.struct(severity_rank(level).alias("rank"), F.lit(name).alias("layer"))) for name, (fires, level) in layers.items()]
    )
    return F.filter(fired, lambda x: x.isNotNull())


def combined(rows: DataFrame, fired) -> DataFrame:
    """Rows on which any layer fires, with the highest severity and the layers' names."""
    from plantwatch.schema import SEVERITIES

    names = F.array(*[F.lit(s) for s in SEVERITIES])
    return (
        rows.withColumn("_fired", fired)
        .where(F.size("_fired") > 0)
        .withColumn("verdict", F.get(names, F.array_max(F.transform("_fired", lambda x: x["rank"]))))
        .withColumn("detectors", F.array_join(F.array_sort(F.transform("_fired", lambda x: x["layer"])), ","))
        .drop("_fired")
    )
