"""Operator commands and alerts made from readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantwatch.functions.labels import sensor_kind
from plantwatch.operators.ordered import numbered, time_slice
from plantwatch.operators.readings import latest_write
from plantwatch.schema import ACTUATOR_KINDS, SENSOR_COLUMNS

ACTUATORS = sorted({c.split()[0] + (c.split()[1] if c.startswith("MV ") else "") for c in SENSOR_COLUMNS if c.startswith(("P1", "P2", "P3", "P4", "P5", "P6", "MV", "UV"))})
ALL_ACTUATORS = "ALL"


def is_actuator(field: Column) -> Column:
    return sensor_kind(field).isin(*ACTUATOR_KINDS)


def audited(commands: DataFrame, actuators: list[str] | None = None) -> DataFrame:
    """Audit rows of commands, with ``rejected`` naming what is missing.

    A command for ALL (emergency stop) becomes one row per actuator: valves close,
    pumps stop. Operator and reason are trimmed and must not be blank.
    """
    targets = actuators or ACTUATORS
    operator, reason = F.trim(F.col("operator")), F.trim(F.col("reason"))
    blank = lambda c: c.isNull() | (c == "")
    everything = F.array(*[F.lit(a) for a in targets])
    expanded = commands.withColumn(
        "_target",
        F.explode(F.when(F.col("actuator_id") == ALL_ACTUATORS, everything).otherwise(F.array(F.col("actuator_id")))),
    )
    stop = F.when(sensor_kind(F.col("_target")) == "MV", "CLOSE").otherwise("OFF")
    action = F.when(F.col("actuator_id") == ALL_ACTUATORS, stop).otherwise(F.col("action"))
    kept = [c for c in commands.columns if c not in ("actuator_id", "action", "operator", "reason")]
    return expanded.select(
        *kept,
        F.col("_target").alias("actuator_id"),
        action.alias("action"),
        operator.alias("operator"),
        reason.alias("reason"),
        F.when(blank(operator), "operator is required").when(blank(reason), "reason is required").alias("rejected"),
    )


def commands_from_anomalies(scores: DataFrame, unit: str = "field", tie: str = "tie") -> DataFrame:
    """Stop command for each actuator whose latest anomaly is critical."""
    critical = scores.where(F.col("severity") == "CRITICAL")
    newest = latest_write(critical.select(unit, "time", tie, "value_num"), [unit], ["time", tie])
    return newest.select(
        F.col(unit).alias("actuator_id"),
        F.lit("OFF").alias("action"),
        F.lit("detector").alias("operator"),
        F.concat(F.lit("critical reading "), F.format_string("%.2f", F.col("value_num"))).alias("reason"),
        "time",
    )


def enriched(scores: DataFrame, is_attack: Column, processed_at: Column) -> DataFrame:
    return scores.withColumn("data_type", F.when(is_attack, "attack").otherwise("normal")).withColumn(
        "processed_at", processed_at
    )


def row_alerts(rows: DataFrame, attack_type: Column, is_flow: Column) -> DataFrame:
    """Alerts from single rows: recorded attacks, and flow readings out of their band."""
    attack = F.when(
        attack_type.isNotNull(),
        F.struct(F.lit("attack").alias("alert_type"), F.lit("high").alias("severity"),
                 F.concat(F.lit("Attack detected: "), attack_type).alias("message")),
    )
    flow = F.when(
        is_flow & F.col("severity").isin("HIGH", "CRITICAL"),
        F.struct(F.lit("flow_anomaly").alias("alert_type"), F.lower("severity").alias("severity"),
                 F.concat(F.lit("Unusual flow at "), F.col("field")).alias("message")),
    )
    raised = F.explode(F.filter(F.array(attack, flow), lambda a: a.isNotNull()))
    return rows.withColumn("_alert", raised).select(*rows.columns, "_alert.alert_type", F.col("_alert.severity").alias("alert_severity"), "_alert.message")


def sequential_ids(alerts: DataFrame, time: str, tie: str) -> DataFrame:
    """``ALERT_000001`` onwards per day, numbered in time slices."""
    dated = alerts.withColumn("_day", F.to_date(time))
    placed = numbered(dated, ["_day"], time_slice(time), [time, tie], "_n")
    return placed.withColumn("alert_id", F.concat(F.lit("ALERT_"), F.lpad(F.col("_n").cast("string"), 6, "0"))).drop("_day", "_n")
