"""The driver's tables in the shape of plant data."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantwatch.functions.times import NTZ
from plantwatch.schema import ATTACK_TOPIC, CONSUMERS, NORMAL_TOPIC

EVENT_FIELDS = ["click", "error", "purchase", "signup", "view"]
LINE_SENSORS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SERIES = ["field", "unit"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_of(table(spark, folder, "events"))


def readings_of(events: DataFrame) -> DataFrame:
    """Long readings: the event type is the field, the user is the unit that reports it."""
    return events.select(
        F.when(F.col("event_type") == "error", "alarm_data").otherwise("actuator_data").alias("measurement"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("field"),
        F.col("value").alias("value_num"),
        F.col("user_id").alias("unit"),
        (F.col("user_id") % 6 + 1).cast("int").alias("stage"),
        (F.col("user_id") % 4).cast("string").alias("state"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("event_id").alias("tie"),
    )


def plant_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings named like plant equipment: three sensor kinds and two actuator kinds in six stages."""
    kinds = {"click": "FIT", "view": "LIT", "purchase": "AIT", "signup": "P", "error": "MV"}
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("field")]
    return (
        readings(spark, folder)
        .withColumn("kind", kind)
        .withColumn("field", F.concat("kind", F.lit(" "), F.col("stage").cast("string"), F.lit("01")))
        .withColumn("code", F.col("k") % 6)
        .drop("state")
    )


PLANT_FIELDS = [f"{kind} {stage}01" for kind in ("FIT", "LIT", "AIT", "P", "MV") for stage in range(1, 7)]


def text_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as text, with unreadable and missing values in fixed places."""
    text = F.when(F.col("tie") % 97 == 0, "n/a").when(F.col("tie") % 89 != 0, F.col("value_num").cast("string"))
    return readings(spark, folder).withColumn("raw", text)


def wide_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as wide sensor rows."""
    return table(spark, folder, "lineitem").withColumnRenamed("l_shipdate", "t_stamp")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages of two topics with three partitions each.

    Offsets number the messages of a partition in event order. Counting is done per
    time slice, so no task orders a whole partition.
    """
    from plantwatch.operators.ordered import numbered, time_slice

    shaped = messages_of(table(spark, folder, "events"))
    placed = numbered(
        shaped, ["topic", "partition"], time_slice("event_time"), ["event_time", "event_id"], "_position"
    )
    return placed.withColumn("offset", F.col("_position") - 1).drop("_position")


def messages_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.when(F.col("user_id") % 2 == 0, NORMAL_TOPIC).otherwise(ATTACK_TOPIC).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("ts").alias("event_time"),
        (F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 30).cast("decimal(18,6)"))).cast(NTZ).alias("arrival_time"),
        F.octet_length("props").cast("bigint").alias("bytes"),
        (F.col("event_type") != "error").alias("ok"),
        "event_id",
    )


def is_committed() -> Column:
    """Every tenth message is committed; the attack consumer stalls from the 10th to the 19th, so its lag grows."""
    stalled = (F.col("topic") == ATTACK_TOPIC) & F.dayofmonth("event_time").between(10, 19)
    return (F.col("offset") % 10 == 0) & ~stalled


def commit_columns() -> dict[str, Column]:
    group = F.when(F.col("topic") == NORMAL_TOPIC, CONSUMERS[NORMAL_TOPIC]).otherwise(CONSUMERS[ATTACK_TOPIC])
    return {
        "group": group,
        "committed_offset": F.col("offset") + 1,
        "commit_time": (F.col("arrival_time") + F.expr("INTERVAL 5 MINUTES")).cast(NTZ),
    }


def commits(stream: DataFrame) -> DataFrame:
    """Offsets committed five minutes after arrival."""
    return stream.where(is_committed()).withColumns(commit_columns()).select(
        "group", "topic", "partition", "committed_offset", "commit_time"
    )


def pipeline_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Messages and the commits derived from them as cell entries, in one pass over the numbered messages."""
    from plantwatch.operators.health import commit_fact, message_fact

    stream = messages(spark, folder).withColumns(commit_columns())
    entries = F.array(message_fact(), F.when(is_committed(), commit_fact()))
    return stream.select(F.inline(F.filter(entries, lambda e: e.isNotNull())))
