"""Health of the message pipeline, computed from produced messages and committed offsets.

Everything starts from ``cells``: one row per topic, partition and tick with counts
and highest offsets. Cells are a plain aggregate (partial sums before the shuffle),
so a topic that carries most of the traffic costs no more than a quiet one; all later
steps work on ticks, whose number does not grow with the traffic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.functions.labels import band, code_text_or, percent_text
from plantwatch.functions.numbers import at_least_zero, lag_megabytes, ratio
from plantwatch.functions.times import NTZ, epoch_micros, epoch_seconds, seconds_between
from plantwatch.schema import COMPRESSION_RATIO, CONSUMERS, PRODUCERS, REPLICATION_FACTOR, RETENTION_HOURS

COUNTS = ["messages", "bytes", "errors", "latency_us"]
LAG_STATUS = [(100.0, "warning"), (500.0, "critical")]


def message_fact() -> Column:
    """A message as one entry to be summed into a cell, dated by its arrival."""
    return F.struct(
        F.col("topic").alias("topic"),
        F.col("partition").alias("partition"),
        F.col("arrival_time").alias("at"),
        F.col("offset").cast("bigint").alias("offset"),
        F.lit(None).cast("bigint").alias("committed"),
        F.lit(1).alias("messages"),
        F.col("bytes").cast("bigint").alias("bytes"),
        (~F.col("ok")).cast("int").alias("errors"),
        (epoch_micros(F.col("arrival_time")) - epoch_micros(F.col("event_time"))).alias("latency_us"),
        F.col("arrival_time").alias("arrived"),
    )


def commit_fact() -> Column:
    """A commit as one entry to be summed into a cell, dated by its commit time."""
    return F.struct(
        F.col("topic").alias("topic"),
        F.col("partition").alias("partition"),
        F.col("commit_time").alias("at"),
        F.lit(None).cast("bigint").alias("offset"),
        F.col("committed_offset").cast("bigint").alias("committed"),
        F.lit(0).alias("messages"),
        F.lit(0).cast("bigint").alias("bytes"),
        F.lit(0).alias("errors"),
        F.lit(0).cast("bigint").alias("latency_us"),
        F.lit(None).cast(NTZ).alias("arrived"),
    )


def cells_of(facts: DataFrame, every: str) -> DataFrame:
    """Facts per topic, partition and tick; the same function serves batch and stream."""
    return (
        facts.groupBy(F.window("at", every).alias("tick"), "topic", "partition")
        .agg(
            F.max("offset").alias("offset"),
            F.max("committed").alias("committed"),
            F.sum("messages").alias("messages"),
            F.sum("bytes").alias("bytes"),
            F.sum("errors").alias("errors"),
            F.sum("latency_us").alias("latency_us"),
            F.max("arrived").alias("arrived"),
        )
        .select(F.col("tick.end").alias("time"), "*")
        .drop("tick")
    )


def cells(messages: DataFrame, commits: DataFrame, every: str) -> DataFrame:
    facts = messages.select(message_fact().alias("f")).unionByName(commits.select(commit_fact().alias("f")))
    return cells_of(facts.select("f.*"), every)


def offsets_of(cells: DataFrame) -> DataFrame:
    """Highest offsets and latest arrival per partition: all that later ticks need of earlier ones."""
    return cells.groupBy("topic", "partition").agg(
        *[F.max(c).alias(c) for c in ("offset", "committed", "arrived")]
    )


def with_offsets(cells: DataFrame, offsets: DataFrame, at: Column) -> DataFrame:
    """Cells with known offsets placed at an earlier tick, from where they carry forward."""
    placed = offsets.select(
        at.alias("time"), "topic", "partition", "offset", "committed", "arrived",
        *[F.lit(0).cast("bigint").alias(c) for c in COUNTS],
    )
    return cells.unionByName(placed).groupBy("time", "topic", "partition").agg(
        *[F.max(c).alias(c) for c in ("offset", "committed", "arrived")], *[F.sum(c).alias(c) for c in COUNTS]
    )


def tick_range(messages: DataFrame, every: str) -> Column:
    """First and last tick that has an arrival, as a scalar subquery over one column."""
    bounds = messages.agg(F.min("arrival_time").alias("a"), F.max("arrival_time").alias("b"))
    tick = lambda c: F.window(F.col(c), every)["end"]
    first = bounds.select("b", tick("a").alias("first")).select("first", tick("b").alias("last"))
    return first.select(F.struct("first", "last").alias("r")).scalar()


def topic_ticks(cells: DataFrame, every: str, ticks: Column) -> DataFrame:
    """One row per topic and tick of the range, quiet ticks included, with offsets carried forward.

    Each cell stands for its own tick and the quiet ticks up to the next cell of its partition.
    """
    step = F.expr(f"INTERVAL {every}")
    series = Window.partitionBy("topic", "partition").orderBy("time")
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    carried = (
        cells.withColumn("_range", ticks)
        .where(F.col("time") <= F.col("_range.last"))
        .withColumns(
            {
                "_produced": F.max("offset").over(so_far),
                "_committed": F.coalesce(F.max("committed").over(so_far), zero),
                "_earlier": F.coalesce(F.max("committed").over(before), zero),
                "_arrived": F.max("arrived").over(so_far),
                "_from": F.when(F.lag("time").over(series).isNull(), F.least("time", "_range.first")).otherwise(F.col("time")),
                "_until": F.coalesce((F.lead("time").over(series) - step).cast(NTZ), F.col("_range.last")),
            }
        )
    )
    filled = carried.withColumn("_tick", F.explode(F.sequence("_from", "_until", step)))
    own, begun = F.col("_tick") == F.col("time"), F.col("_tick") >= F.col("time")
    per_partition = filled.withColumns(
        {
            "_lag": F.when(begun, F.coalesce(at_least_zero(1 + F.col("_produced") - F.col("_committed")), zero)).otherwise(zero),
            "_progress": F.when(own, F.col("_committed") - F.col("_earlier")).otherwise(zero),
            "_arrived": F.when(begun, F.col("_arrived")),
            "_seen": begun & F.col("_produced").isNotNull(),
            **{c: F.when(own, F.col(c)).otherwise(zero) for c in COUNTS},
            "time": F.col("_tick"),
        }
    )
    per_topic = per_partition.groupBy("topic", "time").agg(
        F.sum("_lag").alias("lag_records"),
        F.sum("_progress").alias("progress"),
        F.sum("messages").alias("messages"),
        F.sum("bytes").alias("bytes"),
        F.sum("errors").alias("errors"),
        F.sum("latency_us").alias("latency_us"),
        F.max("_arrived").alias("arrived"),
        F.count_if("_seen").alias("partitions"),
    )
    retained = Window.partitionBy("topic").orderBy(epoch_seconds(F.col("time"))).rangeBetween(-RETENTION_HOURS * 3600 + 1, 0)
    return per_topic.withColumn("retained_bytes", F.sum("bytes").over(retained))


def seconds_of(every: str) -> Column:
    start = F.lit("2000-01-03").cast(NTZ)
    return seconds_between(start, (start + F.expr(f"INTERVAL {every}")).cast(NTZ))


def lag_status(lag: Column) -> Column:
    return band(lag.cast("double"), LAG_STATUS, below="healthy")


def consumer_metrics(ticks: DataFrame, every: str) -> DataFrame:
    return ticks.select("time", *_consumer(every))


def producer_metrics(ticks: DataFrame, every: str) -> DataFrame:
    return ticks.select("time", *_producer(every))


def topic_metrics(ticks: DataFrame, every: str) -> DataFrame:
    return ticks.select("time", *_topic(every))


def _consumer(every: str) -> list[Column]:
    lag = F.col("lag_records")
    return [
        code_text_or(F.col("topic"), CONSUMERS, "unknown").alias("consumer_name"),
        F.col("topic"),
        lag.alias("lag_records"),
        lag_megabytes(lag).alias("lag_mb"),
        (F.col("progress") / seconds_of(every)).alias("consumption_rate"),
        lag_status(lag).alias("status"),
        F.timestamp_diff("SECOND", F.col("arrived"), F.col("time")).alias("last_message_age_seconds"),
        _error_rate().alias("error_rate"),
    ]


def _producer(every: str) -> list[Column]:
    return [
        code_text_or(F.col("topic"), PRODUCERS, "unknown").alias("producer_name"),
        F.col("topic"),
        *_rates(every),
        _error_rate().alias("error_rate"),
        (ratio(F.col("latency_us"), F.col("messages")) / 1000).alias("request_latency_ms"),
        F.lit(COMPRESSION_RATIO).alias("compression_ratio"),
        F.lit("active").alias("status"),
    ]


def _topic(every: str) -> list[Column]:
    return [
        F.col("topic").alias("topic_name"),
        F.col("partitions").cast("int").alias("partitions"),
        *_rates(every),
        (F.col("retained_bytes") / 1e6).alias("log_size_mb"),
        F.lit(RETENTION_HOURS).alias("retention_hours"),
        F.lit(REPLICATION_FACTOR).alias("replication_factor"),
        F.lit(0).alias("under_replicated_partitions"),
    ]


def _rates(every: str) -> list[Column]:
    seconds = seconds_of(every)
    return [
        (F.col("messages") / seconds).alias("messages_per_second"),
        (F.col("bytes") / seconds).alias("bytes_per_second"),
    ]


def _error_rate() -> Column:
    return ratio(F.col("errors"), F.col("messages"))


def lag_penalty(lag: Column) -> Column:
    return F.when(lag > 500, 20).when(lag > 100, 10).otherwise(0)


def error_penalty(rate: Column) -> Column:
    return F.when(rate > 0.05, 15).when(rate > 0.02, 5).otherwise(0)


def system_metrics(ticks: DataFrame, every: str) -> DataFrame:
    """Roll-up of one tick over all topics: throughput, lag, healthy consumers, health score."""
    return ticks.groupBy("time").agg(*_system(every))


def _system(every: str) -> list[Column]:
    lag = F.col("lag_records")
    penalty = F.sum(lag_penalty(lag) + error_penalty(_error_rate()))
    return [
        (F.sum("messages") / seconds_of(every)).alias("total_throughput"),
        F.sum(lag).alias("total_consumer_lag"),
        F.count_if(lag_status(lag) == "healthy").alias("healthy_consumers"),
        F.count("*").alias("total_consumers"),
        F.greatest(F.lit(0.0), 100.0 - penalty).alias("system_health_score"),
    ]


def alerts(ticks: DataFrame, every: str) -> DataFrame:
    """Alerts of the three conditions as rows of one table, read off one report per tick."""
    raised = alerts_of(F.col("timestamp"), F.col("system"), F.col("consumers"), F.col("producers"))
    return report(ticks, every).select(F.inline(raised))


def alerts_of(time: Column, system: Column, consumers: Column, producers: Column) -> Column:
    """Alerts of one report as an array of alert structs."""
    at = epoch_seconds(time).cast("string")

    def alert(prefix, name, kind, severity, component, value, message):
        return F.struct(
            F.concat(F.lit(prefix), *([name, F.lit("_")] if name is not None else []), at).alias("alert_id"),
            time.alias("timestamp"),
            F.lit(kind).alias("alert_type"),
            F.lit(severity).alias("severity"),
            component.alias("component"),
            value.cast("double").alias("value"),
            message.alias("message"),
        )

    def lagging(c):
        name, lag = c["consumer_name"], c["lag_records"]
        text = F.concat(F.lit("CRITICAL: Consumer "), name, F.lit(" has "), lag.cast("string"), F.lit(" records lag"))
        return alert("CRITICAL_LAG_", name, "critical_consumer_lag", "critical", name, lag, text)

    def failing(p):
        name, rate = p["producer_name"], p["error_rate"]
        text = F.concat(F.lit("Producer "), name, F.lit(" error rate: "), percent_text(rate))
        return alert("PRODUCER_ERRORS_", name, "producer_errors", "high", name, rate, text)

    score = system["system_health_score"]
    text = F.format_string("System health degraded to %.1f%%", score)
    degraded = alert("SYSTEM_HEALTH_", None, "system_health_degraded", "high", F.lit("system"), score, text)
    return F.concat(
        F.transform(F.filter(consumers, lambda c: c["lag_records"] > 500), lagging),
        F.filter(F.array(F.when(score < 70, degraded)), lambda a: a.isNotNull()),
        F.transform(F.filter(producers, lambda p: p["error_rate"] > 0.05), failing),
    )


def dashboard_summary(ticks: DataFrame, every: str) -> DataFrame:
    """Display record per tick, with the number of critical alerts raised in that tick."""
    critical = F.count_if(F.col("lag_records") > 500).alias("critical_alerts")
    return ticks.groupBy("time").agg(*_system(every), critical).select(
        "time", "total_consumers", "healthy_consumers", "total_throughput",
        F.col("system_health_score").alias("health_score"), "critical_alerts",
    )


def report(ticks: DataFrame, every: str) -> DataFrame:
    """One nested record per tick; its lists hold one entry per topic."""
    lists = [
        F.collect_list(F.struct(*members)).alias(name)
        for name, members in (("consumers", _consumer(every)), ("producers", _producer(every)), ("topics", _topic(every)))
    ]
    system = _system(every)
    grouped = ticks.groupBy("time").agg(*system, *lists)
    rolled = [c for c in grouped.columns if c not in ("time", "consumers", "producers", "topics")]
    return grouped.select(
        F.lit("kafka_realtime").alias("analytics_type"), F.col("time").alias("timestamp"),
        F.struct(*rolled).alias("system"), "consumers", "producers", "topics",
    )


def flattened(reports: DataFrame, part: str) -> DataFrame:
    """Rows of one list of the nested report, or its system roll-up."""
    if part == "system":
        return reports.select(F.col("timestamp").alias("time"), "system.*")
    return reports.select(F.col("timestamp").alias("time"), F.inline(part))
