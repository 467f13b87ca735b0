"""Message pipeline queries: lag, throughput, health score, alerts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantwatch.functions.numbers import at_least_zero, lag_megabytes
from plantwatch.operators import health as H
from plantwatch.plans.registry import query
from plantwatch.plans.sqlviews import MESSAGES
from plantwatch.sources.adapters import messages, messages_of, pipeline_facts, table

TICK = "1 hour"

_TICKS = MESSAGES + """, facts AS (
SELECT topic, part, time_bucket(INTERVAL 1 HOUR, arrival_time) + INTERVAL 1 HOUR AS t, off, NULL::BIGINT AS committed, 1 AS msgs, bytes, CASE WHEN ok THEN 0 ELSE 1 END AS errors,
epoch_us(arrival_time) - epoch_us(event_time) AS latency, arrival_time AS arrived FROM messages
UNION ALL SELECT topic, part, time_bucket(INTERVAL 1 HOUR, commit_time) + INTERVAL 1 HOUR, NULL, committed, 0, 0, 0, 0, NULL FROM commits), grid AS (
SELECT topic, part, unnest(generate_series((SELECT min(t) FROM facts WHERE msgs = 1), (SELECT max(t) FROM facts WHERE msgs = 1), INTERVAL 1 HOUR)) AS t FROM (SELECT DISTINCT topic, part FROM facts)), dense AS (
SELECT g.topic, g.part, g.t, max(off) AS off, max(committed) AS committed, coalesce(sum(msgs), 0) AS msgs, coalesce(sum(bytes), 0) AS bytes, coalesce(sum(errors), 0) AS errors,
coalesce(sum(latency), 0) AS latency, max(arrived) AS arrived FROM grid g LEFT JOIN facts f ON f.topic = g.topic AND f.part = g.part AND f.t = g.t GROUP BY 1, 2, 3), carried AS (
SELECT *, max(off) OVER w AS top_off, coalesce(max(committed) OVER w, 0) AS now_c, coalesce(max(committed) OVER (PARTITION BY topic, part ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS old_c,
max(arrived) OVER w AS last_at FROM dense WINDOW w AS (PARTITION BY topic, part ORDER BY t)), topic_sums AS (
SELECT topic, t, sum(greatest(0, coalesce(1 + top_off - now_c, 0)))::BIGINT AS lag, sum(now_c - old_c) AS progress, sum(msgs)::BIGINT AS msgs, sum(bytes)::DOUBLE AS bytes, sum(errors)::DOUBLE AS errors,
sum(latency)::DOUBLE AS latency, max(last_at) AS last_at, count(top_off) AS parts FROM carried GROUP BY 1, 2), ticks AS (
SELECT *, sum(bytes) OVER (PARTITION BY topic ORDER BY t RANGE BETWEEN INTERVAL 167 HOUR PRECEDING AND CURRENT ROW) AS kept, coalesce(errors / nullif(msgs, 0), 0.0) AS err FROM topic_sums)"""

_STATUS = "CASE WHEN lag < 100 THEN 'healthy' WHEN lag < 500 THEN 'warning' ELSE 'critical' END"
_CONSUMER = "CASE WHEN topic = 'scada.normal' THEN 'normal_consumer' ELSE 'attack_consumer' END"
_PRODUCER = "CASE WHEN topic = 'scada.normal' THEN 'normal_producer' ELSE 'attack_producer' END"
_PENALTY = "CASE WHEN lag > 500 THEN 20 WHEN lag > 100 THEN 10 ELSE 0 END + CASE WHEN err > 0.05 THEN 15 WHEN err > 0.02 THEN 5 ELSE 0 END"
_SYSTEM = f"""{_TICKS}, system AS (SELECT t AS time, sum(msgs) / 3600.0 AS total_throughput, sum(lag)::BIGINT AS total_consumer_lag,
count(CASE WHEN {_STATUS} = 'healthy' THEN 1 END) AS healthy_consumers, count(*) AS total_consumers, greatest(0, 100.0 - sum({_PENALTY}))::DOUBLE AS system_health_score,
count(CASE WHEN lag > 500 THEN 1 END) AS critical_alerts FROM ticks GROUP BY t)"""


def pipeline_ticks(spark, folder):
    ticks = H.tick_range(messages_of(table(spark, folder, "events")), TICK)
    return H.topic_ticks(H.cells_of(pipeline_facts(spark, folder), TICK), TICK, ticks)


def _rounded(frame, *names, digits=6):
    return frame.withColumns({n: F.round(n, digits) for n in names})


@query(f"""WITH {_TICKS} SELECT t AS time, {_CONSUMER} AS consumer_name, topic, lag AS lag_records, round((lag * 0.001)::DOUBLE, 6) AS lag_mb, round(progress / 3600, 6) AS consumption_rate,
{_STATUS} AS status, CAST(floor(epoch(t) - epoch(last_at)) AS BIGINT) AS last_message_age_seconds, round(err, 6) AS error_rate FROM ticks""")
def consumer_metrics(spark, folder):
    metrics = H.consumer_metrics(pipeline_ticks(spark, folder), TICK)
    return _rounded(metrics, "lag_mb", "consumption_rate", "error_rate")


@query(f"""WITH {_TICKS} SELECT t AS time, {_PRODUCER} AS producer_name, topic, round(msgs / 3600, 6) AS messages_per_second, round(bytes / 3600, 6) AS bytes_per_second,
round(err, 6) AS error_rate, round(coalesce(latency / nullif(msgs, 0), 0.0) / 1000, 4) AS request_latency_ms, 0.75::DOUBLE AS compression_ratio, 'active' AS status FROM ticks""")
def producer_metrics(spark, folder):
    metrics = H.producer_metrics(pipeline_ticks(spark, folder), TICK)
    return _rounded(_rounded(metrics, "messages_per_second", "bytes_per_second", "error_rate"), "request_latency_ms", digits=4)


@query(f"""WITH {_TICKS} SELECT t AS time, topic AS topic_name, parts::INTEGER AS partitions, round(msgs / 3600, 6) AS messages_per_second, round(bytes / 3600, 6) AS bytes_per_second,
round(kept / 1e6, 8) AS log_size_mb, 168 AS retention_hours, 1 AS replication_factor, 0 AS under_replicated_partitions FROM ticks""")
def topic_metrics(spark, folder):
    metrics = H.topic_metrics(pipeline_ticks(spark, folder), TICK)
    return _rounded(_rounded(metrics, "messages_per_second", "bytes_per_second"), "log_size_mb", digits=8)


@query(f"""WITH {_SYSTEM} SELECT time, round(total_throughput, 6)::DOUBLE AS total_throughput, total_consumer_lag, healthy_consumers, total_consumers, system_health_score FROM system""")
def system_rollup(spark, folder):
    return _rounded(H.system_metrics(pipeline_ticks(spark, folder), TICK), "total_throughput")


@query(f"""WITH {_SYSTEM} SELECT system_health_score, count(*) AS ticks, min(time) AS first_time, max(time) AS last_time FROM system GROUP BY 1""")
def health_score(spark, folder):
    scores = H.system_metrics(pipeline_ticks(spark, folder), TICK)
    return scores.groupBy("system_health_score").agg(F.count("*").alias("ticks"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


_EPOCH = "CAST(CAST(epoch({}) AS BIGINT) AS VARCHAR)"


@query(f"""WITH {_SYSTEM} SELECT 'CRITICAL_LAG_' || {_CONSUMER} || '_' || {_EPOCH.format('t')} AS alert_id, t AS timestamp, 'critical_consumer_lag' AS alert_type, 'critical' AS severity,
{_CONSUMER} AS component, lag::DOUBLE AS value, 'CRITICAL: Consumer ' || {_CONSUMER} || ' has ' || CAST(lag AS VARCHAR) || ' records lag' AS message FROM ticks WHERE lag > 500
UNION ALL SELECT 'SYSTEM_HEALTH_' || {_EPOCH.format('time')}, time, 'system_health_degraded', 'high', 'system', system_health_score, printf('System health degraded to %.1f%%', system_health_score) FROM system WHERE system_health_score < 70
UNION ALL SELECT 'PRODUCER_ERRORS_' || {_PRODUCER} || '_' || {_EPOCH.format('t')}, t, 'producer_errors', 'high', {_PRODUCER}, round(err, 6), 'Producer ' || {_PRODUCER} || ' error rate: ' || printf('%.2f%%', err * 100) FROM ticks WHERE err > 0.05""")
def health_alerts(spark, folder):
    return _rounded(H.alerts(pipeline_ticks(spark, folder), TICK), "value")


@query(f"""WITH {_SYSTEM} SELECT time, total_consumers, healthy_consumers, round(total_throughput, 6)::DOUBLE AS total_throughput, system_health_score AS health_score, critical_alerts FROM system""")
def dashboard_summary(spark, folder):
    return _rounded(H.dashboard_summary(pipeline_ticks(spark, folder), TICK), "total_throughput")


@query(f"""WITH {_SYSTEM} SELECT c.t AS time, {_CONSUMER.replace('topic', 'c.topic')} AS consumer_name, lag AS lag_records, {_STATUS} AS status, system_health_score FROM ticks c JOIN system s ON s.time = c.t""")
def flatten_report(spark, folder):
    """Nested reports back to rows, one per consumer."""
    reports = H.report(pipeline_ticks(spark, folder), TICK)
    consumers = reports.select("timestamp", "system", F.explode("consumers").alias("c"))
    return consumers.select(
        F.col("timestamp").alias("time"), "c.consumer_name", "c.lag_records", "c.status", "system.system_health_score"
    )


@query(f"""WITH {MESSAGES} SELECT event_id, off - 40 AS estimate, greatest(0, off - 40) AS lag_records, round((greatest(0, off - 40) * 0.001)::DOUBLE, 6) AS lag_mb FROM messages""")
def clamped_lag_estimates(spark, folder):
    estimate = F.col("offset") - 40
    return messages(spark, folder).select(
        "event_id", estimate.alias("estimate"), at_least_zero(estimate).alias("lag_records"), F.round(lag_megabytes(estimate), 6).alias("lag_mb")
    )
