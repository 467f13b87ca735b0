"""Lag, status, health score and alerts at their thresholds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantwatch.operators import health as H

EVERY = "30 seconds"
T0 = dt.datetime(2024, 1, 1, 0, 0, 30)


def ticks(rows, *entries):
    """(topic, lag, messages, errors) at one tick."""
    data = [(topic, "2024-01-01 00:00:30", lag, 0, messages, 10 * messages, errors, 0, "2024-01-01 00:00:20", 1, 500) for topic, lag, messages, errors in entries]
    return rows(data, "topic string, time timestamp_ntz, lag_records bigint, progress bigint, messages bigint, bytes bigint, errors bigint, latency_us bigint, arrived timestamp_ntz, partitions bigint, retained_bytes bigint")


@pytest.mark.parametrize("lag, status, penalty", [(0, "healthy", 0), (99, "healthy", 0), (100, "warning", 0), (101, "warning", 10), (499, "warning", 10), (500, "critical", 10), (501, "critical", 20)])
def test_lag_steps(rows, lag, status, penalty):
    frame = ticks(rows, ("scada.normal", lag, 100, 0))
    assert H.consumer_metrics(frame, EVERY).first()["status"] == status
    assert H.system_metrics(frame, EVERY).first()["system_health_score"] == 100.0 - penalty


@pytest.mark.parametrize("errors, penalty", [(200, 0), (201, 5), (500, 5), (501, 15)])
def test_error_steps(rows, errors, penalty):
    assert H.system_metrics(ticks(rows, ("scada.normal", 0, 10000, errors)), EVERY).first()["system_health_score"] == 100.0 - penalty


def test_score_of_seventy_raises_no_alert_and_the_floor_is_zero(rows):
    seventy = ticks(rows, ("scada.normal", 0, 100, 6), ("scada.attacks", 0, 100, 6))
    assert H.system_metrics(seventy, EVERY).first()["system_health_score"] == 70.0
    assert [r["alert_type"] for r in H.alerts(seventy, EVERY).collect()] == ["producer_errors", "producer_errors"]
    worst = ticks(rows, ("scada.normal", 900, 100, 99), ("scada.attacks", 900, 100, 99))
    assert H.system_metrics(worst, EVERY).first()["system_health_score"] == 30.0
    many = ticks(rows, *[(f"t{i}", 900, 100, 99) for i in range(4)])
    assert H.system_metrics(many, EVERY).first()["system_health_score"] == 0.0


def test_two_lagging_consumers(rows):
    frame = ticks(rows, ("scada.normal", 501, 100, 0), ("scada.attacks", 501, 100, 0))
    alerts = {r["alert_id"]: r for r in H.alerts(frame, EVERY).collect()}
    assert set(alerts) == {"CRITICAL_LAG_normal_consumer_1704067230", "CRITICAL_LAG_attack_consumer_1704067230", "SYSTEM_HEALTH_1704067230"}
    assert alerts["SYSTEM_HEALTH_1704067230"]["message"] == "System health degraded to 60.0%"
    assert alerts["CRITICAL_LAG_normal_consumer_1704067230"]["message"] == "CRITICAL: Consumer normal_consumer has 501 records lag"
    summary = H.dashboard_summary(frame, EVERY).first()
    assert (summary["critical_alerts"], summary["healthy_consumers"], summary["total_consumers"]) == (2, 0, 2)


def test_quiet_ticks_carry_offsets_forward(rows):
    messages = rows(
        [("scada.normal", 0, 0, "2024-01-01 00:00:05", "2024-01-01 00:00:06", 100, True), ("scada.normal", 0, 1, "2024-01-01 00:00:07", "2024-01-01 00:00:09", 100, False), ("scada.normal", 0, 2, "2024-01-01 00:02:05", "2024-01-01 00:02:06", 100, True)],
        "topic string, partition int, offset bigint, event_time timestamp_ntz, arrival_time timestamp_ntz, bytes bigint, ok boolean",
    )
    commits = rows([("scada.normal", 0, 1, "2024-01-01 00:00:45"), ("scada.normal", 0, 3, "2024-01-01 00:02:10")], "topic string, partition int, committed_offset bigint, commit_time timestamp_ntz")
    found = H.topic_ticks(H.cells(messages, commits, EVERY), EVERY, H.tick_range(messages, EVERY)).orderBy("time").collect()
    assert [(r["time"] - T0).seconds // 30 for r in found] == [0, 1, 2, 3, 4]
    assert [r["lag_records"] for r in found] == [2, 1, 1, 1, 0]
    assert [r["messages"] for r in found] == [2, 0, 0, 0, 1]
    assert [r["retained_bytes"] for r in found] == [200, 200, 200, 200, 300]
    consumer = H.consumer_metrics(H.topic_ticks(H.cells(messages, commits, EVERY), EVERY, H.tick_range(messages, EVERY)), EVERY).orderBy("time").collect()
    assert [r["last_message_age_seconds"] for r in consumer] == [21, 51, 81, 111, 24]
    assert consumer[0]["error_rate"] == 0.5


def test_reports_flatten_to_the_same_rows(rows):
    frame = ticks(rows, ("scada.normal", 5, 100, 0), ("scada.attacks", 7, 50, 1))
    reports = H.report(frame, EVERY)
    assert reports.count() == 1
    assert sorted(map(tuple, H.flattened(reports, "consumers").collect())) == sorted(map(tuple, H.consumer_metrics(frame, EVERY).collect()))
    assert tuple(H.flattened(reports, "system").first()) == tuple(H.system_metrics(frame, EVERY).first())
    assert H.flattened(reports, "topics").count() == 2
