"""Common table expressions that give the oracle SQL the same canonical inputs as the adapters."""

LONG = """long AS (
  SELECT CASE WHEN event_type = 'error' THEN 'alarm_data' ELSE 'actuator_data' END AS measurement,
         ts AS time, event_type AS field, value AS value_num, user_id AS unit,
         CAST(user_id % 6 + 1 AS INTEGER) AS stage, CAST(user_id % 4 AS VARCHAR) AS state,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, event_id AS tie
  FROM events)"""

TEXTS = LONG + """, texts AS (
  SELECT *, CASE WHEN tie % 97 = 0 THEN 'n/a' WHEN tie % 89 <> 0 THEN CAST(value_num AS VARCHAR) END AS raw FROM long)"""

PLANT = LONG + """, plant AS (
  SELECT measurement, time, value_num, unit, stage, k, tie, k % 6 AS code,
         CASE field WHEN 'click' THEN 'FIT' WHEN 'view' THEN 'LIT' WHEN 'purchase' THEN 'AIT' WHEN 'signup' THEN 'P' ELSE 'MV' END AS kind,
         CASE field WHEN 'click' THEN 'FIT' WHEN 'view' THEN 'LIT' WHEN 'purchase' THEN 'AIT' WHEN 'signup' THEN 'P' ELSE 'MV' END
           || ' ' || CAST(stage AS VARCHAR) || '01' AS field
  FROM long)"""

BASELINE = LONG + """, baseline AS (
  SELECT field, avg(value_num) AS mean, stddev_pop(value_num) AS std FROM long GROUP BY field), scored AS (
  SELECT l.*, b.mean, b.std, (l.value_num - b.mean) / nullif(b.std, 0) AS z FROM long l JOIN baseline b USING (field)), banded AS (
  SELECT *, CASE WHEN abs(z) > 4 THEN 'CRITICAL' WHEN abs(z) > 3 THEN 'HIGH' WHEN abs(z) > 2 THEN 'MODERATE' ELSE 'NORMAL' END AS severity
  FROM scored)"""

MESSAGES = """messages AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'scada.normal' ELSE 'scada.attacks' END AS topic,
         CAST(user_id % 3 AS INTEGER) AS part, ts AS event_time,
         ts + to_seconds(event_id % 30) AS arrival_time, octet_length(encode(props)) AS bytes,
         event_type <> 'error' AS ok, event_id,
         row_number() OVER (PARTITION BY user_id % 2, user_id % 3 ORDER BY ts, event_id) - 1 AS off
  FROM events), commits AS (
  SELECT topic, part, off + 1 AS committed, arrival_time + INTERVAL 5 MINUTE AS commit_time FROM messages
  WHERE off % 10 = 0 AND NOT (topic = 'scada.attacks' AND day(event_time) BETWEEN 10 AND 19))"""
