"""Panel queries: ranges, filters, latest values, top lists and windows over readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantwatch.functions import labels as L
from plantwatch.functions import times as T
from plantwatch.operators import readings as R
from plantwatch.operators import statistics as S
from plantwatch.operators.ordered import runs, top_rows, with_previous
from plantwatch.plans.registry import query
from plantwatch.plans.sqlviews import BASELINE, LONG
from plantwatch.schema import FLOW_STEPS, GAUGE_STEPS, SEVERITY_LABELS
from plantwatch.sources.adapters import EVENT_FIELDS, SERIES, readings


@query(f"""WITH {BASELINE}
SELECT CAST(time AS DATE) AS day, field, severity, count(*) AS n FROM banded GROUP BY 1, 2, 3""")
def severity_by_day(spark, folder):
    scores = S.with_severity(S.scored(readings(spark, folder)))
    return scores.groupBy(F.to_date("time").alias("day"), "field", "severity").agg(F.count("*").alias("n"))


@query(f"WITH {LONG} SELECT DISTINCT measurement FROM long")
def measurement_list(spark, folder):
    return R.measurements(readings(spark, folder))


@query(f"WITH {LONG} SELECT time, field, unit, value_num, tie FROM long")
def scan_all(spark, folder):
    return R.in_range(readings(spark, folder)).select("time", "field", "unit", "value_num", "tie")


@query(f"""WITH {LONG} SELECT time, field, unit, value_num, tie FROM long
WHERE measurement = 'actuator_data' AND time >= TIMESTAMP '2024-01-05 00:00:00' AND time < TIMESTAMP '2024-01-12 00:00:00'""")
def time_range_scan(spark, folder):
    chosen = R.select_readings(readings(spark, folder), measurement="actuator_data")
    return R.in_range(chosen, "2024-01-05 00:00:00", "2024-01-12 00:00:00").select(
        "time", "field", "unit", "value_num", "tie"
    )


@query(f"""WITH {LONG} SELECT field, count(*) AS n FROM long
WHERE time >= (SELECT max(time) FROM long) - INTERVAL 24 HOUR GROUP BY field""")
def relative_range_scan(spark, folder):
    long = readings(spark, folder)
    return R.count(R.since(long, "24 HOURS", R.latest_time(long)), ["field"])


@query(f"""WITH {LONG} SELECT field, round(avg(value_num), 6) AS mean_value FROM long
WHERE state = '2' AND field IN ('click', 'view') GROUP BY field""")
def state_filter_mean(spark, folder):
    chosen = R.select_readings(readings(spark, folder), fields=["click", "view"], tags={"state": "2"})
    return R.mean(chosen, ["field"]).withColumn("mean_value", F.round("mean_value", 6))


@query(f"""WITH {LONG} SELECT time, field, unit, value_num FROM long
WHERE regexp_matches(field, '^(sign|pur)|ew$') AND stage = 3""")
def field_regex_filter(spark, folder):
    chosen = R.select_readings(readings(spark, folder), field_like="^(sign|pur)|ew$")
    return chosen.where(F.col("stage") == 3).select("time", "field", "unit", "value_num")


@query(f"""WITH {LONG} SELECT time, field, unit, value_num, tie FROM long
WHERE field IN ('error', 'purchase') AND value_num >= 150 ORDER BY value_num DESC, tie LIMIT 50""")
def membership_and_threshold(spark, folder):
    chosen = R.select_readings(readings(spark, folder), fields=["error", "purchase"])
    over = chosen.where(F.col("value_num") >= 150)
    return R.top(over, 50, "value_num", "tie").select("time", "field", "unit", "value_num", "tie")


@query(f"""WITH {LONG} SELECT field, unit, max(time) AS time,
max_by(value_num, (time, tie)) AS value_num FROM long GROUP BY field, unit""")
def last_per_series(spark, folder):
    return R.last(readings(spark, folder), SERIES, "tie")


@query(f"""WITH {LONG} SELECT time, value_num FROM long WHERE field = 'click' ORDER BY time DESC, tie DESC LIMIT 1""")
def last_merged(spark, folder):
    return R.last(R.select_readings(readings(spark, folder), field="click"), [], "tie")


@query(f"""WITH {LONG}, gaps AS (SELECT *, CASE WHEN k % 3 <> 0 THEN value_num END AS seen FROM long)
SELECT field, unit, max(time) AS time, max_by(seen, (time, tie)) AS seen FROM gaps
WHERE seen IS NOT NULL GROUP BY field, unit""")
def last_non_null(spark, folder):
    gaps = readings(spark, folder).withColumn("seen", F.when(F.col("k") % 3 != 0, F.col("value_num")))
    return R.last_known(gaps, SERIES, "tie", "seen")


@query(f"""WITH {LONG}, ranked AS (SELECT *, row_number() OVER (PARTITION BY field, unit ORDER BY time, tie) AS p FROM long)
SELECT field, unit, time, value_num, tie FROM ranked WHERE p <= 10""")
def first_n_per_series(spark, folder):
    return R.first_per_series(readings(spark, folder), SERIES, 10, "tie").select(
        "field", "unit", "time", "value_num", "tie"
    )


@query(f"""WITH {LONG}, ranked AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY time DESC, tie DESC) AS p FROM long)
SELECT field, unit, time, value_num, tie FROM ranked WHERE p <= 10""")
def tail_n_per_series(spark, folder):
    return R.tail_per_series(readings(spark, folder), ["field"], 10, "tie").select(
        "field", "unit", "time", "value_num", "tie"
    )


@query(f"""WITH {LONG}, ranked AS (SELECT *, row_number() OVER (PARTITION BY field, unit ORDER BY time DESC, tie DESC) AS p FROM long)
SELECT field, unit, time, value_num, tie FROM ranked WHERE p <= 5""")
def latest_n_for_scoring(spark, folder):
    return R.tail_per_series(readings(spark, folder), SERIES, 5, "tie").select(
        "field", "unit", "time", "value_num", "tie"
    )


@query(f"WITH {LONG} SELECT field, unit, time, value_num, tie FROM long ORDER BY value_num DESC, tie LIMIT 10")
def top_n(spark, folder):
    return R.top(readings(spark, folder), 10, "value_num", "tie").select("field", "unit", "time", "value_num", "tie")


@query(f"""WITH {LONG} SELECT date_trunc('minute', time) AS window_start,
date_trunc('minute', time) + INTERVAL 1 MINUTE AS window_end, count(*) AS n FROM long GROUP BY 1, 2""")
def count_per_minute(spark, folder):
    return R.windowed(readings(spark, folder), "1 minute").drop("total")


@query(f"""WITH {LONG} SELECT time_bucket(INTERVAL 5 MINUTE, time) AS window_start,
time_bucket(INTERVAL 5 MINUTE, time) + INTERVAL 5 MINUTE AS window_end, field, count(*) AS n, round(sum(value_num), 4) AS total
FROM long GROUP BY 1, 2, 3""")
def count_tumbling_5m(spark, folder):
    return R.windowed(readings(spark, folder), "5 minutes", ["field"]).withColumn("total", F.round("total", 4))


@query(f"""WITH {LONG}, panes AS (
SELECT time_bucket(INTERVAL 30 SECOND, time) - to_seconds(30 * s) AS window_start, value_num FROM long, (SELECT unnest([0, 1]) AS s) slides)
SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, count(*) AS n, round(sum(value_num), 4) AS total
FROM panes GROUP BY 1, 2""")
def count_sliding_1m(spark, folder):
    return R.windowed(readings(spark, folder), "1 minute", slide="30 seconds").withColumn("total", F.round("total", 4))


SESSIONS = f"""WITH {LONG}, marked AS (
SELECT *, CASE WHEN time - lag(time) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM long
WINDOW w AS (PARTITION BY unit ORDER BY time, tie)), placed AS (
SELECT *, sum(opens) OVER (PARTITION BY unit ORDER BY time, tie) AS s FROM marked)
SELECT unit, min(time) AS session_start, max(time) + INTERVAL 30 MINUTE AS session_end, count(*) AS n,
round(sum(value_num), 4) AS total FROM placed GROUP BY unit, s"""


@query(SESSIONS)
def session_counts(spark, folder):
    gap = F.expr("INTERVAL 30 MINUTES")
    sessions = runs(
        readings(spark, folder), ["unit"], "time", "tie",
        lambda before, now: now["time"] >= before["time"] + gap, total=F.col("value_num"),
    )
    return sessions.select(
        "unit",
        F.col("run_start").alias("session_start"),
        (F.col("run_end") + gap).cast(T.NTZ).alias("session_end"),
        F.col("run_rows").alias("n"),
        F.round("run_total", 4).alias("total"),
    )


@query(f"WITH {LONG} SELECT unit, count(*) AS n FROM long WHERE value_num > 100 GROUP BY unit ORDER BY n DESC, unit LIMIT 20")
def group_count_top(spark, folder):
    over = readings(spark, folder).where(F.col("value_num") > 100)
    return top_rows(R.count(over, ["unit"]), [F.desc("n"), F.asc("unit")], 20)


@query(f"""WITH {LONG} SELECT unit, round(avg(value_num), 6) AS mean_value FROM long GROUP BY unit
ORDER BY mean_value DESC, unit LIMIT 10""")
def group_mean_top(spark, folder):
    means = R.mean(readings(spark, folder), ["unit"]).withColumn("mean_value", F.round("mean_value", 6))
    return top_rows(means, [F.desc("mean_value"), F.asc("unit")], 10)


@query(f"""WITH {LONG}, leader AS (SELECT field FROM long GROUP BY field ORDER BY count(*) DESC, field LIMIT 1)
SELECT time, field AS sensor, value_num AS reading FROM long WHERE field = (SELECT field FROM leader)
ORDER BY time DESC, tie DESC LIMIT 1""")
def top_series_last_value(spark, folder):
    return R.top_series_latest(readings(spark, folder), "field", "tie")


@query(f"""WITH {LONG} SELECT tie, field, state, CASE
WHEN field = 'click' THEN CASE state WHEN '0' THEN 'OFF' WHEN '1' THEN 'ON' ELSE state END
WHEN field = 'view' THEN CASE state WHEN '0' THEN 'CLOSED' WHEN '1' THEN 'OPEN' ELSE state END
WHEN field = 'error' THEN CASE state WHEN '0' THEN 'NORMAL' WHEN '1' THEN 'ALARM' ELSE state END
ELSE CASE state WHEN '0' THEN 'STOPPED' WHEN '1' THEN 'RUNNING' ELSE state END END AS state_label FROM long""")
def state_text(spark, folder):
    kind = L.code_text_or(F.col("field"), {"click": "switch", "view": "valve", "error": "alarm"}, "pump")
    return readings(spark, folder).select("tie", "field", "state", L.state_text(kind, F.col("state")).alias("state_label"))


@query(f"""WITH {LONG} SELECT CASE WHEN value_num >= 30 THEN 'yellow' WHEN value_num >= 10 THEN 'green'
WHEN value_num >= 0 THEN 'red' END AS band, count(*) AS n FROM long GROUP BY 1""")
def threshold_band(spark, folder):
    return readings(spark, folder).groupBy(L.band(F.col("value_num"), FLOW_STEPS).alias("band")).agg(F.count("*").alias("n"))


@query(f"""WITH {LONG}, bounds AS (SELECT field, min(value_num) AS low, max(value_num) AS high FROM long GROUP BY field), placed AS (
SELECT field, (value_num - low) / nullif(high - low, 0) * 100 AS share FROM long JOIN bounds USING (field))
SELECT field, CASE WHEN share >= 85 THEN 'red' WHEN share >= 70 THEN 'orange' ELSE 'green' END AS band, count(*) AS n
FROM placed GROUP BY 1, 2""")
def percent_band(spark, folder):
    from plantwatch.operators.joins import lookup_by

    long = readings(spark, folder)
    bounds = long.groupBy("field").agg(F.min("value_num").alias("low"), F.max("value_num").alias("high"))
    placed = lookup_by(long, bounds, "field")
    shown = L.percent_band(F.col("value_num"), F.col("low"), F.col("high"), GAUGE_STEPS)
    return placed.groupBy("field", shown.alias("band")).agg(F.count("*").alias("n"))


@query(f"""WITH {BASELINE}, tagged AS (SELECT field || '{{severity="' || lower(severity) || '"}}' AS legend FROM banded)
SELECT CASE WHEN legend LIKE '%severity="critical"%' THEN 'Critical' WHEN legend LIKE '%severity="high"%' THEN 'High'
WHEN legend LIKE '%severity="moderate"%' THEN 'Medium' ELSE legend END AS legend, count(*) AS n FROM tagged GROUP BY 1""")
def relabel_severity(spark, folder):
    scores = S.with_severity(S.scored(readings(spark, folder), fields=EVENT_FIELDS))
    legend = F.concat("field", F.lit('{severity="'), F.lower("severity"), F.lit('"}'))
    return scores.groupBy(L.relabel(legend, SEVERITY_LABELS).alias("legend")).agg(F.count("*").alias("n"))


@query(f"""WITH {LONG}, changes AS (SELECT unit, tie, time, CAST(k % 4 AS VARCHAR) AS new_state,
lag(CAST(k % 4 AS VARCHAR)) OVER (PARTITION BY unit ORDER BY time, tie) AS old_state FROM long)
SELECT unit, tie, time, old_state, new_state FROM changes WHERE old_state <> new_state""")
def state_changes(spark, folder):
    states = readings(spark, folder).withColumn("new_state", (F.col("k") % 4).cast("string"))
    tracked = with_previous(states, ["unit"], ["time", "tie"], F.col("new_state"), "old_state")
    return tracked.where(F.col("old_state") != F.col("new_state")).select("unit", "tie", "time", "old_state", "new_state")


@query(f"""WITH {LONG} SELECT CAST(time AS DATE) AS day, field, count(*) AS n, round(avg(value_num), 6) AS mean_value,
round(stddev_pop(value_num), 6) AS std_value, min(value_num) AS min_value, max(value_num) AS max_value FROM long GROUP BY 1, 2""")
def daily_stats(spark, folder):
    daily = R.daily_statistics(readings(spark, folder), ["field"])
    return daily.withColumns({c: F.round(c, 6) for c in ("mean_value", "std_value")})


@query(f"""WITH {LONG} SELECT count(*) AS n, count(CASE WHEN field = 'error' THEN 1 END) AS flagged,
min(time) AS first_time, max(time) AS last_time FROM long""")
def total_counts(spark, folder):
    return readings(spark, folder).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("field") == "error").alias("flagged"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    )


@query(f"""WITH {LONG} SELECT time AS t_stamp, field AS sensor, value_num AS reading FROM long WHERE measurement = 'alarm_data'""")
def project_rename_drop(spark, folder):
    chosen = R.select_readings(readings(spark, folder), measurement="alarm_data")
    return (
        chosen.drop("measurement", "state", "stage", "k")
        .withColumnsRenamed({"time": "t_stamp", "field": "sensor", "value_num": "reading"})
        .select("t_stamp", "sensor", "reading")
    )


@query(f"""WITH {LONG} SELECT time AS "_time", field AS "Sensor", value_num AS "Reading" FROM long WHERE unit = 7""")
def panel_projection(spark, folder):
    return readings(spark, folder).where(F.col("unit") == 7).select(
        F.col("time").alias("_time"), F.col("field").alias("Sensor"), F.col("value_num").alias("Reading")
    )
