"""Detection queries: z-scores, rules, explanations, attack classes, alerts and commands."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantwatch.functions import labels as L
from plantwatch.functions import times as T
from plantwatch.functions.numbers import zscore
from plantwatch.operators import commands as C
from plantwatch.operators import explain as E
from plantwatch.operators import rules as U
from plantwatch.operators import statistics as S
from plantwatch.operators import taxonomy as X
from plantwatch.operators.joins import lookup
from plantwatch.operators.ordered import runs
from plantwatch.operators.rules import Rule
from plantwatch.plans.registry import query
from plantwatch.plans.sqlviews import BASELINE, LONG, PLANT
from plantwatch.schema import ATTACK_TYPES, DETECTOR_LABELS
from plantwatch.sources.adapters import (
    EVENT_FIELDS, LINE_SENSORS, PLANT_FIELDS, plant_readings, readings, table, wide_rows,
)


def banded(spark, folder):
    return S.with_severity(S.scored(readings(spark, folder), fields=EVENT_FIELDS))


@query(f"""WITH {LONG}, s AS (SELECT avg(value_num) AS m, stddev_pop(value_num) AS d FROM long)
SELECT tie, field, value_num, round((value_num - m) / d, 5) AS z, CASE WHEN abs((value_num - m) / d) > 3 THEN 1 ELSE 0 END AS flagged FROM long, s""")
def global_zscore(spark, folder):
    long = readings(spark, folder)
    s = long.agg(F.struct(F.avg("value_num").alias("mean"), F.stddev_pop("value_num").alias("std")).alias("s")).scalar()
    rows = long.withColumn("z", zscore(F.col("value_num"), s["mean"], s["std"]))
    return rows.select("tie", "field", "value_num", F.round("z", 5).alias("z"), S.anomaly_flag(F.col("value_num"), F.col("z"), 3.0).alias("flagged"))


@query(f"""WITH {BASELINE} SELECT tie, field, round(mean, 6) AS mean, round(std, 6) AS std, round(z, 5) AS z, severity FROM banded""")
def field_zscore(spark, folder):
    """The same result as with a broadcast baseline, by the lookup that spreads hot fields."""
    scores = S.with_severity(S.scored(readings(spark, folder), spread_by=["tie"]))
    return scores.select("tie", "field", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), F.round("z", 5).alias("z"), "severity")


_POINTS = """cells AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS field,
unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value_num FROM lineitem)"""
_RATES = f"""{LONG}, {_POINTS}, readings AS (SELECT field, value_num FROM long UNION ALL SELECT * FROM cells), base AS (
SELECT field, avg(value_num) AS m, stddev_pop(value_num) AS d FROM readings GROUP BY field), labels AS (
SELECT field, CASE WHEN abs((value_num - m) / nullif(d, 0)) > 2.5 THEN 1 ELSE 0 END AS y FROM readings JOIN base USING (field)), rates AS (
SELECT field, avg(y) AS anomaly_rate, count(y) AS n, sum(y)::BIGINT AS anomalies FROM labels GROUP BY field)"""


def feature_rates(spark, folder):
    """Anomaly rates of event fields, which are long, and line item sensors, which are wide."""
    long = S.anomaly_rates(S.feature_labels(readings(spark, folder).select("field", "value_num"), EVENT_FIELDS, threshold=2.5))
    return long.unionByName(S.wide_anomaly_rates(wide_rows(spark, folder), LINE_SENSORS, threshold=2.5))


@query(f"WITH {_RATES} SELECT field, round(anomaly_rate, 8) AS anomaly_rate, n, anomalies FROM rates")
def feature_anomaly_rate(spark, folder):
    return feature_rates(spark, folder).withColumn("anomaly_rate", F.round("anomaly_rate", 8))


@query(f"""WITH {_RATES} SELECT field, round(anomaly_rate, 8) AS anomaly_rate, anomalies FROM rates
WHERE anomaly_rate > 0.01 AND anomaly_rate < 0.5 ORDER BY anomaly_rate DESC, field LIMIT 5""")
def gated_features(spark, folder):
    kept = S.most_anomalous(S.gated(feature_rates(spark, folder)), 5)
    return kept.select("field", F.round("anomaly_rate", 8).alias("anomaly_rate"), "anomalies")


@query(f"""WITH {LONG}, base AS (SELECT stage, avg(value_num) AS m, stddev_pop(value_num) AS d FROM long WHERE field <> 'error' GROUP BY stage)
SELECT tie, stage, round(value_num - m, 6) AS deviation, round((value_num - m) / d, 5) AS z FROM long JOIN base USING (stage) WHERE field = 'error'""")
def normal_baseline_vs_attack(spark, folder):
    long = readings(spark, folder)
    normal = S.baseline(long.where(F.col("field") != "error"), by="stage")
    attack = lookup(long.where(F.col("field") == "error"), normal, ["stage"], "inner")
    z = zscore(F.col("value_num"), F.col("mean"), F.col("std"))
    return attack.select("tie", "stage", F.round(F.col("value_num") - F.col("mean"), 6).alias("deviation"), F.round(z, 5).alias("z"))


DIMENSIONS = [f"d{i:02d}" for i in range(64)]
_CONTRIBUTIONS = """dims AS (SELECT vec_id, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), base AS (
SELECT i, avg(value) AS m, sqrt(var_pop(value)) + 1e-8 AS s FROM dims GROUP BY i), ranked AS (
SELECT vec_id, 'd' || lpad(CAST(i AS VARCHAR), 2, '0') AS feature, value, (value - m) / s AS z,
row_number() OVER (PARTITION BY vec_id ORDER BY abs((value - m) / s) DESC, i) AS place FROM dims JOIN base USING (i))"""


def explained(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return E.top_contributors(rows, "embedding", DIMENSIONS, E.vector_statistics(rows, "embedding", len(DIMENSIONS)))


@query(f"WITH {_CONTRIBUTIONS} SELECT vec_id, CAST(place - 1 AS INTEGER) AS place, feature, round(value, 6) AS value, round(abs(z), 5) AS deviation, round(z, 5) AS z_score FROM ranked WHERE place <= 5")
def top_contributors(spark, folder):
    listed = explained(spark, folder).select("vec_id", F.posexplode("contributors").alias("place", "c"))
    return listed.select("vec_id", "place", "c.feature", *[F.round(f"c.{m}", d).alias(m) for m, d in (("value", 6), ("deviation", 5), ("z_score", 5))])


@query(f"""WITH {_CONTRIBUTIONS} SELECT vec_id, """ + ", ".join(
    f"max(feature) FILTER (WHERE place = {i}) AS top_contributor_{i}, round(max(z) FILTER (WHERE place = {i}), 5) AS contributor_{i}_zscore, "
    f"max(CASE WHEN z > 0 THEN 'high' ELSE 'low' END) FILTER (WHERE place = {i}) AS contributor_{i}_direction" for i in (1, 2, 3)
) + " FROM ranked WHERE place <= 3 GROUP BY vec_id")
def contributor_columns(spark, folder):
    rows = E.contributor_columns(explained(spark, folder))
    return rows.select("vec_id", *[
        c for i in (1, 2, 3) for c in (f"top_contributor_{i}", F.round(f"contributor_{i}_zscore", 5).alias(f"contributor_{i}_zscore"), f"contributor_{i}_direction")
    ])


EVENT_RULES = [
    Rule("click", low=0.5, high=250.0, low_critical=5.0, high_critical=180.0, states=(0, 1, 2)),
    Rule("view", low=0.0, high=200.0, low_critical=2.0, high_critical=150.0, states=(0, 2)),
    Rule("purchase", high=300.0, high_critical=160.0),
    Rule("error", low=1.0, states=(1, 2, 3)),
]
_LIMITS = """CASE field WHEN 'click' THEN value_num < 0.5 OR value_num > 250 WHEN 'view' THEN value_num < 0 OR value_num > 200
WHEN 'purchase' THEN value_num > 300 WHEN 'error' THEN value_num < 1 ELSE FALSE END"""
_ZONES = f"""CASE WHEN {_LIMITS} THEN NULL WHEN field = 'click' AND value_num <= 5 THEN 'CRITICAL_LOW' WHEN field = 'view' AND value_num <= 2 THEN 'CRITICAL_LOW'
WHEN field = 'click' AND value_num >= 180 THEN 'CRITICAL_HIGH' WHEN field = 'view' AND value_num >= 150 THEN 'CRITICAL_HIGH'
WHEN field = 'purchase' AND value_num >= 160 THEN 'CRITICAL_HIGH' END"""
_STATES = """CASE field WHEN 'click' THEN state NOT IN ('0', '1', '2') WHEN 'view' THEN state NOT IN ('0', '2')
WHEN 'error' THEN state NOT IN ('1', '2', '3') ELSE FALSE END"""


@query(f"WITH {LONG} SELECT tie, field, value_num FROM long WHERE {_LIMITS}")
def rule_limits(spark, folder):
    broken = U.limit_violated(F.col("field"), F.col("value_num"), EVENT_RULES)
    return readings(spark, folder).where(broken).select("tie", "field", "value_num")


@query(f"WITH {LONG} SELECT tie, field, value_num, {_ZONES} AS zone FROM long WHERE {_ZONES} IS NOT NULL")
def rule_zones(spark, folder):
    zone = U.critical_zone(F.col("field"), F.col("value_num"), EVENT_RULES)
    return readings(spark, folder).select("tie", "field", "value_num", zone.alias("zone")).where(F.col("zone").isNotNull())


@query(f"WITH {LONG} SELECT tie, field, state FROM long WHERE {_STATES}")
def rule_states(spark, folder):
    invalid = U.state_violated(F.col("field"), F.col("state").cast("int"), EVENT_RULES)
    return readings(spark, folder).where(invalid).select("tie", "field", "state")


def event_checks():
    field, value, state = F.col("field"), F.col("value_num"), F.col("state").cast("int")
    zone = U.critical_zone(field, value, EVENT_RULES)
    return {
        "statistical": (F.col("severity") != "NORMAL", F.col("severity")),
        "rule_based_range": (
            U.limit_violated(field, value, EVENT_RULES) | zone.isNotNull(),
            F.when(zone.isNotNull(), "CRITICAL").otherwise("HIGH"),
        ),
        "rule_based_logic": (U.state_violated(field, state, EVENT_RULES), F.lit("HIGH")),
    }


_FOUND = f"""{BASELINE}, found AS (SELECT tie, time, unit, field, 'statistical' AS detector, severity FROM banded WHERE severity <> 'NORMAL'
UNION ALL SELECT tie, time, unit, field, 'rule_based_range', CASE WHEN {_ZONES} IS NOT NULL THEN 'CRITICAL' ELSE 'HIGH' END FROM banded WHERE {_LIMITS} OR {_ZONES} IS NOT NULL
UNION ALL SELECT tie, time, unit, field, 'rule_based_logic', 'HIGH' FROM banded WHERE {_STATES})"""


@query(f"WITH {_FOUND} SELECT tie, field, detector, severity FROM found")
def detector_union(spark, folder):
    return U.findings(banded(spark, folder), ["tie", "field"], event_checks())


@query(f"""WITH {_FOUND} SELECT CASE detector WHEN 'statistical' THEN 'Statistical (Z-Score)' WHEN 'rule_based_logic' THEN 'Rule-Based Logic'
ELSE 'Range Violations' END AS method, count(*) AS n FROM found GROUP BY 1""")
def detector_counts(spark, folder):
    found = U.findings(banded(spark, folder), ["tie"], event_checks())
    return found.groupBy(L.relabel(F.col("detector"), DETECTOR_LABELS).alias("method")).agg(F.count("*").alias("n"))


@query(f"WITH {BASELINE} SELECT severity, count(*) AS n, min(time) AS first_time, max(time) AS last_time FROM banded WHERE severity <> 'NORMAL' GROUP BY 1")
def alert_by_severity(spark, folder):
    alerts = banded(spark, folder).where(F.col("severity") != "NORMAL")
    return alerts.groupBy("severity").agg(F.count("*").alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


@query(f"""WITH {BASELINE}, a AS (SELECT *, CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS active FROM banded WHERE severity <> 'NORMAL' AND time >= (SELECT max(time) FROM long) - INTERVAL 7 DAY)
SELECT tie, time, field, severity, active FROM a WHERE active = 1""")
def active_alerts(spark, folder):
    from plantwatch.operators.readings import latest_time, since

    alerts = banded(spark, folder).where(F.col("severity") != "NORMAL").withColumn("active", (F.col("k") % 2 == 0).cast("int"))
    recent = since(alerts, "7 DAYS", latest_time(readings(spark, folder)))
    return recent.where(F.col("active") == 1).select("tie", "time", "field", "severity", "active")


@query(f"""WITH {BASELINE} SELECT tie, field, value_num, CASE WHEN field = 'error' THEN 'attack' ELSE 'normal' END AS data_type, severity,
TIMESTAMP '2024-02-01 00:00:00' AS processed_at FROM banded""")
def enriched_rows(spark, folder):
    rows = C.enriched(banded(spark, folder), F.col("field") == "error", T.at("2024-02-01"))
    return rows.select("tie", "field", "value_num", "data_type", "severity", "processed_at")


PLANT_SCOPE = X.Scope(every="6 hours", probe_gap_seconds=7200.0)


def plant_scored(spark, folder):
    rows = S.with_severity(S.scored(plant_readings(spark, folder), fields=PLANT_FIELDS))
    return (
        rows.withColumn("is_actuator", C.is_actuator(F.col("field")))
        .withColumn("state_code", F.when(F.col("is_actuator"), F.col("code")))
        .withColumn("state_invalid", F.col("is_actuator") & ~F.col("code").isin(*U.PUMP_STATES))
    )


_PLANT = PLANT + """, pbase AS (SELECT field, avg(value_num) AS m, stddev_pop(value_num) AS d FROM plant GROUP BY field), pscored AS (
SELECT p.*, kind IN ('P', 'MV', 'UV') AS actuator, CASE WHEN kind IN ('P', 'MV', 'UV') THEN code END AS st, CASE WHEN kind IN ('P', 'MV', 'UV') AND code NOT IN (0, 1, 2, 3) THEN 1 ELSE 0 END AS bad,
CASE WHEN abs((value_num - m) / nullif(d, 0)) > 4 THEN 'CRITICAL' WHEN abs((value_num - m) / nullif(d, 0)) > 3 THEN 'HIGH' WHEN abs((value_num - m) / nullif(d, 0)) > 2 THEN 'MODERATE' ELSE 'NORMAL' END AS severity,
time_bucket(INTERVAL 6 HOUR, time) AS w FROM plant p JOIN pbase USING (field)), per_field AS (
SELECT w, field, kind, stage, actuator, count(*) AS seen, min(value_num) AS lo, max(value_num) AS hi, count(CASE WHEN severity <> 'NORMAL' THEN 1 END) AS anomalies,
count(CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 1 END) AS strong, min(CASE WHEN severity <> 'NORMAL' THEN time END) AS first_at, sum(bad) AS invalid, min(st) AS lo_st, max(st) AS hi_st
FROM pscored GROUP BY 1, 2, 3, 4, 5), hits AS (SELECT * FROM per_field WHERE NOT actuator AND anomalies > 0), gaps AS (
SELECT w, max(gap) AS gap FROM (SELECT w, epoch(first_at) - epoch(lag(first_at) OVER (PARTITION BY w ORDER BY first_at)) AS gap FROM hits) GROUP BY w), family AS (
SELECT w, max(s) AS family FROM (SELECT w, kind, count(DISTINCT stage) AS s FROM hits GROUP BY 1, 2) GROUP BY w), grp AS (
SELECT w, max(c) AS largest FROM (SELECT w, stage, count(*) AS c FROM hits GROUP BY 1, 2) GROUP BY w), evidence AS (
SELECT p.w, count(CASE WHEN NOT actuator AND anomalies > 0 THEN 1 END) AS n, count(DISTINCT CASE WHEN NOT actuator AND anomalies > 0 THEN stage END) AS stages,
count(CASE WHEN NOT actuator THEN 1 END) AS sensors, count(CASE WHEN NOT actuator AND lo = hi AND seen >= 2 THEN 1 END) AS frozen,
sum(CASE WHEN NOT actuator THEN strong ELSE 0 END) AS strong, count(CASE WHEN actuator AND lo_st <> hi_st THEN 1 END) AS moving, count(CASE WHEN actuator AND invalid > 0 THEN 1 END) AS invalid,
sum(anomalies) AS anomalies FROM per_field p GROUP BY p.w), classes AS (
SELECT w, n, stages, moving, invalid, CASE WHEN sensors > 0 AND frozen = sensors THEN 'DOS' WHEN n >= 5 AND strong = 0 AND coalesce(gap, 0) <= 7200 THEN 'RECON'
WHEN n >= 5 AND stages >= 3 THEN 'MSMP' WHEN coalesce(family, 0) >= 2 THEN 'MSCP' WHEN coalesce(largest, 0) >= 3 THEN 'SSMP' WHEN moving >= 3 THEN 'CMRI'
WHEN invalid BETWEEN 1 AND 2 THEN 'NMRI' WHEN n BETWEEN 1 AND 2 AND stages = 1 THEN 'SSCP' WHEN anomalies > 0 OR invalid > 0 THEN 'UNKNOWN_ATTACK' ELSE 'NORMAL' END AS attack_class
FROM evidence LEFT JOIN gaps USING (w) LEFT JOIN family USING (w) LEFT JOIN grp USING (w))"""


@query(f"""WITH {_PLANT} SELECT w AS window_start, w + INTERVAL 6 HOUR AS window_end, CAST(n AS INTEGER) AS sensors_hit, CAST(stages AS INTEGER) AS stages_hit,
moving AS moving_actuators, invalid AS invalid_actuators, attack_class FROM classes""")
def attack_taxonomy(spark, folder):
    return X.attack_classes(plant_scored(spark, folder), scope=PLANT_SCOPE)


_CLASS_CODE = "CASE attack_class " + " ".join(f"WHEN '{v}' THEN {k}" for k, v in ATTACK_TYPES.items()) + " END"


@query(f"""WITH {_PLANT}, layers AS (
SELECT tie, 'statistical' AS detector, CASE severity WHEN 'MODERATE' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END AS r FROM pscored WHERE severity <> 'NORMAL'
UNION ALL SELECT tie, 'rule_based_logic', 2 FROM pscored WHERE bad = 1
UNION ALL SELECT tie, 'model', 2 FROM pscored WHERE value_num / 500 > 0.35
UNION ALL SELECT tie, 'pattern', 1 FROM pscored JOIN classes USING (w) WHERE severity <> 'NORMAL' AND attack_class NOT IN ('NORMAL', 'UNKNOWN_ATTACK')), verdicts AS (
SELECT tie, max(r) AS r, string_agg(detector, ',' ORDER BY detector) AS detectors FROM layers GROUP BY tie)
SELECT p.time, p.unit, p.tie, CASE v.r WHEN 1 THEN 'MODERATE' WHEN 2 THEN 'HIGH' ELSE 'CRITICAL' END AS severity, v.detectors, c.attack_class, {_CLASS_CODE} AS class_code
FROM verdicts v JOIN pscored p USING (tie) JOIN classes c USING (w)""")
def layered_verdict(spark, folder):
    """Statistical, rule, model and pattern layers of each reading as one verdict."""
    rows = plant_scored(spark, folder).withColumn("window_start", F.window("time", PLANT_SCOPE.every)["start"])
    classes = X.attack_classes(plant_scored(spark, folder), scope=PLANT_SCOPE).select("window_start", "attack_class")
    placed = lookup(rows, classes, ["window_start"], spread_by=["tie"])
    severity = F.col("severity")
    fired = X.fired_layers({
        "model": (F.col("value_num") / 500 > 0.35, F.lit("HIGH")),
        "pattern": ((severity != "NORMAL") & ~F.col("attack_class").isin("NORMAL", "UNKNOWN_ATTACK"), F.lit("MODERATE")),
        "rule_based_logic": (F.col("state_invalid"), F.lit("HIGH")),
        "statistical": (severity != "NORMAL", severity),
    })
    verdict = X.combined(placed, fired)
    code = L.code_text(F.col("attack_class"), {v: k for k, v in ATTACK_TYPES.items()})
    return verdict.select("time", "unit", "tie", F.col("verdict").alias("severity"), "detectors", "attack_class", code.alias("class_code"))


@query(f"""WITH {BASELINE}, f AS (SELECT date_trunc('hour', time) AS w, field, count(*) AS n FROM banded WHERE severity <> 'NORMAL' GROUP BY 1, 2)
SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, string_agg(field, ',' ORDER BY field) AS fields, CAST(count(*) AS INTEGER) AS n_fields, sum(n)::BIGINT AS anomalies
FROM f GROUP BY w HAVING count(*) >= 2""")
def sensor_correlation_alert(spark, folder):
    return X.correlated(banded(spark, folder), "1 hour", 2)


@query(f"""WITH {BASELINE}, flagged AS (SELECT *, severity <> 'NORMAL' AS hot FROM banded), marked AS (
SELECT *, CASE WHEN hot = lag(hot) OVER (PARTITION BY unit ORDER BY time, tie) THEN 0 ELSE 1 END AS opens FROM flagged), placed AS (
SELECT *, sum(opens) OVER (PARTITION BY unit ORDER BY time, tie) AS s FROM marked)
SELECT unit, min(time) AS run_start, max(time) AS run_end, count(*) AS run_rows, round(sum(value_num), 4) AS run_total FROM placed WHERE hot GROUP BY unit, s HAVING count(*) >= 2""")
def anomaly_runs(spark, folder):
    """Pattern over consecutive events: two or more anomalous readings of a unit in a row."""
    hot = F.col("severity") != "NORMAL"
    found = runs(banded(spark, folder), ["unit"], "time", "tie", lambda before, now: before["state"] != now["state"], state=hot, total=F.col("value_num"))
    return found.where(F.col("run_state") & (F.col("run_rows") >= 2)).select("unit", "run_start", "run_end", "run_rows", F.round("run_total", 4).alias("run_total"))


@query(f"""WITH {BASELINE}, a AS (SELECT tie, time, field, 'attack' AS alert_type, 'high' AS alert_severity, 'Attack detected: attack_' || CAST(k % 6 AS VARCHAR) AS message FROM banded WHERE field = 'error' AND k % 5 = 0
UNION ALL SELECT tie, time, field, 'flow_anomaly', lower(severity), 'Unusual flow at ' || field FROM banded WHERE field = 'click' AND severity IN ('HIGH', 'CRITICAL'))
SELECT time, field, tie, alert_type, alert_severity, message, 'ALERT_' || lpad(CAST(row_number() OVER (PARTITION BY CAST(time AS DATE) ORDER BY time, tie) AS VARCHAR), 6, '0') AS alert_id FROM a""")
def row_alerts(spark, folder):
    attack = F.when((F.col("field") == "error") & (F.col("k") % 5 == 0), F.concat(F.lit("attack_"), (F.col("k") % 6).cast("string")))
    alerts = C.row_alerts(banded(spark, folder), attack, F.col("field") == "click")
    return C.sequential_ids(alerts, "time", "tie").select("time", "field", "tie", "alert_type", "alert_severity", "message", "alert_id")


@query(f"""WITH {_PLANT}, latest AS (SELECT field, max_by(value_num, (time, tie)) AS v, max(time) AS time FROM pscored WHERE severity = 'CRITICAL' AND actuator GROUP BY field)
SELECT field AS actuator_id, 'OFF' AS action, 'detector' AS operator, 'critical reading ' || printf('%.2f', v) AS reason, time FROM latest""")
def actuator_commands(spark, folder):
    return C.commands_from_anomalies(plant_scored(spark, folder).where(F.col("is_actuator")))


_ACTUATOR_ROWS = ", ".join(f"('{a}')" for a in C.ACTUATORS)


@query(f"""WITH {LONG}, actuators(name) AS (VALUES {_ACTUATOR_ROWS}), c AS (SELECT tie, time, CASE WHEN k = 99 THEN 'ALL' ELSE 'P' || CAST(stage AS VARCHAR) || '01' END AS target,
CASE WHEN state = '0' THEN '' ELSE 'operator ' || CAST(unit AS VARCHAR) END AS operator, CASE WHEN state = '1' THEN '' ELSE field END AS reason FROM long WHERE field = 'signup'), x AS (
SELECT tie, time, target AS actuator_id, 'ON' AS action, operator, reason FROM c WHERE target <> 'ALL'
UNION ALL SELECT tie, time, name, CASE WHEN name LIKE 'MV%' THEN 'CLOSE' ELSE 'OFF' END, operator, reason FROM c JOIN actuators ON target = 'ALL')
SELECT tie, time, actuator_id, action, operator, reason, CASE WHEN operator = '' THEN 'operator is required' WHEN reason = '' THEN 'reason is required' END AS rejected FROM x""")
def command_audit(spark, folder):
    commands = readings(spark, folder).where(F.col("field") == "signup").select(
        "tie", "time",
        F.when(F.col("k") == 99, C.ALL_ACTUATORS).otherwise(F.concat(F.lit("P"), F.col("stage").cast("string"), F.lit("01"))).alias("actuator_id"),
        F.lit("ON").alias("action"),
        F.when(F.col("state") == "0", "  ").otherwise(F.concat(F.lit(" operator "), F.col("unit").cast("string"))).alias("operator"),
        F.when(F.col("state") != "1", F.col("field")).alias("reason"),
    )
    return C.audited(commands).withColumn("reason", F.coalesce("reason", F.lit("")))
