"""Preparation queries: typing, times, labels by interval, merged training sets, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantwatch.functions import labels as L
from plantwatch.functions import messages as M
from plantwatch.functions import numbers as N
from plantwatch.functions import times as T
from plantwatch.operators import prepare as P
from plantwatch.operators import reshape
from plantwatch.operators import sampling as X
from plantwatch.operators.readings import latest_write
from plantwatch.operators.statistics import standardised, wide_statistics
from plantwatch.plans.registry import query
from plantwatch.plans.sqlviews import LONG, TEXTS
from plantwatch.schema import ATTACK_LABELS, ATTACK_TYPES, UNKNOWN_ATTACK
from plantwatch.sources.adapters import EVENT_FIELDS, LINE_SENSORS, readings, table, text_readings, wide_rows

# Closed intervals in the events' month: the second and third overlap, the last holds no row.
JANUARY_WINDOWS = [
    ("2024-01-03 08:00:00", "2024-01-03 20:30:00", "FIT401"),
    ("2024-01-08 00:00:00", "2024-01-09 12:00:00", "LIT301"),
    ("2024-01-09 06:00:00", "2024-01-10 00:00:00", "P601"),
    ("2024-01-15 10:15:00", "2024-01-15 22:45:30", "multi-point"),
    ("2024-01-21 00:00:00", "2024-01-22 00:00:00", "MV501"),
    ("2024-03-01 00:00:00", "2024-03-02 00:00:00", "P301"),
]
WINDOWS_SQL = "windows(s, e, target) AS (VALUES " + ", ".join(
    f"(TIMESTAMP '{s}', TIMESTAMP '{e}', '{t}')" for s, e, t in JANUARY_WINDOWS
) + ")"


@query(f"WITH {TEXTS} SELECT tie, CAST(CASE WHEN raw = 'n/a' THEN NULL ELSE raw END AS DOUBLE) AS value_num, raw IS NULL AS was_null FROM texts WHERE field IS NOT NULL AND time IS NOT NULL")
def coerce_numbers(spark, folder):
    rows = text_readings(spark, folder).na.drop(subset=["field", "time"])
    return rows.select("tie", N.to_number(F.col("raw")).alias("value_num"), F.col("raw").isNull().alias("was_null"))


@query(f"""WITH {TEXTS} SELECT tie, field, coalesce(TRY_CAST(raw AS DOUBLE), 0.0) AS value_num FROM texts WHERE raw IS NOT NULL""")
def dropna_cast(spark, folder):
    rows = text_readings(spark, folder).na.drop(subset=["raw"])
    return rows.select("tie", "field", N.fill(N.to_number(F.col("raw")), 0.0).alias("value_num"))


@query("""WITH cells AS (
SELECT l_orderkey, l_linenumber, l_shipdate AS time, l_returnflag, l_linestatus, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS field,
unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value_num FROM lineitem)
SELECT time, l_returnflag, l_linestatus, field, count(*) AS n, round(sum(value_num), 2) AS total FROM cells
WHERE value_num IS NOT NULL GROUP BY 1, 2, 3, 4""")
def points_from_rows(spark, folder):
    points = reshape.to_numeric_points(wide_rows(spark, folder), "t_stamp", ["l_returnflag", "l_linestatus"], LINE_SENSORS)
    return points.groupBy("time", "l_returnflag", "l_linestatus", "field").agg(
        F.count("*").alias("n"), F.round(F.sum("value_num"), 2).alias("total")
    )


@query(f"""WITH {TEXTS} SELECT tie, state AS tag_state, field, TRY_CAST(raw AS DOUBLE) AS value_num,
CASE WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN raw END AS value_str FROM texts WHERE raw IS NOT NULL""")
def typed_points(spark, folder):
    rows = text_readings(spark, folder).select("time", "tie", F.col("state").alias("tag_state"), *[
        F.when(F.col("field") == f, F.col("raw")).alias(f) for f in EVENT_FIELDS
    ])
    points = reshape.to_points(rows, "time", ["tag_state"], EVENT_FIELDS, keep=["tie"])
    return points.select("tie", "tag_state", "field", "value_num", "value_str")


@query(f"""WITH {LONG} SELECT date_trunc('hour', time) AS hour, unit,
max_by(value_num, tie) FILTER (WHERE field = 'click') AS click, max_by(value_num, tie) FILTER (WHERE field = 'error') AS error,
max_by(value_num, tie) FILTER (WHERE field = 'purchase') AS purchase, max_by(value_num, tie) FILTER (WHERE field = 'signup') AS signup,
max_by(value_num, tie) FILTER (WHERE field = 'view') AS "view" FROM long GROUP BY 1, 2""")
def rows_from_points(spark, folder):
    hourly = readings(spark, folder).withColumn("hour", F.date_trunc("HOUR", "time").cast(T.NTZ))
    return reshape.to_rows(hourly, ["hour", "unit"], EVENT_FIELDS, tie="tie")


@query(f"""WITH {LONG}, {WINDOWS_SQL} SELECT tie, time, CASE WHEN EXISTS (SELECT 1 FROM windows WHERE time BETWEEN s AND e) THEN 1 ELSE 0 END AS attack FROM long""")
def label_intervals(spark, folder):
    return P.labelled(readings(spark, folder), "time", JANUARY_WINDOWS, "attack").select("tie", "time", "attack")


@query(f"""WITH {LONG}, {WINDOWS_SQL} SELECT sum(CASE WHEN EXISTS (SELECT 1 FROM windows WHERE time BETWEEN s AND e) THEN 1 ELSE 0 END)::BIGINT AS attack_rows,
min(time) AS first_time, max(time) AS last_time FROM long""")
def label_interval_totals(spark, folder):
    rows = P.labelled(readings(spark, folder), "time", JANUARY_WINDOWS, "attack")
    return rows.agg(
        F.sum("attack").alias("attack_rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )


@query(f"""WITH {LONG}, {WINDOWS_SQL} SELECT tie, (SELECT target FROM windows WHERE time BETWEEN s AND e ORDER BY s LIMIT 1) AS target
FROM long WHERE EXISTS (SELECT 1 FROM windows WHERE time BETWEEN s AND e)""")
def label_interval_target(spark, folder):
    target = P.interval_target(F.col("time"), JANUARY_WINDOWS)
    return readings(spark, folder).select("tie", target.alias("target")).where(F.col("target").isNotNull())


@query("""WITH windows AS (SELECT ts AS s, ts + INTERVAL 20 MINUTE AS e FROM events WHERE event_type = 'error' AND value > 100)
SELECT event_id, CASE WHEN EXISTS (SELECT 1 FROM windows WHERE ts BETWEEN s AND e) THEN 1 ELSE 0 END AS attack FROM events""")
def label_intervals_from_table(spark, folder):
    """Intervals that are themselves data: twenty minutes after every large error."""
    events = table(spark, folder, "events")
    windows = events.where((F.col("event_type") == "error") & (F.col("value") > 100)).select(
        F.col("ts").alias("start"), (F.col("ts") + F.expr("INTERVAL 20 MINUTES")).cast(T.NTZ).alias("end")
    )
    return P.labelled_by_table(events.select("event_id", "ts"), windows, "ts", "attack").select("event_id", "attack")


@query("""WITH windows AS (SELECT event_id AS w, ts AS s, ts + to_minutes(10 + event_id % 50) AS e, event_type || ' ' || CAST(event_id AS VARCHAR) AS target FROM events WHERE value > 150)
SELECT event_id, (SELECT min_by(target, s) FROM windows WHERE ts BETWEEN s AND e) AS target FROM events""")
def interval_targets_from_table(spark, folder):
    """Overlapping intervals of different lengths, one after each large value: the earliest that still runs."""
    events = table(spark, folder, "events")
    minutes = F.make_dt_interval(mins=(10 + F.col("event_id") % 50).cast("int"))
    windows = events.where(F.col("value") > 150).select(
        F.col("ts").alias("start"), (F.col("ts") + minutes).cast(T.NTZ).alias("end"),
        F.concat("event_type", F.lit(" "), F.col("event_id").cast("string")).alias("target"),
    )
    return P.targets_by_table(events.select("event_id", "ts"), windows, "ts").select("event_id", "target")


@query(f"""WITH {LONG} SELECT tie, time + INTERVAL 8 HOUR AS plant_time, strftime(time + INTERVAL 8 HOUR, '%Y-%m-%d %I:%M:%S %p') AS text_12h,
date_trunc('second', time + INTERVAL 8 HOUR) AS parsed_12h FROM long""")
def tz_and_12h_text(spark, folder):
    rows = P.in_plant_time(readings(spark, folder), "time")
    parsed = T.parse_time(F.col("GMT_12hr"), T.TWELVE_HOUR)
    return rows.select("tie", F.col("GMT +8").alias("plant_time"), F.col("GMT_12hr").alias("text_12h"), parsed.alias("parsed_12h"))


@query("""SELECT event_id, date_trunc('millisecond', ts) AS time, CAST(value AS DOUBLE) AS reading, event_type AS sensor FROM events""")
def epoch_ms_parse(spark, folder):
    from pyspark.sql import types as S

    events = table(spark, folder, "events")
    message = M.encode([
        F.floor(T.epoch_micros(F.col("ts")) / 1000).alias("timestamp"),
        F.col("event_type").alias("sensor"), F.col("value").alias("reading"),
    ])
    schema = S.StructType([S.StructField("timestamp", S.LongType()), S.StructField("sensor", S.StringType()), S.StructField("reading", S.DoubleType())])
    parsed = M.decode(events.select("event_id", message.alias("value")), schema, keep=("event_id",))
    return parsed.select("event_id", T.from_epoch_millis(F.col("timestamp")).alias("time"), "reading", "sensor")


@query(f"""WITH {LONG} SELECT tie, CASE WHEN tie % 7 = 0 THEN NULL ELSE date_trunc('second', time) END AS time FROM long""")
def iso_fallback_parse(spark, folder):
    time = F.col("time")
    text = (
        F.when(F.col("tie") % 7 == 0, "not a time")
        .when(F.col("tie") % 2 == 0, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(time, "dd/MM/yyyy HH:mm:ss"))
    )
    return readings(spark, folder).select("tie", T.parse_time(text, "dd/MM/yyyy HH:mm:ss").alias("time"))


@query(f"""WITH {LONG} SELECT tie, CASE WHEN tie % 11 = 0 THEN NULL ELSE time END AS time,
CAST(epoch(date_trunc('second', time)) AS BIGINT) AS epoch_s FROM long""")
def parse_timestamps(spark, folder):
    text = F.when(F.col("tie") % 11 == 0, "broken").otherwise(T.iso_text(F.col("time")))
    return readings(spark, folder).select("tie", T.parse_time(text).alias("time"), T.epoch_seconds(F.col("time")).alias("epoch_s"))


@query(f"""WITH {LONG} SELECT tie, strftime(time, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS iso, time AS from_nanos,
'ALERT_' || field || '_' || CAST(CAST(epoch(date_trunc('second', time)) AS BIGINT) AS VARCHAR) AS alert_id,
CASE field WHEN 'click' THEN 'Click Reading' WHEN 'view' THEN 'View Reading' WHEN 'error' THEN 'Error Reading'
WHEN 'signup' THEN 'Signup Reading' ELSE 'Purchase Reading' END AS title,
printf('%d%%', k) AS share FROM long""")
def iso_and_epoch_text(spark, folder):
    time = F.col("time")
    nanos = F.concat(T.epoch_micros(time).cast("string"), F.lit("000"))
    return readings(spark, folder).select(
        "tie",
        T.iso_text(time, "Z").alias("iso"),
        T.from_epoch_nanos(nanos).alias("from_nanos"),
        F.concat(F.lit("ALERT_"), "field", F.lit("_"), T.epoch_seconds(time).cast("string")).alias("alert_id"),
        L.title(F.concat("field", F.lit("_reading"))).alias("title"),
        L.percent_text(F.col("k") / 100, 0).alias("share"),
    )


_CODES = "CASE code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in ATTACK_LABELS.items()) + f" ELSE '{UNKNOWN_ATTACK}' END"
_TYPES = "CASE code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in ATTACK_TYPES.items()) + " END"


@query(f"""WITH {LONG}, coded AS (SELECT k % 10 AS code FROM long)
SELECT code, {_CODES} AS recorded_attack, {_TYPES} AS attack_class, count(*) AS n FROM coded GROUP BY 1, 2, 3""")
def code_lookup_default(spark, folder):
    code = F.col("code")
    return (
        readings(spark, folder).select((F.col("k") % 10).alias("code"))
        .groupBy("code", L.code_text_or(code, ATTACK_LABELS, UNKNOWN_ATTACK).alias("recorded_attack"), L.code_text(code, ATTACK_TYPES).alias("attack_class"))
        .agg(F.count("*").alias("n"))
    )


def normal_and_attack(spark, folder):
    """The two streams as wide training rows."""
    rows = readings(spark, folder).select(
        "tie", "time", "value_num", "unit", "stage", F.hour("time").alias("hour_of_day"), "k", "field"
    )
    normal = rows.where(F.col("field") != "error").drop("field")
    attack = rows.where(F.col("field") == "error").drop("field").withColumn("attack_label", F.col("k") % 8)
    return normal, attack


FEATURES = ["hour_of_day", "k", "stage", "unit", "value_num"]


@query("""SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS "Attack", count(*) AS n FROM events GROUP BY 1""")
def concat_label_distribution(spark, folder):
    return P.class_distribution(P.merged(*normal_and_attack(spark, folder)), "Attack")


_TYPE_OF = "CASE WHEN field <> 'error' THEN 'Normal' ELSE CASE k % 8 " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in ATTACK_LABELS.items()
) + f" ELSE '{UNKNOWN_ATTACK}' END END"
TYPED = LONG + f", typed AS (SELECT *, {_TYPE_OF} AS attack_type FROM long)"


@query(f"""WITH {LONG}, m AS (SELECT avg(value_num) FILTER (WHERE tie % 13 <> 0) AS mean FROM long)
SELECT tie, CASE WHEN field = 'error' THEN 1 ELSE 0 END AS "Attack", CAST(hour(time) AS DOUBLE) AS hour_of_day, CAST(k AS DOUBLE) AS k,
CAST(stage AS DOUBLE) AS stage, CAST(unit AS DOUBLE) AS unit,
round(CASE WHEN tie % 13 = 0 THEN (SELECT mean FROM m) ELSE value_num END, 6) AS value_num FROM long""")
def prepared_binary(spark, folder):
    normal, attack = normal_and_attack(spark, folder)
    rows = P.merged(normal, attack)
    rows = rows.withColumn("value_num", F.when(F.col("tie") % 13 == 0, "bad").otherwise(F.col("value_num").cast("string")))
    features = P.common_features(normal, attack, exclude=["tie"])
    ready = P.imputed(P.numeric_features(rows, features), features)
    return ready.select("tie", "Attack", *features).withColumn("value_num", F.round("value_num", 6))


@query(f"""WITH {TYPED}, codes AS (SELECT attack_type, CAST(row_number() OVER (ORDER BY attack_type) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT attack_type FROM typed))
SELECT attack_type AS "Attack_Type", code AS "Attack_Type_code", count(*) AS n, round(avg(value_num), 6) AS mean_value
FROM typed JOIN codes USING (attack_type) GROUP BY 1, 2""")
def prepared_multiclass(spark, folder):
    rows = P.label_codes(P.merged_with_types(*normal_and_attack(spark, folder)), "Attack_Type")
    return rows.groupBy("Attack_Type", "Attack_Type_code").agg(
        F.count("*").alias("n"), F.round(F.avg("value_num"), 6).alias("mean_value")
    )


@query(f"""WITH {TYPED} SELECT attack_type AS "Attack_Type", CAST(dense_rank() OVER (ORDER BY attack_type) - 1 AS INTEGER) AS "Attack_Type_code", tie FROM typed""")
def label_encode(spark, folder):
    rows = P.label_codes(P.merged_with_types(*normal_and_attack(spark, folder)), "Attack_Type")
    return rows.select("Attack_Type", "Attack_Type_code", "tie")


@query(f"""WITH {TYPED}, sizes AS (SELECT attack_type, count(*) AS n FROM typed GROUP BY 1)
SELECT attack_type AS "Attack_Type", n, round((SELECT sum(n) FROM sizes) / ((SELECT count(*) FROM sizes) * n), 6) AS weight FROM sizes""")
def class_weights(spark, folder):
    weights = P.class_weights(P.merged_with_types(*normal_and_attack(spark, folder)), "Attack_Type")
    return weights.withColumn("weight", F.round("weight", 6))


@query(f"""WITH {LONG}, ranked AS (SELECT tie, field = 'error' AS attack, row_number() OVER (PARTITION BY field = 'error' ORDER BY md5('42:' || CAST(tie AS VARCHAR))) AS p,
count(*) OVER (PARTITION BY field = 'error') AS n FROM long)
SELECT tie, CAST(attack AS INTEGER) AS "Attack", p <= ceil(0.3 * n) AS held_out FROM ranked""")
def stratified_split(spark, folder):
    rows = P.merged(*normal_and_attack(spark, folder)).select("tie", "Attack")
    return X.stratified(rows, "tie", "Attack", classes=2)


@query(f"""WITH {LONG}, ranked AS (SELECT field = 'error' AS attack, row_number() OVER (PARTITION BY field = 'error' ORDER BY md5('42:' || CAST(tie AS VARCHAR))) AS p,
count(*) OVER (PARTITION BY field = 'error') AS n FROM long)
SELECT CAST(attack AS INTEGER) AS "Attack", p <= ceil(0.3 * n) AS held_out, count(*) AS n FROM ranked GROUP BY 1, 2""")
def stratified_split_counts(spark, folder):
    rows = P.merged(*normal_and_attack(spark, folder)).select("tie", "Attack")
    return X.stratified(rows, "tie", "Attack", classes=2).groupBy("Attack", "held_out").agg(F.count("*").alias("n"))


@query(f"""WITH {LONG}, dealt AS (SELECT tie, row_number() OVER (ORDER BY md5('7:' || CAST(tie AS VARCHAR)), tie) AS position FROM long WHERE field <> 'error')
SELECT tie, position, (position - 1) // 1000 AS chunk FROM dealt""")
def seeded_shuffle_chunks(spark, folder):
    normal = readings(spark, folder).where(F.col("field") != "error").select("tie")
    return X.chunked(normal, "tie", 1000, seed=7)


@query("""WITH stats AS (SELECT avg(l_quantity) qm, stddev_pop(l_quantity) qs, avg(l_extendedprice) pm, stddev_pop(l_extendedprice) ps,
avg(l_discount) dm, stddev_pop(l_discount) ds, avg(l_tax) tm, stddev_pop(l_tax) ts FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - qm) / qs, 5) AS l_quantity, round((l_extendedprice - pm) / ps, 5) AS l_extendedprice,
round((l_discount - dm) / ds, 5) AS l_discount, round((l_tax - tm) / ts, 5) AS l_tax FROM lineitem, stats""")
def impute_and_standardise(spark, folder):
    rows = wide_rows(spark, folder)
    training = rows.where(F.col("t_stamp") < T.at("1999-01-01"))
    scaled = standardised(rows, LINE_SENSORS, training)
    return scaled.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.round(c, 5).alias(c) for c in LINE_SENSORS]
    )


@query("""SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature,
unnest([round(avg(l_quantity), 6), round(avg(l_extendedprice), 6), round(avg(l_discount), 6), round(avg(l_tax), 6)]) AS mean,
unnest([round(var_pop(l_quantity), 4), round(var_pop(l_extendedprice), 2), round(var_pop(l_discount), 4), round(var_pop(l_tax), 4)]) AS variance FROM lineitem""")
def wide_baseline(spark, folder):
    stats = wide_statistics(wide_rows(spark, folder), LINE_SENSORS)
    digits = F.when(F.col("feature") == "l_extendedprice", F.round("variance", 2)).otherwise(F.round("variance", 4))
    return stats.select("feature", F.round("mean", 6).alias("mean"), digits.alias("variance"))


@query("""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM ranked WHERE p = 1""")
def dedupe_last_write(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    newest = latest_write(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return newest.drop("l_discount", "l_tax")


@query("""SELECT event_id, ts AS time, event_type AS field, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value_num,
CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k, event_id % 50 = 3 AS malformed FROM events WHERE event_id % 50 <> 3
UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, TRUE FROM events WHERE event_id % 50 = 3""")
def json_roundtrip(spark, folder):
    """Rows to JSON messages and back; every fiftieth message is cut short on the way."""
    from pyspark.sql import types as S

    rows = table(spark, folder, "events").select(
        "event_id",
        M.encode([
            T.iso_text(F.col("ts")).alias("t_stamp"), F.col("event_type").alias("field"),
            F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value_num"),
            F.from_json("props", "k bigint").alias("props"),
        ], keep_nulls=True).alias("message"),
    )
    sent = rows.withColumn("value", F.when(F.col("event_id") % 50 == 3, F.substring("message", 1, 20)).otherwise(F.col("message")))
    schema = S.StructType([
        S.StructField("t_stamp", S.StringType()), S.StructField("field", S.StringType()), S.StructField("value_num", S.DoubleType()),
        S.StructField("props", S.StructType([S.StructField("k", S.LongType())])),
    ])
    read = M.decode(sent, schema, keep=("event_id",))
    broken = F.col("error_message").isNotNull()
    whole = lambda c: F.when(~broken, c)
    return read.select(
        "event_id", whole(T.parse_time(F.col("t_stamp"))).alias("time"), whole(F.col("field")).alias("field"),
        whole(F.col("value_num")).alias("value_num"), whole(F.col("props.k")).alias("k"), broken.alias("malformed"),
    )


@query(f"""WITH {LONG} SELECT tie, CASE WHEN k % 4 = 0 THEN 'unknown' ELSE field END AS status,
CASE WHEN k % 3 = 0 THEN 0.0 ELSE value_num END AS lag_mb FROM long""")
def struct_defaults(spark, folder):
    report = F.struct(
        F.when(F.col("k") % 4 != 0, F.col("field")).alias("status"), F.when(F.col("k") % 3 != 0, F.col("value_num")).alias("lag_mb")
    )
    rows = readings(spark, folder).select("tie", report.alias("report"))
    return rows.select(
        "tie", M.member_or(F.col("report"), "status", "unknown").alias("status"), M.member_or(F.col("report"), "lag_mb", 0.0).alias("lag_mb")
    )


@query(f"""WITH {LONG} SELECT tie, round((CASE WHEN k % 4 = 0 THEN value_num + k ELSE (value_num + k + stage) END) / (CASE WHEN k % 4 = 0 THEN 2 ELSE 3 END), 6) AS avg_pressure,
round(CASE WHEN k % 4 = 0 THEN pow(value_num - k, 2) / 2
ELSE (pow(value_num - (value_num + k + stage) / 3, 2) + pow(k - (value_num + k + stage) / 3, 2) + pow(stage - (value_num + k + stage) / 3, 2)) / 2 END, 6) AS pressure_variance FROM long""")
def rowwise_pressure_stats(spark, folder):
    rows = readings(spark, folder)
    members = [F.col("value_num"), F.col("k").cast("double"), F.when(F.col("k") % 4 != 0, F.col("stage").cast("double"))]
    return rows.select(
        "tie", F.round(N.row_mean(members), 6).alias("avg_pressure"), F.round(N.row_sample_variance(members), 6).alias("pressure_variance")
    )
