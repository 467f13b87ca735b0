"""Column names, declared schemas and the plant's fixed reference values."""

from __future__ import annotations

from pyspark.sql import types as T

MEASUREMENT, TIME, FIELD, NUMBER, TEXT = "measurement", "time", "field", "value_num", "value_str"

# ---------------------------------------------------------------------------
# Raw column name -> readable column name.
# ---------------------------------------------------------------------------
RENAMES = {
    "FIT101.Pv": "FIT 101",
    "LIT101.Pv": "LIT 101",
    "MV101.Status": "MV 101",
    "P1_STATE": "P1_STATE",
    "P101.Status": "P101 Status",
    "P102.Status": "P102 Status",
    "AIT201.Pv": "AIT 201",
    "AIT202.Pv": "AIT 202",
    "AIT203.Pv": "AIT 203",
    "FIT201.Pv": "FIT 201",
    "LS201.Alarm": "LS 201",
    "LS202.Alarm": "LS 202",
    "LSL203.Alarm": "LSL 203",
    "LSLL203.Alarm": "LSLL 203",
    "MV201.Status": "MV201",
    "P2_STATE": "P2_STATE",
    "P201.Status": "P201 Status",
    "P202.Status": "P202 Status",
    "P203.Status": "P203 Status",
    "P204.Status": "P204 Status",
    "P205.Status": "P205 Status",
    "P206.Status": "P206 Status",
    "P207.Status": "P207 Status",
    "P208.Status": "P208 Status",
    "AIT301.Pv": "AIT 301",
    "AIT302.Pv": "AIT 302",
    "AIT303.Pv": "AIT 303",
    "DPIT301.Pv": "DPIT 301",
    "FIT301.Pv": "FIT 301",
    "LIT301.Pv": "LIT 301",
    "MV301.Status": "MV 301",
    "MV302.Status": "MV 302",
    "MV303.Status": "MV 303",
    "MV304.Status": "MV 304",
    "P3_STATE": "P3_STATE",
    "P301.Status": "P301 Status",
    "P302.Status": "P302 Status",
    "AIT401.Pv": "AIT 401",
    "AIT402.Pv": "AIT 402",
    "FIT401.Pv": "FIT 401",
    "LIT401.Pv": "LIT 401",
    "LS401.Alarm": "LS 401",
    "P4_STATE": "P4_STATE",
    "P401.Status": "P401 Status",
    "P402.Status": "P402 Status",
    "P403.Status": "P403 Status",
    "P404.Status": "P404 Status",
    "UV401.Status": "UV401",
    "AIT501.Pv": "AIT 501",
    "AIT502.Pv": "AIT 502",
    "AIT503.Pv": "AIT 503",
    "AIT504.Pv": "AIT 504",
    "FIT501.Pv": "FIT 501",
    "FIT502.Pv": "FIT 502",
    "FIT503.Pv": "FIT 503",
    "FIT504.Pv": "FIT 504",
    "MV501.Status": "MV 501",
    "MV502.Status": "MV 502",
    "MV503.Status": "MV 503",
    "MV504.Status": "MV 504",
    "P5_STATE": "P5_STATE",
    "P501.Status": "P501 Status",
    "P502.Status": "P502 Status",
    "PIT501.Pv": "PIT 501",
    "PIT502.Pv": "PIT 502",
    "PIT503.Pv": "PIT 503",
    "FIT601.Pv": "FIT 601",
    "LSH601.Alarm": "LSH 601",
    "LSL601.Alarm": "LSL 601",
    "LSH602.Alarm": "LSH 602",
    "LSL602.Alarm": "LSL 602",
    "LSH603.Alarm": "LSH 603",
    "LSL603.Alarm": "LSL 603",
    "P6_STATE": "P6_STATE",
    "P601.Status": "P601 Status",
    "P602.Status": "P602 Status",
    "P603.Status": "P603 Status",
}
# Fixed value: another spelling that prepared files use.
OTHER_SPELLINGS = {"P6 STATE": "P6_STATE"}

STATE_TAGS = ["P1_STATE", "P2_STATE", "P3_STATE", "P4_STATE", "P5_STATE", "P6_STATE"]
SENSOR_COLUMNS = [name for name in RENAMES.values() if name not in STATE_TAGS]
ACTUATOR_KINDS = ["P", "MV", "UV"]
POINT_MEASUREMENT = "actuator_data"

# Closed attack intervals (GMT+8) and their targets.
ATTACK_WINDOWS = [
    ("2019-07-20 15:08:46", "2019-07-20 15:10:31", "FIT401"),
    ("2019-07-20 15:15:00", "2019-07-20 15:19:32", "LIT301"),
    ("2019-07-20 15:26:57", "2019-07-20 15:30:48", "P601"),
    ("2019-07-20 15:38:50", "2019-07-20 15:46:20", "multi-point"),
    ("2019-07-20 15:54:00", "2019-07-20 15:56:00", "MV501"),
    ("2019-07-20 16:02:56", "2019-07-20 16:16:18", "P301"),
]

# Attack classes and the five label codes of recorded attacks.
ATTACK_TYPES = {
    0: "NORMAL", 1: "DOS", 2: "NMRI", 3: "CMRI", 4: "SSCP",
    5: "SSMP", 6: "MSCP", 7: "MSMP", 8: "RECON",
}
ATTACK_LABELS = {
    1: "Response_Injection",
    2: "Command_Injection",
    3: "Sensor_Spoofing",
    4: "Actuator_Manipulation",
    5: "Communication_Attack",
}
UNKNOWN_ATTACK = "Unknown_Attack"

# Severity steps on |z|, display text of state codes, threshold steps.
SEVERITY_STEPS = [(2.0, "MODERATE"), (3.0, "HIGH"), (4.0, "CRITICAL")]
SEVERITIES = ["NORMAL", "MODERATE", "HIGH", "CRITICAL"]
STATE_TEXT = {
    "switch": {"0": "OFF", "1": "ON"},
    "valve": {"0": "CLOSED", "1": "OPEN"},
    "alarm": {"0": "NORMAL", "1": "ALARM"},
    "pump": {"0": "STOPPED", "1": "RUNNING"},
}
FLOW_STEPS = [(0, "red"), (10, "green"), (30, "yellow")]
LEVEL_STEPS = [(0, "red"), (20, "yellow"), (40, "green"), (80, "yellow"), (95, "red")]
TANK_STEPS = [(0, "red"), (300, "green"), (700, "yellow")]
GAUGE_STEPS = [(0, "green"), (70, "orange"), (85, "red")]
SEVERITY_LABELS = [
    ('severity="critical"', "Critical"),
    ('severity="high"', "High"),
    ('severity="medium"', "Medium"),
    ('severity="moderate"', "Medium"),
    ('severity="low"', "Low"),
]
DETECTOR_LABELS = [
    ("statistical", "Statistical (Z-Score)"),
    ("rule_based_logic", "Rule-Based Logic"),
    ("rule_based_range", "Range Violations"),
]
VALID_STATES = {0: "off", 1: "starting", 2: "on", 3: "stop"}

# The message pipeline.
NORMAL_TOPIC, ATTACK_TOPIC = "scada.normal", "scada.attacks"
CONSUMERS = {NORMAL_TOPIC: "normal_consumer", ATTACK_TOPIC: "attack_consumer"}
PRODUCERS = {NORMAL_TOPIC: "normal_producer", ATTACK_TOPIC: "attack_producer"}
RETENTION_HOURS = 168
REPLICATION_FACTOR = 1
COMPRESSION_RATIO = 0.75
MB_PER_RECORD = 0.001
BUCKETS = ["normal_data", "attack_data", "anomaly_data", "kafka_analytics", "kafka_analytics_alerts"]
PROBABILITY_THRESHOLD = 0.07

LONG_SCHEMA = T.StructType(
    [T.StructField(MEASUREMENT, T.StringType()), T.StructField(TIME, T.TimestampNTZType())]
    + [T.StructField(tag, T.StringType()) for tag in STATE_TAGS]
    + [
        T.StructField(FIELD, T.StringType()),
        T.StructField(NUMBER, T.DoubleType()),
        T.StructField(TEXT, T.StringType()),
    ]
)

# A message is one wide row; every member arrives as text or number and is typed later.
MESSAGE_SCHEMA = T.StructType(
    [T.StructField("t_stamp", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in RENAMES.values()]
    + [T.StructField("attack_type", T.StringType())]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)
