"""Baselines, rules, explanations, attack classes and commands on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from plantwatch.operators import commands as C
from plantwatch.operators import explain as E
from plantwatch.operators import rules as U
from plantwatch.operators import statistics as S
from plantwatch.operators import taxonomy as X
from plantwatch.operators.rules import Rule


def test_baseline_uses_the_population_and_skips_nan(rows):
    frame = rows([("f", 1.0), ("f", 3.0), ("f", float("nan")), ("f", None), ("one", 5.0)], "field string, value_num double")
    found = {r["field"]: (r["mean"], r["std"]) for r in S.baseline(frame).collect()}
    assert found == {"f": (2.0, 1.0), "one": (5.0, 0.0)}


def test_labels_of_constant_missing_and_extreme_values(rows):
    data = [("const", 5.0)] * 4 + [("f", 0.0)] * 30 + [("f", 100.0), ("f", None)]
    labels = S.feature_labels(rows(data, "field string, value_num double"), ["const", "f"], 3.0)
    found = {(r["field"], r["value_num"]): r["y"] for r in labels.collect()}
    assert found == {("const", 5.0): 0, ("f", 0.0): 0, ("f", 100.0): 1, ("f", None): None}
    rates = {r["field"]: r["anomaly_rate"] for r in S.anomaly_rates(labels).collect()}
    assert rates == {"const": 0.0, "f": pytest.approx(1 / 31)}


def test_gate_is_exclusive(rows):
    rates = rows([("a", 0.01), ("b", 0.5), ("c", 0.011), ("d", 0.499), ("e", 0.0)], "field string, anomaly_rate double")
    assert sorted(r["field"] for r in S.gated(rates).collect()) == ["c", "d"]
    assert [r["field"] for r in S.most_anomalous(rates, 2).collect()] == ["b", "d"]


RULES = [Rule("t", low=-10, high=100), Rule("tank", low=0, high=1000, low_critical=200, high_critical=900), Rule("pump", states=U.PUMP_STATES)]


@pytest.mark.parametrize(
    "field, value, broken, zone, invalid",
    [
        ("t", -10.0, False, None, False), ("t", -10.1, True, None, False), ("t", 100.1, True, None, False),
        ("tank", 200.0, False, "CRITICAL_LOW", False), ("tank", 900.0, False, "CRITICAL_HIGH", False),
        ("tank", 500.0, False, None, False), ("tank", 1000.5, True, None, False),
        ("pump", 3.0, False, None, False), ("pump", 4.0, False, None, True),
        ("other", 1e9, False, None, False), ("t", float("nan"), False, None, False), ("t", None, False, None, False),
    ],
)
def test_rules(rows, field, value, broken, zone, invalid):
    f, v = F.col("field"), F.col("v")
    frame = rows([(field, value)], "field string, v double")
    found = frame.select(U.limit_violated(f, v, RULES), U.critical_zone(f, v, RULES), U.state_violated(f, v.try_cast("int"), RULES)).first()
    assert tuple(found) == (broken, zone, invalid)


def test_findings_give_one_row_per_detector(rows):
    frame = rows([(1, 5.0), (2, 50.0)], "id int, v double")
    found = U.findings(frame, ["id"], {"a": (F.col("v") > 1, F.lit("HIGH")), "b": (F.col("v") > 10, F.lit("CRITICAL"))}).collect()
    assert sorted(map(tuple, found)) == [(1, "a", "HIGH"), (2, "a", "HIGH"), (2, "b", "CRITICAL")]


def explained(rows, **options):
    frame = rows([([0.0, 0.0, 0.0],), ([4.0, -4.0, 4.0],)], "v array<double>")
    stats = E.vector_statistics(frame, "v", 3)
    return E.top_contributors(frame, "v", ["b", "c", "a"], stats, 2, **options).collect()


def test_contributors_are_ordered_and_ties_go_by_name(rows):
    top = explained(rows)[1]["contributors"]
    assert [c["feature"] for c in top] == ["a", "b"]
    assert top[0]["z_score"] == pytest.approx(1.0, abs=1e-6) and top[0]["deviation"] == pytest.approx(1.0, abs=1e-6)


def test_legacy_scaling_scales_twice(rows):
    top = {c["feature"]: c["z_score"] for c in explained(rows, legacy_double_scaling=True)[1]["contributors"]}
    # mean 2 and std 2 give z = 1, scaled again (1 - 2) / 2
    assert top["b"] == pytest.approx(-0.5, abs=1e-6)


def test_contributor_columns_name_directions(rows):
    frame = rows([([4.0, -2.0],), ([0.0, 0.0],)], "v array<double>")
    found = E.contributor_columns(E.top_contributors(frame, "v", ["x", "y"], E.vector_statistics(frame, "v", 2)), 3).collect()[0]
    assert (found["contributor_1_direction"], found["top_contributor_3"]) == ("high", None)


SENSORS = [("FIT", s) for s in range(1, 7)] + [("LIT", s) for s in range(1, 7)] + [("AIT", 1), ("PIT", 1)]


def window_of(rows, hits, actuators=(), frozen=False, gap=30, level="HIGH"):
    """One minute of readings: every sensor twice, given (kind, stage) pairs anomalous, given actuator states."""
    data = []
    for kind, stage in SENSORS:
        hot = (kind, stage) in hits
        at = hits.index((kind, stage)) * gap % 60 if hot else 0
        for i, value in enumerate((1.0, 1.0 if frozen else 2.0)):
            data.append((f"2024-01-01 00:00:{at if i == 0 else 59:02d}", f"{kind} {stage}01", kind, stage, False, value, level if hot and i == 0 else "NORMAL", None, False))
    for n, states in enumerate(actuators):
        for i, state in enumerate(states):
            data.append((f"2024-01-01 00:00:{i:02d}", f"P{n + 1}01 Status", "P", n % 6 + 1, True, float(state), "NORMAL", state, state > 3))
    return rows(data, "time timestamp_ntz, field string, kind string, stage int, is_actuator boolean, value_num double, severity string, state_code int, state_invalid boolean")


@pytest.mark.parametrize(
    "name, hits, options",
    [
        ("NORMAL", [], {}),
        ("DOS", [], {"frozen": True}),
        ("RECON", [("FIT", i) for i in range(1, 6)], {"gap": 10, "level": "MODERATE"}),
        ("MSMP", [("FIT", i) for i in range(1, 6)], {"gap": 11, "level": "MODERATE"}),
        ("MSMP", [("FIT", i) for i in range(1, 6)], {"gap": 1}),
        ("MSCP", [("FIT", 1), ("FIT", 2)], {}),
        ("SSMP", [("FIT", 1), ("LIT", 1), ("AIT", 1)], {}),
        ("SSCP", [("FIT", 1)], {}),
        ("UNKNOWN_ATTACK", [("FIT", 1), ("LIT", 2)], {}),
        ("CMRI", [], {"actuators": [(0, 2), (2, 0), (1, 2)]}),
        ("NMRI", [], {"actuators": [(5, 5)]}),
        ("NORMAL", [], {"actuators": [(0, 2)]}),
        ("UNKNOWN_ATTACK", [], {"actuators": [(5,), (5,), (5,)]}),
    ],
)
def test_attack_classes(rows, name, hits, options):
    found = X.attack_classes(window_of(rows, hits, **options)).collect()
    assert [r["attack_class"] for r in found] == [name]


def test_layers_combine_to_the_highest_severity(rows):
    frame = rows([(1, True, True), (2, True, False), (3, False, False)], "id int, a boolean, b boolean")
    fired = X.fired_layers({"rules": (F.col("a"), F.lit("HIGH")), "model": (F.col("b"), F.lit("CRITICAL"))})
    found = X.combined(frame, fired).select("id", "verdict", "detectors").collect()
    assert sorted(map(tuple, found)) == [(1, "CRITICAL", "model,rules"), (2, "HIGH", "rules")]


def test_commands_are_checked_and_emergency_stops_reach_every_actuator(rows):
    frame = rows(
        [(1, "MV101", "OPEN", " ann ", "test"), (2, "P101", "ON", "  ", "x"), (3, "P101", "ON", "bob", None), (4, "ALL", "STOP", "eve", "leak")],
        "id int, actuator_id string, action string, operator string, reason string",
    )
    found = C.audited(frame).collect()
    single = {r["id"]: (r["operator"], r["rejected"]) for r in found if r["id"] < 4}
    assert single == {1: ("ann", None), 2: ("", "operator is required"), 3: ("bob", "reason is required")}
    stopped = {r["actuator_id"]: r["action"] for r in found if r["id"] == 4}
    assert set(stopped) == set(C.ACTUATORS) and stopped["MV101"] == "CLOSE" and stopped["P101"] == "OFF"


def test_alert_ids_restart_each_day(rows):
    frame = rows([("2024-01-01 00:00:01", 1), ("2024-01-01 05:00:00", 2), ("2024-01-02 00:00:00", 3)], "time timestamp_ntz, tie bigint")
    found = {r["tie"]: r["alert_id"] for r in C.sequential_ids(frame, "time", "tie").collect()}
    assert found == {1: "ALERT_000001", 2: "ALERT_000002", 3: "ALERT_000001"}


def test_undeclared_and_missing_fields_are_scored(spark):
    from plantwatch.operators import statistics as S
    from plantwatch.schema import FIELD, NUMBER

    table = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("sixth", 2.0), (None, 4.0), (None, 6.0)], f"{FIELD} string, {NUMBER} double")
    got = sorted(((r[FIELD] or "", r[NUMBER], r["mean"]) for r in S.scored(table, fields=["a"]).collect()))
    assert got == [("", 4.0, 5.0), ("", 6.0, 5.0), ("a", 1.0, 2.0), ("a", 3.0, 2.0), ("sixth", 2.0, 2.0)]


@pytest.fixture(scope="module")
def more_types(spark, folder, tmp_path_factory):
    """Two folders of events, one time a week, with a sixth type and a missing one, which the second folder calls '~'."""
    out = tmp_path_factory.mktemp("types")
    kind = F.when(F.col("event_id") % 3 == 0, "sixth").when(F.col("event_id") % 4 != 0, F.col("event_type"))
    events = spark.read.parquet(f"{folder}/events.parquet").withColumns({"event_type": kind, "ts": F.date_trunc("week", "ts").cast("timestamp_ntz")})
    for name, frame in (("nulls", events), ("named", events.fillna("~", ["event_type"]))):
        frame.coalesce(1).write.parquet(f"{out}/{name}/events.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["severity_by_day", "percent_band", "sensor_correlation_alert"])
def test_queries_keep_undeclared_and_missing_types(spark, more_types, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{more_types}/named/events.parquet/*.parquet'")
    frame = entry.queries()[name](spark, f"{more_types}/nulls")
    columns = [c for c in frame.columns if c != "fields"]  # the text leaves a missing name out
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    got = frame.fillna("~", ["field"]) if "field" in columns else frame
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)
    if "fields" in frame.columns:
        assert frame.where("fields like '%sixth%'").count() > 0 and frame.where("n_fields > size(split(fields, ','))").count() > 0


def test_isolation_scores_keep_undeclared_and_missing_types(spark, more_types):
    import __spark_entry__ as entry

    events = spark.read.parquet(f"{more_types}/nulls/events.parquet")
    found = entry.queries()["iforest_scores"](spark, f"{more_types}/nulls").persist()
    count = lambda frame, column: {tuple(r) for r in frame.groupBy(column).count().collect()}
    assert count(found, "field") == count(events, "event_type")
    assert found.where("value_num is not null and (outlier_score is null or is_outlier is null)").count() == 0
    assert {r["field"] for r in found.where("is_outlier = 1").select("field").distinct().collect()} >= {None, "sixth"}
    found.unpersist()
