"""Scalar functions at their boundary values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantwatch.functions import labels as L
from plantwatch.functions import messages as M
from plantwatch.functions import numbers as N
from plantwatch.functions import times as T
from plantwatch.schema import FLOW_STEPS, GAUGE_STEPS, LEVEL_STEPS, SEVERITY_LABELS


def one(frame, column):
    return [r[0] for r in frame.select(column).collect()]


def test_text_to_number(rows):
    frame = rows([("1.5",), (" 2 ",), ("n/a",), (None,), ("NaN",), ("1.5d",), ("2f",), ("1e3",), ("true",), ("",)], "x string")
    assert one(frame, N.to_number(F.col("x"))) == [1.5, 2.0, None, None, None, None, None, 1000.0, None, None]


@pytest.mark.parametrize("z, band", [(0.0, "NORMAL"), (2.0, "NORMAL"), (2.0001, "MODERATE"), (-3.0, "MODERATE"), (3.1, "HIGH"), (4.0, "HIGH"), (-4.1, "CRITICAL"), (None, "NORMAL"), (float("nan"), "NORMAL")])
def test_severity_steps_are_exclusive(rows, z, band):
    assert one(rows([(z,)], "z double"), L.severity(F.col("z"))) == [band]


def test_bands(rows):
    frame = rows([(-1.0,), (0.0,), (9.9,), (10.0,), (30.0,), (95.0,), (None,)], "v double")
    assert one(frame, L.band(F.col("v"), FLOW_STEPS)) == [None, "red", "red", "green", "yellow", "yellow", None]
    assert one(frame, L.band(F.col("v"), LEVEL_STEPS)) == [None, "red", "red", "red", "yellow", "red", None]


def test_percent_band_of_constant_range(rows):
    frame = rows([(1.75, 0.0, 2.5), (2.125, 0.0, 2.5), (1.0, 1.0, 1.0)], "v double, low double, high double")
    assert one(frame, L.percent_band(F.col("v"), F.col("low"), F.col("high"), GAUGE_STEPS)) == ["orange", "red", "green"]


def test_words(rows):
    frame = rows([("alerts{severity=\"high\"}", "pump", "1"), ("plain", "alarm", "7")], "t string, kind string, code string")
    assert one(frame, L.relabel(F.col("t"), SEVERITY_LABELS)) == ["High", "plain"]
    assert one(frame, L.state_text(F.col("kind"), F.col("code"))) == ["RUNNING", "7"]
    assert one(frame, L.title(F.lit("isolation_forest"))) == ["Isolation Forest"] * 2


def test_sensor_names(rows):
    frame = rows([("FIT 101",), ("MV201",), ("P101 Status",), ("LSLL 203",)], "f string")
    assert one(frame, L.sensor_kind(F.col("f"))) == ["FIT", "MV", "P", "LSLL"]
    assert one(frame, L.sensor_stage(F.col("f"))) == [1, 2, 1, 2]


def test_times(rows):
    frame = rows([("2019-07-20 07:08:46.5",)], "t timestamp_ntz")
    t = F.col("t")
    assert one(frame, T.to_plant_zone(t)) == [dt.datetime(2019, 7, 20, 15, 8, 46, 500000)]
    assert one(frame, T.twelve_hour_text(T.to_plant_zone(t))) == ["2019-07-20 03:08:46 PM"]
    assert one(frame, T.iso_text(t, "Z")) == ["2019-07-20T07:08:46.500000Z"]
    assert one(frame, T.epoch_seconds(t)) == [1563606526]


def test_time_parsing(rows):
    frame = rows([("2020-06-22T01:02:03",), ("2020-06-22 01:02:03",), ("22/06/2020 01:02:03",), ("never",), (None,)], "x string")
    at = dt.datetime(2020, 6, 22, 1, 2, 3)
    assert one(frame, T.parse_time(F.col("x"), "dd/MM/yyyy HH:mm:ss")) == [at, at, at, None, None]


def test_epoch_text(rows):
    frame = rows([("1574649591000000000",), ("1574649591123456789",), ("x",)], "x string")
    assert one(frame, T.from_epoch_nanos(F.col("x"))) == [dt.datetime(2019, 11, 25, 2, 39, 51), dt.datetime(2019, 11, 25, 2, 39, 51, 123456), None]


def test_spans(spark):
    frame = spark.range(1).select(F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("t"))
    assert one(frame, (F.col("t") - T.span("60")).cast("timestamp_ntz")) == [dt.datetime(2024, 1, 1, 23, 59)]
    assert one(frame, (F.col("t") - T.span("24 HOURS")).cast("timestamp_ntz")) == [dt.datetime(2024, 1, 1)]


def test_documented_pressure_row(rows):
    frame = rows([(100.5, 98.2, None), (100.5, None, None), (None, None, None)], "a double, b double, c double")
    members = [F.col("a"), F.col("b"), F.col("c")]
    assert one(frame, F.round(N.row_mean(members), 6)) == [99.35, 100.5, None]
    assert one(frame, F.round(N.row_sample_variance(members), 6)) == [2.645, None, None]


def test_clamping(rows):
    frame = rows([(-5,), (0,), (30,)], "lag bigint")
    assert one(frame, N.at_least_zero(F.col("lag"))) == [0, 0, 30]
    assert one(frame, N.lag_megabytes(F.col("lag"))) == [0.0, 0.0, 0.03]


def test_broken_json_keeps_its_error(rows):
    from pyspark.sql import types as S

    schema = S.StructType([S.StructField("a", S.LongType())])
    found = M.decode(rows([('{"a": 1}',), ('{"a": ',)], "value string"), schema).collect()
    assert [tuple(r) for r in found] == [(1, None), (None, '{"a": ')]


def test_numeric_members(rows):
    frame = rows([('{"a": 1, "b": "x", "c": 2.5}',)], "value string")
    members = F.from_json("value", "map<string,string>")
    assert one(frame, M.numeric_members(members)) == [{"a": 1.0, "c": 2.5}]
