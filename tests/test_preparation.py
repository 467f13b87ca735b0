"""Labels by interval, reshaping, training sets and splits."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plantwatch.operators import prepare as P
from plantwatch.operators import reshape
from plantwatch.operators import sampling as X
from plantwatch.operators.readings import latest_write
from plantwatch.operators.statistics import standardised
from plantwatch.schema import ATTACK_WINDOWS, RENAMES, SENSOR_COLUMNS, STATE_TAGS

EDGES = [
    ("2019-07-20 15:08:46", 1), ("2019-07-20 15:10:31", 1), ("2019-07-20 15:10:31.000001", 0),
    ("2019-07-20 15:08:45.999999", 0), ("2019-07-20 16:16:18", 1), (None, 0),
]


def test_mapping_covers_the_plant():
    assert len(RENAMES) == 77 and len(SENSOR_COLUMNS) == 71 and len(STATE_TAGS) == 6


def test_renaming_and_unmapped_columns(spark):
    frame = spark.range(1).select(
        F.lit(1.0).alias("FIT101.Pv"), F.lit(2.0).alias("spare"), F.lit("x").alias("t_stamp"), F.lit("2").alias("P6_STATE")
    )
    assert P.renamed(frame).columns == ["FIT 101", "spare", "t_stamp", "P6_STATE"]
    assert P.unmapped_columns(frame) == ["spare"]
    assert [r["column_name"] for r in P.column_catalogue(frame).collect()] == frame.columns


def test_size_and_numeric_columns(rows):
    frame = rows([(1, "a", 1.0), (2, "b", None)], "i int, s string, d double")
    assert tuple(P.size_of(frame).first()) == (2, 3)
    assert P.numeric_columns(frame) == ["i", "d"]


def test_system_columns_are_dropped(spark):
    frame = spark.range(1).select(F.lit(1).alias("_time"), F.lit(1).alias("_start"), F.lit(1).alias("x"))
    assert P.without_system_columns(frame).columns == ["_time", "x"]


def test_interval_edges_are_closed(rows):
    frame = P.labelled(rows([(t,) for t, _ in EDGES], "t timestamp_ntz"), "t")
    assert [r["Attack"] for r in frame.collect()] == [want for _, want in EDGES]


def test_interval_table_equals_interval_list(rows):
    windows = rows(ATTACK_WINDOWS, "start timestamp_ntz, end timestamp_ntz, target string")
    frame = rows([(t,) for t, _ in EDGES], "t timestamp_ntz")
    found = {r["t"]: r["Attack"] for r in P.labelled_by_table(frame, windows, "t").collect()}
    assert list(found[k] for k in sorted(k for k in found if k)) == [0, 1, 1, 0, 1]
    assert found[None] == 0


def test_interval_table_against_brute_force(rows):
    draw = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    at = lambda s: base + dt.timedelta(seconds=s)
    windows = []
    for i in range(60):
        s = draw.randrange(0, 40_000)
        windows.append((at(s), at(s + draw.choice([0, 5, 600, 5000])), f"w{i}"))
    points = [(i, at(draw.choice([draw.randrange(0, 45_000), (windows[i % 60][0] - base).seconds, (windows[i % 60][1] - base).seconds]))) for i in range(400)]
    text = lambda t: t.isoformat(sep=" ")
    wf = rows([(text(s), text(e), w) for s, e, w in windows], "start timestamp_ntz, end timestamp_ntz, target string")
    pf = rows([(i, text(t)) for i, t in points], "id bigint, t timestamp_ntz")
    got = {r["id"]: r["target"] for r in P.targets_by_table(pf, wf, "t", width_seconds=1800).collect()}
    want = {i: min(((s, e, w) for s, e, w in windows if s <= t <= e), default=(0, 0, None))[2] for i, t in points}
    assert got == want
    assert P.labelled_by_table(pf, wf, "t", width_seconds=1800).count() == len(points)


def test_points_and_back(rows):
    wide = rows([("2024-01-01 00:00:00", "2", 1.5, None), ("2024-01-01 00:00:01", "2", None, 7.0)], "t timestamp_ntz, P1_STATE string, a double, b double")
    points = reshape.to_points(wide, "t", ["P1_STATE"], ["a", "b"])
    assert points.count() == 2
    back = reshape.to_rows(points, ["time", "P1_STATE"], ["a", "b"]).orderBy("time").collect()
    assert [tuple(r)[1:] for r in back] == [("2", 1.5, None), ("2", None, 7.0)]


def test_booleans_become_numbers_and_text_stays_text(rows):
    wide = rows([("2024-01-01 00:00:00", True, "Open")], "t timestamp_ntz, flag boolean, note string")
    found = {r["field"]: (r["value_num"], r["value_str"]) for r in reshape.to_points(wide, "t", [], ["flag", "note"]).collect()}
    assert found == {"flag": (1.0, None), "note": (None, "Open")}


def test_merged_types(rows):
    normal = rows([(1.0,)], "x double")
    coded = rows([(2.0, 1), (3.0, 9)], "x double, attack_label int")
    assert [r["Attack_Type"] for r in P.merged_with_types(normal, coded).orderBy("x").collect()] == ["Normal", "Response_Injection", "Unknown_Attack"]
    assert {r["Attack_Type"] for r in P.merged_with_types(normal, normal).collect()} == {"Normal", "Unknown_Attack"}


def test_common_features_skip_time_and_labels(rows):
    left = rows([(1, 2, 3, 4)], "b int, a int, Attack int, t_stamp int")
    right = rows([(1, 2, 3, 4)], "a int, b int, t_stamp int, c int")
    assert P.common_features(left, right) == ["a", "b"]


def test_split_takes_the_exact_share_of_every_class(rows):
    frame = rows([(i, "big") for i in range(97)] + [(1000 + i, "small") for i in range(7)] + [(5000, "single")], "id bigint, y string")
    counts = {(r["y"], r["held_out"]): r["count"] for r in X.stratified(frame, "id", "y").groupBy("y", "held_out").count().collect()}
    assert counts == {("big", True): 30, ("big", False): 67, ("small", True): 3, ("small", False): 4, ("single", True): 1}


def test_shuffle_is_a_permutation_in_whole_chunks(rows):
    frame = rows([(i,) for i in range(105)], "id bigint")
    found = X.chunked(frame, "id", 25).collect()
    assert sorted(r["position"] for r in found) == list(range(1, 106))
    assert sorted({r["chunk"] for r in found}) == [0, 1, 2, 3, 4]
    assert [r["id"] for r in sorted(found, key=lambda r: r["position"])] != list(range(105))


def test_standardising_a_constant_column(rows):
    frame = standardised(rows([(1.0, 5.0), (3.0, 5.0)], "x double, c double"), ["x", "c"])
    assert [tuple(r) for r in frame.orderBy("x").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_replays_do_not_change_the_last_write(rows):
    data = [("a", 1, 10.0), ("a", 2, 20.0), ("b", 1, 5.0)]
    once = latest_write(rows(data, "k string, v int, x double"), ["k"], ["v"])
    again = latest_write(rows(list(reversed(data)) * 3, "k string, v int, x double"), ["k"], ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect())) == [("a", 2, 20.0), ("b", 1, 5.0)]


def test_alignment_adds_missing_features_as_zero(rows):
    frame = rows([("4", None)], "a string, b double")
    assert tuple(frame.select(*reshape.aligned(frame, ["c", "a", "b"])).first()) == (0.0, 4.0, 0.0)


def test_a_null_label_is_split_like_a_class(rows):
    frame = rows([(i, None if i % 10 == 0 else i % 2) for i in range(100)], "id bigint, y int")
    counts = {(r["y"], r["held_out"]): r["count"] for r in X.stratified(frame, "id", "y").groupBy("y", "held_out").count().collect()}
    assert counts == {(None, True): 3, (None, False): 7, (0, True): 12, (0, False): 28, (1, True): 15, (1, False): 35}


def _random_intervals(draw, base):
    at = lambda micros: base + dt.timedelta(microseconds=micros)
    out = []
    for i in range(80):
        s = draw.choice([draw.randrange(-10**9, 10**9), draw.randrange(0, 4 * 10**13)])
        out.append((at(s), at(s + draw.choice([0, 1, 17, 10**6, 3 * 10**9, 2 * 10**13])), f"w{i}"))
    return out + [(out[0][0], out[0][1], "a tie"), (at(10), at(5), "ends before it starts")]


@pytest.mark.parametrize("at_most", [10**6, 0])
def test_intervals_of_any_length_against_brute_force(rows, at_most):
    draw = random.Random(8)
    windows = _random_intervals(draw, dt.datetime(1970, 1, 1))
    times = [draw.choice(windows)[draw.randrange(2)] + dt.timedelta(microseconds=draw.randrange(-2, 3)) for _ in range(500)]
    text = lambda t: t.isoformat(sep=" ")
    wf = rows([(text(s), text(e), w) for s, e, w in windows], "start timestamp_ntz, end timestamp_ntz, target string")
    pf = rows([(i, text(t)) for i, t in enumerate(times)] + [(-1, None)], "id bigint, t timestamp_ntz")
    got = {r["id"]: r["interval"] for r in P.with_interval(pf, wf, "t", at_most=at_most).collect()}
    valid = [w for w in windows if w[0] <= w[1]]
    assert {i: r and (r["start"], r["end"], r["target"]) for i, r in got.items()} == {
        **{i: min((w for w in valid if w[0] <= t <= w[1]), default=None) for i, t in enumerate(times)}, -1: None,
    }


def test_nodes_make_up_their_stretches(rows):
    draw = random.Random(1)
    windows = _random_intervals(draw, dt.datetime(2020, 1, 1))
    wf = rows([(s.isoformat(sep=" "), e.isoformat(sep=" "), w) for s, e, w in windows], "start timestamp_ntz, end timestamp_ntz, target string")
    stretches = P.earliest_stretches(wf).persist()
    spans = sorted((r["low"], r["high"]) for r in stretches.collect())
    assert all(a < b for a, b in spans) and all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
    parts = sorted((r["node"] << 4 * r["level"], (r["node"] + 1) << 4 * r["level"]) for r in P.interval_nodes(stretches).collect())
    assert all(b <= c for (_, b), (c, _) in zip(parts, parts[1:]))
    assert sum(b - a for a, b in parts) == sum(b - a for a, b in spans)


def test_year_long_intervals_are_few_nodes_and_one_instant_moves_no_row(rows, spark):
    windows = rows([(f"{1970 + i}-03-01 00:00:01", f"{1971 + i}-02-01 12:34:56.789", f"y{i}") for i in range(50)], "start timestamp_ntz, end timestamp_ntz, target string")
    assert P.interval_nodes(P.earliest_stretches(windows)).count() < 50 * 330
    crowd = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, F.lit("2001-05-05 00:00:00")).cast("timestamp_ntz").alias("t"))
    found = P.targets_by_table(crowd, windows, "t")
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r["target"], r["count"]) for r in found.groupBy("target").count().collect()} == {("y31", 10_000), (None, 10_000)}
    none = P.labelled_by_table(crowd, windows.limit(0), "t")
    assert none.where("Attack = 0").count() == 20_000 and none.columns == ["id", "t", "Attack"]


def test_a_large_interval_table_is_neither_broadcast_nor_copied_for_the_rows(spark):
    """Copies of the table, estimated by their size before copying, once went to the driver to be broadcast."""
    windows = spark.range(500).select(F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("start"), F.timestamp_seconds(F.col("id") * 60 + 29).cast("timestamp_ntz").alias("end"), F.concat(F.lit("w"), "id").alias("target"))
    frame = spark.range(30_000).select("id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"))
    large = P.with_interval(frame, windows, "t", at_most=0)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "_copy" not in plan and "BroadcastExchange" not in plan and "SortMergeJoin" not in plan
    want = frame.where("id % 60 < 30").select("id", F.expr("concat('w', id div 60)").alias("target"))
    assert large.select("id", "interval.target").where("target IS NOT NULL").exceptAll(want).isEmpty() and large.where("interval IS NOT NULL").count() == 15_000
    assert large.columns == ["id", "t", "interval"] and large.count() == 30_000


@pytest.mark.parametrize("rows_a_slice", [1, 7, 100, 10**6])
def test_slices_of_any_size_against_brute_force(rows, rows_a_slice):
    draw = random.Random(21)
    windows = _random_intervals(draw, dt.datetime(1970, 1, 1))
    times = [draw.choice(windows)[draw.randrange(2)] + dt.timedelta(microseconds=draw.randrange(-2, 3)) for _ in range(300)]
    times += [times[0]] * 300 + [windows[0][0]] * 50 + [None] * 100
    text = lambda t: t and t.isoformat(sep=" ")
    wf = rows([(text(s), text(e), w) for s, e, w in windows], "start timestamp_ntz, end timestamp_ntz, target string")
    pf = rows([(i, text(t), "x") for i, t in enumerate(times)], "id bigint, t timestamp_ntz, `a.b` string")
    found = P.with_stretch(pf, P.earliest_stretches(wf), "t", rows_a_slice)
    assert found.columns == ["id", "t", "a.b", "interval"]
    got = found.collect()
    valid = [w for w in windows if w[0] <= w[1]]
    assert len(got) == len(times)
    assert {r["id"]: r["interval"] and tuple(r["interval"]) for r in got} == {
        i: t and min((w for w in valid if w[0] <= t <= w[1]), default=None) for i, t in enumerate(times)
    }


def test_an_instant_of_many_rows_has_many_slices(spark):
    times = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("m"))
    bounds = P.slice_bounds(times, 1000)
    assert len(bounds) == 31 and 14 <= bounds.count(7) <= 17 and bounds == sorted(bounds)
    first, last = P.slices_of(F.col("m"), F.col("m"), bounds)
    found = times.select("m", first.alias("f"), last.alias("l")).distinct().where("f < l AND m = 7 OR m = 19999").collect()
    assert {(r["m"], r["l"] - r["f"]) for r in found} == {(7, bounds.count(7)), (19_999, 0)}
    none = times.select(F.lit(None).cast("bigint").alias("m"))
    assert P.slice_bounds(none, 1000) == [0] * 31 and P.slice_bounds(none.limit(0)) == []


def test_nodes_are_counted_without_making_them(rows):
    windows = _random_intervals(random.Random(3), dt.datetime(2020, 1, 1))
    wf = rows([(s.isoformat(sep=" "), e.isoformat(sep=" "), w) for s, e, w in windows], "start timestamp_ntz, end timestamp_ntz, target string")
    stretches = P.earliest_stretches(wf).persist()
    want = {r["level"]: r["count"] for r in P.interval_nodes(stretches).groupBy("level").count().collect()}
    assert P.node_counts(stretches) == want
    assert P.node_counts(stretches.limit(0)) == {}
    assert {r["level"] for r in P.interval_nodes(stretches, [2, 5]).collect()} == {2, 5}


def test_labels_by_a_table_too_large_to_broadcast(spark):
    micros = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    low, high = F.col("id") * 2_000_000_000 + 1_234_567, F.col("id") * 2_000_000_000 + 1_201_234_567
    windows = spark.range(2500).select(micros(low).alias("start"), micros(high).alias("end"))
    assert sum(P.node_counts(P.earliest_stretches(windows)).values()) > P.INTERVAL_NODES
    frame = spark.range(50_000).select("id", micros(F.col("id") * 100_000_000).alias("t"))
    found = P.labelled_by_table(frame, windows, "t")
    assert "_copy" not in found._jdf.queryExecution().executedPlan().toString()
    want = F.expr("id * 100000000 % 2000000000 BETWEEN 1234567 AND 1201234567").cast("int")
    assert found.columns == ["id", "t", "Attack"] and found.where(F.col("Attack") == want).count() == found.count() == 50_000
