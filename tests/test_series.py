"""Order-sensitive operators against plain Python, with slices cut in awkward places."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plantwatch.operators import readings as R
from plantwatch.operators.joins import lookup
from plantwatch.operators.ordered import numbered, running_total, runs, time_slice, with_previous

BASE = dt.datetime(2024, 1, 1)


def series(seed, n=200, units=("a", "b")):
    """Rows of which one unit has most; gaps from none to several hours."""
    draw = random.Random(seed)
    out, clock = [], {u: 0 for u in units}
    for i in range(n):
        unit = units[0] if draw.random() < 0.8 else draw.choice(units[1:])
        clock[unit] += draw.choice([0, 1, 60, 900, 1800, 1801, 4000, 9000])
        out.append((unit, (BASE + dt.timedelta(seconds=clock[unit])).isoformat(sep=" "), i, draw.choice(["x", "y"]), float(i % 7)))
    draw.shuffle(out)
    return out


SCHEMA = "unit string, time timestamp_ntz, tie bigint, state string, v double"


@pytest.mark.parametrize("width", [60, 3600, 86400])
def test_previous_row_crosses_slices(rows, width):
    data = series(1)
    got = {r["tie"]: r["before"] for r in with_previous(rows(data, SCHEMA), ["unit"], ["time", "tie"], F.col("state"), "before", width).collect()}
    want = {}
    for unit in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == unit), key=lambda r: (r[1], r[2]))
        want.update({b[2]: a[3] for a, b in zip(mine, mine[1:])})
        want[mine[0][2]] = None
    assert got == want


def expected_runs(data, breaks):
    out = []
    for unit in sorted({r[0] for r in data}):
        mine = sorted((r for r in data if r[0] == unit), key=lambda r: (r[1], r[2]))
        group = []
        for row in mine:
            if group and breaks(group[-1], row):
                out.append(group)
                group = []
            group.append(row)
        out.append(group)
    return sorted((g[0][0], g[0][1], g[-1][1], len(g), sum(r[4] for r in g)) for g in out)


def as_tuples(frame):
    return sorted(
        (r["unit"], r["run_start"].isoformat(sep=" "), r["run_end"].isoformat(sep=" "), r["run_rows"], r["run_total"]) for r in frame.collect()
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("width", [600, 3600])
def test_sessions_match_a_plain_scan(rows, seed, width):
    data = series(seed)
    gap = F.expr("INTERVAL 30 MINUTES")
    found = runs(rows(data, SCHEMA), ["unit"], "time", "tie", lambda a, b: b["time"] >= a["time"] + gap, total=F.col("v"), width=width)
    late = lambda a, b: dt.datetime.fromisoformat(b[1]) - dt.datetime.fromisoformat(a[1]) >= dt.timedelta(minutes=30)
    assert as_tuples(found) == expected_runs(data, late)


def test_a_session_that_spans_many_slices_stays_whole(rows):
    data = [("a", (BASE + dt.timedelta(seconds=60 * i)).isoformat(sep=" "), i, "x", 1.0) for i in range(300)]
    gap = F.expr("INTERVAL 30 MINUTES")
    found = runs(rows(data, SCHEMA), ["unit"], "time", "tie", lambda a, b: b["time"] >= a["time"] + gap, total=F.col("v"), width=600).collect()
    assert [(r["run_rows"], r["run_total"]) for r in found] == [(300, 300.0)]


def test_numbering_across_slices(rows):
    data = series(4)
    got = {r["tie"]: r["n"] for r in numbered(rows(data, SCHEMA), ["unit"], time_slice("time", 600), ["time", "tie"], "n").collect()}
    for unit in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == unit), key=lambda r: (r[1], r[2]))
        assert [got[r[2]] for r in mine] == list(range(1, len(mine) + 1))


def test_running_total_across_slices(rows):
    frame = rows([(i, float(i % 3)) for i in range(100)], "i bigint, v double")
    got = {r["i"]: r["t"] for r in running_total(frame, F.floor(F.col("i") / 7), ["i"], F.col("v"), "t").collect()}
    total = 0.0
    for i in range(100):
        total += i % 3
        assert got[i] == total


@pytest.mark.parametrize("bound", [None, 2])
def test_lookup_neither_loses_nor_repeats_rows(rows, bound):
    facts = rows([("hot", i) for i in range(300)] + [("cold", 1000), ("absent", 1001)], "k string, i bigint")
    names = rows([("hot", 1.0), ("cold", 2.0)], "k string, m double")
    found = lookup(facts, names, ["k"], at_most=bound).collect()
    assert len(found) == 302
    assert {(r["k"], r["m"]) for r in found} == {("hot", 1.0), ("cold", 2.0), ("absent", None)}


def test_latest_per_series_with_and_without_ties(rows):
    frame = rows(
        [("f", "2024-01-01 00:00:00", 1, 1.0), ("f", "2024-01-02 00:00:00", 2, None), ("f", "2024-01-02 00:00:00", 3, 3.0), ("g", "2024-01-01 00:00:00", 4, None)],
        "field string, time timestamp_ntz, tie bigint, value_num double",
    )
    assert {(r["field"], r["value_num"]) for r in R.last(frame, ["field"], "tie").collect()} == {("f", 3.0), ("g", None)}
    assert {(r["field"], r["value_num"]) for r in R.last_known(frame, ["field"], "tie").collect()} == {("f", 3.0)}
    assert [r["value_num"] for r in R.last(frame.where("tie < 3 and field = 'f'"), []).collect()] == [None]


def test_range_is_half_open_and_relative_range_is_closed(rows):
    frame = rows([("2024-01-01 00:00:00",), ("2024-01-01 01:00:00",), ("2024-01-02 00:00:00",)], "time timestamp_ntz")
    assert R.in_range(frame, "2024-01-01 00:00:00", "2024-01-02 00:00:00").count() == 2
    assert R.since(frame, "1 DAY", R.latest_time(frame)).count() == 3
    assert R.since(frame, "60", R.latest_time(frame)).count() == 1


def test_rows_without_series_or_time_are_kept(rows):
    data = [("a", "2024-01-01 00:00:00", 1, "x", 1.0), (None, "2024-01-01 00:00:00", 2, "x", 2.0), (None, "2024-01-01 05:00:00", 3, "x", 3.0), ("a", None, 4, "y", 4.0), (None, None, 5, "x", 5.0)]
    frame = rows(data, SCHEMA)
    placed = numbered(frame, ["unit"], time_slice("time", 600), ["time", "tie"], "n").collect()
    assert {r["tie"]: r["n"] for r in placed} == {4: 1, 1: 2, 5: 1, 2: 2, 3: 3}
    before = with_previous(frame, ["unit"], ["time", "tie"], F.col("tie"), "before", 600).collect()
    assert {r["tie"]: r["before"] for r in before} == {4: None, 1: 4, 5: None, 2: 5, 3: 2}
    found = runs(frame, ["unit"], "time", "tie", lambda a, b: a["state"] != b["state"], state=F.col("state"), total=F.col("v"), width=600)
    assert sorted((r["unit"] or "", r["run_rows"], r["run_total"], r["run_state"]) for r in found.collect()) == [("", 3, 10.0, "x"), ("a", 1, 1.0, "x"), ("a", 1, 4.0, "y")]


def test_runs_that_start_together_stay_apart(rows):
    data = [("a", "2024-01-01 00:00:00", i, state, 1.0) for i, state in enumerate("xyx")]
    found = runs(rows(data, SCHEMA), ["unit"], "time", "tie", lambda a, b: a["state"] != b["state"], state=F.col("state"))
    assert sorted((r["run_state"], r["run_rows"]) for r in found.collect()) == [("x", 1), ("x", 1), ("y", 1)]


def test_sliding_windows_whose_slide_does_not_divide_them(rows):
    frame = rows([(f"2024-01-01 00:{m:02d}:{s:02d}", 1.0) for m in range(4) for s in (5, 31, 50)], "time timestamp_ntz, value_num double")
    want = frame.groupBy(F.window("time", "1 minute", "25 seconds").alias("w")).agg(F.count("*").alias("n"))
    found = R.windowed(frame, "1 minute", slide="25 seconds")
    assert {(r["window_start"], r["n"]) for r in found.collect()} == {(r["w"]["start"], r["n"]) for r in want.collect()}
