"""Step-function models: their application, one-run training, stored cuts and the model table."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantwatch.learning import isolation, steps
from plantwatch.learning.detector import Detector, forest
from plantwatch.learning.training import feature_models, feature_summary
from plantwatch.operators import statistics as S
from plantwatch.operators.joins import lookup

LONG = "id long, field string, value_num double"


def planted(spark, fields, n=400):
    """Every twentieth reading of a field lies far out, on either side."""
    draw = random.Random(4)
    data = [(f, draw.gauss(i, 1 + i) if j % 20 else i + (15.0 + i * 15) * (-1) ** j) for i, f in enumerate(fields) for j in range(n)]
    return spark.createDataFrame([(k, f, v) for k, (f, v) in enumerate(data)], LONG)


def model_rows(rng):
    out = []
    for field, mean, deviation in (("a", 0.0, 1.0), (None, 500.0, 0.25), ("b", -3.0, 40.0)):
        functions = []
        for name, n in (("one", 3), ("two", 900), ("none", 0)):
            cuts = np.sort(mean + deviation * rng.standard_normal(n) * 6)
            functions.append({"name": name, "cuts": cuts.tolist(), "values": rng.random(n + 1).tolist(), "cut": 0.5})
        out.append({"field": field, "mean": mean, "deviation": deviation, "n": 1, "functions": functions})
    return out


def test_results_equal_binary_search(spark, monkeypatch):
    rng = np.random.default_rng(3)
    known = model_rows(rng)
    models = spark.createDataFrame(known, steps.MODEL_DDL)
    data, number = [], 0
    for m in known:
        values = (m["mean"] + m["deviation"] * rng.standard_normal(200) * 7).tolist()
        values += [c for f in m["functions"] for c in f["cuts"][:40]] + [float("inf"), float("-inf"), 1e300, float("nan"), None]
        data += [(number + i, m["field"], v, "x", 1.0) for i, v in enumerate(values)]
        number = len(data)
    data += [(number, "unknown", 1.0, "x", 1.0)]
    readings = spark.createDataFrame(data, LONG + ", model string, mean double").repartition(3)
    of = {m["field"]: m["functions"] for m in known}
    for broadcast in (steps.BROADCAST_CUTS, 0):
        monkeypatch.setattr(steps, "BROADCAST_CUTS", broadcast)
        got = {r["id"]: r for r in steps.applied(readings, models).collect()}
        assert len(got) == len(data)
        for i, field, v, *_ in data:
            r = got[i]["results"]
            if field not in of or v is None or v != v:
                assert r is None
            else:
                want = [f["values"][int(np.searchsorted(f["cuts"], v, "left"))] for f in of[field]]
                assert [(x["name"], x["result"], x["predicted"]) for x in r] == [(f["name"], w, int(w >= 0.5)) for f, w in zip(of[field], want)]


def test_one_run_trains_as_well_as_a_forest_of_its_own(spark):
    frame = planted(spark, ["a", "b", "c"])
    labels = S.feature_labels(frame, ["a", "b", "c"], 2.5).persist()
    _, predictions = feature_models(labels, S.anomaly_rates(labels), None, "id", trees=20, depth=5)
    summary = {(r["field"], r["model"]): r["accuracy"] for r in feature_summary(predictions).collect()}
    assert set(summary) == {(f, m) for f in "abc" for m in ("random_forest", "isolation_forest")}
    held = {r["id"] for r in predictions.select("id").distinct().collect()}
    for field in "abc":
        own = labels.where(F.col("field") == field)
        single = Detector.fit(own.where(~F.col("id").isin(held)), ["value_num"], "y", forest(20, 5, 1), key="id")
        right = single.transform(own.where(F.col("id").isin(held))).agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]
        assert summary[field, "random_forest"] >= right - 0.01
    assert min(summary.values()) > 0.9


def test_plan_and_jobs_do_not_grow_with_fields(spark):
    tracker, runs = spark.sparkContext.statusTracker(), []
    for n in (2, 30):
        names = [f"f{i}" for i in range(n)]
        labels = S.feature_labels(planted(spark, names, 60), names, 2.5).persist()
        rates = S.anomaly_rates(labels)
        spark.sparkContext.setJobGroup(f"fit {n}", "")
        models, predictions = feature_models(labels, rates, None, "id", trees=3, isolation_trees=5)
        runs.append((len(tracker.getJobIdsForGroup(f"fit {n}")), predictions._jdf.queryExecution().executedPlan().toString().count("Exchange")))
        assert models.count() == n
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert runs[0][1] == runs[1][1] and abs(runs[0][0] - runs[1][0]) <= 5


def test_histograms_count_every_labelled_reading(spark):
    frame = planted(spark, ["a", "b"]).unionByName(spark.createDataFrame([(9001, None, 4.0), (9002, "a", None), (9003, None, 4.0)], LONG))
    labels = frame.withColumn("y", (F.abs("value_num") > 5).cast("int"))
    scales = steps.scales_of(labels).persist()
    counted = {r["field"]: r["bins"] for r in steps.histograms(labels, scales).collect()}
    cuts = {r["field"]: r["cuts"] for r in scales.collect()}
    rows = [r for r in labels.collect() if r["y"] is not None]
    for field, bins in counted.items():
        want = {}
        for r in rows:
            if r["field"] == field:
                at = int(np.searchsorted(cuts[field], r["value_num"], "left")), r["y"]
                want[at] = want.get(at, 0) + 1
        assert {(b["bin"], b["label"]): b["n"] for b in bins} == want
    assert set(counted) == {"a", "b", None}


def test_a_tree_cuts_where_the_label_changes():
    counts = np.zeros((10, 2))
    counts[:, 0], counts[[0, 8, 9], :] = 20, [0, 10]
    assert steps.grown(counts, 5, 1).tolist() == [1.0, *[0.0] * 7, 1.0, 1.0]
    assert steps.grown(counts, 0, 1).tolist() == [30 / 170] * 10
    assert steps.grown(np.array([[5.0, 0.0]]), 3, 1).tolist() == [0.0]


def outliers(spark):
    frame = planted(spark, ["a", "b"]).unionByName(spark.createDataFrame([(9000 + i, None, float(i % 7)) for i in range(70)], LONG))
    rates = spark.createDataFrame([("a", 0.05), ("b", 0.05)], "field string, anomaly_rate double")
    scales = steps.scales_of(frame).persist()
    found = steps.outlier_functions(frame, scales, isolation.fit(frame, None, "id", trees=30, sample=64), rates)
    return frame, steps.with_functions(scales, found).persist()


def test_cut_of_the_training_rows_judges_new_rows(spark):
    frame, models = outliers(spark)
    judged = steps.judged(frame, models).persist()
    assert judged.count() == frame.count()
    flagged = {r["field"]: (r["n"], r["k"]) for r in judged.groupBy("field").agg(F.count("*").alias("n"), F.sum("predicted").alias("k")).collect()}
    assert all(0 < flagged[f][1] <= 0.05 * 400 for f in "ab") and flagged[None] == (70, 0)
    alone = frame.where("id = 20").unionByName(spark.createDataFrame([(1, "a", 400.0), (2, "a", 0.1), (3, "new", 0.1)], LONG))
    got = {r["id"]: r["predicted"] for r in steps.judged(alone, models).collect()}
    assert got == {20: 1, 1: 1, 2: 0, 3: None}  # one row does not change the cut


def test_stored_models_judge_alike_in_batch_and_stream(spark, tmp_path):
    frame, models = outliers(spark)
    path, sent = str(tmp_path / "models"), str(tmp_path / "sent")
    steps.save(models, path, 1)
    steps.save(models.where("field = 'a'"), path, 2)
    steps.save(models.where("field = 'b'"), path, 2)  # replaces version 2 and leaves 1
    assert [r["field"] for r in steps.load(spark, path).collect()] == ["b"] and steps.load(spark, path, 1).count() == models.count()
    known = steps.load(spark, path, 1)
    rows = lambda f: sorted(map(str, f.collect()))
    assert rows(steps.judged(frame, known)) == rows(steps.judged(frame, models))
    frame.coalesce(2).write.parquet(sent)
    stream = spark.readStream.schema(frame.schema).parquet(sent)
    done = steps.judged(stream, known).writeStream.format("memory").queryName("judged").trigger(availableNow=True).start()
    done.awaitTermination()
    assert rows(spark.table("judged")) == rows(steps.judged(frame, models))


def test_small_dimensions_leave_the_facts_in_place(spark):
    facts = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("field"), F.rand(1).alias("value_num"))
    plan = lambda f: f._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan(S.scored(facts, S.baseline(facts)))
    names = facts.select("field").distinct()
    assert "_copy" in plan(lookup(facts, names, ["field"], at_most=2)) and "_copy" not in plan(lookup(facts, names, ["field"], at_most=3))
    heavy = lookup(facts, names, ["field"], at_most=29, weight=F.lit(10))
    assert "_copy" in plan(heavy) and heavy.count() == 1000


def test_nothing_to_train(spark):
    frame = planted(spark, ["a"]).limit(0)
    labels = S.feature_labels(frame, [], 2.5)
    models, predictions = feature_models(labels, S.anomaly_rates(labels), None, "id")
    assert models.count() == 0 and predictions.count() == 0
    assert steps.judged(planted(spark, ["a"], 20), models).where("predicted is null").count() == 20


def test_constant_field(spark):
    frame = spark.createDataFrame([(i, "c", 2.0) for i in range(50)], LONG)
    labels = frame.withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    rates = spark.createDataFrame([("c", 0.1)], "field string, anomaly_rate double")
    _, predictions = feature_models(labels, rates, ["c"], "id", trees=3)
    assert {(r["model"], r["count"]) for r in predictions.groupBy("model").count().collect()} == {("random_forest", 16), ("isolation_forest", 16)}


@pytest.mark.parametrize("size", [2**40, 10**15])
def test_bootstrap_of_huge_counts(size):
    counts = np.array([[size, 0], [size, size // 50], [0, size // 20]], np.int64)
    mean = steps.grow_forest(counts, 5, 3, 1, 42)
    assert mean[0] == 0.0 and mean[2] == 1.0 and 0 < mean[1] < 0.5
