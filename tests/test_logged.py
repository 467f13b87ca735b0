"""Tables with a commit log: repeated batches, broken attempts, merges and pruned listings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantwatch.operators import prepare as P
from plantwatch.sources import logged
from plantwatch.sources.adapters import readings
from plantwatch.sources.streams import stream_rows
from plantwatch.streaming import jobs as J

POINTS = "time timestamp_ntz, measurement string, field string, value_num double"


def contents(frame):
    return sorted(map(repr, frame.drop("date").collect()))


def folders(spark, table):
    return {(r["date"], r["commit"]) for r in logged._live(spark, table).collect()}


def days_read(frame):
    return {f.split("date=")[1].split("/")[0] for f in frame.inputFiles()}


@pytest.fixture
def points(rows):
    def build(*items):
        return rows([(t, "m", f, float(v)) for t, f, v in items], POINTS)

    return build


def test_a_stream_with_replays_merges_and_a_vacuum(spark, folder, tmp_path):
    long = readings(spark, folder)
    sent, table = str(tmp_path / "sent"), str(tmp_path / "table")
    for i in range(4):
        long.where(F.pmod(F.col("tie"), F.lit(4)) == i).coalesce(1).write.mode("append").parquet(sent)
    for run in ("a", "b"):  # the second run has lost its checkpoint: all batches come again
        J.ingest_logged(stream_rows(spark, sent, long.schema, files_per_trigger=1), table, str(tmp_path / run), merge_after=3).awaitTermination()
    read = lambda *days: logged.read(spark, table, *days, schema=long.schema)
    whole = contents(long)
    assert contents(read()) == whole
    assert len({c for _, c in folders(spark, table)}) == 2  # three batches merged, the fourth as it came
    assert logged.merge(spark, table)
    days = {d for d, _ in folders(spark, table)}
    assert len(folders(spark, table)) == len(days)
    assert logged.vacuum(spark, table) > 0 and logged.vacuum(spark, table) == 0
    assert contents(read()) == whole
    first, last = sorted(days)[3], sorted(days)[5]
    part = read(first, last)
    assert days_read(part) == {str(d) for d in days if first <= d <= last}
    assert contents(part) == contents(long.where(F.to_date("time").between(first, last)))
    J.ingest_logged(stream_rows(spark, sent, long.schema, files_per_trigger=1), table, str(tmp_path / "c")).awaitTermination()
    assert contents(read()) == whole  # batches whose commits are gone are known to be stored


def test_readers_see_whole_commits_only(spark, points, tmp_path):
    table = str(tmp_path / "table")
    schema = points().schema
    read = lambda: contents(logged.read(spark, table, schema=schema))
    assert read() == [] and logged.merge(spark, table) == [] and logged.vacuum(spark, table) == 0
    one = points(("2024-01-01 00:00:00", "a", 1), ("2024-01-01 00:00:00", "a", 1), (None, "b", 2), ("2024-01-02 00:00:00", None, 3))
    assert logged.commit_batch(one, table, 0) and not logged.commit_batch(one, table, 0)
    assert read() == contents(one)
    two = points(("2024-01-01 05:00:00", "a", 4), (None, "c", 5))
    files = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (None, 1)], "date date, _files int")
    logged._store(logged.dated(two), files, table, "batch-000000000001")  # ended before its commit
    logged._store(logged.dated(two), files, table, "merge-000000000000")
    assert read() == contents(one)
    assert logged.commit_batch(points(), table, 1) is True and read() == contents(one)
    assert logged.commit_batch(two, table, 2)
    assert read() == contents(one.unionByName(two))
    assert set(logged.merge(spark, table)) == {dt.date(2024, 1, 1), None}
    assert read() == contents(one.unionByName(two))
    assert (dt.date(2024, 1, 2), "batch-000000000000") in folders(spark, table)
    assert logged.vacuum(spark, table) > 0 and read() == contents(one.unionByName(two))


def test_files_follow_measured_bytes(spark, points, tmp_path):
    table = str(tmp_path / "table")
    some = spark.range(2000).select(
        F.lit("2024-01-01").cast("timestamp_ntz").alias("time"), F.lit("m").alias("measurement"), F.col("id").cast("string").alias("field"), F.rand(1).alias("value_num")
    )
    logged.commit_batch(some, table, 0)
    size = logged._live(spark, table).first()
    assert size["rows"] == 2000 and size["bytes"] > 1000
    logged.commit_batch(some, table, 1, file_bytes=size["bytes"] // 4)
    files = logged.read(spark, table, schema=some.schema).inputFiles()
    assert sum("commit=batch-000000000000" in f for f in files) == 1
    assert 4 <= sum("commit=batch-000000000001" in f for f in files) <= 8


def test_codes_of_many_classes(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 1000 != 7, F.concat(F.lit("c"), (F.col("id") * 7919 % 100_000).cast("string"))).alias("kind"), (F.col("id") * 2).alias("n")
    )
    found = {r["kind"]: r["kind_code"] for r in P.label_codes(rows, "kind").distinct().select("kind", "kind_code").collect()}
    classes = sorted(k for k in found if k is not None)
    assert len(classes) > 99_000 and found[None] is None
    assert [found[k] for k in classes] == list(range(len(classes)))
    coded = P.label_codes(rows, "kind")
    assert coded.count() == 200_000 and coded.columns == ["kind", "n", "kind_code"]
    assert P.label_codes(rows.limit(0), "kind").count() == 0
    assert P.label_codes(rows.where("kind is null"), "kind").select("kind_code").distinct().collect() == [(None,)]
