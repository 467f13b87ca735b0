"""Point tables with a commit log: days outermost, batches that count once, files sized by measured bytes.

    <table>/data/date=<day>/commit=<name>/part-*.parquet
    <table>/log/<name>/            one row per day that the commit stored, complete once Spark has marked it

Rows exist for readers from the moment their commit is complete; folders of failed attempts are in no
commit and are never read. A merge rewrites days that lie in many folders and puts the whole list of live
folders into one commit, so readers see all of it or nothing, and the list to read does not grow with batches.
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwatch.schema import FIELD, LONG_SCHEMA, MEASUREMENT, TIME
from plantwatch.sources.sinks import dated

#: Bytes that a file should have, and those of a row while the table has none to measure.
FILE_BYTES = 256 << 20
ROW_BYTES = 64
BATCH, MERGE = "batch", "merge"
LOG = "date date, commit string, rows long, bytes long, upto long"


def commit_batch(rows: DataFrame, table: str, batch_id: int, file_bytes: int = FILE_BYTES) -> bool:
    """Stores a batch of a stream as a commit of its own; False if that batch is stored already.

    Rows without a time are kept under the null day. A batch that failed half-way is written anew. An
    empty batch is a commit without days. One writer per table; merges may run beside it.
    """
    spark, name = rows.sparkSession, _name(BATCH, batch_id)
    merged = _newest_merge(spark, table)
    if _complete(spark, table, name) or (merged is not None and batch_id <= _upto(spark, table, merged)):
        return False
    kept = dated(rows).persist()
    try:
        sizes = kept.groupBy("date").agg(F.count(F.lit(1)).alias("_rows"))
        per_row = _row_bytes(spark, table)
        files = sizes.select("date", F.ceil(F.col("_rows") * F.lit(per_row) / F.lit(file_bytes)).cast("int").alias("_files"))
        _store(kept, files, table, name, math.ceil(file_bytes / per_row))
    finally:
        kept.unpersist()
    _commit(_measured(spark, table, name, rows.schema), table, name, batch_id)
    return True


def merge(spark: SparkSession, table: str, at_least: int = 2, file_bytes: int = FILE_BYTES) -> list[datetime.date | None]:
    """Days with ``at_least`` live folders or more become one folder each; the days that were rewritten.

    Batches committed meanwhile are untouched: the merge lists what was live when it began and the
    last batch that this holds. Without such days nothing is written.
    """
    live = _live(spark, table).persist()
    try:
        days = [r["date"] for r in live.groupBy("date").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least).collect()]
        if not days:
            return []
        upto = live.agg(F.max("upto")).first()[0]
        newest = _newest_merge(spark, table)
        name = _name(MERGE, 0 if newest is None else int(newest.rsplit("-", 1)[1]) + 1)
        chosen = live.where(_on(days))
        files = chosen.groupBy("date").agg(F.ceil(F.sum("bytes") / F.lit(file_bytes)).cast("int").alias("_files"))
        rows = _folders(spark, table, chosen)
        _store(rows.drop("commit"), files, table, name, math.ceil(file_bytes / _row_bytes(spark, table)))
        stored = _measured(spark, table, name, rows.drop("date", "commit").schema)
        _commit(stored.unionByName(live.where(~_on(days)).drop("upto")), table, name, upto)
        return days
    finally:
        live.unpersist()


def read(
    spark: SparkSession, table: str, first: datetime.date | None = None, last: datetime.date | None = None, schema: T.StructType = LONG_SCHEMA
) -> DataFrame:
    """Rows of all complete commits, of the days from ``first`` to ``last`` where given; no folder of another day is listed.

    The driver holds one name per live folder: days, times the batches since the last merge.
    """
    live = _live(spark, table)
    live = live.where(F.col("date") >= F.lit(first)) if first else live
    live = live.where(F.col("date") <= F.lit(last)) if last else live
    return _folders(spark, table, live, schema).drop("commit")


def vacuum(spark: SparkSession, table: str) -> int:
    """Deletes data folders and commits that the newest merge replaced; how many. Only once no reader is at the old ones."""
    newest = _newest_merge(spark, table)
    if newest is None:
        return 0
    upto = _upto(spark, table, newest)
    live = {_folder(table, r["date"], r["commit"]).split("/data/")[-1] for r in _live(spark, table).collect()}
    replaced = lambda name: name < newest if name.startswith(MERGE) else int(name.rsplit("-", 1)[1]) <= upto
    fs, path = _files(spark, table)
    gone = [path(f"{table}/log/{name}") for name in _commits(spark, table) if replaced(name)]
    for status in fs.globStatus(path(f"{table}/data/date=*/commit=*")) or []:
        folder = status.getPath()
        day, commit = folder.getParent().getName(), folder.getName()
        if f"{day}/{commit}" not in live and replaced(commit.removeprefix("commit=")):
            gone.append(folder)
    for old in gone:
        fs.delete(old, True)
    return len(gone)


def _name(kind: str, number: int) -> str:
    return f"{kind}-{number:012d}"


def _files(spark: SparkSession, table: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(table).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _commits(spark: SparkSession, table: str) -> list[str]:
    """Names of the complete commits: those that Spark's committer has marked."""
    fs, path = _files(spark, table)
    return sorted(s.getPath().getParent().getName() for s in fs.globStatus(path(f"{table}/log/*/_SUCCESS")) or [])


def _complete(spark: SparkSession, table: str, name: str) -> bool:
    fs, path = _files(spark, table)
    return fs.exists(path(f"{table}/log/{name}/_SUCCESS"))


def _newest_merge(spark: SparkSession, table: str) -> str | None:
    return max((c for c in _commits(spark, table) if c.startswith(MERGE)), default=None)


def _upto(spark: SparkSession, table: str, merge_name: str) -> int:
    return spark.read.schema(LOG).parquet(f"{table}/log/{merge_name}").agg(F.max("upto")).first()[0]


def _live(spark: SparkSession, table: str) -> DataFrame:
    """One row per live folder: those of the newest merge and of the batches after it."""
    newest = _newest_merge(spark, table)
    after = -1 if newest is None else _upto(spark, table, newest)
    names = [c for c in _commits(spark, table) if c == newest or (c.startswith(BATCH) and int(c.rsplit("-", 1)[1]) > after)]
    if not names:
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(*[f"{table}/log/{c}" for c in names]).where("commit is not null")


def _row_bytes(spark: SparkSession, table: str) -> float:
    total = _live(spark, table).agg(F.sum("bytes").alias("b"), F.sum("rows").alias("n")).first()
    return total["b"] / total["n"] if total["n"] else float(ROW_BYTES)


def _store(rows: DataFrame, files: DataFrame, table: str, name: str, most: int = 0) -> None:
    """The rows of a commit, each day spread over its number of files and sorted by field, ``most`` rows a file.

    What a failed attempt under that name left goes first: its days need not be those of this one.
    """
    fs, path = _files(rows.sparkSession, table)
    for status in fs.globStatus(path(f"{table}/data/date=*/commit={name}")) or []:
        fs.delete(status.getPath(), True)
    sized = F.broadcast(files.withColumnRenamed("date", "_day"))  # one row per day
    spread = F.pmod(F.xxhash64(MEASUREMENT, FIELD, TIME), F.greatest(F.col("_files"), F.lit(1)))
    placed = rows.join(sized, F.col("date").eqNullSafe(F.col("_day"))).withColumn("_file", spread).withColumn("commit", F.lit(name))
    ordered = placed.repartition("date", "_file").sortWithinPartitions("date", MEASUREMENT, FIELD, TIME).drop("_day", "_files", "_file")
    ordered.write.mode("append").option("maxRecordsPerFile", most).partitionBy("date", "commit").parquet(f"{table}/data")


def _measured(spark: SparkSession, table: str, name: str, schema) -> DataFrame:
    """Rows and bytes of each day of a commit, from the files themselves."""
    fs, path = _files(spark, table)
    found = [s.getPath().toString() for s in fs.globStatus(path(f"{table}/data/date=*/commit={name}")) or []]
    if not found:
        return spark.createDataFrame([], LOG).drop("upto")
    stored = spark.read.option("basePath", f"{table}/data").schema(_with_parts(schema)).parquet(*found)
    per_file = stored.groupBy("date", "commit", F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes")
    )
    return per_file.groupBy("date", "commit").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))


def _commit(folders: DataFrame, table: str, name: str, upto: int) -> None:
    """An entry without a folder says which batch the commit reaches, also when it stored nothing."""
    end = folders.sparkSession.createDataFrame([(None, None, 0, 0, upto)], LOG)
    rows = folders.withColumn("upto", F.lit(upto).cast("long")).select("date", "commit", "rows", "bytes", "upto").unionByName(end)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{table}/log/{name}")


def _with_parts(schema):
    own = [f for f in schema.fields if f.name not in ("date", "commit")]
    return T.StructType([*own, T.StructField("date", T.DateType()), T.StructField("commit", T.StringType())])


def _on(days: list) -> Column:
    known = [F.lit(d) for d in days if d is not None]
    listed = F.coalesce(F.col("date").isin(*known), F.lit(False)) if known else F.lit(False)
    return listed | (F.col("date").isNull() & F.lit(None in days))


def _folder(table: str, day: datetime.date | None, commit: str) -> str:
    return f"{table}/data/date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}/commit={commit}"


def _folders(spark: SparkSession, table: str, live: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    names = [_folder(table, r["date"], r["commit"]) for r in live.select("date", "commit").collect()]
    if not names:
        return spark.createDataFrame([], _with_parts(schema))
    reader = spark.read.option("basePath", f"{table}/data")
    rows = (reader.schema(_with_parts(schema)) if schema else reader).parquet(*names)
    return rows.withColumn("date", F.col("date").cast("date"))
