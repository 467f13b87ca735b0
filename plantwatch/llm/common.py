"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantwatch.session import shared_folder

#: Rows below which a counted table is broadcast; beyond, Spark's own join is used.
BROADCAST_ROWS = 200_000
#: Bytes of text that one numpy pass takes; a longer text is a pass of its own.
SLAB_BYTES = 1 << 20
#: Bytes of one batch between an executor and its Python workers; both sides hold it, some stages twice.
BATCH_BYTES = 4 << 20

#: Folders that ``saved`` wrote inside the ``scratch`` that is open, if one is.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)

#: In a Python worker: how to drop what modules keep between tasks, and the module whose task ran last.
_KEPT: list[Callable[[], None]] = []
_RAN: list[str] = []


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(frame: DataFrame, purpose: str, stays: bool = False) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back: cuts the lineage,
    survives lost executors and is computed once however often it is used. Inside ``scratch``
    it goes at the end of that, unless it ``stays``."""
    path = shared_folder(frame.sparkSession, purpose)
    if not stays and _WRITTEN.get() is not None:
        _WRITTEN.get().append(path)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``saved`` wrote inside it. No frame that still reads such a table may leave it."""
    written: list[str] = []
    token = _WRITTEN.set(written)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path
        for folder in map(path, written):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_or_plain(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The (saved) frame marked for broadcast if its counted rows are at most ``rows``."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def set_aside(docs: DataFrame, used: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with all columns but the used ones under names that clash with nothing, and how to get them back."""
    inner = {n: n if n in used else f"_aside_{i}" for i, n in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(f"`{n}`").alias(k) for n, k in inner.items()))
    return renamed, lambda frame: frame.select(*(F.col(k).alias(n) for n, k in inner.items()))


def text_key(column: Column | str) -> Column:
    """A key without nulls, so that plain joins and windows keep rows whose value is null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), value.cast("string")))


def in_order(rows: DataFrame, keys: list[str], slices: list[str], order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: the place from 1 of each row among the rows of its ``keys``, by ``slices`` then ``order``.

    No task sorts a whole key: slices are counted with partial aggregation, their counts are
    summed per key, and only the rows of one slice are sorted together. ``keys`` and ``slices``
    must not hold nulls.
    """
    counts = saved(rows.groupBy(*keys, *slices).agg(F.count(F.lit(1)).alias("_rows")), "slices")
    before = counted_before(counts, keys, slices)
    placed = rows.join(small_or_plain(before), [*keys, *slices])
    own = Window.partitionBy(*keys, *slices).orderBy(*order)
    return placed.withColumn(name, F.col("_before") + F.row_number().over(own)).drop("_before")


def counted_before(counts: DataFrame, keys: list[str], slices: list[str]) -> DataFrame:
    earlier = Window.partitionBy(*keys).orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, *slices, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))


def small_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Batches to Python workers by bytes in this session: by rows alone, ten thousand long texts are one batch.

    Only how rows travel changes, no result. A row larger than ``limit`` is a batch of its own.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def keeps(forget: Callable[[], None]) -> None:
    """Names what drops a module's tables, which workers keep between tasks: no longer than that module's tasks follow each other."""
    _KEPT.append(forget)


def begin(module: str) -> None:
    """A task of the module begins in this worker: what others keep goes."""
    if _RAN != [module]:
        _RAN[:] = [module]
        for forget in _KEPT:
            forget()
        hand_back()


def hand_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def freed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task's function, after which its worker hands unused memory back; workers live on between tasks,
    beside an executor's heap, and would each keep the most they ever held."""

    def task(batches: Iterator) -> Iterator:
        begin(run.__module__)
        try:
            yield from run(batches)
        finally:
            hand_back()

    return task


def by_slab(
    make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: ``make()`` gives, once per task, a function from a batch to columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start, end in cuts(batch):
                yield pa.RecordBatch.from_pydict(work(batch.slice(start, end - start)), schema)

    return run


def cuts(batch: pa.RecordBatch, limit: int = SLAB_BYTES, column: str = "text") -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts have about ``limit`` bytes."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def joined_bytes(texts: list[bytes], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte array of all texts, each followed by ``gap`` zero bytes, with starts and ends."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + gap) - gap
    return np.frombuffer((b"\0" * gap).join([*texts, b""]), np.uint8), ends - lengths, ends


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
