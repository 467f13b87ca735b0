"""Order-sensitive operators over long series.

A series may hold a large part of all rows, so none of these sorts a whole series
in one task. Rows are split by (series, time slice); each slice is ordered on its
own, and a small table with one row per slice carries the state from slice to
slice. Slice width is a parameter: it bounds what one task sorts. A null in a series
column is a series of its own, a null time comes first: slices are joined on a struct,
which is never null itself and whose null members are equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.functions.times import epoch_seconds

SLICE = "_slice"
SLICE_SECONDS = 600


def time_slice(time: str, seconds: int = SLICE_SECONDS) -> Column:
    """Number of the time slice; a slice should hold a few million rows of the busiest series at most."""
    return F.floor(epoch_seconds(F.col(time)) / seconds)


def with_previous(
    rows: DataFrame, series: list[str], order: list[str], value: Column, name: str, width: int = SLICE_SECONDS
) -> DataFrame:
    """Adds the value of the row before, within the series and across slices."""
    sliced = rows.withColumn(SLICE, _key(series, time_slice(order[0], width))).withColumn("_now", F.struct(value.alias("v")))
    inside = Window.partitionBy(SLICE).orderBy(*order)
    lasts = sliced.groupBy(SLICE).agg(F.max_by("_now", F.struct(*order)).alias("_last"))
    carried = lasts.select(SLICE, F.lag("_last").over(_by_slice()).alias("_carried"))
    before = sliced.withColumn("_before", F.lag("_now").over(inside))
    return (
        before.join(carried, SLICE, "left")
        .withColumn(name, F.coalesce("_before", "_carried")["v"])
        .drop(SLICE, "_now", "_before", "_carried")
    )


def numbered(rows: DataFrame, group: list[str], slice_of: Column, order: list[str], name: str) -> DataFrame:
    """Adds the row's position (from 1) within its group.

    ``slice_of`` must rise with ``order``: every row of a lower slice precedes every
    row of a higher one. Positions inside a slice are counted locally and shifted by
    the size of the slices before it.
    """
    sliced = rows.withColumn(SLICE, _key(group, slice_of))
    earlier = _by_slice().rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.groupBy(SLICE)
        .agg(F.count("*").alias("_size"))
        .select(SLICE, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    )
    local = F.row_number().over(Window.partitionBy(SLICE).orderBy(*order))
    return (
        sliced.withColumn("_local", local)
        .join(shifts, SLICE)
        .withColumn(name, F.col("_shift") + F.col("_local"))
        .drop(SLICE, "_local", "_shift")
    )


def runs(
    rows: DataFrame,
    series: list[str],
    time: str,
    tie: str,
    breaks: Callable[[Column, Column], Column],
    state: Column | None = None,
    total: Column | None = None,
    width: int = SLICE_SECONDS,
) -> DataFrame:
    """Consecutive rows of a series as runs; a new run starts where ``breaks(previous, current)``.

    Both arguments of ``breaks`` are structs (time, state). Sessions cut at a time
    gap, state runs cut at a change. Result: series, run_start, run_end, run_rows,
    run_total, run_state. A run is known by the time and tie of its first row, so runs
    that start at one instant stay apart; ties are unique within a series and time.
    Where ``breaks`` gives null, as between states of which one is null, no new run starts.
    """
    item = F.struct(F.col(time).alias("time"), (F.lit(None) if state is None else state).alias("state"), F.col(tie).alias("tie"))
    sliced = rows.select(
        F.col(time).alias("_time"),
        F.col(tie).alias("_tie"),
        item.alias("_item"),
        (F.lit(0.0) if total is None else total.cast("double")).alias("_total"),
        _key(series, time_slice(time, width)).alias(SLICE),
    )
    parted = lambda before, now: F.coalesce(breaks(before, now), F.lit(False))
    inside = Window.partitionBy(SLICE).orderBy("_time", "_tie")
    previous = F.lag("_item").over(inside)
    pieces = (
        sliced.withColumn("_previous", previous)
        .withColumn("_starts", (F.col("_previous").isNull() | parted(F.col("_previous"), F.col("_item"))).cast("int"))
        .withColumn("_piece", F.sum("_starts").over(inside))
        .groupBy(SLICE, "_piece")
        .agg(
            F.min_by("_item", F.struct("_time", "_tie")).alias("_first"),
            F.max_by("_item", F.struct("_time", "_tie")).alias("_last"),
            F.count("*").alias("_rows"),
            F.sum("_total").alias("_total"),
        )
    )
    edges = pieces.groupBy(SLICE).agg(
        F.min_by("_first", "_piece").alias("_slice_first"),
        F.max_by("_last", "_piece").alias("_slice_last"),
        F.max_by("_first", "_piece").alias("_final_first"),
        F.max("_piece").alias("_pieces"),
    ).withColumns({"_series": F.col(f"{SLICE}.series"), "_slice_number": F.col(f"{SLICE}.slice")})
    # by columns, not by fields of the key: windows over one column share a shuffle
    over_slices = Window.partitionBy("_series").orderBy("_slice_number")
    earlier_last = F.lag("_slice_last").over(over_slices)
    linked = edges.withColumn("_earlier", earlier_last).withColumn(
        "_joins", F.col("_earlier").isNotNull() & ~parted(F.col("_earlier"), F.col("_slice_first"))
    )
    begun = lambda first: F.struct(first["time"].alias("time"), first["tie"].alias("tie"))
    opened = F.when((F.col("_pieces") > 1) | ~F.col("_joins"), begun(F.col("_final_first")))
    current = F.last(opened, ignorenulls=True).over(over_slices.rowsBetween(Window.unboundedPreceding, 0))
    carried = (
        linked.withColumn("_current", current)
        .withColumn("_inherited", F.lag("_current").over(over_slices))
        .select(SLICE, F.when(F.col("_joins"), F.col("_inherited")).alias("_inherited"))
    )
    start = F.when(F.col("_piece") == 1, F.col("_inherited"))
    return (
        pieces.join(carried, SLICE)
        .withColumn("_run", F.coalesce(start, begun(F.col("_first"))))
        .groupBy(F.col(f"{SLICE}.series").alias("_series"), "_run")
        .agg(
            F.max(F.col("_last")["time"]).alias("run_end"),
            F.sum("_rows").alias("run_rows"),
            F.sum("_total").alias("run_total"),
            F.max_by(F.col("_last")["state"], begun(F.col("_last"))).alias("run_state"),
        )
        .select(
            *[F.col("_series")[f"s{i}"].alias(c) for i, c in enumerate(series)],
            F.col("_run")["time"].alias("run_start"), "run_end", "run_rows", "run_total", "run_state",
        )
    )


def _key(series: list[str], slice_of: Column) -> Column:
    """Series and slice as one value for grouping and joining, in which nulls are equal."""
    of = [F.col(c).alias(f"s{i}") for i, c in enumerate(series)] or [F.lit(0).alias("s0")]
    return F.struct(F.struct(*of).alias("series"), slice_of.alias("slice"))


def _by_slice():
    """The slices of a series in order; a frame of one row per slice."""
    return Window.partitionBy(f"{SLICE}.series").orderBy(f"{SLICE}.slice")


def first_rows(rows: DataFrame, series: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows of every series. Spark trims each partition to n rows per series before the shuffle."""
    position = F.row_number().over(Window.partitionBy(*series).orderBy(*order))
    return rows.withColumn("_position", position).where(F.col("_position") <= n).drop("_position")


def top_rows(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First n rows overall; every partition keeps n, so nothing is sorted as a whole."""
    return rows.orderBy(*order).limit(n)


def running_total(
    rows: DataFrame, slice_of: Column, order: list[str], value: Column, name: str, by: list[str] | None = None
) -> DataFrame:
    """Adds the sum of a value up to and including each row, over all rows or those of its group.

    ``slice_of`` must rise with ``order``, as in ``numbered``; slices are few. Groups are not null.
    """
    by = by or []
    sliced = rows.withColumn(SLICE, slice_of).withColumn("_value", value)
    earlier = Window.partitionBy(F.lit(0), *by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.groupBy(*by, SLICE)
        .agg(F.sum("_value").alias("_sum"))
        .select(*by, SLICE, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    )
    upto = Window.partitionBy(*by, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_local", F.sum("_value").over(upto))
        .join(shifts, [*by, SLICE])
        .withColumn(name, F.col("_shift") + F.col("_local"))
        .drop(SLICE, "_value", "_local", "_shift")
    )
