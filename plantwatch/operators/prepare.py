"""Data preparation: renaming, time shift, interval labels, merging normal and attack rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwatch.functions import times as T
from plantwatch.functions.labels import code_text_or
from plantwatch.functions.numbers import to_number
from plantwatch.operators.joins import lookup_by, stored
from plantwatch.schema import ATTACK_LABELS, ATTACK_WINDOWS, OTHER_SPELLINGS, RENAMES, UNKNOWN_ATTACK

#: Levels of the tree over time, from a microsecond on, each 16 times as long as the one below.
LEVELS = 15
#: Nodes of an interval table that are broadcast at most.
INTERVAL_NODES = 200_000
#: Slices of time in which rows meet a larger table: rows and stretches of each, and a power of two of slices at most.
SLICE_ROWS, MOST_SLICES = 10_000, 4096

# Columns that are never features.
NOT_FEATURES = [
    "Timestamp", "t_stamp", "Date", "Time", "label", "Attack", "attack_type", "attack_label", "Attack_Type",
    "_time", "time", "table", "result", "_start", "_stop", "_measurement", "measurement",
]


def renamed(rows: DataFrame, names: dict[str, str] = RENAMES | OTHER_SPELLINGS) -> DataFrame:
    return rows.withColumnsRenamed(names)


def unmapped_columns(rows: DataFrame, names: dict[str, str] = RENAMES | OTHER_SPELLINGS) -> list[str]:
    """Columns that the mapping does not cover, time and label aside."""
    return sorted(set(rows.columns) - set(names) - {"t_stamp", "Attack"})


def column_catalogue(rows: DataFrame) -> DataFrame:
    """Names and types of a frame's columns as a table."""
    return rows.sparkSession.createDataFrame(
        [(i, name, kind) for i, (name, kind) in enumerate(rows.dtypes)], "position int, column_name string, data_type string"
    )


def size_of(rows: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return rows.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(rows.columns)))


def without_system_columns(rows: DataFrame) -> DataFrame:
    """Drops columns with a leading underscore except ``_time``."""
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c == "_time" or not c.startswith("_")])


def in_plant_time(rows: DataFrame, source: str, target: str = "GMT +8") -> DataFrame:
    """Adds plant time and its 12-hour text, which keeps whole seconds."""
    return (
        rows.withColumn(target, T.to_plant_zone(F.col(source)))
        .withColumn("GMT_12hr", T.twelve_hour_text(F.col(target)))
        .withColumn("GMT_12hr_dt", T.whole_seconds(F.col(target)))
    )


def within_any(time: Column, intervals: list[tuple]) -> Column:
    """True inside any of the closed intervals; overlaps count once and a missing time is outside."""
    inside = reduce(lambda any_of, w: any_of | time.between(T.at(w[0]), T.at(w[1])), intervals, F.lit(False))
    return F.coalesce(inside, F.lit(False))


def interval_target(time: Column, intervals: list[tuple]) -> Column:
    """Target of the earliest interval that holds the time, null outside all."""
    ordered = sorted(intervals)
    return reduce(lambda rest, w: rest.when(time.between(T.at(w[0]), T.at(w[1])), F.lit(w[2])), ordered, F)


def labelled(rows: DataFrame, time: str, intervals: list[tuple] = ATTACK_WINDOWS, label: str = "Attack") -> DataFrame:
    """0/1 label by a fixed list of intervals: an expression on the row, no join."""
    return rows.withColumn(label, within_any(F.col(time), intervals).cast("int"))


def earliest_stretches(intervals: DataFrame, width_seconds: int = 86400) -> DataFrame:
    """low, high, interval: stretches of microseconds [low, high) that do not overlap, each with the earliest
    interval (start, end, target) that holds it.

    In the order of their starts, an interval adds what lies behind the ends of all before it. The
    latest end so far is carried over slices of ``width_seconds`` of starts, one row a slice.
    """
    target = F.col("target") if "target" in intervals.columns else F.lit(None).cast("string")
    distinct = intervals.where(F.col("start") <= F.col("end")).groupBy("start", "end").agg(F.min(target).alias("target"))
    placed = distinct.select(
        F.struct("start", "end", "target").alias("interval"), T.epoch_micros(F.col("start")).alias("_low"), T.epoch_micros(F.col("end")).alias("_last"),
        F.floor(T.epoch_seconds(F.col("start")) / width_seconds).alias("_slice"),
    )
    earlier_slices = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy("_slice").agg(F.max("_last").alias("_slice_last")).select("_slice", F.max("_slice_last").over(earlier_slices).alias("_carried"))
    earlier = Window.partitionBy("_slice").orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    behind = placed.withColumn("_own", F.max("_last").over(earlier)).join(carried, "_slice").withColumn("_covered", F.greatest("_own", "_carried"))
    stretches = behind.select(F.greatest(F.col("_low"), F.col("_covered") + 1).alias("low"), (F.col("_last") + 1).alias("high"), "interval")
    return stretches.where("low < high")


def _spans(level: int) -> tuple[Column, Column, Column, Column]:
    """Nodes of a level in a stretch [low, high): those from the first value up to the second, and from the third up to the fourth."""
    size = 4 * level
    first, last = F.shiftright(F.col("low") + ((1 << size) - 1), size), F.shiftright("high", size)
    if level == LEVELS - 1:
        return first, last, last, last
    inner_first, inner_last = F.shiftright(first + 15, 4) * 16, F.shiftright(last, 4) * 16
    inner = inner_first < inner_last
    return first, F.when(inner, inner_first).otherwise(last), F.when(inner, inner_last).otherwise(last), last


def interval_nodes(stretches: DataFrame, levels: list[int] | None = None) -> DataFrame:
    """level, node, interval: the stretches as nodes of a tree over time, of all levels or those given.

    A node of level l is a stretch of 16^l microseconds that begins at a multiple of it. Each stretch is
    the fewest nodes that make it up, at most 30 of a level: those of a level that the level
    above leaves over on either side.
    """

    def at(level: int) -> Column:
        left_first, left_end, right_first, right_end = _spans(level)
        none = F.array().cast("array<bigint>")
        left = F.when(left_first < left_end, F.sequence(left_first, left_end - 1)).otherwise(none)
        right = F.when(right_first < right_end, F.sequence(right_first, right_end - 1)).otherwise(none)
        return F.transform(F.concat(left, right), lambda node: F.struct(F.lit(level).alias("level"), node.alias("node")))

    return stretches.select("interval", F.inline(F.concat(*[at(level) for level in (range(LEVELS) if levels is None else levels)])))


def node_counts(stretches: DataFrame) -> dict[int, int]:
    """Number of nodes of each level that has any, from the ends of the stretches: no node is made for it."""

    def of(level: int) -> Column:
        left_first, left_end, right_first, right_end = _spans(level)
        return F.greatest(left_end - left_first, F.lit(0)) + F.greatest(right_end - right_first, F.lit(0))

    found = stretches.agg(*[F.sum(of(level)) for level in range(LEVELS)]).first()
    return {level: n for level, n in enumerate(found) if n}


def slice_bounds(times: DataFrame, rows_a_slice: int = SLICE_ROWS) -> list[int]:
    """Bounds between slices of about ``rows_a_slice`` of the microseconds in the only column: 2^k - 1 of them, at most MOST_SLICES - 1.

    They are quantiles, so an instant of many rows is a bound several times over. Without any time
    there are as many, as rows without one are dealt over slices too.
    """
    shares = F.split(F.lit(",".join(str(i / MOST_SLICES) for i in range(1, MOST_SLICES))), ",").cast("array<double>")
    n, found = times.agg(F.count(F.lit(1)), F.percentile_approx(times.columns[0], shares)).first()
    slices = 1
    while slices < MOST_SLICES and slices * rows_a_slice < n:
        slices *= 2
    step = MOST_SLICES // slices
    return (found or [0] * (MOST_SLICES - 1))[step - 1 :: step]


def slices_of(first: Column, last: Column, bounds: list[int]) -> tuple[Column, Column]:
    """First and last slice that times from ``first`` to ``last`` touch, a time at a bound those on both sides of it; null the first slice."""
    edges = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def passed(is_behind) -> Column:
        """Number of leading bounds that the condition holds for, by halving."""
        if not bounds:
            return F.lit(0)
        return F.aggregate(F.lit(steps), F.lit(0), lambda n, step: F.when(is_behind(F.element_at(edges, n + step)), n + step).otherwise(n))

    return passed(lambda edge: edge < first), passed(lambda edge: edge <= last)


def with_stretch(rows: DataFrame, stretches: DataFrame, time: str, rows_a_slice: int = SLICE_ROWS) -> DataFrame:
    """Adds ``interval``: that of the stretch that holds the row, else null.

    Rows and stretches meet in slices of time of about the same number of both. A stretch goes to each
    slice that it touches, which makes no more copies of all than there are bounds, as stretches do not overlap; a row
    goes to one slice, where only the last stretch that began can hold it. An instant of many rows
    has several slices, and rows without a time have all: a digest of the row says which.
    """
    micros = T.epoch_micros(F.col(time))
    bounds = slice_bounds(rows.select(micros.alias("_micros")).union(stretches.select("low")), rows_a_slice)
    first, last = slices_of(F.col("_micros"), F.col("_micros"), bounds)
    last = F.when(F.col("_micros").isNull(), F.lit(len(bounds))).otherwise(last)
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    facts = rows.withColumns({"_micros": micros, "_digest": digest}).withColumns({"_first": first, "_last": last})
    facts = facts.withColumns({"_slice": F.col("_first") + F.pmod("_digest", F.col("_last") - F.col("_first") + 1).cast("int"), "_is_row": F.lit(True)})
    touched = F.explode(F.sequence(*slices_of(F.col("low"), F.col("high") - 1, bounds)))
    pieces = stretches.select(F.col("low").alias("_micros"), touched.alias("_slice"), F.lit(False).alias("_is_row"), F.struct("high", "interval").alias("_stretch"))
    begun = Window.partitionBy("_slice").orderBy("_micros", "_is_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = facts.drop("_digest", "_first", "_last").unionByName(pieces, allowMissingColumns=True)
    found = both.withColumn("_stretch", F.last("_stretch", ignorenulls=True).over(begun)).where("_is_row")
    interval = F.when(F.col("_micros") < F.col("_stretch.high"), F.col("_stretch.interval"))
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], interval.alias("interval"))


def with_interval(rows: DataFrame, intervals: DataFrame, time: str, width_seconds: int = 86400, at_most: int = INTERVAL_NODES) -> DataFrame:
    """Adds ``interval``: the earliest interval (start, end, target) of a table that holds the row, else null.

    Made for interval tables of any size and intervals of any length. The nodes of the intervals do not
    overlap, so a time lies in one of them at most, and looks up one node for each level there is. Up to
    ``at_most`` nodes, counted, rows stay where they are, and many rows of one instant, or without a
    time, are no special case; rows may be a stream. Beyond, rows meet the stretches of the intervals in
    slices of time of about the same size, each row once and no row repeated.
    """
    stretches = stored(earliest_stretches(intervals, width_seconds), "stretches")
    counts = node_counts(stretches)
    if not rows.isStreaming and sum(counts.values()) > at_most:
        return with_stretch(rows, stretches, time)
    found = rows.withColumn("_micros", T.epoch_micros(F.col(time)))
    for level in counts:
        own = interval_nodes(stretches, [level]).select(F.col("node").alias("_node"), F.col("interval").alias(f"_at_{level}"))
        found = found.withColumn("_node", F.shiftright("_micros", 4 * level)).join(F.broadcast(own), "_node", "left").drop("_node")
    none = F.lit(None).cast(stretches.schema["interval"].dataType)
    return found.withColumn("interval", F.coalesce(*[F.col(f"_at_{level}") for level in counts], none)).drop("_micros", *[f"_at_{level}" for level in counts])


def labelled_by_table(rows: DataFrame, intervals: DataFrame, time: str, label: str = "Attack", width_seconds: int = 86400) -> DataFrame:
    """0/1 label by a table of closed intervals; overlapping intervals count once."""
    found = with_interval(rows, intervals, time, width_seconds)
    return found.withColumn(label, F.col("interval").isNotNull().cast("int")).drop("interval")


def targets_by_table(rows: DataFrame, intervals: DataFrame, time: str, width_seconds: int = 86400) -> DataFrame:
    """Target of the earliest interval of a table that holds the row."""
    found = with_interval(rows, intervals, time, width_seconds)
    return found.withColumn("target", F.col("interval.target")).drop("interval")


def numeric_columns(rows: DataFrame) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [name for name, kind in rows.dtypes if kind in kinds or kind.startswith("decimal")]


def common_features(left: DataFrame, right: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Sorted columns that both frames have and that are not time, key or label."""
    return sorted((set(left.columns) & set(right.columns)) - set(NOT_FEATURES) - set(exclude or []))


def merged(normal: DataFrame, attack: DataFrame) -> DataFrame:
    """Normal and attack rows with a 0/1 label; columns of either side are kept."""
    return normal.withColumn("Attack", F.lit(0)).unionByName(
        attack.withColumn("Attack", F.lit(1)), allowMissingColumns=True
    )


def merged_with_types(normal: DataFrame, attack: DataFrame) -> DataFrame:
    """As ``merged`` with the attack's type: given, looked up from its code, or unknown."""
    if "attack_type" in attack.columns:
        kind = F.col("attack_type")
    elif "attack_label" in attack.columns:
        kind = code_text_or(F.col("attack_label"), ATTACK_LABELS, UNKNOWN_ATTACK)
    else:
        kind = F.lit(UNKNOWN_ATTACK)
    return merged(normal.withColumn("Attack_Type", F.lit("Normal")), attack.withColumn("Attack_Type", kind))


def numeric_features(rows: DataFrame, features: list[str]) -> DataFrame:
    """Features as doubles; text that is no number becomes null."""
    kinds = dict(rows.dtypes)
    return rows.withColumns(
        {f: to_number(F.col(f)) if kinds[f] == "string" else F.col(f).cast("double") for f in features}
    )


def imputed(rows: DataFrame, features: list[str], training: DataFrame | None = None) -> DataFrame:
    """Missing features become the training rows' mean (one aggregate, one scalar subquery)."""
    means = (
        (training if training is not None else rows)
        .agg(F.struct(*[F.avg(f).alias(f) for f in features]).alias("m"))
        .scalar()
    )
    filled = {f: F.coalesce(F.col(f), F.col("_means")[f]) for f in features}
    return rows.withColumn("_means", means).withColumns(filled).drop("_means")


def class_distribution(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(label).agg(F.count("*").alias("n"))


def label_codes(rows: DataFrame, label: str) -> DataFrame:
    """Sorted classes numbered from 0, however many there are; a null class has no code.

    Distinct classes are stored in sorted slices, which are counted; a class's code is the number of
    classes in earlier slices and its place in its own. The codes are looked up by their measured size.
    """
    classes = rows.where(F.col(label).isNotNull()).select(label).distinct().repartitionByRange(label)
    classes = stored(classes.withColumn("_slice", F.spark_partition_id()), "classes")
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    sizes = classes.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(label))
    coded = classes.join(F.broadcast(before), "_slice").withColumn(f"{label}_code", (F.col("_before") + place - 1).cast("int"))
    return lookup_by(rows.drop(f"{label}_code"), coded.select(label, f"{label}_code"), label)


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * class size)."""
    sizes = class_distribution(rows, label)
    totals = sizes.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    return sizes.withColumn("weight", totals["n"] / (totals["k"] * F.col("n")))
